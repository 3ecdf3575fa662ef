"""Query bindings to the driver tables; importing this package fills the registry."""

from threadsmith.plans import archive_plans, cache_plans, corpus_plans, identity_plans, media_plans, post_plans, segment_plans, sink_plans, trainset_plans, transcript_plans  # noqa: F401
from threadsmith.plans.registry import ORACLES, QUERIES  # noqa: F401
