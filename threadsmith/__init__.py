"""threadsmith: social-archive and conversation-log corpus building on Spark DataFrames.

Every operator is a ``DataFrame -> DataFrame`` function (usable with ``df.transform``)
or a ``Column`` helper built from ``pyspark.sql.functions``.  Random choices are
deterministic md5-derived uniforms so that results are stable under task retry and
re-partitioning and can be checked against an independent SQL oracle.

Functions that run inside tasks are sent to the executors by value, so that these need no copy of the package.
"""

import sys

from pyspark import cloudpickle

from threadsmith.config import CorpusConfig

__all__ = ["CorpusConfig"]
__version__ = "0.1.0"

cloudpickle.register_pickle_by_value(sys.modules[__name__])
