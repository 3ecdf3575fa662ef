"""Partition invariance of the skew-safe plans: the same rows for 1 and 7 shuffle partitions."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF001

NAMES = ["group_transcript", "dm_transcript", "group_events_render", "chat_window", "lookup_batches",
         "id_universe", "lookup_gate", "padded_batches"]


@pytest.mark.parametrize("name", NAMES)
def test_same_rows_for_any_partitioning(spark, name):
    prev = spark.conf.get("spark.sql.shuffle.partitions")
    got = []
    try:
        for n in ("1", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            df = E.queries()[name](spark, SF001)
            got.append(sorted(tuple(str(v) for v in r) for r in df.collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", prev)
    assert got[0] == got[1]
    assert len(got[0]) > 0
