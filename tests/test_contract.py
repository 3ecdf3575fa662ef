"""Driver contract: entry runs, every query has a callable, oracles agree at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF001

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["doc_id", "round", "arm", "instruction", "input", "output"]
    assert df.count() > 0


def test_registry_consistent():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 50


@pytest.mark.parametrize("name", ["instruction_corpus", "reply_pairs", "dm_transcript", "encode_rows",
                                  "media_resolve", "lookup_batches", "group_name", "thread_context"])
def test_oracle_small(spark, name):
    from tools.oracle_check import rows_of
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    df = E.queries()[name](spark, SF001)
    res = con.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(res.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(res.columns, res.fetchall())
