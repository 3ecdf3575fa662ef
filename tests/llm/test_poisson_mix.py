import math

from pyspark.sql import functions as F

from tests.llm.helpers import with_clashes
from threadsmith.llm import poisson_mix as p


def table(spark):
    return spark.range(6000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"),
                                    F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, "b").alias("source"))


def test_counts_follow_the_rates_and_copies_are_whole(spark):
    docs = table(spark)
    out = p.mix_sources(docs, weights={"hot": 3.0, "b": 1.0, None: 0.5}).cache()
    n = {r.source: r["count"] for r in out.groupBy("source").count().collect()}
    for source, weight in (("hot", 3.0), ("b", 1.0), (None, 0.5)):
        want = 6000 * weight / 4.5
        assert abs(n[source] - want) < 5 * math.sqrt(want)
    per = out.groupBy("doc_id").agg(F.max("mix_copy").alias("m"), F.count("*").alias("n"), F.countDistinct("mix_key").alias("k"))
    assert per.where("m <> n OR k <> n").count() == 0


def test_counts_are_poisson(spark):
    docs = spark.range(20000).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"))
    got = {r.n: r["count"] for r in p.mix_sources(docs, total=2.0).groupBy("doc_id").agg(
        F.count("*").alias("n")).groupBy("n").count().collect()}
    for k in range(1, 6):
        want = 20000 * math.exp(-2) * 2 ** k / math.factorial(k)
        assert abs(got[k] - want) < 5 * math.sqrt(want)


def test_salted_join_gives_the_same_rows(spark, monkeypatch):
    docs = table(spark)
    rows = sorted(tuple(r) for r in p.mix_sources(docs).select("doc_id", "mix_copy", "mix_key").collect())
    monkeypatch.setattr(p, "BROADCAST_SOURCES", 1)
    assert sorted(tuple(r) for r in p.mix_sources(docs.repartition(5)).select("doc_id", "mix_copy", "mix_key").collect()) == rows


def test_large_rates_and_odd_rows(spark):
    rates = spark.createDataFrame([(0.0,), (0.3,), (900.0,)], "r double").select("r", p.poisson_table(F.col("r")).alias("c"))
    for r in rates.collect():
        assert abs(r.c[-1] - 1) < 1e-9 and r.c == sorted(r.c)
    docs = with_clashes(spark.createDataFrame([(1, None, "a"), (1, None, "a"), (None, "", None)],
                                              "doc_id long, text string, source string"))
    out = p.mix_sources(docs, total=50.0)
    assert set(out.columns) == set(docs.columns) and out.columns[-2:] == ["mix_copy", "mix_key"]
    assert out.where("doc_id = 1").count() % 2 == 0 and out.where("doc_id IS NULL").count() > 0
    assert p.mix_sources(docs.limit(0)).count() == 0


def test_clashing_columns_come_back_unchanged(spark):
    docs = with_clashes(spark.createDataFrame([(i, "t", "s") for i in range(30)], "doc_id long, text string, source string"))
    kept = [c for c in docs.columns if c not in ("doc_id", "text", "source", "mix_copy", "mix_key")]
    rows = p.mix_sources(docs, total=3.0).collect()
    assert rows and all(r[c] == "clash" for r in rows for c in kept) and "mix_n" in kept
