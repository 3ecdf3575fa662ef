"""The retry ledger: odd results, and one pass by hash over them."""

from pyspark.sql import functions as F

from threadsmith.operators import media

RESULTS = [("a", 1, False, 5), ("a", 1, False, 7), ("a", 2, True, 3), ("a", 2, False, 90), ("b", 1, False, None), ("b", 2, True, None),
           ("c", 0, True, 4), ("c", 6, True, 4), ("d", 2, True, 8), *[("e", n, False, n) for n in range(1, 6)], (None, 1, True, 6),
           ("f", 1, None, 9), ("f", 1, False, 2)]
KIND = "file string, round int, success boolean, bytes long"


def test_odd_results(spark):
    got = {r.file: (r.attempts, r.state, r.bytes) for r in media.retry_ledger(spark.createDataFrame(RESULTS, KIND)).collect()}
    assert got["a"] == (2, "best", 10) and got["b"][:2] == (2, "best") and got["c"] == (0, "pending", 0)
    assert got["d"] == (0, "pending", 0) and got["e"] == (5, "failed", 15) and got["f"] == (1, "pending", 2)
    assert got[None] == (0, "pending", 0)  # without a name nothing says which file it was


def test_one_pass_by_hash(spark):
    plan = media.retry_ledger(spark.createDataFrame(RESULTS, KIND).where(F.col("round") > 0))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert not any(x in plan for x in ("Sort", "Join", "ObjectHashAggregate"))
