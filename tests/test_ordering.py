"""The skew-safe ordered index equals a per-group enumeration, also for a hot group."""

from pyspark.sql import functions as F

from threadsmith.operators.ordering import ordered_index, part_numbers


def test_ordered_index_hot_group(spark):
    rows = [("hot", i, (i * 7919) % 1000) for i in range(3000)] + [(f"g{j}", i, i) for j in range(20) for i in range(5)]
    df = spark.createDataFrame(rows, "g string, seq int, ts int")
    out = ordered_index(df, ["g"], ["ts", "seq"], idx_col="idx", stride=100).collect()
    by = {}
    for r in out:
        by.setdefault(r.g, []).append(r)
    for g, rs in by.items():
        want = sorted(rs, key=lambda r: (r.ts, r.seq))
        assert [r.idx for r in want] == list(range(len(rs))), g


def test_part_numbers(spark):
    df = spark.createDataFrame([("a", i) for i in range(25)] + [("b", i) for i in range(10)], "g string, t int")
    p = part_numbers(df, ["g"], ["t"], 10).groupBy("g", "part").agg(F.count("*").alias("n")).collect()
    got = sorted((r.g, r.part, r.n) for r in p)
    assert got == [("a", 1, 10), ("a", 2, 10), ("a", 3, 5), ("b", None, 10)]


def test_ordered_index_consistent_over_shuffled_input(spark):
    """Input whose row order comes from a shuffle (fetch order varies) and a payload column that the
    count branch does not read: the index must still equal the position in a plain sort."""
    from pyspark.sql import functions as F
    from threadsmith.operators.ordering import ordered_index
    base = spark.range(0, 6000).select(
        (F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 40)).alias("g"),
        ((F.col("id") * 7919) % 6000).alias("o"),
        F.repeat(F.lit("x"), 50).alias("payload"))
    # a coalescable upstream shuffle with a tiny advisory size: AQE coalesces it by bytes,
    # so a branch that prunes the payload would see differently grouped input partitions
    shuffled = base.repartition("o")
    prev = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4k")
    try:
        for _ in range(2):
            got = {(r.g, r.o): r.idx for r in ordered_index(shuffled, ["g"], ["o"], stride=64).collect()}
            want = {}
            for g in {k[0] for k in got}:
                for i, o in enumerate(sorted(o for gg, o in got if gg == g)):
                    want[(g, o)] = i
            assert got == want
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", prev)


def test_hashed_index_numbers_all_rows_once(spark):
    from threadsmith.functions.draws import uniform
    from threadsmith.operators.ordering import hashed_index
    df = spark.range(5000).withColumn("k", F.col("id") % 4999).repartition(7)
    rows = hashed_index(df.withColumn("u", uniform(["k"], "order", "1")), F.col("u"), ["id"]).collect()
    assert [r.idx for r in sorted(rows, key=lambda r: (r.u, r.id))] == list(range(5000))


def test_order_by_time_null_and_negative(spark):
    rows = [("g", None), ("g", -5), ("g", 10 ** 6), ("g", 3), (None, 1), (None, 2)]
    df = spark.createDataFrame(rows, "g string, t long")
    got = sorted((str(r.g), -1e9 if r.t is None else r.t, r.idx) for r in ordered_index(df, ["g"], ["t"], stride=2).collect())
    assert got == [("None", 1, 0), ("None", 2, 1), ("g", -1e9, 0), ("g", -5, 1), ("g", 3, 2), ("g", 10 ** 6, 3)]


def test_wide_rows_are_shuffled_once_and_numbered_alike(spark):
    """A group and its stride as one value, null groups among them, give the same numbers without a second shuffle."""
    rows = [(g, t, f"{g}-{t}") for g in (None, 1, 2) for t in range(0, 90, 7)]
    df = spark.createDataFrame(rows, "g int, t int, text string")
    number = lambda wide: ordered_index(df, ["g"], ["t"], count_col="n", stride=16, running={"sum": F.col("t")}, wide=wide)
    assert sorted(map(str, number(True).collect())) == sorted(map(str, number(False).collect()))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffles = [number(w)._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") for w in (True, False)]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert shuffles[0] == shuffles[1] - 1
