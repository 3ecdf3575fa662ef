import duckdb
from pyspark.sql import functions as F

from threadsmith.functions.draws import sql_uniform, uniform


def test_uniform_matches_duckdb_twin(spark):
    ids = list(range(0, 500, 7))
    df = spark.createDataFrame([(i,) for i in ids], "id long").withColumn("round", F.lit(1))
    got = {r.id: r.u for r in df.select("id", uniform(["id", "round"], "arm").alias("u")).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t AS SELECT unnest(range(0, 500, 7)) AS id, 1 AS round")
    want = dict(con.sql(f"SELECT id, {sql_uniform(['id', 'round'], 'arm')} FROM t").fetchall())
    assert got == want
    assert all(0 <= u < 1 for u in got.values())
