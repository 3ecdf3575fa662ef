"""Compaction of the append-only response cache.

Appends stay what they are: Parquet files of versioned rows directly below the table's path.  ``compact`` merges the
files that no generation has taken in yet into buckets by id, writing anew only the buckets that their ids fall in, and
then publishes a manifest: for every bucket the folder that holds it, and the files merged so far.  The manifest is one
small file, so a generation is there or not; readers use the last one and every append beyond it.  Folders are
never written twice and nothing is deleted, so a crash at any point leaves the table as it was."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 64
_MANIFEST = "gen long, bucket int, folder string, merged string, buckets int"


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def manifest(spark: SparkSession, path: str) -> DataFrame | None:
    """Rows of the last generation, or None: one a bucket with its folder, and one a merged file."""
    if not _exists(spark, f"{path}/_manifest"):
        return None
    rows = spark.read.schema(_MANIFEST).parquet(f"{path}/_manifest/*")
    last = rows.agg(F.max("gen")).first()[0]
    return rows.where(F.col("gen") == last) if last is not None else None


def _appended(spark: SparkSession, path: str, known: DataFrame | None) -> list[str]:
    """Append files that the generation has not taken in."""
    merged = {r["merged"] for r in known.where("merged IS NOT NULL").select("merged").collect()} if known is not None else set()
    return [f for f in spark.read.parquet(path).inputFiles() if f not in merged] if _exists(spark, path) else []


def _latest(rows: DataFrame) -> DataFrame:
    """One row an id: that of the greatest version (of equal ones the greatest value)."""
    others = [c for c in rows.columns if c not in ("id", "version")]
    return rows.groupBy("id").agg(F.max(F.struct("version", *others)).alias("r")).select("id", "r.*")


def read_compacted(spark: SparkSession, path: str) -> DataFrame:
    """The latest row of every id: the last generation's buckets and the appends beyond it."""
    known = manifest(spark, path)
    new = _appended(spark, path, known)
    rows = spark.read.parquet(*new) if new else None
    if known is not None:
        folders = [r["folder"] for r in known.where("folder IS NOT NULL").select("folder").collect()]
        if folders:
            buckets = spark.read.parquet(*folders)
            rows = buckets if rows is None else buckets.unionByName(rows)
    if rows is None:
        raise ValueError(f"no cache table at {path}")
    return _latest(rows)


def compact(spark: SparkSession, path: str, buckets: int = BUCKETS) -> dict:
    """Take the appended files in; returns the generation, the files taken in and the buckets rewritten.  The number of
    buckets is the first generation's.  Of two compactions at once, one fails and changes nothing."""
    known = manifest(spark, path)
    new = _appended(spark, path, known)
    gen = known.first()["gen"] + 1 if known is not None else 1
    if known is not None:
        buckets = known.first()["buckets"]
    if not new:
        return {"generation": gen - 1, "files": 0, "buckets": 0}
    bucket = F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int")
    rows = spark.read.parquet(*new)
    touched = {r["bucket"] for r in rows.select(bucket.alias("bucket")).distinct().collect()}  # at most ``buckets`` numbers
    folders = {r["bucket"]: r["folder"] for r in known.where("folder IS NOT NULL").collect()} if known is not None else {}
    old = [folders[b] for b in sorted(touched) if b in folders]
    if old:
        rows = spark.read.parquet(*old).unionByName(rows)
    written = f"{path}/_buckets/{uuid.uuid4().hex}"
    _latest(rows).withColumn("bucket", bucket).repartition(min(buckets, len(touched)), "bucket").write.partitionBy(
        "bucket").parquet(written)
    folders.update({b: f"{written}/bucket={b}" for b in touched})
    entries = [(gen, b, f, None, buckets) for b, f in folders.items()] + [(gen, None, None, f, buckets) for f in new]
    table = spark.createDataFrame(entries, _MANIFEST)
    if known is not None:
        table = table.unionByName(known.where("merged IS NOT NULL").withColumn("gen", F.lit(gen).cast("long")))
    table.coalesce(1).write.mode("errorifexists").parquet(f"{path}/_manifest/{gen:012d}")
    return {"generation": gen, "files": len(new), "buckets": len(touched)}
