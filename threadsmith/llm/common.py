"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, by a path that only Spark has to understand."""
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def text_or_empty(name: str) -> Column:
    """The text column with null read as the empty text."""
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """``fn`` over every Arrow batch of ``df``; nothing is kept between batches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield fn(batch)
    return df.mapInArrow(run, schema)


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns that an operator is about to add (compared as Spark resolves names)."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def unit_hash(*parts: Column) -> Column:
    """Uniform number in [0, 1) of the parts: the first 52 bits of their md5, exact as a double."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir.  Where none is named, a local session (as in
    tests) gets a private one; elsewhere that is an error, as executors could not see it."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="threadsmith-shared-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """``df`` written as a table to the shared folder and read back: lineage ends here, and a lost executor loses
    nothing of it."""
    path = f"{shared_folder(df.sparkSession)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
