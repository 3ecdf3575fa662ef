"""Dataset readers: instruction JSON (S5), JSON lines (S6), response/thread caches (S7),
captured pages (S8) and the tokenised dataset (S10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadsmith.sinks.cache_table import manifest, read_compacted

INSTRUCTION_SCHEMA = "instruction string, input string, output string"
FORMATTED_SCHEMA = "context string, target string"


def read_instruction_array(spark: SparkSession, path: str) -> DataFrame:
    """A (pretty-printed) JSON array of instruction rows; a malformed file is an error."""
    return spark.read.schema(INSTRUCTION_SCHEMA).option("multiLine", True).option("mode", "FAILFAST").json(path)


def read_json_lines(spark: SparkSession, path: str, schema: str = FORMATTED_SCHEMA) -> DataFrame:
    """One JSON object per line; a malformed line is an error."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_cache_dir(spark: SparkSession, path: str, value_col: str = "responses") -> DataFrame:
    """A directory of ``<id>.txt`` files, each a JSON array of strings; an unreadable
    entry is a miss (NULL) and is dropped."""
    raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("f"), "value")
    ident = F.regexp_extract("f", "^(.*)\\.txt$", 1)
    arr = F.from_json("value", "array<string>")
    return raw.select(ident.alias("id"), arr.alias(value_col)).filter(
        (F.col("id") != "") & F.col(value_col).isNotNull())


def read_cache_table(spark: SparkSession, path: str, value_col: str = "responses") -> DataFrame:
    """S7 (table form) with K8's append-only versions, compacted or not: the latest version per id wins."""
    if manifest(spark, path) is not None:
        return read_compacted(spark, path).select("id", value_col)
    t = spark.read.parquet(path)
    if "version" not in t.columns:
        return t.select("id", value_col)
    return t.groupBy("id").agg(F.max_by(value_col, F.struct("version", value_col)).alias(value_col))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Captured pages ``(page_id, url, html)``."""
    return spark.read.parquet(path).select("page_id", "url", "html")


def read_tokenised(spark: SparkSession, path: str) -> DataFrame:
    """Reload the tokenised dataset."""
    return spark.read.parquet(path).select("input_ids", "seq_len")
