"""Dimension lookups (id -> handle).  The join strategy is left to Spark, which broadcasts by bytes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup_handle(df: DataFrame, users: DataFrame, id_col: str, out_col: str,
                  default: Column | None = None) -> DataFrame:
    """Left-outer lookup ``id -> handle`` with a default for unknown ids."""
    u = users.select(F.col("user_id").alias("__uid"), F.col("handle").alias("__handle"))
    joined = df.join(u, df[id_col] == F.col("__uid"), "left")
    val = F.col("__handle") if default is None else F.coalesce(F.col("__handle"), default)
    return joined.withColumn(out_col, val).drop("__uid", "__handle")
