"""Skew-safe numbering.

``ordered_index`` numbers the rows of every group without putting a group into one task: rows are numbered
inside ``(group, stride)``, a stride being a range of the first order column, and the counts of the strides, a
much smaller table, give each stride's offset in its group.  ``hashed_index`` numbers all rows in the order of a
uniform draw the same way, its strides being equal cells of the draw.  Both depend on the rows alone: no
checkpoint, partition ids or jobs at plan-build time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: strides of numeric order columns; a day where the order column is a time in seconds
STRIDE = 4096
DAY = 86400
#: cells of a uniform draw; one row a cell is ever in one task
CELLS = 1 << 16


def stride_of(df: DataFrame, order_col: str, stride: int) -> Column:
    """Stride number of the first order column (numeric, or a timestamp taken in seconds); nulls come first."""
    value = F.col(order_col)
    if dict(df.dtypes)[order_col].startswith("timestamp"):
        value, stride = F.unix_seconds(value.cast("timestamp")), DAY
    return F.coalesce(F.floor(value / stride).cast("bigint"), F.lit(-(1 << 63)).cast("bigint"))


def ordered_index(df: DataFrame, group_cols: list[str], order_cols: list, idx_col: str = "idx",
                  count_col: str | None = None, stride: int = STRIDE, running: dict[str, Column] | None = None,
                  counted: DataFrame | None = None, wide: bool = False) -> DataFrame:
    """``df`` with the 0-based place of each row in its group's order (and the group's size).  ``running`` adds
    columns with the sum of an expression over the earlier rows of the group.  ``counted`` may give the same
    groups and order values more cheaply than ``df``, to be counted in its place.  ``wide`` rows go with their group and
    stride as one value, in which nulls are equal: a null-safe join of several columns would shuffle them again."""
    running = running or {}
    x = df.withColumn("__stride", stride_of(df, order_cols[0], stride))
    if wide:
        x = x.withColumn("__at", F.struct(*group_cols, "__stride"))
    source = x if counted is None else counted.withColumn("__stride", stride_of(counted, order_cols[0], stride))
    sizes = source.groupBy(*group_cols, "__stride").agg(
        F.count(F.lit(1)).alias("__n"), *[F.sum(v).alias(f"__sum_{c}") for c, v in running.items()])
    group = Window.partitionBy(*group_cols)
    before = group.orderBy("__stride").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*[F.col(c).alias(f"__g{i}") for i, c in enumerate(group_cols)],
                           F.col("__stride").alias("__s"),
                           F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"),
                           F.sum("__n").over(group).alias("__size"),
                           *[F.coalesce(F.sum(f"__sum_{c}").over(before), F.lit(0)).alias(f"__sum_{c}") for c in running])
    if wide:
        offsets = offsets.withColumn("__key", F.struct(*[F.col(f"__g{i}").alias(c) for i, c in enumerate(group_cols)],
                                                       F.col("__s").alias("__stride")))
        same = F.col("__at") == F.col("__key")
    else:
        same = F.col("__stride") == F.col("__s")
        for i, c in enumerate(group_cols):
            same &= F.col(c).eqNullSafe(F.col(f"__g{i}"))
    in_stride = Window.partitionBy(*(["__at"] if wide else [*group_cols, "__stride"])).orderBy(*order_cols)
    place = F.row_number().over(in_stride)
    earlier = in_stride.rowsBetween(Window.unboundedPreceding, -1)
    x = x.withColumn("__in_stride", place).withColumns(
        {f"__part_{c}": F.coalesce(F.sum(v).over(earlier), F.lit(0)) for c, v in running.items()})
    out = x.join(offsets, same)
    out = out.withColumn(idx_col, (F.col("__off") + F.col("__in_stride") - 1).cast("bigint")).withColumns(
        {c: F.col(f"__sum_{c}") + F.col(f"__part_{c}") for c in running})
    if count_col:
        out = out.withColumn(count_col, F.col("__size"))
    return out.drop("__stride", "__s", "__off", "__size", "__in_stride", "__at", "__key", *[f"__g{i}" for i in range(len(group_cols))],
                    *[f"__{k}_{c}" for c in running for k in ("sum", "part")])


def hashed_index(df: DataFrame, draw: Column, ties: list[str], idx_col: str = "idx") -> DataFrame:
    """``df`` with the 0-based place of each row among all rows in the order of a uniform draw, then ``ties``."""
    x = df.withColumn("__u", draw).withColumn("__cell", F.floor(F.col("__u") * CELLS).cast("int"))
    before = Window.orderBy("__c").rowsBetween(Window.unboundedPreceding, -1)
    sizes = x.groupBy(F.col("__cell").alias("__c")).agg(F.count(F.lit(1)).alias("__n"))
    offsets = sizes.select("__c", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    place = F.row_number().over(Window.partitionBy("__cell").orderBy("__u", *ties))
    out = x.withColumn("__in_stride", place).join(offsets, F.col("__cell") == F.col("__c"))
    return out.withColumn(idx_col, (F.col("__off") + F.col("__in_stride") - 1).cast("bigint")).drop(
        "__u", "__cell", "__c", "__off", "__in_stride")


def part_numbers(df: DataFrame, group_cols: list[str], order_cols: list, part_size: int,
                 idx_col: str = "msg_idx", part_col: str = "part", stride: int = STRIDE,
                 counted: DataFrame | None = None) -> DataFrame:
    """1-based part of ``part_size`` messages when the group has more than
    ``part_size`` messages, else NULL (unnumbered)."""
    x = ordered_index(df, group_cols, order_cols, idx_col=idx_col, count_col="__cnt", stride=stride, counted=counted)
    part = F.when(F.col("__cnt") > part_size, F.floor(F.col(idx_col) / part_size) + 1).cast("bigint")
    return x.withColumn(part_col, part).withColumnRenamed("__cnt", "group_size")
