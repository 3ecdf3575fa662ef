"""Mixing sources to target weights by Poisson replication.

A source with n of N documents and target weight w has the repetition rate N * w / n.  Each document's
count is the inverse of the Poisson distribution with that mean at a uniform number hashed from
seed and id; it is exploded by its count and the copies are shuffled globally on a hashed key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadsmith.llm.common import unit_hash, without

#: rates of so many sources at most are broadcast (each a short name and its distribution's table)
BROADCAST_SOURCES = 2000
SALTS = 64


def poisson_table(rate: Column) -> Column:
    """P(X <= k) for k = 0, 1, ... until less than one part in 2^52 is left, summed in logarithms."""
    last = F.ceil(rate + 12 * F.sqrt(rate) + 25).cast("int")
    start = F.struct((-rate).alias("log"), F.array(F.exp(-rate)).alias("cdf"))

    def step(acc: Column, k: Column) -> Column:
        log = acc["log"] + F.log(rate) - F.log(k.cast("double"))
        return F.struct(log.alias("log"),
                        F.concat(acc["cdf"], F.array(F.element_at(acc["cdf"], -1) + F.exp(log))).alias("cdf"))
    return F.when(rate > 0, F.aggregate(F.sequence(F.lit(1), last), start, step, lambda a: a["cdf"])
                  ).otherwise(F.array(F.lit(1.0)))


def source_rates(docs: DataFrame, source_col: str = "source", weights: dict[str, float] | None = None,
                 temperature: float = 0.5, total: float = 1.0) -> DataFrame:
    """(source, rate, cdf) by source.  ``weights`` are relative target weights (a source that is not
    named gets 0); without them the target weight of a source is its size to the power
    ``temperature``.  ``total`` is the output's size as a multiple of the input's."""
    counts = docs.groupBy(F.col(f"`{source_col}`").cast("string").alias("source")).agg(F.count("*").alias("n"))
    if weights is None:
        weight = F.pow(F.col("n").cast("double"), F.lit(float(temperature)))
    else:
        weight = F.lit(0.0)
        for name, value in weights.items():
            weight = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(value))).otherwise(weight)
    counts = counts.withColumn("w", weight)
    sums = counts.agg(F.sum("n").alias("all_n"), F.sum("w").alias("all_w")).first()
    all_n, all_w = float(sums["all_n"] or 0), float(sums["all_w"] or 0)
    rate = F.lit(all_n * float(total)) * F.col("w") / F.lit(all_w or 1.0) / F.col("n")
    return counts.select("source", rate.alias("rate")).select("source", "rate", poisson_table(F.col("rate")).alias("cdf"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source",
                weights: dict[str, float] | None = None, temperature: float = 0.5, total: float = 1.0,
                seed: str = "mix") -> DataFrame:
    """``docs`` replicated to the target weights and shuffled: its columns, mix_copy (from 1) and mix_key.

    Documents with count 0 go.  A null source is a source of its own; rows that share an id (or
    have none) share their count and keys.  Columns named like the added ones are replaced.  A hot source needs no
    shuffle by source: counts are combined on the map side, the rates of a counted, bounded number
    of sources are broadcast, more are joined on a salted key.  Copies are dealt on their hashed key."""
    docs = without(docs, "mix_copy", "mix_key")
    row = F.struct(*[F.col(f"d.`{c}`") for c in docs.columns]).alias("row")  # no column of it meets an added one
    rates = source_rates(docs, source_col, weights, temperature, total)
    n_sources = rates.select("source").limit(BROADCAST_SOURCES + 1).count()
    source = F.col(f"d.`{source_col}`").cast("string")
    if n_sources <= BROADCAST_SOURCES:
        joined = docs.alias("d").join(F.broadcast(rates.alias("r")), source.eqNullSafe(F.col("r.source")))
    else:
        salted = rates.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
        salt = F.pmod(F.xxhash64(F.col(f"d.`{id_col}`")), F.lit(SALTS)).cast("int")
        joined = docs.alias("d").join(salted.alias("r"), source.eqNullSafe(F.col("r.source")) & (salt == F.col("r.salt")))
    at = unit_hash(F.lit(seed), F.col(f"d.`{id_col}`").cast("string"))
    count = F.size(F.filter(F.col("r.cdf"), lambda c: c <= at))
    copies = joined.select(row, count.alias("n")).where("n > 0").select(
        "row", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy")).select("row.*", F.col("copy").alias("mix_copy"))
    key = F.md5(F.concat_ws("|", F.lit(seed), F.lit("order"), F.col(f"`{id_col}`").cast("string"), F.col("mix_copy")))
    return copies.withColumn("mix_key", key).repartition("mix_key").sortWithinPartitions("mix_key")
