"""Sinks (K1-K8).  Every writer is a DataFrame write whose totals come from the write itself; no rows are
collected to the driver.  Transcripts and reports go to files of exact names (``named_files``)."""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from threadsmith.operators.corpus import shuffle_key, shuffled
from threadsmith.sinks.named_files import apart, write_named_files


def write_instruction_dataset(rows: DataFrame, path: str, seed: str = "42", fmt: str = "json",
                              id_cols=("source", "id", "round")) -> dict:
    """K1: rows in a stable shuffled order (md5 key of the id columns, which must exist; hash
    partitions sorted by the key), non-ASCII kept (JSON lines / parquet).  Returns the number of rows (A11)."""
    missing = [c for c in id_cols if c not in rows.columns]
    if missing or not id_cols:
        raise ValueError(f"id columns {missing} are not in the rows; name those that identify a row")
    seen, counts = observed(rows, n_rows=F.count(F.lit(1)))
    keyed = shuffled(seen.withColumn("__k", shuffle_key(list(id_cols), seed)), "__k").drop("__k")
    keyed.select("instruction", "input", "output").write.mode("overwrite").format(fmt).save(path)
    return counts()


def write_formatted(rows: DataFrame, path: str) -> None:
    """K2: ``{context, target}`` JSON lines."""
    rows.select("context", "target").write.mode("overwrite").json(path)


def write_tokenised(rows: DataFrame, path: str) -> None:
    """K3."""
    rows.select("input_ids", "seq_len").write.mode("overwrite").parquet(path)


def write_posts_by_month(posts: DataFrame, path: str) -> dict:
    """K4: posts laid out by kind/year/month (partition pruning on later reads).  The rebalance keeps
    a month together while it is small and splits a large one over tasks.  Returns the number of posts (A11)."""
    seen, counts = observed(posts, n_posts=F.count(F.lit(1)))
    seen.hint("rebalance", "kind", "year", "month").write.mode("overwrite").partitionBy(
        "kind", "year", "month").parquet(path)
    return counts()


# How the files of an archive's output are named.
TRANSCRIPT_KINDS = {"dm": "DMs", "group": "DMs-Group"}


def transcript_files(transcripts: DataFrame, kind: str, name_col: str, id_col: str = "conversation_id",
                     scope: tuple = (), ending: str = "md") -> DataFrame:
    """K5/K6: ``name, content`` of each transcript (part): ``DMs/DMs-<name>[-part001].md``.  Conversations of one safe name
    stay apart; ``scope`` (the archive) becomes a folder."""
    folder = TRANSCRIPT_KINDS[kind]
    named = apart(transcripts.select(*scope, F.col(id_col).alias("__id"), F.col(name_col).alias("__file"), "part", "transcript"),
                  "__id", "__file", scope)
    part = F.when(F.col("part").isNotNull(), F.concat(F.lit("-part"), F.lpad(F.col("part").cast("string"), F.greatest(
        F.lit(3), F.length(F.col("part").cast("string"))), F.lit("0")))).otherwise("")
    file = F.concat(F.lit(f"{folder}/{folder}-"), F.col("__file"), part, F.lit(f".{ending}"))
    return named.select(F.concat_ws("/", *[F.col(c).cast("string") for c in scope], file).alias("name"), F.col("transcript").alias("content"))


def report_files(lines: DataFrame, scope: tuple = (), ending: str = "txt") -> DataFrame:
    """K7: ``name, content`` of each kind's report (``following.txt``): its lines sorted by code point, joined by line ends.
    A report holds the ids of one archive (``scope``), so it is one row."""
    per = lines.groupBy(*scope, "kind").agg(F.array_join(F.array_sort(F.collect_list("line")), "\n").alias("content"))
    return per.select(F.concat_ws("/", *[F.col(c).cast("string") for c in scope], F.concat("kind", F.lit(f".{ending}"))).alias("name"),
                      "content")


def write_transcripts(transcripts: DataFrame, path: str, name_col: str, kind: str = "dm", id_col: str = "conversation_id",
                      scope: tuple = ()) -> dict:
    """K5/K6: one named file per conversation (or part); returns the totals of what was written."""
    first = F.col("part").isNull() | (F.col("part") == 1)
    seen, counts = observed(transcripts, n_conversations=F.count_if(first), n_files=F.count(F.lit(1)), n_messages=F.sum("n_messages"))
    write_named_files(transcript_files(seen, kind, name_col, id_col, scope), path)
    return counts()


def write_report(lines: DataFrame, path: str, scope: tuple = (), kinds: tuple = ("following", "followers")) -> dict:
    """K7: one named, sorted file a kind; returns the number of accounts by kind."""
    seen, counts = observed(lines, **{k: F.count_if(F.col("kind") == k) for k in kinds})
    write_named_files(report_files(seen, scope), path)
    return counts()


def observed(df: DataFrame, **metrics) -> tuple[DataFrame, Callable[[], dict]]:
    """``df`` and a function that gives the metrics of its rows once an action has run over it.  They are gathered
    by that action itself, without a second scan."""
    seen = Observation()
    first, *rest = [c.cast("long").alias(k) for k, c in metrics.items()]

    def counts() -> dict:
        try:
            found = seen.get
        except Py4JJavaError:  # Spark proves the plan empty and runs no metrics
            found = {}
        return {k: found.get(k) or 0 for k in metrics}
    return df.observe(seen, first, *rest), counts


def append_cache(entries: DataFrame, path: str, version_col: str = "version") -> None:
    """K8: append new cache entries (``id, <array>, version``); readers keep the latest."""
    entries.write.mode("append").parquet(path)
