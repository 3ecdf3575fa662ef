"""Identity resolution.

Id sets are one-column DataFrames ``user_id`` (strings); set algebra is
``union/distinct``, ``subtract`` (EXCEPT DISTINCT) and semi/anti joins, all shuffled on
the id (no group can be hot: an id is one row after de-duplication)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadsmith.config import UNKNOWN_HANDLE, USER_URL_PREFIX, CorpusConfig
from threadsmith.functions.draws import uniform
from threadsmith.operators.joins import lookup_handle
from threadsmith.operators.ordering import hashed_index


def ids(df: DataFrame, col: str) -> DataFrame:
    """Ids of rows that have one (rows lacking the key are skipped)."""
    return df.select(F.col(col).cast("string").alias("user_id")).filter(F.col("user_id").isNotNull())


def dm_ids(convs: DataFrame, conv_col: str = "conversation_id") -> DataFrame:
    """Both parties of ``id1-id2`` conversation ids, distinct."""
    return convs.select(F.explode(F.split(F.col(conv_col), "-")).alias("user_id")).distinct()


def group_ids(events: DataFrame) -> DataFrame:
    """The distinct ids of all group conversations' participants, straight from their events: senders, those who
    join, add or are added, but not those only named as leaving."""
    k = F.col("kind")
    people = F.when(k == "message", F.array("actor_id")).when(k.isin("join", "add"), F.concat(
        F.array("actor_id"), F.coalesce("user_ids", F.array().cast("array<string>"))))
    return ids(events.select(F.explode(people).alias("user_id")), "user_id").distinct()


def universe(following: DataFrame, followers: DataFrame, dms: DataFrame, groups: DataFrame | None = None):
    """``(without_followers, only_followers, all)`` id sets."""
    base = following.unionByName(dms)
    if groups is not None:
        base = base.unionByName(groups)
    without = base.distinct()
    only = followers.distinct().join(without, "user_id", "left_anti")
    return without, only, without.unionByName(only)


def membership(following: DataFrame, followers: DataFrame, dms: DataFrame, users: DataFrame,
               groups: DataFrame | None = None) -> DataFrame:
    """R1-R5 and J3 in one aggregation: every id with its row count per source
    (``n_following``, ``n_followers``, ``n_dm``, ``n_group``, ``n_known``) and the set flags
    ``in_all``, ``only_follower``, ``unknown``, ``unknown_follower``.  Each set is then a
    filter, so the whole set algebra is one shuffle on the id, combined map-side (a hot id
    is one partial row per task) instead of a chain of distinct/anti joins."""
    srcs = [("following", following), ("followers", followers), ("dm", dms), ("known", users)]
    if groups is not None:
        srcs.append(("group", groups))
    tagged = None
    for tag, df in srcs:
        t = df.select("user_id", F.lit(tag).alias("source"))
        tagged = t if tagged is None else tagged.unionByName(t)
    return membership_of(tagged)


def membership_of(tagged: DataFrame) -> DataFrame:
    """``membership`` from ``(user_id, source)`` rows, source in following / followers /
    dm / group / known (lets a caller tag several sources in one scan)."""
    tags = ["following", "followers", "dm", "group", "known"]
    m = tagged.groupBy("user_id").agg(*[F.count_if(F.col("source") == t).alias(f"n_{t}") for t in tags])
    without = (F.col("n_following") > 0) | (F.col("n_dm") > 0) | (F.col("n_group") > 0)
    only = (F.col("n_followers") > 0) & ~without
    return (m.withColumn("only_follower", only)
            .withColumn("in_all", without | only)
            .withColumn("unknown", F.col("in_all") & (F.col("n_known") == 0))
            .withColumn("unknown_follower", F.col("unknown") & F.col("only_follower")))


def unknown(id_set: DataFrame, users: DataFrame) -> DataFrame:
    """Ids without a handle in ``users``."""
    return id_set.join(users.select("user_id"), "user_id", "left_anti")


def lookup_gate(n_unknown_followers: Column, cfg: CorpusConfig, consent: bool = False) -> Column:
    """Followers stay in the lookup unless there are more than the limit and no consent."""
    return (n_unknown_followers <= F.lit(cfg.max_follower_lookup)) | F.lit(consent)


def lookup_batches(lookup_ids: DataFrame, cfg: CorpusConfig) -> DataFrame:
    """Ids numbered in a drawn order, ``lookup_batch`` per request, comma-joined.  The
    numbering is over cells of the draw, so no task holds more than one of them."""
    b = hashed_index(lookup_ids, uniform(["user_id"], "order", cfg.seed), ["user_id"])
    b = b.withColumn("batch", F.floor(F.col("idx") / cfg.lookup_batch).cast("bigint"))
    return b.groupBy("batch").agg(
        F.count(F.lit(1)).alias("n_ids"),
        F.array_join(F.array_sort(F.collect_list("user_id")), ",").alias("ids"))


def report_lines(id_rows: DataFrame, users: DataFrame, cfg: CorpusConfig) -> DataFrame:
    """``handle profile-url`` per id (unknown -> placeholder handle), not de-duplicated."""
    x = lookup_handle(id_rows, users, "user_id", "__h", F.lit(UNKNOWN_HANDLE))
    return x.select("*", F.concat(F.col("__h"), F.lit(" " + USER_URL_PREFIX), F.col("user_id")).alias("line")).drop("__h")


def harvest_users(mentions: DataFrame) -> DataFrame:
    """``(user_id, handle, order...)`` observations -> last write wins per id;
    negative ids and NULL handles are ignored.  ``max_by`` is a partial aggregate, so a
    hot id is combined map-side before the shuffle.  ``mentions`` must carry an ``ord``
    struct/column giving the write order."""
    ok = mentions.filter((F.col("user_id").cast("string").try_cast("bigint") >= 0) & F.col("handle").isNotNull())
    return ok.groupBy("user_id").agg(F.max_by("handle", "ord").alias("handle"))


def merge_users(users: DataFrame, looked_up: DataFrame) -> DataFrame:
    """Looked-up handles overwrite known ones; NULL screen names are dropped."""
    lk = looked_up.filter(F.col("handle").isNotNull()).select("user_id", "handle")
    keep = users.join(lk.select("user_id"), "user_id", "left_anti")
    return keep.unionByName(lk)
