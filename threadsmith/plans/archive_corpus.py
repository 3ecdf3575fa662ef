"""Entry A end to end on archive folders: scan -> normalise -> media -> route -> instruction rows
(originals, and replies where a thread cache is supplied), users.

Folders are the ``data`` folders of one or many archives (paths or globs, on any storage that Spark reads);
owners come from each archive's account file by a join."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadsmith.config import CorpusConfig
from threadsmith.operators import corpus, identity, media, posts, threads
from threadsmith.sources import archive

ROW = ("archive", *archive.ROW_ORDER)


def all_posts(spark: SparkSession, data_dirs: str | list[str]) -> DataFrame:
    """Every post of the archives in normal form, also those without a valid time."""
    owners = archive.account_usernames(spark, data_dirs).withColumnRenamed("username", "owner")
    raw = archive.read_posts(spark, data_dirs).join(owners, "archive")
    return posts.normalize(posts.parse_posts(raw, "json"), F.col("owner"))


def with_media(spark: SparkSession, norm: DataFrame, data_dirs: str | list[str]) -> DataFrame:
    """Both bodies with their media links replaced and the page rendered with them; files are looked up in the post's own
    archive."""
    listing = archive.media_listing(spark, data_dirs)
    found = norm.filter(F.col("media").isNotNull() & F.col("media_url0").isNotNull())
    items = found.select(*ROW, F.col("id").alias("post_id"), F.posexplode("media").alias("pos", "m")).filter(
        F.col("m.url").isNotNull() & F.col("m.media_url").isNotNull()).select(
        *ROW, "post_id", "pos", F.col("m.media_url").alias("media_url"))
    bodies = found.select(*ROW, "body", "html_body", F.col("media_url0").alias("media_link"))
    resolved = media.resolve_media(items, listing, bodies, keys=ROW, scope=("archive",)).select(
        *ROW, F.col("body").alias("__mbody"))
    tagged = media.media_tags(items, listing, bodies, keys=ROW, scope=("archive",)).withColumnRenamed("html_body", "__hbody")
    x = norm.join(resolved, list(ROW), "left").join(tagged, list(ROW), "left")
    x = x.withColumn("body", F.coalesce("__mbody", "body")).withColumn("html_body", F.coalesce("__hbody", "html_body"))
    page = posts.page_html(F.col("html_header"), F.col("html_body"), F.col("permalink"), F.col("created_at"))
    return x.withColumn("html", F.when(F.col("__hbody").isNotNull(), page).otherwise(F.col("html"))).drop("__mbody", "__hbody")


def media_manifest(spark: SparkSession, norm: DataFrame, data_dirs: str | list[str]) -> DataFrame:
    """``archive, ..., post_id, pos, kind, media_file, source`` of every kept media file of the posts."""
    listing = archive.media_listing(spark, data_dirs)
    found = norm.filter(F.col("media").isNotNull()).select(*ROW, F.col("id").alias("post_id"), F.posexplode("media").alias("pos", "m"))
    keys = [*ROW, "post_id"]
    items = found.filter(F.col("m.url").isNotNull() & F.col("m.media_url").isNotNull()).select(
        *keys, "pos", F.col("m.media_url").alias("media_url"))
    variants = found.select(*keys, F.col("pos").alias("media_pos"), F.posexplode("m.video_info.variants").alias("pos", "v")).select(
        *keys, "media_pos", "pos", F.col("v.bitrate").alias("bitrate"), F.col("v.url").alias("url"))
    best = media.best_variants(variants, [*keys, "media_pos"]).withColumnRenamed("media_pos", "pos")
    return media.media_manifest(items, listing, best, keys=tuple(keys), scope=("archive",))


def normalised_posts(spark: SparkSession, data_dirs: str | list[str], media_files: bool = True) -> DataFrame:
    """Posts with a valid time; ``media_files=False`` for archives that were saved without media folders."""
    norm = posts.valid_time(all_posts(spark, data_dirs), "ts")
    return with_media(spark, norm, data_dirs) if media_files else norm


def corpus_from_archive(spark: SparkSession, data_dirs: str | list[str], cfg: CorpusConfig,
                        lexicon: DataFrame | None = None, thread_cache: DataFrame | None = None,
                        media_files: bool = True):
    """``(instruction_rows, reply_candidates, users)``.  With a thread cache (``id, context``) the
    replies it covers are paired with their context, ``augmentation_replies`` times."""
    norm = normalised_posts(spark, data_dirs, media_files)
    routed = posts.route(norm.select("archive", "id", "ts", "body", "is_reply", "is_quote", "is_retweet",
                                     *archive.ROW_ORDER))
    text = routed.select("kind", "id", F.col("body").alias("text"))
    originals = text.filter(F.col("kind") == "original").drop("kind")
    replies = text.filter(F.col("kind") == "reply").drop("kind")
    rows = corpus.original_rows(originals, cfg, lexicon, id_col="id", text_col="text")
    if thread_cache is not None:
        pairs = corpus.reply_rows(threads.join_thread_cache(replies, thread_cache, cfg), cfg, ["id"])
        pairs = corpus.rounds(pairs, cfg.augmentation_replies).withColumn("arm", F.lit("reply"))
        rows = rows.unionByName(pairs.select(*rows.columns))
    seen = posts.user_observations(all_posts(spark, data_dirs), archive.ROW_ORDER)
    return rows, replies, identity.harvest_users(seen)
