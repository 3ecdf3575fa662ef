"""Model-written prompts through a response cache.

The model call itself is out of scope; these operators plan the requests that are still
missing, render them, and turn cached responses into instruction rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadsmith.config import CorpusConfig
from threadsmith.functions.draws import uniform
from threadsmith.functions.text import passes_gate
from threadsmith.operators.corpus import open_question, rounds

# Our own request wording for the two request kinds.
SYSTEM_QA = "A message follows. Reply with the single question that its author was most likely asked before writing it."
SYSTEM_CONTINUE = "A message follows. Reply with one opening phrase after which the message reads as the rest of a sentence."
USER_PREFIX = "Message: "


def cache_join(posts: DataFrame, cache: DataFrame, id_col: str = "id") -> DataFrame:
    """J6 (left): every post with ``hit`` and ``n_cached``."""
    c = cache.select(F.col(id_col), F.col("responses"))
    j = posts.join(c, id_col, "left")
    return j.withColumn("hit", F.col("responses").isNotNull()).withColumn(
        "n_cached", F.when(F.col("responses").isNull(), F.lit(0)).otherwise(F.size("responses")))


def pending_requests(posts: DataFrame, cache: DataFrame, cfg: CorpusConfig,
                     id_col: str = "id", text_col: str = "text") -> DataFrame:
    """One request per missing cache slot ``[n_cached, max_generated)`` for posts
    passing the gate; none in cache-only mode."""
    if cfg.cache_only:
        return posts.limit(0).select(id_col, F.lit(0).alias("idx"), F.lit("").alias("kind"), text_col)
    j = cache_join(posts.filter(passes_gate(F.col(text_col), cfg.response_thresh)), cache, id_col)
    j = j.filter(F.col("n_cached") < cfg.max_generated)
    j = j.withColumn("idx", F.explode(F.sequence(F.col("n_cached"), F.lit(cfg.max_generated - 1))))
    kind = F.when(uniform([id_col, "idx"], "kind", cfg.seed) < cfg.qa_prob, "qa").otherwise("continue")
    return j.select(id_col, "idx", kind.alias("kind"), text_col)


def render_requests(requests: DataFrame, cfg: CorpusConfig, text_col: str = "text") -> DataFrame:
    """System + user message per request, with generation settings."""
    system = F.when(F.col("kind") == "qa", F.lit(SYSTEM_QA)).otherwise(F.lit(SYSTEM_CONTINUE))
    return requests.select(
        "*", system.alias("system_message"),
        F.concat(F.lit(USER_PREFIX), F.col(text_col)).alias("user_message"),
        F.lit(cfg.request_max_tokens).alias("max_tokens"),
        F.lit(cfg.request_temperature).alias("temperature"),
    ).drop(text_col)


def request_json(rendered: DataFrame) -> DataFrame:
    """The request body as JSON (for a sink that feeds a model service)."""
    msgs = F.array(
        F.struct(F.lit("system").alias("role"), F.col("system_message").alias("content")),
        F.struct(F.lit("user").alias("role"), F.col("user_message").alias("content")),
    )
    body = F.to_json(F.struct(msgs.alias("messages"), F.col("max_tokens"), F.col("temperature")))
    return rendered.withColumn("body", body)


def response_rows(posts: DataFrame, cache: DataFrame, cfg: CorpusConfig,
                  id_col: str = "id", text_col: str = "text") -> DataFrame:
    """For each round r, the cached response r becomes the instruction; rounds past
    the cache size are skipped; in cache-only mode partial caches are dropped."""
    j = posts.filter(passes_gate(F.col(text_col), cfg.response_thresh)).join(
        cache.select(id_col, "responses"), id_col, "inner")
    if cfg.cache_only:
        j = j.filter(F.size("responses") >= cfg.max_generated)
    j = rounds(j, cfg.augmentation_original)
    j = j.filter(F.col("round") < F.size("responses"))
    return j.select(id_col, "round", F.get(F.col("responses"), F.col("round")).alias("instruction"),
                    F.lit("").alias("input"), F.col(text_col).alias("output"))


def seed_rows(posts: DataFrame, cfg: CorpusConfig, round_no: int = 0,
              id_col: str = "id", text_col: str = "text") -> DataFrame:
    """In round 0, 10% gated open questions and the next 10% unconditional rows."""
    keys = [id_col, "round"]
    p = posts.select(id_col, text_col).withColumn("round", F.lit(round_no))
    u = uniform(keys, "seed", cfg.seed)
    p = p.withColumn("__u", u)
    open_row = (F.col("__u") < cfg.seed_open_prob) & passes_gate(F.col(text_col), cfg.response_thresh)
    plain_row = (F.col("__u") >= cfg.seed_open_prob) & (F.col("__u") < cfg.seed_open_prob + cfg.seed_uncond_prob)
    return p.filter((open_row | plain_row) & F.lit(round_no == 0)).select(
        id_col, "round",
        F.when(F.col("__u") < cfg.seed_open_prob, open_question(keys, cfg.seed)).otherwise(F.lit("")).alias("instruction"),
        F.lit("").alias("input"), F.col(text_col).alias("output"))
