"""Sinks written and read back (K1-K8, S5-S7, S10), and operators that no other query reaches.

A write-and-read-back query writes to the folder that the cluster shares (``spark.checkpoint.dir``; a local session
without one gets a private folder) and returns what a reader finds there."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadsmith.config import ASCII, TRANSCRIPT_SEPARATOR
from threadsmith.operators import corpus, identity, posts, threads, trainset
from threadsmith.operators import transcripts as TR
from threadsmith.plans import sqlfrag as S
from threadsmith.plans.cache_plans import CACHE_SQL, cache
from threadsmith.plans.identity_plans import users
from threadsmith.plans.registry import register, table
from threadsmith.plans.transcript_plans import group_raw
from threadsmith.sinks import cache_table, writers
from threadsmith.sources import datasets

CFG = ASCII


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own below the shared one."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="threadsmith-sinks-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def plain_rows(spark, sf) -> DataFrame:
    d = table(spark, sf, "documents")
    return d.select("doc_id", F.concat(F.lit("About "), "source").alias("instruction"), F.lit("").alias("input"), F.col("text").alias("output"))


@register("dataset_round_trip", oracle="SELECT 'About ' || source AS instruction, '' AS input, text AS output FROM documents")
def dataset_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Instruction rows as JSON lines."""
    path = new_folder(spark, "instructions")
    writers.write_instruction_dataset(plain_rows(spark, sf), path, id_cols=("doc_id",))
    return datasets.read_json_lines(spark, path, datasets.INSTRUCTION_SCHEMA)


@register("formatted_round_trip", oracle="""
SELECT 'Instruction: About ' || source || chr(10) || 'Answer: ' AS context, text AS target FROM documents""")
def formatted_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Formatted rows."""
    path = new_folder(spark, "formatted")
    writers.write_formatted(trainset.format_rows(plain_rows(spark, sf)), path)
    return datasets.read_json_lines(spark, path)


@register("tokenised_round_trip", oracle="""
SELECT array_to_string(list_transform(range(0, n_chars % 7), lambda i: i + doc_id), ',') AS input_ids, CAST(n_chars % 7 AS BIGINT) AS seq_len
FROM documents""")
def tokenised_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Token ids."""
    path = new_folder(spark, "tokens")
    n = (F.col("n_chars") % 7).cast("int")
    ids = F.transform(F.array_repeat(F.lit(0), n), lambda x, i: i + F.col("doc_id"))
    writers.write_tokenised(table(spark, sf, "documents").select(ids.alias("input_ids"), n.alias("seq_len")), path)
    return datasets.read_tokenised(spark, path).select(F.array_join("input_ids", ",").alias("input_ids"),
                                                       F.col("seq_len").cast("bigint").alias("seq_len"))


@register("month_layout", oracle="""
SELECT CASE WHEN o_orderstatus = 'F' THEN 'reply' ELSE 'original' END AS kind, year(o_orderdate) AS year, month(o_orderdate) AS month,
       count(*) AS n_posts, (SELECT count(*) FROM orders) AS written
FROM orders GROUP BY ALL""")
def month_layout(spark: SparkSession, sf: str) -> DataFrame:
    """Posts by kind, year and month, with the number that the write reported."""
    path = new_folder(spark, "months")
    o = table(spark, sf, "orders")
    kind = F.when(F.col("o_orderstatus") == "F", "reply").otherwise("original")
    made = writers.write_posts_by_month(o.select(kind.alias("kind"), F.year("o_orderdate").alias("year"),
                                                 F.month("o_orderdate").alias("month"), F.col("o_orderkey").alias("id")), path)
    back = spark.read.parquet(path).groupBy("kind", "year", "month").agg(F.count(F.lit(1)).alias("n_posts"))
    return back.select("kind", F.col("year").cast("bigint").alias("year"), F.col("month").cast("bigint").alias("month"), "n_posts",
                       F.lit(made["n_posts"]).alias("written"))


PART = 4


@register("transcript_files", oracle=f"""
WITH n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i, count(*) OVER (PARTITION BY conv_id) AS n
           FROM conversations),
p AS (SELECT conv_id, CASE WHEN n > {PART} THEN i // {PART} + 1 END AS part, i, coalesce(text, '') AS line FROM n),
t AS (SELECT conv_id, part, string_agg(line, {S.lit_text(TRANSCRIPT_SEPARATOR)} ORDER BY i) AS content, count(*) AS messages FROM p GROUP BY ALL),
s AS (SELECT count(DISTINCT conv_id) AS n_conversations, count(*) AS n_files, sum(messages) AS n_messages FROM t),
f AS (SELECT 'DMs/DMs-room' || CAST(conv_id % 50 AS VARCHAR) ||
        CASE WHEN conv_id <> min(conv_id) OVER (PARTITION BY conv_id % 50) THEN '-' || CAST(conv_id AS VARCHAR) ELSE '' END ||
        CASE WHEN part IS NOT NULL THEN '-part' || lpad(CAST(part AS VARCHAR), CAST(greatest(3, length(CAST(part AS VARCHAR))) AS INTEGER), '0') ELSE '' END
        || '.md' AS name, content FROM t)
SELECT name, md5(content) AS content, CAST(n_conversations AS BIGINT) AS n_conversations, CAST(n_files AS BIGINT) AS n_files,
       CAST(n_messages AS BIGINT) AS n_messages FROM f, s""")
def transcript_files(spark: SparkSession, sf: str) -> DataFrame:
    """One named file a conversation or part; fifty names for all conversations."""
    path = new_folder(spark, "transcripts")
    lines = table(spark, sf, "conversations").select("conv_id", "turn", F.coalesce("text", F.lit("")).alias("line"))
    parts = TR.transcripts(lines, "conv_id", ["turn"], F.lit(""), PART).withColumn(
        "name", F.concat(F.lit("room"), (F.col("conv_id") % 50).cast("string")))
    made = writers.write_transcripts(parts, path, "name", id_col="conv_id")
    files = spark.read.text(f"{path}/DMs", wholetext=True).select(
        F.concat(F.lit("DMs/"), F.col("_metadata.file_name")).alias("name"), F.md5("value").alias("content"))
    return files.select("name", "content", *[F.lit(made[k]).cast("bigint").alias(k) for k in ("n_conversations", "n_files", "n_messages")])


@register("report_files", oracle="""
WITH l AS (SELECT CASE WHEN o_orderstatus = 'O' THEN 'following' ELSE 'followers' END AS kind, 'A' || CAST(o_custkey % 9 AS VARCHAR) AS archive,
                  'user' || CAST(o_custkey AS VARCHAR) AS line FROM orders WHERE o_orderstatus IN ('O', 'F'))
SELECT archive || '/' || kind || '.txt' AS name, md5(string_agg(line, chr(10) ORDER BY line)) AS content,
       (SELECT count(*) FROM l WHERE kind = 'following') AS n_following, (SELECT count(*) FROM l WHERE kind = 'followers') AS n_followers
FROM l GROUP BY archive, kind""")
def report_files(spark: SparkSession, sf: str) -> DataFrame:
    """One sorted report a kind and archive."""
    path = new_folder(spark, "reports")
    o = table(spark, sf, "orders").where("o_orderstatus IN ('O', 'F')")
    lines = o.select(F.when(F.col("o_orderstatus") == "O", "following").otherwise("followers").alias("kind"),
                     F.concat(F.lit("A"), (F.col("o_custkey") % 9).cast("string")).alias("archive"),
                     F.concat(F.lit("user"), F.col("o_custkey").cast("string")).alias("line"))
    made = writers.write_report(lines, path, scope=("archive",))
    path_name = F.regexp_extract("_metadata.file_path", "([^/]+/[^/]+)$", 1)
    files = spark.read.text(f"{path}/*", wholetext=True).select(path_name.alias("name"), F.md5("value").alias("content"))
    return files.select("name", "content", F.lit(made["following"]).alias("n_following"), F.lit(made["followers"]).alias("n_followers"))


@register("cache_compaction", oracle=f"""WITH {CACHE_SQL}
SELECT CAST(doc_id AS VARCHAR) AS id, array_to_string(CASE WHEN doc_id % 3 = 0 THEN list_append(responses, 'v2') ELSE responses END, ',')
         AS responses FROM cache""")
def cache_compaction(spark: SparkSession, sf: str) -> DataFrame:
    """An append taken in by a compaction, a second one merged, a third one read beside the buckets."""
    path = new_folder(spark, "cache")
    first = cache(spark, sf).select(F.col("doc_id").cast("string").alias("id"), "responses", F.lit(1).alias("version"), "doc_id")
    newer = first.where("doc_id % 3 = 0").withColumn("version", F.lit(2)).withColumn(
        "responses", F.concat("responses", F.array(F.lit("v2"))))
    rows = ["id", "responses", "version"]
    writers.append_cache(first.select(*rows), path)
    cache_table.compact(spark, path, buckets=8)
    writers.append_cache(newer.where("doc_id % 2 = 0").select(*rows), path)
    cache_table.compact(spark, path)
    writers.append_cache(newer.where("doc_id % 2 = 1").select(*rows), path)
    return datasets.read_cache_table(spark, path).select("id", F.array_join("responses", ",").alias("responses"))


@register("thread_cache_join", oracle=f"""
SELECT conv_id AS id, count(*) AS n_turns, NOT any_value(p.page_id IS NULL) AS cached, coalesce(any_value(p.url), '') AS context
FROM conversations c LEFT JOIN pages p ON p.page_id = c.conv_id WHERE role = 'assistant' GROUP BY conv_id""")
def thread_cache_join(spark: SparkSession, sf: str) -> DataFrame:
    """Cached thread contexts; what the cache does not hold stays, to be fetched."""
    replies = table(spark, sf, "conversations").where("role = 'assistant'").groupBy(F.col("conv_id").alias("id")).agg(
        F.count(F.lit(1)).alias("n_turns"))
    known = table(spark, sf, "pages").select(F.col("page_id").alias("id"), F.array("url").alias("context"))
    j = threads.join_thread_cache(replies, known, CFG)
    return j.select("id", "n_turns", F.col("context").isNotNull().alias("cached"),
                    F.coalesce(F.array_join("context", "||"), F.lit("")).alias("context"))


@register("users_merged", oracle="""
WITH u AS (SELECT CAST(c_custkey AS VARCHAR) AS user_id, c_name AS handle FROM customer WHERE c_acctbal >= 0),
l AS (SELECT CAST(c_custkey AS VARCHAR) AS user_id, CASE WHEN c_custkey % 5 <> 0 THEN 'found_' || CAST(c_custkey AS VARCHAR) END AS handle
      FROM customer WHERE c_custkey % 2 = 0)
SELECT user_id, handle FROM u WHERE user_id NOT IN (SELECT user_id FROM l WHERE handle IS NOT NULL)
UNION ALL SELECT user_id, handle FROM l WHERE handle IS NOT NULL""")
def users_merged(spark: SparkSession, sf: str) -> DataFrame:
    """Looked-up users take the place of known ones; those without a handle do not."""
    ck = F.col("c_custkey").cast("string")
    found = table(spark, sf, "customer").where("c_custkey % 2 = 0").select(
        ck.alias("user_id"), F.when(F.col("c_custkey") % 5 != 0, F.concat(F.lit("found_"), ck)).alias("handle"))
    return identity.merge_users(users(spark, sf), found)


@register("overlength_rows", oracle="""
SELECT doc_id, CAST(n_chars % 500 AS BIGINT) AS n_ids FROM documents WHERE n_chars % 500 <= 384""")
def overlength_rows(spark: SparkSession, sf: str) -> DataFrame:
    """L4: rows whose ids fit the longest sequence."""
    d = table(spark, sf, "documents").select("doc_id", F.array_repeat(F.lit(7), (F.col("n_chars") % 500).cast("int")).alias("input_ids"))
    return trainset.drop_overlength(d, CFG.max_seq_length).select("doc_id", F.size("input_ids").cast("bigint").alias("n_ids"))


@register("post_unwrap", oracle="""
SELECT event_id, 'did ' || event_type AS full_text, event_id % 3 <> 2 AS has_reply_key, event_id % 2 = 0 AS has_entities FROM events""")
def post_unwrap(spark: SparkSession, sf: str) -> DataFrame:
    """Posts as archive elements, every other one in its envelope; keys may be absent or null."""
    e = table(spark, sf, "events")
    text = F.concat(F.lit('"full_text": "did '), "event_type", F.lit('"'))
    reply = F.when(F.col("event_id") % 3 == 0, F.lit(', "in_reply_to_status_id": null')).when(
        F.col("event_id") % 3 == 1, F.lit(', "in_reply_to_status_id": "5"')).otherwise("")
    ents = F.when(F.col("event_id") % 2 == 0, F.lit(', "entities": {"urls": []}')).otherwise("")
    body = F.concat(F.lit("{"), text, reply, ents, F.lit("}"))
    raw = e.select("event_id", F.when(F.col("event_id") % 4 < 2, F.concat(F.lit('{"tweet": '), body, F.lit("}"))).otherwise(body).alias("json"))
    return posts.parse_posts(raw).select("event_id", F.col("p.full_text").alias("full_text"), "has_reply_key", "has_entities")


@register("group_user_ids", oracle="""
WITH e AS (SELECT event_type, json_extract_string(props, '$.k') AS k FROM events)
SELECT DISTINCT user_id FROM (
  SELECT k AS user_id FROM e WHERE event_type IN ('view', 'signup', 'purchase')
  UNION ALL SELECT CAST(CAST(k AS INTEGER) + 1 AS VARCHAR) FROM e WHERE event_type IN ('signup', 'purchase')
  UNION ALL SELECT CAST(CAST(k AS INTEGER) + 2 AS VARCHAR) FROM e WHERE event_type = 'purchase') WHERE user_id IS NOT NULL""")
def group_user_ids(spark: SparkSession, sf: str) -> DataFrame:
    """The ids that group conversations name."""
    return identity.group_ids(group_raw(spark, sf))


@register("reply_rounds", oracle="""
SELECT conv_id, turn, CAST(r.round AS BIGINT) AS round FROM conversations, (SELECT unnest(range(0, 3)) AS round) r WHERE role = 'assistant'""")
def reply_rounds(spark: SparkSession, sf: str) -> DataFrame:
    """X1 for replies: rows repeated by the replies' factor."""
    rows = table(spark, sf, "conversations").where("role = 'assistant'").select("conv_id", "turn")
    return corpus.rounds(rows, 3).withColumn("round", F.col("round").cast("bigint"))
