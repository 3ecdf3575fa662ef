"""Corpus queries bound to ``documents``, ``benchmark`` and
``conversations``.  The driver tables hold Latin prose, so the ASCII delimiter set is
used; the CJK set of the original is the library default."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadsmith.config import ASCII
from threadsmith.functions import templates
from threadsmith.functions.draws import uniform
from threadsmith.functions.text import gate_length, split_sentences
from threadsmith.operators import corpus, topics
from threadsmith.plans import sqlfrag as S
from threadsmith.plans.registry import register, table

CFG = ASCII
GATE_THRESH_LONG = 40
WITH_REPLIES = CFG.with_(parse_replies=True)


# ---------------------------------------------------------------- shared pieces
def posts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(F.col("doc_id"), F.col("text"))


def lexicon(spark: SparkSession, sf: str) -> DataFrame:
    return topics.lexicon_from_text(table(spark, sf, "benchmark"), "text")


def originals(spark: SparkSession, sf: str, cfg=CFG, shown: Callable[[Column], Column] | None = None) -> DataFrame:
    return corpus.original_rows(posts(spark, sf), cfg, lexicon(spark, sf), id_col="doc_id", shown=shown)


def reply_pairs_df(spark: SparkSession, sf: str) -> DataFrame:
    conv = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    return corpus.reply_rows(contexts(conv), CFG, ["conv_id", "turn"])


def contexts(conv: DataFrame) -> DataFrame:
    return corpus.thread_contexts(conv, wanted=F.col("role") == "assistant")


def gated_turns(spark: SparkSession, sf: str) -> DataFrame:
    """The replies that pass the gates, numbered, without their contexts."""
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    return corpus.gated_replies(turns, CFG).filter(F.col("role") == "assistant")


def reply_topics_df(spark: SparkSession, sf: str) -> DataFrame:
    """The last context text alone is needed, and only that meets the drawn replies."""
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    keys = ["conv_id", "turn"]
    lucky = corpus.gated_replies(turns, CFG, mark="__passes").withColumn(
        "__passes", F.col("__passes") & (F.col("role") == "assistant") & (uniform(keys, "aug", CFG.seed) < CFG.reply_topic_prob))
    pairs = corpus.with_last_text(lucky, wanted=F.col("__passes")).select(*keys, F.col("text").alias("output"), "last_context")
    return corpus.reply_topic_rows(pairs, CFG, keys, lexicon(spark, sf))


def corpus_union(spark: SparkSession, sf: str, shown: Callable[[Column], Column] | None = None) -> DataFrame:
    """Originals, replies and reply topics; with replies the originals draw by the arms for that case.  ``shown`` is the
    part of an output that the caller needs, as in ``original_rows``."""
    o = originals(spark, sf, WITH_REPLIES, shown).select(F.lit("original").alias("source"), F.col("doc_id").cast("string").alias("id"),
                                    F.col("round").cast("bigint").alias("round"), "instruction", "input", "output")
    r = reply_pairs_df(spark, sf)
    rid = F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    r1 = r.select(F.lit("reply").alias("source"), rid.alias("id"), F.lit(0).cast("bigint").alias("round"),
                  "instruction", "input", "output")
    t = reply_topics_df(spark, sf)
    r2 = t.select(F.lit("reply_topic").alias("source"), rid.alias("id"), F.lit(0).cast("bigint").alias("round"),
                  "instruction", "input", "output")
    return o.unionByName(r1).unionByName(r2)


# ---------------------------------------------------------------- SQL pieces
LEX_SQL = ("lex AS (SELECT DISTINCT lower(w) AS word FROM (SELECT unnest(" + S.words("text") +
           ") AS w FROM benchmark) WHERE length(lower(w)) >= 4)")


def topics_sql(src: str, text: str, keys: list[str], prefix: str) -> str:
    """CTEs computing ``<prefix>topic(keys..., topic, topic_instruction)`` from ``src``."""
    k = ", ".join(keys)
    p = prefix
    trim = ", ".join(S.q(c) for c in CFG.topic_trim)
    nt = len(templates.TOPIC_TEMPLATES)
    return f"""
{p}s AS (SELECT {k}, {S.sents(text, CFG.delimiters)} AS ss FROM {src}),
{p}t AS (SELECT {k}, ss[{S.pick(S.u(keys, 'sent'), 'len(ss)')} + 1] AS sent0 FROM {p}s WHERE len(ss) > 1),
{p}tr AS (SELECT {k}, CASE WHEN right(sent0, 1) IN ({trim}) THEN left(sent0, length(sent0) - 1) ELSE sent0 END AS sent
          FROM {p}t),
{p}w AS (SELECT {k}, unnest(generate_series(0, len(ws) - 1)) AS pos, unnest(ws) AS word
         FROM (SELECT {k}, {S.words('sent')} AS ws FROM {p}tr)),
{p}n AS (SELECT {', '.join(p + 'w.' + c for c in keys)}, list({p}w.word ORDER BY {p}w.pos) AS nouns
         FROM {p}w JOIN lex ON lower({p}w.word) = lex.word GROUP BY ALL),
{p}tp AS (SELECT {k}, coalesce(CASE WHEN len(nouns) > 0 THEN nouns[{S.pick(S.u(keys, 'noun'), 'len(nouns)')} + 1] END,
                             sent) AS topic
          FROM {p}tr LEFT JOIN {p}n USING ({k})),
{p}topic AS (SELECT {k}, topic,
             replace({templates.sql_list(templates.TOPIC_TEMPLATES)}[{S.pick(S.u(keys, 'ttmpl'), str(nt))} + 1],
                     '{templates.TOPIC_SLOT}', topic) AS topic_instruction FROM {p}tp)"""


def originals_sql(cfg=CFG) -> str:
    T = cfg.arm_thresholds()
    keys = ["doc_id", "round"]
    no = len(templates.OPEN_QUESTIONS)
    openq = f"{templates.sql_list(templates.OPEN_QUESTIONS)}[{S.pick(S.u(keys, 'tmpl'), str(no))} + 1]"
    ua = S.u(keys, "arm")
    g = CFG.response_thresh
    return f"""
base AS (SELECT doc_id, CAST(r.round AS BIGINT) AS round, text
         FROM documents, (SELECT unnest(range(0, {CFG.augmentation_original})) AS round) r),
drawn AS (SELECT *, CASE WHEN {ua} < {T[0]} THEN 'open' WHEN {ua} < {T[1]} THEN 'complete'
                         WHEN {ua} < {T[2]} THEN 'topic' ELSE 'plain' END AS arm FROM base),
sx AS (SELECT *, CASE WHEN arm = 'complete' THEN {S.sents('text', CFG.delimiters)} END AS ss FROM drawn),
kx AS (SELECT *, CASE WHEN arm = 'complete' AND len(ss) > 1
                      THEN 1 + CAST(floor({S.u(keys, 'cut')} * (len(ss) - 1)) AS INTEGER) END AS k FROM sx),
{LEX_SQL},
tsrc AS (SELECT doc_id, round, text FROM drawn WHERE arm = 'topic'),
{topics_sql('tsrc', 'text', keys, 'o_')},
pre AS (SELECT kx.*, o_topic.topic_instruction,
               array_to_string(ss[1:k], '') AS prefix, array_to_string(ss[k+1:len(ss)], '') AS rest
        FROM kx LEFT JOIN o_topic USING (doc_id, round)),
orig AS (
  SELECT doc_id, round, arm,
    CASE WHEN arm = 'open' THEN {openq} WHEN k IS NOT NULL THEN prefix WHEN arm = 'complete' THEN {openq}
         WHEN arm = 'topic' THEN coalesce(topic_instruction, {openq}) ELSE '' END AS instruction,
    '' AS input,
    CASE WHEN k IS NOT NULL THEN rest ELSE text END AS output
  FROM pre
  WHERE CASE WHEN arm = 'open' THEN {S.gate('text', g)} WHEN k IS NOT NULL THEN {S.gate('prefix', g)}
             WHEN arm = 'complete' THEN true WHEN arm = 'topic' THEN {S.gate('text', g)} ELSE true END)"""


def replies_sql() -> str:
    g = CFG.response_thresh
    return f"""
cx AS (SELECT conv_id, turn, role, text,
              list(text) OVER (PARTITION BY conv_id ORDER BY turn
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ctx FROM conversations),
rp AS (SELECT conv_id, turn, CAST(len(ctx) AS BIGINT) AS n_context,
              array_to_string(ctx, '{CFG.reply_delimiter}') AS instruction, '' AS input, text AS output,
              ctx[len(ctx)] AS last_context, ctx
       FROM cx WHERE role = 'assistant' AND {S.gate('text', g)} AND ctx IS NOT NULL AND len(ctx) > 0
             AND {S.gate("array_to_string(ctx, '')", g)})"""


def reply_topics_sql() -> str:
    keys = ["conv_id", "turn"]
    return f"""
{replies_sql()},
{LEX_SQL},
lucky AS (SELECT * FROM rp WHERE {S.u(keys, 'aug')} < {CFG.reply_topic_prob}),
{topics_sql('lucky', 'last_context', keys, 'r_')},
rt AS (SELECT lucky.conv_id, lucky.turn, r_topic.topic_instruction AS instruction, '' AS input, lucky.output
       FROM lucky JOIN r_topic USING (conv_id, turn))"""


def union_sql() -> str:
    return f"""WITH {originals_sql(WITH_REPLIES)},
{reply_topics_sql().replace(LEX_SQL + ',', '', 1)},
u AS (
  SELECT 'original' AS source, CAST(doc_id AS VARCHAR) AS id, round, instruction, input, output FROM orig
  UNION ALL
  SELECT 'reply', CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR), CAST(0 AS BIGINT), instruction, input, output
  FROM rp
  UNION ALL
  SELECT 'reply_topic', CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR), CAST(0 AS BIGINT), instruction,
         input, output FROM rt)"""


# ---------------------------------------------------------------- queries
@register("instruction_corpus", oracle=f"WITH {originals_sql()} SELECT * FROM orig")
def instruction_corpus(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: documents -> 2 rounds of 4-arm draws -> gated instruction rows."""
    return originals(spark, sf).withColumn("round", F.col("round").cast("bigint"))


@register("sentence_split", oracle=f"""
SELECT doc_id, CAST(unnest(generate_series(0, len(ss) - 1)) AS BIGINT) AS pos, unnest(ss) AS sentence
FROM (SELECT doc_id, {S.sents('text', CFG.delimiters)} AS ss FROM documents)""")
def sentence_split(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents")
    return (d.select("doc_id", F.posexplode(split_sentences(F.col("text"), CFG.delimiters)).alias("pos", "sentence"))
            .withColumn("pos", F.col("pos").cast("bigint")))


@register("length_gate", oracle=f"""
SELECT conv_id, turn, CAST({S.gate_len('text')} AS BIGINT) AS gate_len, {S.gate('text', GATE_THRESH_LONG)} AS passes
FROM conversations""")
def length_gate(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "conversations")
    gl = gate_length(F.col("text"))
    return c.select("conv_id", "turn", gl.cast("bigint").alias("gate_len"), (gl >= GATE_THRESH_LONG).alias("passes"))


@register("topic_prompt", oracle=f"""WITH {LEX_SQL},
tsrc AS (SELECT doc_id, CAST(0 AS BIGINT) AS round, text FROM documents),
{topics_sql('tsrc', 'text', ['doc_id', 'round'], 'p_')}
SELECT tsrc.doc_id, p_topic.topic, p_topic.topic_instruction
FROM tsrc LEFT JOIN p_topic USING (doc_id, round)""")
def topic_prompt(spark: SparkSession, sf: str) -> DataFrame:
    d = posts(spark, sf).withColumn("round", F.lit(0).cast("bigint"))
    tp = topics.choose_topics(d, ["doc_id", "round"], "text", lexicon(spark, sf), CFG)
    return tp.select("doc_id", "topic", "topic_instruction")


@register("reply_pairs", oracle=f"WITH {replies_sql()} SELECT conv_id, turn, n_context, instruction, input, output FROM rp")
def reply_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return (reply_pairs_df(spark, sf).withColumn("n_context", F.col("n_context").cast("bigint"))
            .drop("last_context"))


@register("reply_suffixes", oracle=f"""WITH {replies_sql()},
sl AS (SELECT *, len(ctx) AS n, list_transform(ctx, lambda c: {S.gate_len('c')}) AS lens FROM rp),
sf AS (SELECT *, list_min(list_filter(range(1, n), lambda r: list_sum(lens[n - r + 1:n]) >= {CFG.response_thresh})) AS least
       FROM sl),
sr AS (SELECT *, CASE WHEN least IS NULL THEN [] ELSE range(least, n) END AS rs FROM sf),
sw AS (SELECT *, list_transform(rs, lambda r: pow(r + 1, {-CFG.reply_temperature})) AS ws FROM sr),
sa AS (SELECT *, {S.u(['conv_id', 'turn'], 'suffix')} * (1.0 + coalesce(list_sum(ws), 0.0)) AS aim FROM sw),
sd AS (SELECT *, CASE WHEN aim < 1.0 THEN 0 ELSE coalesce(list_min(list_filter(rs, lambda r:
         aim < 1.0 + list_sum(ws[1:r - least + 1]))), n - 1) END AS r FROM sa)
SELECT conv_id, turn, CASE WHEN r = 0 THEN n ELSE r END AS n_context,
       array_to_string(CASE WHEN r = 0 THEN ctx ELSE ctx[n - r + 1:n] END, chr(10)) AS instruction, input, output
FROM sd""")
def reply_suffixes(spark: SparkSession, sf: str) -> DataFrame:
    """X11: replies with a drawn suffix of their context."""
    conv = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    rows = corpus.suffix_rows(contexts(conv), CFG, ["conv_id", "turn"])
    return rows.withColumn("n_context", F.col("n_context").cast("bigint"))


@register("reply_topic_augment", oracle=f"WITH {reply_topics_sql()} SELECT * FROM rt")
def reply_topic_augment(spark: SparkSession, sf: str) -> DataFrame:
    return reply_topics_df(spark, sf)


@register("context_histogram", oracle=f"""WITH {replies_sql()}
SELECT n_context, CAST(count(*) AS BIGINT) AS n_pairs FROM rp GROUP BY n_context""")
def context_histogram(spark: SparkSession, sf: str) -> DataFrame:
    h = corpus.context_histogram(gated_turns(spark, sf))
    return h.select(F.col("n_context").cast("bigint").alias("n_context"), F.col("n_pairs").cast("bigint"))


@register("shuffled_corpus", oracle=f"""{union_sql()}
SELECT *, md5(concat_ws('|', '{CFG.seed}', source, id, CAST(round AS VARCHAR), 'shuf')) AS shuffle_key
FROM u ORDER BY shuffle_key""")
def shuffled_corpus(spark: SparkSession, sf: str) -> DataFrame:
    u = corpus_union(spark, sf)
    return corpus.shuffled(u.withColumn("shuffle_key", corpus.shuffle_key(["source", "id", "round"], CFG.seed)))


@register("corpus_counters", oracle=f"""{union_sql()}
SELECT source, round, CAST(count(*) AS BIGINT) AS n_rows FROM u GROUP BY source, round""")
def corpus_counters(spark: SparkSession, sf: str) -> DataFrame:
    """Counted before any context is built."""
    parts = [originals(spark, sf, WITH_REPLIES).select(F.lit("original").alias("source"), F.col("round").cast("bigint").alias("round"))]
    for source, rows in (("reply", gated_turns(spark, sf)), ("reply_topic", reply_topics_df(spark, sf))):
        parts.append(rows.select(F.lit(source).alias("source"), F.lit(0).cast("bigint").alias("round")))
    rows = parts[0].union(parts[1]).union(parts[2])
    return rows.groupBy("source", "round").agg(F.count(F.lit(1)).alias("n_rows"))
