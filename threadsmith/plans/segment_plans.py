"""Words of text without spaces (T3) over ``documents`` with their spaces taken out.

The lexicon is the words of ``benchmark`` with their frequencies; words of four letters or more are flagged ``n``.
The driver tables hold Latin text, so the script without spaces is Latin here."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadsmith.config import ASCII
from threadsmith.functions.text import words
from threadsmith.operators import segment, topics
from threadsmith.plans import sqlfrag as S
from threadsmith.plans.corpus_plans import topics_sql
from threadsmith.plans.registry import register, table

CFG = ASCII
LATIN = "A-Za-zÀ-ɏ"
SPACE = "[ \\t]+"


def lexicon(spark: SparkSession, sf: str) -> DataFrame:
    found = table(spark, sf, "benchmark").select(F.explode(words("text")).alias("w")).groupBy(
        F.lower("w").alias("word")).agg(F.count(F.lit(1)).alias("freq"))
    return found.withColumn("flag", F.when(F.length("word") >= 4, "n").otherwise("x"))


def joined_up(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents")
    # paths are long work on few bytes: texts go to all cores, whatever the file's row groups are
    spread = d.select("doc_id", "text").repartition(spark.sparkContext.defaultParallelism, "doc_id")
    return spread.select("doc_id", F.regexp_replace("text", SPACE, "").alias("text"))


LEXICON_SQL = f"""lf AS (SELECT lower(w) AS word, count(*) AS freq FROM (SELECT unnest({S.words('text')}) AS w FROM benchmark)
       GROUP BY lower(w)),
lw AS (SELECT word, CASE WHEN length(word) >= 4 THEN 'n' ELSE 'x' END AS flag,
              CAST(round(ln(freq / (SELECT sum(freq) FROM lf)) * {segment.SCALE}) AS BIGINT) AS weight FROM lf)"""


def paths_sql(src: str, text: str, keys: list[str]) -> str:
    """CTEs (in WITH RECURSIVE) computing ``found(piece, ws)``: the words of the best path of each distinct run of
    ``src``, and ``placed(keys..., ws)``, those of all runs of a row in order."""
    k = ", ".join(keys)
    return f"""
pc AS (SELECT {k}, unnest(ps) AS piece, generate_subscripts(ps, 1) AS pos
       FROM (SELECT {k}, regexp_extract_all({text}, '[{LATIN}]+') AS ps FROM {src})),
run AS (SELECT DISTINCT piece, length(piece) AS n FROM pc),
one AS (SELECT min(weight) AS unknown, max(length(word)) AS longest FROM lw),
st AS (SELECT piece, n, unnest(range(0, n)) AS a FROM run),
sp AS (SELECT piece, a, unnest(range(1, least(longest, n - a) + 1)) AS len FROM st, one),
ed AS (SELECT piece, a, a + len AS b, weight FROM sp JOIN lw ON lw.word = lower(substr(piece, a + 1, len))
       UNION ALL SELECT piece, a, a + 1, unknown FROM st, one),
eb AS (SELECT piece, b, list({{'a': a, 'w': weight}}) AS es FROM ed GROUP BY piece, b),
go(piece, n, done, score, back) AS (
  SELECT piece, n, CAST(0 AS BIGINT), [CAST(0 AS BIGINT)], [CAST(0 AS BIGINT)] FROM run
  UNION ALL
  SELECT piece, n, done + 1, list_append(score, best.s), list_append(back, CAST(-best.m AS BIGINT))
  FROM (SELECT go.*, list_max(list_transform(es, lambda e: {{'s': score[e.a + 1] + e.w, 'm': -e.a}})) AS best
        FROM go JOIN eb ON eb.piece = go.piece AND eb.b = go.done + 1 WHERE go.done < n)),
solved AS (SELECT piece, n, back FROM go WHERE done = n),
ret(piece, stop, back, ws) AS (
  SELECT piece, CAST(n AS BIGINT), back, CAST([] AS VARCHAR[]) FROM solved
  UNION ALL
  SELECT piece, back[stop + 1], back,
         list_prepend(substr(piece, CAST(back[stop + 1] + 1 AS BIGINT), CAST(stop - back[stop + 1] AS BIGINT)), ws)
  FROM ret WHERE stop > 0),
found AS (SELECT piece, ws FROM ret WHERE stop = 0),
placed AS (SELECT {k}, flatten(list(ws ORDER BY pos)) AS ws FROM pc JOIN found USING (piece) GROUP BY {k})"""


DOCS_SQL = f"joined AS (SELECT doc_id, regexp_replace(text, '{SPACE}', '', 'g') AS text FROM documents)"


@register("unspaced_words")
def unspaced_words(spark: SparkSession, sf: str) -> DataFrame:
    """All words of whole texts.  The SQL of ``unspaced_topics`` finds the paths of sentences; over whole texts it takes
    too long, so this query is tested against every segmentation of short texts."""
    found = segment.segment(joined_up(spark, sf), "text", lexicon(spark, sf), unspaced=LATIN)
    return found.select("doc_id", F.size("words").cast("bigint").alias("n_words"),
                        F.array_join(F.transform("words", lambda w: w["word"]), " ").alias("words"),
                        F.size(segment.nouns("words")).cast("bigint").alias("n_nouns"))


def _topics_sql() -> str:
    """The topic CTEs with the sentence's nouns taken from the paths."""
    sql = topics_sql("tsrc", "text", ["doc_id", "round"], "g_")
    start, end = sql.index("g_w AS"), sql.index("g_tp AS")
    nouns = f"""{paths_sql('g_tr', 'sent', ['doc_id', 'round'])},
gw AS (SELECT doc_id, round, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM placed),
g_n AS (SELECT gw.doc_id, gw.round, list(gw.word ORDER BY gw.pos) AS nouns FROM gw JOIN lw ON lw.word = lower(gw.word)
        WHERE lw.flag = 'n' GROUP BY gw.doc_id, gw.round),
"""
    return sql[:start] + nouns + sql[end:]


@register("unspaced_topics", oracle=f"""WITH RECURSIVE {LEXICON_SQL}, {DOCS_SQL},
tsrc AS (SELECT doc_id, CAST(0 AS BIGINT) AS round, text FROM joined),
{_topics_sql()}
SELECT tsrc.doc_id, g_topic.topic, g_topic.topic_instruction FROM tsrc LEFT JOIN g_topic USING (doc_id, round)""")
def unspaced_topics(spark: SparkSession, sf: str) -> DataFrame:
    d = joined_up(spark, sf).withColumn("round", F.lit(0).cast("bigint"))
    found = topics.choose_topics(d, ["doc_id", "round"], "text", lexicon(spark, sf), CFG, unspaced=LATIN)
    return found.select("doc_id", "topic", "topic_instruction")
