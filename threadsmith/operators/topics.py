"""Topic prompts (T3/T4): pick a random sentence, trim a trailing delimiter, pick a random
noun of that sentence from a lexicon table, and fill a topic template.

The lexicon ``(word, flag)`` replaces a part-of-speech tagger: a word counts as a noun
when its flag contains the letter ``n``.  Plan: the chosen sentence's words are exploded,
joined to the noun set (Spark chooses the join by its size) and re-assembled per key in
sentence order; only rows with >1 sentence take part.  For text without spaces the words come
from ``segment`` and the lexicon has a ``freq``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadsmith.config import CorpusConfig
from threadsmith.functions import templates
from threadsmith.functions.draws import pick_index, uniform
from threadsmith.functions.text import split_sentences, words
from threadsmith.operators.segment import nouns as segment_nouns
from threadsmith.operators.segment import segment


def lexicon_from_text(df: DataFrame, text_col: str = "text", min_noun_len: int = 4) -> DataFrame:
    """A stand-in lexicon derived from a text table: distinct lower-cased letter runs,
    flagged ``n`` when at least ``min_noun_len`` letters long, else ``x``."""
    w = df.select(F.explode(words(F.col(text_col))).alias("w"))
    w = w.select(F.lower("w").alias("word")).distinct()
    return w.withColumn("flag", F.when(F.length("word") >= min_noun_len, "n").otherwise("x"))


def noun_set(lexicon: DataFrame) -> DataFrame:
    return (lexicon.filter(F.col("flag").contains("n"))
            .select(F.lower("word").alias("__noun")).distinct())


def topic_sentence(sents, trim_chars: str, keys, seed: str):
    """The randomly chosen sentence with one trailing delimiter removed."""
    n = F.size(sents)
    sent = F.get(sents, pick_index(uniform(keys, "sent", seed), n))
    last = F.substring(sent, -1, 1)
    return F.when(last.isin(*list(trim_chars)), F.left(sent, F.length(sent) - 1)).otherwise(sent)


def choose_topics(df: DataFrame, keys: list[str], text_col: str, lexicon: DataFrame,
                  cfg: CorpusConfig, carry: list[str] | None = None,
                  apart: list[str] | None = None, unspaced: str | None = None, once: bool = False) -> DataFrame:
    """``keys..., carry..., topic, topic_instruction`` for every input row; topic and
    instruction are NULL when the text has at most one sentence.  Draws depend on ``keys``
    alone; ``apart`` columns tell rows with equal keys apart.  With ``unspaced`` (a regex class body of the
    script written without spaces) the words are those of ``segment``, found in the row.  With ``once`` rows
    that share ``keys`` and ``apart`` count as one: their sentences meet, not their texts.

    Plan: the sentence list is computed once per row; only the chosen sentence's words
    are exploded, tagged by a join with the noun set and re-assembled per
    key.  The row's other columns ride along on its first exploded word only, so the
    aggregation (partial, map-side) returns whole rows and no join back is needed: one
    shuffle in total."""
    apart = apart or []
    carry = [c for c in (carry or []) if c not in keys and c not in apart]
    draw, keys = keys, [*keys, *apart]
    sents = split_sentences(F.col(text_col), cfg.delimiters)
    t = (df.select(*keys, *carry, sents.alias("__s"))
         .select(*keys, *carry, F.when(F.size("__s") > 1, topic_sentence(F.col("__s"), cfg.topic_trim, draw, cfg.seed))
                 .alias("__sent")))
    if once:
        # grouped, not dropDuplicates: Spark shares the shuffles of two uses of these rows only so
        t = t.groupBy(*keys).agg(*[F.first(c).alias(c) for c in carry + ["__sent"]])
    if unspaced is not None:
        found = segment(t, "__sent", lexicon, "__words", unspaced).withColumn("__nouns", segment_nouns("__words"))
        return _with_topics(found, keys, carry, draw, F.col("__nouns"), cfg)
    nouns = noun_set(lexicon)
    exploded = t.select(*keys, *carry, "__sent",
                        F.posexplode_outer(words(F.col("__sent"))).alias("__pos", "__word"))
    first = F.col("__pos").isNull() | (F.col("__pos") == 0)
    exploded = exploded.select(*keys, *[F.when(first, F.col(c)).alias(c) for c in carry + ["__sent"]],
                               "__pos", "__word", first.alias("__first"))
    tagged = exploded.join(nouns, F.lower(F.col("__word")) == F.col("__noun"), "left")
    per_key = tagged.groupBy(*keys).agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in carry + ["__sent"]],
        F.array_sort(F.collect_list(
            F.when(F.col("__noun").isNotNull(), F.struct(F.col("__pos"), F.col("__word")))
        )).alias("__nouns"),
    )
    return _with_topics(per_key, keys, carry, draw, F.transform("__nouns", lambda n: n["__word"]), cfg)


def _with_topics(sentences: DataFrame, keys: list[str], carry: list[str], draw: list[str], nouns, cfg: CorpusConfig) -> DataFrame:
    """A drawn noun of the sentence (or the sentence itself) in a drawn template."""
    cnt = F.size(nouns)
    noun = F.when(cnt > 0, F.get(nouns, pick_index(uniform(draw, "noun", cfg.seed), cnt)))
    topic = F.when(F.col("__sent").isNotNull(), F.coalesce(noun, F.col("__sent")))
    tmpl = templates.pick(templates.TOPIC_TEMPLATES,
                          pick_index(uniform(draw, "ttmpl", cfg.seed), len(templates.TOPIC_TEMPLATES)))
    return sentences.select(*keys, *carry, topic.alias("topic"),
                            F.replace(tmpl, F.lit(templates.TOPIC_SLOT), topic).alias("topic_instruction"))
