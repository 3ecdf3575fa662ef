"""Instruction-corpus construction.

Originals: every post is drawn ``augmentation`` times (rounds); each round a 4-arm
categorical draw decides between an open question, a completion split, a topic question
and an unconditional row, each arm with its own length gate.  Replies: the reply becomes
the output and its context (earlier turns) the instruction.  All draws are md5 uniforms
keyed by ``(id, round, salt)``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadsmith.config import CorpusConfig
from threadsmith.functions import templates
from threadsmith.functions.draws import pick_index, randint, uniform
from threadsmith.functions.text import gate_length, passes_gate, split_sentences
from threadsmith.operators.ordering import ordered_index
from threadsmith.operators.topics import choose_topics

ROW_COLUMNS = ["instruction", "input", "output"]
#: turns whose texts travel as one row to the later turns of their conversation
SEGMENT = 64


def rounds(df: DataFrame, factor: int) -> DataFrame:
    """Repeat every row ``factor`` times with a ``round`` column (narrow; no join)."""
    if factor <= 0:
        return df.withColumn("round", F.lit(None).cast("int")).limit(0)
    return df.withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(factor - 1))))


def arm_of(u, thresholds) -> "F.Column":
    t0, t1, t2, _ = thresholds
    return F.when(u < t0, "open").when(u < t1, "complete").when(u < t2, "topic").otherwise("plain")


def open_question(keys, seed: str):
    bank = templates.OPEN_QUESTIONS
    return templates.pick(bank, pick_index(uniform(keys, "tmpl", seed), len(bank)))


def keep_rows(df: DataFrame, keep, **cols) -> DataFrame:
    """Project ``cols`` and keep rows where ``keep`` holds, evaluating every expression
    once: the candidate row is built as a struct and filtered inside a generator, so the
    optimizer cannot push the (expensive) predicate below the projection and recompute it."""
    row = F.struct(*[c.alias(n) for n, c in cols.items()], keep.alias("__keep"))
    return df.select(F.inline(F.filter(F.array(row), lambda r: r["__keep"]))).drop("__keep")


def original_rows(posts: DataFrame, cfg: CorpusConfig, lexicon: DataFrame | None,
                  id_col: str = "id", text_col: str = "text",
                  shown: Callable[[Column], Column] | None = None) -> DataFrame:
    """Instruction rows from original posts: ``id, round, arm, instruction, input, output``.  ``shown`` may give the
    part of a topic row's text that the caller needs: no more of it goes through the topic join.

    Plan: the draw is narrow; only topic-arm rows take part in the topic join (the other
    arms never shuffle); results are united."""
    keys = [id_col, "round"]
    base = rounds(posts.select(id_col, text_col), cfg.augmentation_original)
    base = base.withColumn("arm", arm_of(uniform(keys, "arm", cfg.seed), cfg.arm_thresholds()))
    text = F.col(text_col)
    open_q = open_question(keys, cfg.seed)
    gate = cfg.response_thresh

    # arms open / complete / plain: narrow
    nt = base.filter(F.col("arm") != "topic")
    nt = nt.withColumn("__s", F.when(F.col("arm") == "complete", split_sentences(text, cfg.delimiters)))
    n = F.size("__s")
    multi = (F.col("arm") == "complete") & (n > 1)
    nt = nt.withColumn("__k", F.when(multi, randint(uniform(keys, "cut", cfg.seed), F.lit(1), n - 1)))
    nt = nt.withColumn("__prefix", F.when(multi, F.array_join(F.slice("__s", F.lit(1), F.col("__k")), "")))
    rest = F.array_join(F.slice("__s", F.col("__k") + 1, n - F.col("__k")), "")
    arm = F.col("arm")
    instruction = (F.when(arm == "open", open_q).when(multi, F.col("__prefix"))
                   .when(arm == "complete", open_q).otherwise(F.lit("")))
    keep = (F.when(arm == "open", passes_gate(text, gate))
            .when(multi, passes_gate(F.col("__prefix"), gate)).otherwise(F.lit(True)))
    nt_rows = keep_rows(nt, keep, **{id_col: F.col(id_col), "round": F.col("round"), "arm": arm,
                                     "instruction": instruction, "input": F.lit(""),
                                     "output": F.when(multi, rest).otherwise(text)})

    # arm topic: topic question (or the open question when there is none), gated on the
    # text.  Only these rows meet the topic table; the join is left to AQE (broadcast
    # while the topic table is small, sort-merge beyond) - carrying the text through the
    # topic aggregation instead would force a sort-based aggregate over the texts.
    tp = base.filter((F.col("arm") == "topic") & passes_gate(text, gate))
    tp_text = text if shown is None else shown(text)
    if lexicon is not None:
        # posts can share an id (an archive keeps both parts' copies): the text tells them apart
        tp = tp.withColumn("__text", F.md5(text))
        topics = choose_topics(tp, keys, text_col, lexicon, cfg, apart=["__text"], once=True)
        tp = tp.select(*keys, "arm", "__text", tp_text.alias("__shown")).join(topics.select(*keys, "__text", "topic_instruction"), [*keys, "__text"], "left")
        t_instr, tp_text = F.coalesce(F.col("topic_instruction"), open_q), F.col("__shown")
    else:
        t_instr = open_q
    tp_rows = tp.select(
        id_col, "round", "arm", t_instr.alias("instruction"), F.lit("").alias("input"), tp_text.alias("output"))
    return nt_rows.unionByName(tp_rows)


def thread_contexts(turns: DataFrame, conv_col: str = "conv_id", order_col: str = "turn",
                    text_col: str = "text", wanted: Column | None = None, segment: int = SEGMENT) -> DataFrame:
    """Turns (all, or the ``wanted`` ones) with the ordered texts of all earlier turns of their conversation.

    A segmented scan: turns are numbered from strides and ``segment`` of them in a row are one row of texts.
    A segment's texts are copied to the later segments of the conversation, where they meet that segment's turns.
    So no task needs more than one context and one segment at a time, and the shuffle is ``1/segment`` of what the
    contexts themselves hold.  Null texts are no part of a context."""
    x = ordered_index(turns, [conv_col], [order_col], idx_col="__i", count_col="__n", wide=True)
    row = F.struct(*[F.col(c) for c in turns.columns])
    turn = F.struct(F.col("__i").alias("i"), F.col(text_col).alias("text"),
                    (row if wanted is None else F.when(wanted, row)).alias("row"))
    by_number = lambda a, b: (a["i"] - b["i"]).cast("int")  # noqa: E731  within a segment
    segments = x.groupBy(F.col(conv_col).alias("__conv"), F.floor(F.col("__i") / segment).alias("__seg")).agg(
        F.array_sort(F.collect_list(turn), by_number).alias("__turns"),
        F.floor((F.max("__n") - 1) / segment).alias("__last"))
    here = F.col("__to") == F.col("__seg")
    said = F.transform(F.filter("__turns", lambda t: t["text"].isNotNull()), lambda t: t["text"])
    copies = segments.select("__conv", "__seg", "__turns", F.explode(F.sequence("__seg", "__last")).alias("__to")).select(
        "__conv", "__to", F.when(here, F.col("__turns")).alias("__own"),
        F.when(~here, F.struct("__seg", said.alias("texts"))).alias("__said"))
    met = copies.groupBy("__conv", "__to").agg(F.first("__own", ignorenulls=True).alias("__own"),
                                               F.array_sort(F.collect_list("__said")).alias("__before"))
    before = F.flatten(F.transform("__before", lambda s: s["texts"]))
    out = met.select(before.alias("__before"), "__own", F.posexplode("__own").alias("__k", "__turn")).where(
        F.col("__turn.row").isNotNull())
    own = F.transform(F.filter(F.slice("__own", F.lit(1), F.col("__k")), lambda t: t["text"].isNotNull()), lambda t: t["text"])
    return out.select("__turn.row.*", F.concat("__before", own).alias("context"))


def reply_rows(replies: DataFrame, cfg: CorpusConfig, id_cols: list[str],
               text_col: str = "text", context_col: str = "context") -> DataFrame:
    """Gate (X7) and pair (X8): reply interesting, context non-empty and interesting."""
    ctx = F.col(context_col)
    gate = (passes_gate(F.col(text_col), cfg.response_thresh)
            & ctx.isNotNull() & (F.size(ctx) > 0)
            & passes_gate(F.array_join(ctx, ""), cfg.response_thresh))
    return (replies.filter(gate)
            .select(*id_cols, F.size(ctx).alias("n_context"),
                    F.array_join(ctx, cfg.reply_delimiter).alias("instruction"),
                    F.lit("").alias("input"), F.col(text_col).alias("output"),
                    F.element_at(ctx, -1).alias("last_context")))


def suffix_rows(replies: DataFrame, cfg: CorpusConfig, id_cols: list[str], text_col: str = "text",
                context_col: str = "context") -> DataFrame:
    """X11: the reply with a drawn part of its context: all of it (number 0), or its last r < n texts, with weight
    (r + 1)^-temperature among the numbers whose texts pass the gate together.

    Lengths only grow with r, so the texts that pass are 0 and all r from the first one on; one draw is inverted
    over the weights of these, and nothing is drawn again.  A text's length is measured on its own."""
    ctx, n = F.col(context_col), F.size(context_col)
    gate = (passes_gate(F.col(text_col), cfg.response_thresh) & (n > 0)
            & passes_gate(F.array_join(ctx, ""), cfg.response_thresh))
    x = replies.filter(gate).withColumn("__n", n)
    start = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("r"), F.lit(0).alias("least"))

    def longer(a, text):
        total, r = a["sum"] + gate_length(text), a["r"] + 1
        least = F.when((a["least"] == 0) & (total >= cfg.response_thresh), r).otherwise(a["least"])
        return F.struct(total.alias("sum"), r.alias("r"), least.alias("least"))

    x = x.withColumn("__least", F.aggregate(F.reverse(context_col), start, longer)["least"])
    some = (F.col("__least") > 0) & (F.col("__least") < F.col("__n"))
    numbers = F.when(some, F.sequence(F.col("__least"), F.col("__n") - 1)).otherwise(F.array().cast("array<int>"))
    weight = lambda r: F.pow((r + 1).cast("double"), F.lit(-float(cfg.reply_temperature)))
    x = x.withColumn("__rs", numbers)
    whole = F.aggregate("__rs", F.lit(1.0), lambda a, r: a + weight(r))
    x = x.withColumn("__aim", uniform(id_cols, "suffix", cfg.seed) * whole)
    first = F.struct(F.lit(1.0).alias("sum"), F.when(F.col("__aim") < 1.0, F.lit(0)).alias("r"))
    found = F.aggregate("__rs", first, lambda a, r: F.struct(
        (a["sum"] + weight(r)).alias("sum"), F.coalesce(a["r"], F.when(F.col("__aim") < a["sum"] + weight(r), r)).alias("r")))["r"]
    x = x.withColumn("__r", F.coalesce(found, F.col("__n") - 1))
    part = F.when(F.col("__r") == 0, ctx).otherwise(F.slice(context_col, F.col("__n") - F.col("__r") + 1, F.col("__r")))
    return x.select(*id_cols, F.size(part).alias("n_context"), F.array_join(part, "\n").alias("instruction"),
                    F.lit("").alias("input"), F.col(text_col).alias("output"))


def reply_topic_rows(pairs: DataFrame, cfg: CorpusConfig, id_cols: list[str],
                     lexicon: DataFrame) -> DataFrame:
    """With probability ``reply_topic_prob`` an extra topic question about the last
    context message; skipped when that message has no topic."""
    keys = id_cols
    lucky = pairs.filter(uniform(keys, "aug", cfg.seed) < cfg.reply_topic_prob)
    topics = choose_topics(lucky.select(*keys, "output", F.col("last_context").alias("__ctx")),
                           keys, "__ctx", lexicon, cfg, carry=["output"])
    return (topics.filter(F.col("topic_instruction").isNotNull())
            .select(*keys, F.col("topic_instruction").alias("instruction"), F.lit("").alias("input"), "output"))


def gated_replies(turns: DataFrame, cfg: CorpusConfig, conv_col: str = "conv_id", order_col: str = "turn",
                  text_col: str = "text", mark: str | None = None) -> DataFrame:
    """X7 without the contexts themselves: turns that pass the gate and whose earlier turns together pass it,
    with ``n_context``.  With ``mark`` all turns that have a text stay and that column tells which pass.  Turn numbers
    and running lengths come from strides, so a hot conversation spreads."""
    said = turns.where(F.col(text_col).isNotNull())
    x = ordered_index(said.withColumn("__len", gate_length(F.col(text_col))), [conv_col], [order_col],
                      idx_col="n_context", running={"__before": F.col("__len")}, wide=True)
    passes = (F.col("__len") >= cfg.response_thresh) & (F.col("n_context") > 0) & (F.col("__before") >= cfg.response_thresh)
    x = x.filter(passes) if mark is None else x.withColumn(mark, F.coalesce(passes, F.lit(False)))
    return x.drop("__len", "__before")


def with_last_text(turns: DataFrame, conv_col: str = "conv_id", order_col: str = "turn", text_col: str = "text",
                   number_col: str = "n_context", wanted: Column | None = None) -> DataFrame:
    """``turns`` (all, or the ``wanted`` ones) numbered in ``number_col`` with ``last_context``, the text of the turn
    before.  Every turn's text is copied to the next number, so no task holds a conversation."""
    row = F.struct(*[F.col(c) for c in turns.columns])
    both = F.array(F.lit(0), F.lit(1))
    shifted = turns.select(F.col(conv_col).alias("__conv"), F.col(number_col).alias("__i"), F.col(text_col).alias("__text"),
                           row.alias("__row"),
                           F.explode(both if wanted is None else F.when(wanted, both).otherwise(F.array(F.lit(1)))).alias("__by"))
    own = F.col("__by") == 0
    met = shifted.groupBy("__conv", (F.col("__i") + F.col("__by")).alias("__at")).agg(
        F.first(F.when(own, F.col("__row")), ignorenulls=True).alias("__row"),
        F.first(F.when(~own, F.col("__text")), ignorenulls=True).alias("last_context"))
    return met.where(F.col("__row").isNotNull()).select("__row.*", "last_context")


def context_histogram(pairs: DataFrame) -> DataFrame:
    """Number of pairs per context length."""
    return pairs.groupBy("n_context").agg(F.count(F.lit(1)).alias("n_pairs"))


def shuffled(df: DataFrame, key_col: str = "shuffle_key", num_partitions: int | None = None) -> DataFrame:
    """A stable shuffled order.  The md5 key is uniform, so hash-partitioning on it
    and sorting inside each partition yields a deterministic pseudo-random permutation
    without the sampling pass a global range sort needs.  By default the partition count
    is the session's ``spark.sql.shuffle.partitions``, which AQE may coalesce."""
    parted = df.repartition(num_partitions, key_col) if num_partitions else df.repartition(key_col)
    return parted.sortWithinPartitions(key_col)


def shuffle_key(cols: list, seed: str):
    """A stable shuffle key (md5 of the row identity), not ``rand()``."""
    return F.md5(F.concat_ws("|", F.lit(seed), *[F.col(c).cast("string") for c in cols], F.lit("shuf")))
