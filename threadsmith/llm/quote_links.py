"""Quotation linking: conversations in reply order, without their quotes.

Quote marks at the start of a line give its level.  Runs of lines of one level are quoted passages.  Every
quoted line, paragraph and whole passage is normalised, hashed without white space (clients wrap lines anew) and joined
to the earliest message of the conversation that wrote it itself as a line, a paragraph or its whole text; a short
one only if a single earlier turn holds it.  Most characters decide which message a passage quotes, and the passages of
the least level which message is replied to.  A message that quotes none starts a thread.  Threads come in the order of their first turn,
their messages by turn, so that each reply follows what it replies to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from threadsmith.llm.common import cut

MARKS = r"^(?:[ \t]*>)+"
#: shorter normalised texts (thanks, yes) are common to many messages and link only if a single earlier turn holds them
LEAST_CHARS = 8
#: "Somebody wrote:" above a quoted line belongs to the quote
ATTRIBUTION = r"(?i)\b(wrote|writes|said|schrieb|a écrit|escribió)\s*:\s*$"
#: turns, and threads, that one task numbers at most
STRIDE = 4096


def normalise(line: Column) -> Column:
    """Lower case, punctuation and white space runs to one space, trimmed."""
    return F.trim(F.regexp_replace(F.lower(line), r"[\p{P}\p{S}\s]+", " "))


def parsed_lines(text: Column) -> Column:
    """Lines of a text as structs: level of quotation, body without marks."""
    def line(x: Column) -> Column:
        marks = F.regexp_extract(x, MARKS, 0)
        return F.struct(F.char_length(F.regexp_replace(marks, r"[^>]", "")).alias("level"),
                        F.trim(F.substr(x, F.char_length(marks) + 1)).alias("body"))
    return F.transform(F.split(F.regexp_replace(text, r"\r\n?", "\n"), "\n"), line)


def own_lines(lines: Column) -> Column:
    """Bodies of level 0, without the attribution above a quote."""
    def own(x: Column, i: Column) -> Column:
        following = F.get(lines, i + 1)
        introduces = x["body"].rlike(ATTRIBUTION) & F.coalesce(following["level"] > 0, F.lit(False))
        return (x["level"] == 0) & ~introduces
    return F.transform(F.filter(lines, own), lambda x: x["body"])


def starts_passage(lines: Column):
    """Filter for the first line of each quoted passage, a run of lines of one level."""
    return lambda x, i: (x["level"] > 0) & (x["level"] != F.coalesce(
        F.when(i > 0, F.get(lines, i - 1))["level"], F.lit(-1)))


def joined_parts(bodies: Column, lines: Column) -> Column:
    """The paragraphs (between blank lines) of an array of bodies, normalised in ``lines``, and their whole text."""
    text = F.array_join(F.zip_with(bodies, lines, lambda b, x: F.when(F.trim(b) == "", "\n").otherwise(x)), " ")
    parts = F.concat(F.split(text, "\n"), F.array(F.replace(text, F.lit("\n"), F.lit(" "))))
    return F.transform(parts, lambda x: F.trim(F.regexp_replace(x, " +", " ")))


def text_hash(text: Column) -> Column:
    return F.md5(F.replace(text, F.lit(" "), F.lit("")))


def originals(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of messages (c, t, own): (c, hash, original) of long texts, with the earliest turn that wrote them, and
    (c, hash, original, next) of short ones, with the two earliest (next is null if one turn only wrote it)."""
    lines = F.transform("own", normalise)
    parts = messages.select("c", "t", "own", lines.alias("lines"))
    parts = parts.select("c", "t", F.explode(F.array_distinct(F.concat(
        "lines", joined_parts(F.col("own"), F.col("lines"))))).alias("part")).where("part <> ''")
    parts = parts.select("c", "t", text_hash(F.col("part")).alias("hash"), (F.char_length("part") < LEAST_CHARS).alias("short"))
    long = parts.where(~F.col("short")).groupBy("c", "hash").agg(F.min("t").alias("original"))
    turns = parts.where("short").groupBy("c", "hash", "t").agg(F.lit(1).alias("one"))
    first = turns.withColumn("n", F.row_number().over(W.partitionBy("c", "hash").orderBy("t"))).where("n <= 2")
    return long, first.groupBy("c", "hash").agg(F.min("t").alias("original"),
                                                F.max(F.when(F.col("n") == 2, F.col("t"))).alias("next"))


def quoted_texts(messages: DataFrame) -> DataFrame:
    """(c, t, row, passage, level, text) of the quoted lines, paragraphs and passages of messages (c, t, row, lines),
    normalised."""
    lines = messages.select("c", "t", "row", F.posexplode("lines").alias("at", "x")).select("c", "t", "row", "at", "x.*")
    order = W.partitionBy("c", "t", "row").orderBy("at")
    begins = F.when(F.col("level") != F.coalesce(F.lag("level").over(order), F.lit(-1)), 1).otherwise(0)
    runs = lines.withColumn("begins", begins).withColumn("passage", F.sum("begins").over(order))
    runs = runs.where("level > 0").groupBy("c", "t", "row", "passage", "level").agg(
        F.array_sort(F.collect_list(F.struct("at", "body"))).alias("run"))
    runs = runs.withColumn("bodies", F.col("run.body")).withColumn("lines", F.transform("run.body", normalise))
    parts = joined_parts(F.col("bodies"), F.col("lines"))
    return runs.select("c", "t", "row", "passage", "level", F.explode(F.concat(
        "lines", F.array_except(parts, F.col("lines")))).alias("text")).where("text <> ''")


def _roots(replies: DataFrame) -> DataFrame:
    """(c, t, root, depth) of replies (c, t, parent): pointers jump to their target's target until all reach a
    message that replies to none; rounds grow with the logarithm of the longest chain."""
    state = cut(replies.select("c", "t", F.col("parent").alias("root"), F.lit(1).alias("depth")))
    while True:
        target = state.select(F.col("c").alias("tc"), F.col("t").alias("tt"), F.col("root").alias("up"),
                              F.col("depth").alias("more"))
        moved = state.join(target, (F.col("c") == F.col("tc")) & (F.col("root") == F.col("tt")), "left")
        state = cut(moved.select("c", "t", F.coalesce("up", "root").alias("root"),
                                 (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
                                 F.col("up").isNotNull().alias("jumped")))
        if not state.where("jumped").limit(1).count():
            return state.drop("jumped")
        state = state.drop("jumped")


def _positions(threads: DataFrame) -> DataFrame:
    """``threads`` with position: number of the message in (c, thread, t) order from 0.  A long conversation is dealt
    over strides of threads and turns; their counts, one row each, give the offsets."""
    strided = threads.withColumn("s1", F.floor(F.col("thread") / STRIDE)).withColumn("s2", F.floor(F.col("t") / STRIDE))
    fine = strided.groupBy("c", "s1", "thread", "s2").agg(F.count("*").alias("n"))
    coarse = fine.groupBy("c", "s1").agg(F.sum("n").alias("n"))
    coarse = coarse.select("c", "s1", F.coalesce(F.sum("n").over(
        W.partitionBy("c").orderBy("s1").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    fine = fine.select("c", "s1", "thread", "s2", F.coalesce(F.sum("n").over(
        W.partitionBy("c", "s1").orderBy("thread", "s2").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("skip"))
    offsets = fine.join(coarse, ["c", "s1"]).select("c", "thread", "s2", (F.col("base") + F.col("skip")).alias("offset"))
    at = F.row_number().over(W.partitionBy("c", "thread", "s2").orderBy("t", "row"))
    return strided.withColumn("at", at).join(offsets, ["c", "thread", "s2"]).withColumn(
        "position", F.col("offset") + F.col("at") - 1)


def link_quotations(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                    text_col: str = "text") -> DataFrame:
    """``messages`` -> (conv, turn, role, text without quotes, position, thread_turn, parent_turn, depth, n_passages,
    n_linked), one row a message.

    Null text counts as empty.  Rows with a null conversation or turn are carried with null position, thread and parent.
    Messages of one turn are ordered by their text's hash, and quotes of any of them link to that turn.  Other columns are
    ignored.  Links are joined on conversation and text hash after originals are combined to the earliest turn (or two) a hash,
    so that a hot conversation or line spreads and adds no more rows than its quotes."""
    rows = messages.select(
        F.col(f"`{conv_col}`").alias("c"), F.col(f"`{turn_col}`").cast("long").alias("t"),
        F.col(f"`{role_col}`").alias("role"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("raw"))
    parsed = rows.withColumn("lines", parsed_lines(F.col("raw")))
    parsed = parsed.select("c", "t", "role", F.xxhash64("raw", "role").alias("row"), "lines",
                           own_lines(F.col("lines")).alias("own"))
    placed = parsed.where("c IS NOT NULL AND t IS NOT NULL")
    long, short = originals(placed)
    quoting = placed.where(F.exists("lines", lambda x: x["level"] > 0)).dropDuplicates(["c", "t", "row"])
    quoted = quoted_texts(quoting).select("c", "t", "row", "passage", "level", text_hash(F.col("text")).alias("hash"),
                                          F.char_length("text").alias("chars"))
    hits = quoted.where(F.col("chars") >= LEAST_CHARS).join(long, ["c", "hash"]).where("original < t")
    alone = quoted.where(F.col("chars") < LEAST_CHARS).join(short, ["c", "hash"]).where(
        "original < t AND (next IS NULL OR next >= t)")
    hits = hits.unionByName(alone.drop("next"))
    votes = hits.groupBy("c", "t", "row", "passage", "level", "original").agg(F.sum("chars").alias("chars"))
    passages = votes.groupBy("c", "t", "row", "passage", "level").agg(
        F.max(F.struct("chars", "original")).alias("best"))
    linked = cut(passages.groupBy("c", "t", "row").agg(
        F.count("*").alias("n_linked"),
        F.max(F.struct((-F.col("level")).alias("near"), F.col("best.chars").alias("chars"),
                       F.col("best.original").alias("original")))["original"].alias("parent")))
    roots = _roots(linked.groupBy("c", "t").agg(F.max("parent").alias("parent")))
    plain = parsed.select("c", "t", "role", "row",
                          F.trim(F.regexp_replace(F.array_join("own", "\n"), r"\n{3,}", "\n\n")).alias("text"),
                          F.size(F.filter("lines", starts_passage(F.col("lines")))).alias("n_passages"))
    linked = linked.withColumnsRenamed({"c": "lc", "t": "lt", "row": "lrow"})
    roots = roots.withColumnsRenamed({"c": "rc", "t": "rt"})
    joined = plain.join(linked, (F.col("c") == F.col("lc")) & (F.col("t") == F.col("lt")) & (F.col("row") == F.col("lrow")), "left")
    joined = joined.join(roots, (F.col("c") == F.col("rc")) & (F.col("t") == F.col("rt")), "left")
    threads = joined.select("c", "t", "role", "row", "text", "n_passages", F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
                            "parent", F.coalesce("root", "t").alias("thread"), F.coalesce("depth", F.lit(0)).alias("depth"))
    known = F.col("c").isNotNull() & F.col("t").isNotNull()
    named = [F.col("c").alias(conv_col), F.col("t").alias(turn_col), F.col("role").alias(role_col),
             F.col("text").alias(text_col)]
    tail = ["n_passages", "n_linked"]
    ordered = _positions(threads.where(known)).select(
        *named, "position", F.col("thread").alias("thread_turn"), F.col("parent").alias("parent_turn"), "depth", *tail)
    null = F.lit(None).cast("long")
    rest = threads.where(~known).select(*named, null.alias("position"), null.alias("thread_turn"),
                                        null.alias("parent_turn"), "depth", *tail)
    return ordered.union(rest)
