"""Order-independent fingerprints: a homomorphic multiset hash of a text's paragraphs.

Each paragraph is hashed to a wide vector of words, a text's fingerprint is the sum of its paragraphs' vectors modulo
2^62, so that paragraphs can be added or taken out without the rest.  The first ``EXACT`` words come from the whole
paragraph and tell equal multisets.  The other words hold small counters (``LANES`` a word of 20 bits): the
paragraph's pieces, phrases of at most ``PIECE_CHARS`` characters, each add one bit of their hash to every
counter, and the correlation of two texts' counters estimates the likeness of their pieces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from threadsmith.llm.common import cut, text_or_empty

EXACT, COUNTERS, LANES, LANE_BITS = 4, 20, 3, 20
PIECE_CHARS = 64
MODULUS = 1 << 62
PIECES = r"[^ \t\n.!?,;:][^\n.!?,;:]{0,%d}" % (PIECE_CHARS - 1)
#: one bit of each counter in a word
SPREAD = sum(1 << (LANE_BITS * k) for k in range(LANES))
ROW_BITS = 33


def hex_number(text: Column, start: int) -> Column:
    """Fifteen hexadecimal digits as a number below 2^60."""
    return F.conv(F.substring(text, start, 15), 16, 10).cast("long")


def sum_modulo(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("long"),
                       lambda acc, x: (acc + x).bitwiseAND(F.lit(MODULUS - 1)))


def paragraphs(text: Column) -> Column:
    """Non-empty lines; an empty text has none."""
    return F.filter(F.split(text, "\n"), lambda p: p != "")


def digests(text: Column) -> tuple[Column, Column, Column]:
    """md5 of each paragraph, of each paragraph marked with #, and the hash of each piece."""
    lines = paragraphs(text)
    pieces = F.regexp_extract_all(text, F.lit(PIECES), F.lit(0))
    return (F.transform(lines, lambda p: F.md5(p)), F.transform(lines, lambda p: F.md5(F.concat(F.lit("#"), p))),
            F.transform(pieces, lambda p: hex_number(F.md5(p), 1)))


def vector(first: Column, second: Column, pieces: Column) -> Column:
    """The words of the fingerprint, then the number of pieces; from the columns of ``digests``."""
    exact = [sum_modulo(F.transform(d, _hex_at(start))) for d in (first, second) for start in (1, 17)]
    spread = F.lit(SPREAD).cast("long")
    counters = [sum_modulo(F.transform(pieces, _bits_at(j, spread))) for j in range(COUNTERS)]
    return F.array(*exact, *counters, F.size(pieces).cast("long"))


def _hex_at(start: int):
    return lambda m: hex_number(m, start)


def _bits_at(j: int, spread: Column):
    return lambda h: F.shiftright(h, j).bitwiseAND(spread)


def with_vector(rows: DataFrame, text: str, name: str) -> DataFrame:
    """``rows`` with the fingerprint words of a text column, hashed once a paragraph and piece."""
    first, second, pieces = digests(F.col(text))
    hashed = rows.withColumns({"__a": first, "__b": second, "__c": pieces})
    return hashed.withColumn(name, vector(F.col("__a"), F.col("__b"), F.col("__c"))).drop("__a", "__b", "__c")


def fingerprint_text(words: Column) -> Column:
    """Sixteen hexadecimal digits a word."""
    return F.array_join(F.transform(words, lambda w: F.lpad(F.lower(F.hex(w)), 16, "0")), "")


def add(words: Column, others: Column, sign: int = 1) -> Column:
    """Fingerprint words of a multiset after insertion (sign 1) or deletion (-1) of another's paragraphs."""
    other = F.transform(others, lambda y: y if sign > 0 else F.lit(MODULUS) - y)
    return F.zip_with(words, other, lambda x, y: F.pmod(x.cast("decimal(38,0)") + y, F.lit(MODULUS)).cast("long"))


def counters(words: Column) -> Column:
    """Signed counters: set minus unset bits, one number a lane."""
    n = F.element_at(words, -1)
    mask = F.lit((1 << LANE_BITS) - 1).cast("long")
    return F.flatten(F.transform(F.slice(words, EXACT + 1, COUNTERS), lambda w: F.array(*[
        (2 * F.shiftright(w, LANE_BITS * k).bitwiseAND(mask) - n).cast("double") for k in range(LANES)])))


def likeness(words: Column, others: Column) -> Column:
    """Correlation of the counters, 0 to 1; 1 for equal fingerprints, 0 if only one has pieces."""
    a, b = counters(words), counters(others)

    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda acc, v: acc + v)
    size = F.sqrt(dot(a, a) * dot(b, b))
    cosine = F.when(size > 0, dot(a, b) / F.when(size > 0, size)).otherwise(F.lit(0.0))
    return F.when(words == others, F.lit(1.0)).otherwise(F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), cosine)), 6))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` -> (id, words, fingerprint), one row a document.

    Null counts as the empty text, whose words are all 0.  Ids are carried as they are; other columns are ignored.  A
    projection: no shuffle, no Python."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text_or_empty(text_col).alias("text"))
    return with_vector(rows, "text", "words").select(
        F.col("id").alias(id_col), "words", fingerprint_text(F.col("words")).alias("fingerprint"))


def successors(keys: DataFrame) -> DataFrame:
    """(id, key, n, next_id, next_key) of rows (id, key, n) in descending order of id (nulls last), then key; the last
    row's successor is the first.

    The rows, without texts, are sorted over all partitions and numbered within each; the successor is the next number,
    or the first of the next partition.  Only one row a partition is ever in one task."""
    placed = cut(keys.orderBy(F.col("id").desc_nulls_last(), "key").withColumn("m", F.monotonically_increasing_id()))
    parts = placed.groupBy(F.shiftright("m", ROW_BITS).alias("part")).agg(F.min("m").alias("first"), F.max("m").alias("last"))
    every = W.orderBy("part")
    edges = parts.select("last", F.lead("first").over(every).alias("next"),
                         F.first("first").over(every).alias("start")).select(
        F.col("last").alias("m"), F.coalesce("next", "start").alias("wrapped"))
    follow = placed.join(edges, "m", "left").withColumn("to", F.coalesce("wrapped", F.col("m") + 1))
    target = placed.select(F.col("m").alias("to"), F.col("id").alias("next_id"), F.col("key").alias("next_key"))
    return follow.join(target, "to").select("id", "key", "n", "next_id", "next_key")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` -> (id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    The edited text ends with the first floor(n_chars / 3) characters (or all) of the next document, in descending order of
    id, in place of as many of its own.  Null counts as the empty text.  Null ids come last; rows of one id with different texts follow
    each other by the texts' hash, rows that repeat id and text are one document and get the same result each.  Other
    columns are ignored."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text_or_empty(text_col).alias("text"))
    rows = rows.select("id", F.xxhash64("text").alias("key"), F.char_length("text").cast("long").alias("n"), "text")
    distinct = rows.groupBy("id", "key").agg(F.min("n").alias("n"), F.count("*").alias("copies"))
    order = cut(successors(distinct.select("id", "key", "n")))
    texts = rows.select("id", "key", "text")
    heads = texts.join(order.select(F.col("id").alias("to_id"), F.col("key").alias("to_key"), F.col("n").alias("to_n"),
                                    "next_id", "next_key"),
                       texts["id"].eqNullSafe(F.col("next_id")) & (texts["key"] == F.col("next_key")))
    heads = heads.select("to_id", "to_key", F.substr("text", F.lit(1), F.floor(F.col("to_n") / 3).cast("int")).alias("head"))
    heads = heads.dropDuplicates(["to_id", "to_key"])
    both = texts.join(heads, texts["id"].eqNullSafe(heads["to_id"]) & (texts["key"] == heads["to_key"]))
    n = F.char_length("text")
    both = both.select("id", "key", n.cast("long").alias("n"), "text", F.concat(
        F.substr("text", F.lit(1), n - F.floor(n / 3).cast("int")), F.col("head")).alias("edited"))
    both = both.select("*", F.sha2("edited", 256).alias("edited_sha256"))
    worded = with_vector(with_vector(both, "text", "words"), "edited", "edited_words")
    done = cut(worded.select("id", "key", "n", "edited_sha256", "words", "edited_words"))
    follow = order.select(F.col("id").alias("to_id"), F.col("key").alias("to_key"), "next_id", "next_key")
    nexts = done.groupBy(F.col("id").alias("n_id"), F.col("key").alias("n_key")).agg(F.any_value("words").alias("next_words"))
    nexts = follow.join(nexts, F.col("next_id").eqNullSafe(F.col("n_id")) & (F.col("next_key") == F.col("n_key")))
    out = done.join(nexts, done["id"].eqNullSafe(F.col("to_id")) & (done["key"] == F.col("to_key")))
    return out.select(done["id"].alias(id_col), F.col("n").alias("n_chars"), "edited_sha256",
                      fingerprint_text(F.col("words")).alias("fingerprint"),
                      fingerprint_text(F.col("edited_words")).alias("edited_fingerprint"),
                      likeness(F.col("words"), F.col("edited_words")).alias("near_edited"),
                      likeness(F.col("words"), F.col("next_words")).alias("near_next"))
