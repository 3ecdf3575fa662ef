"""Tokens of each document, counted by pre-token.

A byte-level BPE never merges across pre-tokens, so the tokens of a text are the sum over its pre-tokens.  The
pieces of every distinct pre-token of the corpus are counted once; each document's pre-token frequencies meet
these counts by a join, and the products are summed.  No token ids are made.

Pre-tokens that many documents share would be hot keys of that join.  So the most frequent ones, at most ``FREQUENT`` by
a histogram of document frequencies, meet the documents in the scan; all others are joined as rows."""

from __future__ import annotations

import json
import math
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadsmith.llm.common import cut, text_or_empty

#: pre-tokens that meet the documents in the scan, and the most characters of one of these: bounds of the shipped table
FREQUENT, FREQUENT_CHARS = 200_000, 64
#: distinct pre-tokens that a task holds before it hands them on
HELD = 500_000
#: cells of the histogram of document frequencies for each factor of two
CELLS = 8

#: fixed value: the published pre-token pattern of byte-level BPE vocabularies of this kind
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: code points whose letter, number and space classes are alike in all Unicode versions in use; a text with others is
#: split by the tokenizer's own library, which is slower
SETTLED = "[\\0-\\u0557\\u0d00-\\u208e\\u20a0-\\ua7cd\\uac00-\\uffff]*+"


def tokenizer_text(path: str) -> str:
    """The tokenizer's JSON, read where the query is planned, so that executors need no such file."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def splitter(tokenizer: str) -> Callable[[str], tuple[list[str], int]]:
    """text -> (its pre-tokens, number of added special tokens in it), as the library splits by default.

    Pre-tokens are slices of the text for plain byte-level tokenizers, else what the library's own pre-tokenizer gives."""
    config = json.loads(tokenizer)
    added = config.get("added_tokens") or []
    odd = [a["content"] for a in added if a["single_word"] or a["lstrip"] or a["rstrip"] or a["normalized"]]
    if odd:
        raise ValueError(f"added tokens that strip, normalise or stand as whole words are not covered: {odd}")
    special = regex.compile("|".join(regex.escape(a["content"]) for a in sorted(added, key=lambda a: -len(a["content"]))))
    pre = config.get("pre_tokenizer") or {}
    plain = (config.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
             and not pre.get("add_prefix_space", True))
    pattern, settled = regex.compile(PATTERN), regex.compile(SETTLED)
    library: list = []

    def by_library(part: str) -> list[str]:
        if not library:
            from tokenizers import Tokenizer
            library.append(Tokenizer.from_str(tokenizer))
        t = library[0]
        if plain:
            return [part[a:b] for _, (a, b) in t.pre_tokenizer.pre_tokenize_str(part)]
        if t.normalizer is not None:
            part = t.normalizer.normalize_str(part)
        return [p for p, _ in t.pre_tokenizer.pre_tokenize_str(part)] if t.pre_tokenizer is not None else [part]

    def split_part(part: str) -> list[str]:
        return pattern.findall(part) if plain and settled.fullmatch(part) else by_library(part)

    def split(text: str) -> tuple[list[str], int]:
        if not added:
            return split_part(text), 0
        parts = special.split(text)
        if len(parts) == 1:
            return split_part(text), 0
        return [p for part in parts if part for p in split_part(part)], len(parts) - 1
    return split


def piece_counter(tokenizer: str) -> Callable[[str], int]:
    """pre-token (as ``splitter`` gives it) -> number of its pieces."""
    from tokenizers import Tokenizer, pre_tokenizers
    t, config = Tokenizer.from_str(tokenizer), json.loads(tokenizer)
    pre = config.get("pre_tokenizer") or {}
    if config.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) \
            and not pre.get("add_prefix_space", True):
        as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        return lambda p: sum(len(t.model.tokenize(mapped)) for mapped, _ in as_bytes.pre_tokenize_str(p))
    return lambda p: len(t.model.tokenize(p))


def pre_token_table(texts: DataFrame, tokenizer: str) -> DataFrame:
    """(token, df, pieces): every distinct pre-token of ``texts``, its documents and, counted once, its pieces."""
    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, held = splitter(tokenizer), Counter()

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())],
                                              ["token", "df"])
        for batch in batches:
            for text in batch.column(0):
                held.update(set(split(text.as_py())[0]))
                if len(held) >= HELD:
                    yield rows()
                    held = Counter()
        if held:
            yield rows()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = piece_counter(tokenizer)
        for batch in batches:
            found = pa.array([count(p.as_py()) for p in batch.column(0)], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], ["token", "df", "pieces"])

    seen = texts.select("text").mapInArrow(distinct, "token string, df long")
    return seen.groupBy("token").agg(F.sum("df").alias("df")).mapInArrow(pieces, "token string, df long, pieces long")


def frequent_pieces(table: DataFrame) -> dict[str, int]:
    """pre-token -> pieces of the most frequent pre-tokens: as many cells of the histogram of document frequencies as
    stay within ``FREQUENT`` entries together.  Only the histogram and these entries reach the driver."""
    short = table.where(F.char_length("token") <= FREQUENT_CHARS)
    cell = F.floor(F.log2("df") * CELLS)
    total, least = 0, None
    for row in sorted(short.groupBy(cell.alias("cell")).count().collect(), key=lambda r: -r["cell"]):
        total += row["count"]
        if total > FREQUENT or row["cell"] < CELLS:  # what a single document holds is no hot key
            break
        least = row["cell"]
    if least is None:
        return {}
    return {r["token"]: r["pieces"] for r in short.where(cell >= least).select("token", "pieces").toLocalIterator()}


_ROWS = "id {}, hash long, own boolean, token string, n long, n_bytes long"


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = 512, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``docs`` -> (id, n_bytes, n_tokens, over_limit): tokens of each whole text under the tokenizer file (.json).

    Nothing is added at the ends, truncated or padded; added special tokens inside a text count one each.  Null counts as
    the empty text (0 tokens).  Every row gives one row: null and repeated ids and repeated rows too.  Other columns are
    ignored.  Rows are told apart by id and a 64-bit hash of the text."""
    tokenizer, kind = tokenizer_text(tokenizer_path), dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text_or_empty(text_col).alias("text"))
    table = cut(pre_token_table(rows, tokenizer))
    known = frequent_pieces(table)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = splitter(tokenizer)
        for batch in batches:
            at, own, token, n, n_bytes = [], [], [], [], []
            for i, text in enumerate(batch.column(2)):
                text = text.as_py()
                parts, total = split(text)
                for p, times in Counter(parts).items():
                    pieces = known.get(p)
                    if pieces is None:
                        at.append(i)
                        own.append(False)
                        token.append(p)
                        n.append(times)
                        n_bytes.append(0)
                    else:
                        total += times * pieces
                at.append(i)
                own.append(True)
                token.append(str(batch.column(1)[i]))  # own rows meet no pre-token; their hash spreads them
                n.append(total)
                n_bytes.append(len(text.encode()))
            at = pa.array(at, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(own, pa.bool_()), pa.array(token, pa.string()),
                 pa.array(n, pa.int64()), pa.array(n_bytes, pa.int64())], ["id", "hash", "own", "token", "n", "n_bytes"])

    keyed = rows.select("id", F.xxhash64("text").alias("hash"), "text").mapInArrow(frequencies, _ROWS.format(kind))
    pieces = table.select(F.lit(False).alias("own"), "token", "pieces")
    summed = keyed.join(pieces, ["own", "token"], "left").groupBy("id", "hash").agg(
        F.sum(F.col("n") * F.coalesce("pieces", F.lit(1))).alias("total"), F.sum("n_bytes").alias("bytes"),
        F.count_if("own").alias("copies"))
    out = summed.select("id", "total", "bytes", "copies", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    return out.select(F.col("id").alias(id_col), F.expr("bytes div copies").alias("n_bytes"),
                      F.expr("total div copies").alias("n_tokens"),
                      (F.expr("total div copies") > limit).alias("over_limit"))
