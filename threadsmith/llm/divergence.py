"""Audit of how the term frequencies of a language's sources differ.

Terms are counted by length-bucketed packing: the texts of an Arrow batch stay one byte buffer, terms of up to 8 bytes
become one uint64 word and terms of up to 16 bytes two, which are sorted by 16-bit radix passes and counted as runs;
longer terms are sorted as bytes in buckets of doubling width.  Nothing of this is a Python object per term.

Runs are summed by (language, term) in Spark; only the kept terms, with their counts by source, are written and go on.
Their divergences are exact integers: shares of a billion, and the floors of squared differences over the reference."""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadsmith.llm.common import cut, text_or_empty

#: documents of the language that a kept term is in; scale of the shares; terms reported for each group
LEAST_DOCUMENTS, SCALE, TOP_TERMS = 3, 10**9, 200
#: counts (terms x sources) that a task holds in one matrix
CELLS = 1 << 20

_LETTERS = np.frombuffer(string.ascii_letters.encode(), np.uint8)
IN_TERM = np.arange(256) >= 0x80
IN_TERM[_LETTERS] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
#: keeps the first k bytes of a word whose first byte is the highest
_HEAD = np.array([0] + [(1 << 64) - (1 << (64 - 8 * k)) for k in range(1, 9)], np.uint64)


def term_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, text number) of the terms in texts that lie one after the other in ``data``."""
    inside = IN_TERM[data]
    first = np.zeros(len(data) + 1, bool)  # where a text begins
    first[offsets] = True
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1] | first[1:-1]
    end[:-1] &= ~inside[1:] | first[1:-1]
    start = np.flatnonzero(begin)
    return start, np.flatnonzero(end) + 1 - start, np.searchsorted(offsets, start, "right") - 1


def radix_order(words: list[np.ndarray]) -> np.ndarray:
    """Stable order by unsigned words, the most significant first: passes over 16-bit digits, last digit first;
    digits in which all agree are left out."""
    order = np.arange(len(words[0]))
    for word in reversed(words):
        for shift in range(0, 8 * word.dtype.itemsize, 16):
            digit = (word >> word.dtype.type(shift)).astype(np.uint16)
            if len(digit) and (digit != digit[0]).any():
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def packed_strings(words: list[np.ndarray], size: np.ndarray) -> pa.Array:
    """The terms of packed words and their sizes in bytes."""
    grid = np.concatenate([w.astype(">u8").view(np.uint8).reshape(-1, 8) for w in words], axis=1)
    ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    used = grid[np.arange(grid.shape[1]) < size[:, None]]
    return pa.StringArray.from_buffers(len(grid), pa.py_buffer(ends), pa.py_buffer(used))


def run_heads(columns: list[np.ndarray]) -> np.ndarray:
    """Whether a row differs from the one before it in any column; the first one does."""
    head = np.ones(len(columns[0]), bool)
    head[1:] = False
    for column in columns:
        head[1:] |= column[1:] != column[:-1]
    return head


def sorted_terms(data: np.ndarray, start: np.ndarray, size: np.ndarray, group: np.ndarray
                 ) -> Iterator[tuple[np.ndarray, np.ndarray, pa.Array]]:
    """The spans of ``data`` in the order of (group, size, bytes), a length bucket at a time: (spans' numbers in that
    order, whether a new (group, term) begins there, the terms that begin).  Equal terms keep the spans' order.  The
    size tells apart what zero padding would not."""
    data = np.concatenate([data, np.zeros(16, np.uint8)])
    at = np.ndarray((len(data) - 8,), "<u8", data, 0, (1,))  # the eight bytes from each place on
    for least, most in ((1, 8), (9, 16)):
        pick = np.flatnonzero((size >= least) & (size <= most))
        if not len(pick):
            continue
        words = [at[start[pick] + skip].byteswap() & _HEAD[np.minimum(size[pick] - skip, 8)] for skip in range(0, most, 8)]
        order = radix_order([group[pick], size[pick].astype(np.uint16), *words])
        pick, words = pick[order], [w[order] for w in words]
        head = run_heads([group[pick], size[pick], *words])
        yield pick, head, packed_strings([w[head] for w in words], size[pick][head])
    width = 32
    while len(size) and width < 2 * size.max():
        pick = np.flatnonzero((size > max(16, width // 2)) & (size <= width))
        if len(pick):
            terms = np.array([data[a:b].tobytes() for a, b in zip(start[pick], start[pick] + size[pick])], f"S{width}")
            order = np.argsort(terms, kind="stable")
            order = order[radix_order([group[pick][order], size[pick][order].astype(np.uint64)])]
            pick, terms = pick[order], terms[order]
            head = run_heads([group[pick], size[pick], terms])
            new = pick[head]
            yield pick, head, pa.array([data[a:b].tobytes() for a, b in zip(start[new], start[new] + size[new])],
                                       pa.binary()).cast(pa.string())
        width *= 2


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of the texts one after the other, where each begins and the last ends); no nulls."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    whole = texts.buffers()[2]
    data = np.frombuffer(whole, np.uint8)[offsets[0]:offsets[-1]] if whole is not None else np.empty(0, np.uint8)
    return data, offsets - offsets[0]


def count_terms(texts: pa.Array, group: np.ndarray) -> Iterator[tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]]:
    """(group, term, occurrences, documents) of every term in every group of texts, a length bucket at a time.
    ``group`` numbers the texts' groups (uint32)."""
    data, offsets = text_bytes(texts)
    start, size, doc = term_spans(data, offsets)
    group = group[doc]
    for spans, head, terms in sorted_terms(LOWER[data], start, size, group):
        heads = np.flatnonzero(head)
        other = head | run_heads([doc[spans]])  # a run's documents stand in order
        yield group[spans][heads], terms, np.diff(np.append(heads, len(spans))), np.add.reduceat(other.astype(np.int64), heads)


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["lang", "source", "term", "n", "df"]
    for batch in batches:
        if not batch.num_rows:
            continue
        lang, source = (batch.column(k).dictionary_encode() for k in (0, 1))
        code = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
        codes, group = np.unique(code, return_inverse=True)
        for key, term, n, df in count_terms(batch.column(2), group.astype(np.uint32)):
            ids = codes[key]
            yield pa.RecordBatch.from_arrays(
                [lang.dictionary.take(pa.array(ids // len(source.dictionary))),
                 source.dictionary.take(pa.array(ids % len(source.dictionary))), term, pa.array(n), pa.array(df)], names)


def kept_terms(texts: DataFrame, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """(lang, term, total, counts: array of source and n) of the terms in enough documents of their language.
    One shuffle, by language and term."""
    runs = texts.select("lang", "source", "text").mapInArrow(
        _count_batches, "lang string, source string, term string, n long, df long").repartition("lang", "term")
    by_source = runs.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
    by_term = by_source.groupBy("lang", "term").agg(
        F.sum("df").alias("df"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("counts"))
    return by_term.where(F.col("df") >= least_documents).drop("df")


def group_sizes(texts: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, kinds: kept terms, whole: their occurrences, groups: sorted array of source and n) of every language."""
    n = kept.select("lang", F.explode("counts").alias("c")).groupBy("lang", F.col("c.source").alias("source")).agg(
        F.sum("c.n").alias("n"))
    totals = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kinds"), F.sum("total").alias("whole"))
    groups = texts.select("lang", "source").distinct().join(n, ["lang", "source"], "left")
    listed = groups.groupBy("lang").agg(
        F.array_sort(F.collect_list(F.struct("source", F.coalesce("n", F.lit(0)).alias("n")))).alias("groups"))
    return listed.join(totals, "lang", "left").na.fill(0, ["kinds", "whole"])


def shares(counts: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * (count + 1) / whole) without leaving 64 bits: the quotient's decimal digits, three a step."""
    quotient, rest = np.divmod(counts + 1, whole)
    for _ in range(3):
        more, rest = np.divmod(rest * 1000, whole)
        quotient = quotient * 1000 + more
    return quotient + 1


def _pair_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, item, value): sums of the pairs' divergences over the terms of one task."""
    sums: dict[str, tuple[pa.Array, np.ndarray]] = {}
    for batch in batches:
        langs = batch.column(0).dictionary_encode()
        for k, lang in enumerate(langs.dictionary.to_pylist()):
            rows = batch.take(pa.array(np.flatnonzero(langs.indices.to_numpy() == k)))
            groups = rows.column(3)[0].values
            sources, n = groups.field("source"), groups.field("n").to_numpy()
            whole = n + rows.column(2)[0].as_py()
            total = sums.setdefault(lang, (sources, np.zeros((len(sources), len(sources)), np.int64)))[1]
            step = max(1, CELLS // len(sources))
            for at in range(0, rows.num_rows, step):
                lists = rows.column(1).slice(at, step)
                flat = lists.flatten()
                counts = np.zeros((len(lists), len(sources)), np.int64)
                row = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())
                counts[row, pc.index_in(flat.field("source"), value_set=sources).to_numpy()] = flat.field("n").to_numpy()
                p = shares(counts, whole)
                for a in range(len(sources)):
                    apart = p[:, a:a + 1] - p
                    total[a] += (apart * apart // p).sum(axis=0)
    for lang, (sources, total) in sums.items():
        size = len(sources)
        a, b = (pa.array(x) for x in np.divmod(np.arange(size * size), size))
        yield pa.RecordBatch.from_arrays([pa.array([lang] * size * size, pa.string()), sources.take(a), sources.take(b),
                                          pa.array(total.ravel())], ["lang", "source", "item", "value"])


def _share(count: Column, whole: Column) -> Column:
    """1 + floor(SCALE * (count + 1) / whole), the product as a decimal that cannot overflow."""
    product = (count + 1).cast("decimal(19,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return 1 + F.call_function("div", product, whole.cast("decimal(19,0)"))


def _ranked(rows: DataFrame, part: str, most: int | None = None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    out = rows.withColumn("rank", F.row_number().over(order))
    if most is not None:
        out = out.where(F.col("rank") <= most)
    return out.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


def audit_sources(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
                  least_documents: int = LEAST_DOCUMENTS, top_terms: int = TOP_TERMS) -> DataFrame:
    """``docs`` -> (lang, source, part, item, value, rank).

    Part ``pair``: how far the group's term shares are from each other source's of its language, as the sum over the kept
    terms of floor((p-q)^2/q); part ``term``: the terms that the group has more of than its language, by the same measure,
    the first ``top_terms``.  Terms are runs of letters and of all characters beyond ASCII, A-Z lower-cased; kept are those in
    ``least_documents`` documents of the language.  Shares are 1 + floor(SCALE * (count + 1) / (N + V)).

    Null text, language and source are empty strings.  Every row is a document of its own.  Groups without terms are
    paired too; a language without kept terms has pair values 0.  An empty table gives no rows; other columns are ignored."""
    texts = docs.select(text_or_empty(lang_col).alias("lang"), text_or_empty(source_col).alias("source"),
                        text_or_empty(text_col).alias("text"))
    kept = cut(kept_terms(texts, least_documents))
    sizes = cut(group_sizes(texts, kept))
    # Spark decides by the written table's size whether the groups' sizes are sent to the terms or both are shuffled
    sums = kept.join(sizes, "lang").select("lang", "counts", "kinds", "groups").mapInArrow(
        _pair_batches, "lang string, source string, item string, value long").groupBy("lang", "source", "item").agg(
        F.sum("value").alias("value"))
    group = F.col("g.source").alias("source")
    sources = sizes.select("lang", "groups", F.explode("groups").alias("g")).select("lang", "groups", group)
    paired = sources.select("lang", "source", F.explode("groups").alias("g")).select(
        "lang", "source", F.col("g.source").alias("item")).where("source <> item")
    pairs = paired.join(sums, ["lang", "source", "item"], "left").withColumn("value", F.coalesce("value", F.lit(0)))

    own = sizes.select("lang", "kinds", "whole", F.explode("groups").alias("g")).select(
        "lang", "kinds", "whole", group, F.col("g.n").alias("size"))
    terms = kept.select("lang", F.col("term").alias("item"), "total", F.explode("counts").alias("c")).select(
        "lang", F.col("c.source").alias("source"), "item", "total", F.col("c.n").alias("n")).join(own, ["lang", "source"])
    terms = terms.withColumn("p", _share(F.col("n"), F.col("size") + F.col("kinds"))).withColumn(
        "q", _share(F.col("total"), F.col("whole") + F.col("kinds"))).where("p > q")
    terms = terms.withColumn("value", F.expr("(p - q) * (p - q) div q"))
    return _ranked(pairs, "pair").union(_ranked(terms, "term", top_terms))
