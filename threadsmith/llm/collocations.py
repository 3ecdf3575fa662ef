"""Phrases whose words occur together more often than apart, by direct-address tiling.

Texts become sequences of numbers: word ids ranked by frequency, a word of each language having its own.  A pair of
neighbours is a cell of the plane left x right, which is cut into tiles whose sides grow with the rank.  Tiles of
frequent ids are small and counted in a dense numpy array by address (bincount); the others are counted as sorted
coordinates.  The pairs found often enough are ranked by frequency anew, and the texts' sequences become sequences of
pair ids: neighbours in these are phrases of three words.

Spark deals the work: blocks of texts are written once; a tile is split by the hash of its cells into as many groups as
keep each one bounded, and a group sees its cells of all blocks and gives the frequent pairs.  Once these are ranked, the
groups meet them again and hand each block the ids of the pairs that it holds."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadsmith.llm.common import cut, text_or_empty
from threadsmith.llm.divergence import LOWER, run_heads, sorted_terms, text_bytes

#: occurrences of a candidate, phrases reported for a language, scale of the score, share of a longer phrase that hides a shorter one
LEAST, TOP, SCALE, HIDDEN = 10, 2000, 10**6, 0.5
#: language of documents that name none
NO_LANG = "und"
#: side of the first tile; the next bands of ids are GROWTH times as wide each
SIDE, GROWTH = 256, 4
#: cells of the largest tile that is counted densely
DENSE = 1 << 22
#: bytes of text in a block (one text may be more); blocks whose pairs are about what one group of a split tile holds
BLOCK_BYTES, SPLIT_BLOCKS = 4 << 20, 64
#: cells by hash in which ids of one frequency are numbered
NUMBER_CELLS = 256

_BREAKS = np.zeros(256, bool)
_BREAKS[np.frombuffer(b".,;:!?\n\x0b\x0c\r", np.uint8)] = True
_OUTSIDE = _BREAKS.copy()
_OUTSIDE[np.frombuffer(b" \t", np.uint8)] = True
_EDGES = np.array([SIDE * GROWTH**k for k in range(27)], np.int64)


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, size, text, whether the word follows the one before it in the same piece) of all words."""
    inside = ~_OUTSIDE[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1] | first[1:-1]
    end[:-1] &= ~inside[1:] | first[1:-1]
    start = np.flatnonzero(begin)
    doc = np.searchsorted(offsets, start, "right") - 1
    piece = np.cumsum(_BREAKS[data], dtype=np.int32)[start]
    return start, np.flatnonzero(end) + 1 - start, doc, ~run_heads([doc, piece]) if len(start) else np.empty(0, bool)


_BLOCKS = ("block long, tokens array<struct<lang:string,n:long>>, words array<struct<lang:string,word:string,n:long>>, "
           "seq binary")


def text_slices(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``BLOCK_BYTES`` together, but at least one text each."""
    at = 0
    while at < len(offsets) - 1:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + BLOCK_BYTES, "right")) - 1)
        yield at, end
        at = end


def _block_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of texts: the distinct words of each language with their counts, and the texts as places in that list
    (-1 where a piece ends)."""
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        langs = batch.column(0).dictionary_encode()
        data, offsets = text_bytes(batch.column(1))
        for low, high in text_slices(offsets):
            part = data[offsets[low]:offsets[high]]
            start, size, doc, follows = word_spans(part, offsets[low:high + 1] - offsets[low])
            group = langs.indices.to_numpy()[low:high].astype(np.uint32)[doc]
            place, owners, names, counts, known = np.empty(len(start), np.int32), [], [], [], 0
            for spans, head, words in sorted_terms(LOWER[part], start, size, group):
                place[spans] = known + np.cumsum(head) - 1
                known += len(words)
                owners.append(group[spans][head])
                names.append(words)
                counts.append(np.diff(np.append(np.flatnonzero(head), len(spans))))
            if not known:
                continue
            owner, count = np.concatenate(owners), np.concatenate(counts)
            held = pa.StructArray.from_arrays([langs.dictionary.take(pa.array(owner)), pa.concat_arrays(names), pa.array(count)],
                                              ["lang", "word", "n"])
            kinds, n = np.unique(group, return_counts=True)
            tokens = pa.StructArray.from_arrays([langs.dictionary.take(pa.array(kinds)), pa.array(n)], ["lang", "n"])
            seq = np.insert(place, np.flatnonzero(~follows), -1)
            yield pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.ListArray.from_arrays([0, len(tokens)], tokens),
                 pa.ListArray.from_arrays([0, known], held), pa.array([_packed(seq)], pa.binary())],
                ["block", "tokens", "words", "seq"])
            number += 1


def ranked(counts: DataFrame, ties: list[str]) -> DataFrame:
    """``counts`` (n, ...) with ``id``: 0-based rank by falling n, then a hash, then ``ties``.  Rows are numbered inside
    (n, cell of the hash); the counts of these and of the frequencies give the offsets."""
    x = counts.withColumn("cell", F.pmod(F.xxhash64(*ties), F.lit(NUMBER_CELLS)))
    cells = x.groupBy("n", "cell").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.unboundedPreceding
    by_n = cells.groupBy("n").agg(F.sum("rows").alias("rows")).select("n", F.coalesce(F.sum("rows").over(
        Window.orderBy(F.desc("n")).rowsBetween(before, -1)), F.lit(0)).alias("base"))
    by_cell = cells.select("n", "cell", F.coalesce(F.sum("rows").over(
        Window.partitionBy("n").orderBy("cell").rowsBetween(before, -1)), F.lit(0)).alias("skip"))
    offsets = by_cell.join(by_n, "n")
    place = F.row_number().over(Window.partitionBy("n", "cell").orderBy(*ties))
    return x.withColumn("place", place).join(offsets, ["n", "cell"]).withColumn(
        "id", F.col("base") + F.col("skip") + F.col("place") - 1).drop("cell", "place", "base", "skip")


def neighbours(seq: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places, left, right) of neighbours that both have an id."""
    at = np.flatnonzero((seq[:-1] >= 0) & (seq[1:] >= 0))
    return at, seq[at], seq[at + 1]


def distinct_pairs(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(left, right) of the distinct pairs in their order, and each pair's place among them."""
    if len(left) and int(left.max()) < 1 << 31 and int(right.max()) < 1 << 31:
        pairs, place = np.unique(left << 31 | right, return_inverse=True)
        return pairs >> 31, pairs & ((1 << 31) - 1), place
    order = np.lexsort((right, left))
    head = run_heads([left[order], right[order]]) if len(order) else np.empty(0, bool)
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(head) - 1
    return left[order][head], right[order][head], place


def band_bounds(band: int) -> tuple[int, int]:
    return (int(_EDGES[band - 1]) if band else 0), int(_EDGES[band])


def count_tile(tile: int, left: np.ndarray, right: np.ndarray, n: np.ndarray | None = None
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(left, right, count) of the distinct cells of one tile; ``n`` are the cells' counts so far, else 1 each."""
    (low, high), (low_r, high_r) = band_bounds(tile // 32), band_bounds(tile % 32)
    width = high_r - low_r
    area = (high - low) * width
    if area <= DENSE and area <= 16 * len(left):
        cells = (left - low) * width + (right - low_r)
        dense = np.bincount(cells, minlength=area)
        if n is not None:  # weights of bincount are doubles, exact for the two halves of the counts
            dense = sum(np.bincount(cells, part, area).astype(np.int64) << shift
                        for part, shift in ((n & 0xFFFFFFFF, 0), (n >> 32, 32)) if part.any())
        found = np.flatnonzero(dense)
        return low + found // width, low_r + found % width, dense[found]
    if area < 1 << 62:
        order = np.argsort((left - low) * width + (right - low_r))
    else:
        order = np.lexsort((right, left))
    left, right = left[order], right[order]
    heads = np.flatnonzero(run_heads([left, right]))
    count = np.diff(np.append(heads, len(left))) if n is None else np.add.reduceat(n[order], heads)
    return left[heads], right[heads], count


def _packed(values: np.ndarray) -> bytes:
    """Numbers as bytes, four each where all fit, else eight (the first byte tells); like bytes stand together, which
    compresses well."""
    size = 4 if not len(values) or (int(values.max()) < 1 << 31 and int(values.min()) >= -1 << 31) else 8
    return bytes([size]) + values.astype(f"<i{size}").view(np.uint8).reshape(-1, size).T.tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    size = data[0]
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(size, -1)
    return np.ascontiguousarray(planes.T).view(f"<i{size}").ravel().astype(np.int64)


_TILES = "tile int, split int, block long, left binary, right binary, n binary"


def split_of(left: np.ndarray, right: np.ndarray, splits: int) -> np.ndarray:
    """Which of the groups of a tile a cell belongs to."""
    mixed = (left.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (right.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    return ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(33)).astype(np.int64) % splits


def _tile_batches(splits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The counted pairs of each block (block, seq), a row a tile and split; left ids as differences, as they rise."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                _, left, right = neighbours(_unpacked(batch.column(1)[k].as_py()))
                tile = np.searchsorted(_EDGES, left, "right") * 32 + np.searchsorted(_EDGES, right, "right")
                order = np.argsort(tile.astype(np.uint16), kind="stable")
                tile, left, right = tile[order], left[order], right[order]
                heads = np.flatnonzero(run_heads([tile])) if len(tile) else tile
                rows = []
                for a, b in zip(heads, np.append(heads[1:], len(tile))):
                    cells = count_tile(int(tile[a]), left[a:b], right[a:b])
                    split = split_of(cells[0], cells[1], splits)
                    by_split = np.argsort(split, kind="stable")
                    ends = np.searchsorted(split[by_split], np.arange(splits + 1))
                    for at, (low, high) in enumerate(zip(ends, ends[1:])):
                        if low < high:
                            x, y, n = (c[by_split[low:high]] for c in cells)
                            rows.append((int(tile[a]), at, _packed(np.diff(x, prepend=0)), _packed(y), _packed(n)))
                if rows:
                    tiles, split, *packed = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(tiles, pa.int32()), pa.array(split, pa.int32()), pa.array([batch.column(0)[k].as_py()] * len(rows), pa.int64()),
                         *(pa.array(p, pa.binary()) for p in packed)], ["tile", "split", "block", "left", "right", "n"])
    return run


def _cells(rows: pa.Table) -> list[tuple[np.ndarray, np.ndarray]]:
    """(left, right) of each block's cells in a group."""
    return [(np.cumsum(_unpacked(x.as_py())), _unpacked(y.as_py())) for x, y in zip(rows["left"], rows["right"])]


def _merge_tile(least: int) -> Callable[[tuple, pa.Table], pa.Table]:
    """The pairs of one group found often enough."""
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        left, right = (np.concatenate(x) for x in zip(*_cells(rows)))
        n = np.concatenate([_unpacked(x.as_py()) for x in rows["n"]])
        left, right, n = count_tile(key[0].as_py(), left, right, n)
        often = n >= least
        left, right, n = left[often], right[often], n[often]
        return pa.table({"tile": pa.array([key[0].as_py()] * len(n), pa.int32()), "split": pa.array([key[1].as_py()] * len(n), pa.int32()),
                         "left": left, "right": right, "n": n})
    return run


_HELD = pa.schema([("block", pa.int64()), ("left", pa.binary()), ("right", pa.binary()), ("id", pa.binary())])


def _hand_ids(key: tuple, rows: pa.Table, pairs: pa.Table) -> pa.Table:
    """A row for each block with those of its pairs in the group that have an id."""
    if not rows.num_rows or not pairs.num_rows:
        return _HELD.empty_table()
    cells = _cells(rows)
    n = pairs.num_rows
    _, _, place = distinct_pairs(*(np.concatenate([pairs[c].to_numpy(), *x]) for c, x in zip(("left", "right"), zip(*cells))))
    ids = np.full(place.max() + 1, -1, np.int64)
    ids[place[:n]] = pairs["id"].to_numpy()
    found, at = [], n
    for block, (left, right) in zip(rows["block"].to_pylist(), cells):
        own = ids[place[at:at + len(left)]]
        at += len(left)
        known = own >= 0
        if known.any():
            found.append((block, _packed(left[known]), _packed(right[known]), _packed(own[known])))
    return pa.table([list(x) for x in zip(*found)], schema=_HELD) if found else _HELD.empty_table()


def frequent_pairs(blocks: DataFrame, splits: int, least: int) -> DataFrame:
    """(tile, split, left, right, n, id) of the pairs of neighbours in blocks (block, seq) found ``least`` times or more,
    ranked."""
    tiles = blocks.select("block", "seq").mapInArrow(_tile_batches(splits), _TILES)
    found = tiles.groupBy("tile", "split").applyInArrow(_merge_tile(least), "tile int, split int, left long, right long, n long")
    return cut(ranked(cut(found), ["left", "right"]))


def held_pairs(blocks: DataFrame, pairs: DataFrame, splits: int) -> DataFrame:
    """(block, left, right, id) of the ranked pairs that each block holds, packed, a row for each group of a tile: the
    blocks' cells meet the pairs of their group once more."""
    tiles = blocks.select("block", "seq").mapInArrow(_tile_batches(splits), _TILES).drop("n")
    known = pairs.select(F.col("tile").alias("in_tile"), F.col("split").alias("in_split"), "left", "right", "id")
    return tiles.groupBy("tile", "split").cogroup(known.groupBy("in_tile", "in_split")).applyInArrow(
        _hand_ids, "block long, left binary, right binary, id binary")


_SEQ = pa.schema([("block", pa.int64()), ("seq", pa.binary())])


def _renumber(blocks: DataFrame, entries: DataFrame, ids_of: Callable[[np.ndarray, pa.Table], np.ndarray]) -> DataFrame:
    """Blocks (block, seq) with the ids that ``ids_of`` gives their sequence and entries; a block's entries are bounded by
    its texts.  Blocks without entries go."""
    def run(block: pa.Table, held: pa.Table) -> pa.Table:
        if not block.num_rows or not held.num_rows:
            return _SEQ.empty_table()
        seq = ids_of(_unpacked(block["seq"][0].as_py()), held)
        return pa.table([block["block"], pa.array([_packed(seq)], pa.binary())], schema=_SEQ)
    entries = entries.withColumn("of", F.col("block") + F.lit(0)).drop("block")  # a column of its own
    return cut(blocks.select("block", "seq").groupBy("block").cogroup(entries.groupBy("of")).applyInArrow(run, "block long, seq binary"))


def word_ids(seq: np.ndarray, held: pa.Table) -> np.ndarray:
    """Ids of the words at the places of a sequence, -1 for words without."""
    ids = np.full(int(seq.max(initial=-1)) + 2, -1, np.int64)  # the last one stands for -1
    ids[held["pos"].to_numpy()] = held["id"].to_numpy()
    return ids[seq]


def pair_ids(seq: np.ndarray, held: pa.Table) -> np.ndarray:
    """Ids of the pairs that begin at each place of a sequence but the last, -1 for pairs without."""
    at, left, right = neighbours(seq)
    known_left, known_right, known = (np.concatenate([_unpacked(x.as_py()) for x in held[c]]) for c in ("left", "right", "id"))
    _, _, place = distinct_pairs(np.concatenate([known_left, left]), np.concatenate([known_right, right]))
    ids = np.full(place.max(initial=-1) + 1, -1, np.int64)
    ids[place[:len(known)]] = known
    out = np.full(max(0, len(seq) - 1), -1, np.int64)
    out[at] = ids[place[len(known):]]
    return out


def _score(together: Column, left: Column, right: Column) -> Column:
    """floor(SCALE * together^2 / (left * right)), in decimals of 38 digits."""
    wide = [c.cast("decimal(16,0)") for c in (together, left, right)]
    return F.call_function("div", F.lit(SCALE).cast("decimal(7,0)") * wide[0] * wide[0], wide[1] * wide[2])


def mine_phrases(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST, top: int = TOP,
                 hidden: float = HIDDEN) -> DataFrame:
    """``docs`` -> (lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases of two and three words.

    Words are runs without spaces and tabs inside pieces that end at ``. , ; : ! ?`` and line ends, A-Z lower-cased.  A phrase
    found ``a`` >= ``least`` times is scored at its weakest cut, floor(SCALE a^2 / (l r)); ties go to the shorter first part.
    Phrases that a longer candidate holds in ``hidden`` of their occurrences are dropped.  Order: score, then a, both
    falling, then the phrase's bytes.  ``n`` counts all words of the language.

    Null text is empty and null lang is ``und``.  Repeated rows count each.  An empty table gives no rows; other columns are
    ignored.  Counts and scores are exact."""
    texts = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(NO_LANG)).alias("lang"),
                        text_or_empty(text_col).alias("text"))
    blocks = cut(texts.mapInArrow(_block_batches, _BLOCKS))
    splits = max(1, -(-blocks.count() // SPLIT_BLOCKS))
    totals = blocks.select(F.explode("tokens").alias("t")).groupBy("t.lang").agg(F.sum("t.n").alias("all"))
    counted = blocks.select(F.explode("words").alias("w")).groupBy("w.lang", "w.word").agg(F.sum("w.n").alias("n"))
    words = cut(ranked(cut(counted.where(F.col("n") >= least)), ["lang", "word"]))
    held = blocks.select("block", F.posexplode("words").alias("pos", "w")).select("block", "pos", "w.lang", "w.word")
    by_word = _renumber(blocks, held.join(words, ["lang", "word"]).select("block", "pos", "id"), word_ids)
    pairs = frequent_pairs(by_word, splits, least)
    by_pair = _renumber(by_word, held_pairs(by_word, pairs, splits), pair_ids)
    triples = frequent_pairs(by_pair, splits, least)

    def word(side: str) -> DataFrame:
        return words.select(F.col("id").alias(side), F.col("word").alias(f"{side}_word"), F.col("n").alias(f"{side}_n"))

    def pair(side: str, first: str, second: str) -> DataFrame:
        return pairs.select(F.col("id").alias(side), F.col("left").alias(first), F.col("right").alias(second),
                            F.col("n").alias(f"{side}_n"))

    lang = words.select(F.col("id").alias("x"), "lang")
    holders = triples.select(F.explode(F.array("left", "right")).alias("id"), "n").groupBy("id").agg(F.max("n").alias("longest"))
    seen = pairs.join(holders, "id", "left").where(
        F.col("longest").isNull() | (100 * F.col("longest") < F.lit(round(100 * hidden)) * F.col("n")))
    twos = seen.select(F.col("left").alias("x"), F.col("right").alias("y"), F.col("n").alias("a")).join(lang, "x").join(
        word("x"), "x").join(word("y"), "y").select(
        "lang", F.concat_ws(" ", "x_word", "y_word").alias("phrase"), "a", F.col("x_n").alias("l"), F.col("y_n").alias("r"),
        _score(F.col("a"), F.col("x_n"), F.col("y_n")).alias("score"))
    threes = triples.select(F.col("left").alias("xy"), F.col("right").alias("yz"), F.col("n").alias("a")).join(
        pair("xy", "x", "y"), "xy").join(pair("yz", "y_again", "z"), "yz").join(lang, "x")
    for side in "xyz":
        threes = threes.join(word(side), side)
    cuts = F.array(*[F.struct(_score(F.col("a"), F.col(left), F.col(right)).alias("score"), F.lit(k).alias("k"),
                              F.col(left).alias("l"), F.col(right).alias("r"))
                     for k, (left, right) in enumerate((("x_n", "yz_n"), ("xy_n", "z_n")), 1)])
    threes = threes.withColumn("cut", F.array_min(cuts)).select(
        "lang", F.concat_ws(" ", "x_word", "y_word", "z_word").alias("phrase"), "a", "cut.l", "cut.r", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = twos.union(threes).withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("all").alias("n"), "score")
