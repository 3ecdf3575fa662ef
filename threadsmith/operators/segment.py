"""Words of text without spaces (T3): the best path through a lattice of lexicon words.

The lexicon is a table ``(word, flag, freq)``.  A word's weight is its log share of all frequencies, in whole
millionths so that equal paths tie exactly; a character that no word covers is a word of its own with the
weight of a single occurrence.  The path of greatest total weight wins; of equal ones the one whose last word is
longest, then the one before it, and so on.

A lexicon of bounded size goes to the tasks as a trie, and segmentation is one narrow step.  A larger one meets the
texts' substrings in a join, which gives the same lattice."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

#: words that a trie may hold, and the characters of one
TRIE_WORDS, TRIE_CHARS = 500_000, 64
#: scripts written without spaces; every other run of letters is a word as it stands
UNSPACED = "⺀-⿿々-〇〡-〩〸-ヿㇰ-ㇿ㐀-䶿一-鿿豈-﫿"
#: flags of a character without a word, and of a run of other letters that the lexicon does not hold
UNKNOWN, OTHER = "x", "eng"
SCALE = 1_000_000
#: texts that are segmented together, and a score below that of any path
TEXTS, NO_PATH = 1000, -(1 << 60)


def weighted_lexicon(lexicon: DataFrame) -> DataFrame:
    """``word, flag, weight`` of the lower-cased words; frequencies of repeated words add up, the flag is the one of the
    most frequent entry (of equal ones the greatest)."""
    best = F.max(F.struct("freq", "flag"))["flag"]
    words = lexicon.where((F.col("freq") > 0) & (F.col("word") != "")).groupBy(F.lower("word").alias("word")).agg(
        best.alias("flag"), F.sum("freq").alias("freq"))
    total = words.agg(F.sum("freq").alias("total"))
    weight = F.round(F.log(F.col("freq") / F.col("total")) * SCALE).cast("bigint")
    return words.crossJoin(F.broadcast(total)).select("word", "flag", weight.alias("weight"))  # total: one row


def best_path(n: int, edges: list[tuple[int, int, int]], unknown: int) -> list[int]:
    """Ends of the words of the best path over ``n`` characters; ``edges`` are (start, end, weight)."""
    by_end: list[list[tuple[int, int]]] = [[] for _ in range(n + 1)]
    for start, end, weight in edges:
        by_end[end].append((start, weight))
    score, back = [0] * (n + 1), [0] * (n + 1)
    for end in range(1, n + 1):
        best = (score[end - 1] + unknown, 1 - end)
        for start, weight in by_end[end]:
            best = max(best, (score[start] + weight, -start))
        score[end], back[end] = best[0], -best[1]
    ends = []
    while n:
        ends.append(n)
        n = back[n]
    return ends[::-1]


class Trie:
    """Words by their characters; a node is a dict of next characters, a word's (weight, flag) stands under None."""

    def __init__(self, words: list[tuple[str, str, int]]) -> None:
        self.root: dict = {}
        for word, flag, weight in words:
            node = self.root
            for char in word:
                node = node.setdefault(char, {})
            node[None] = (weight, flag)

    def edges(self, text: str) -> list[tuple[int, int, int, str]]:
        out = []
        for start in range(len(text)):
            node = self.root
            for end in range(start, len(text)):
                node = node.get(text[end])
                if node is None:
                    break
                if None in node:
                    out.append((start, end + 1, *node[None]))
        return out


def path_words(text: str, edges: list[tuple[int, int, int, str]], unknown: int) -> list[tuple[str, str]]:
    """(word, flag) along the best path through ``text``."""
    flags = {(start, end): flag for start, end, _, flag in edges}
    out, at = [], 0
    for end in best_path(len(text), [e[:3] for e in edges], unknown):
        out.append((text[at:end], flags.get((at, end), UNKNOWN)))
        at = end
    return out


class Lattices:
    """Best paths of many runs of characters at once: the words that start at any character are found a character at a
    time over a whole batch, and paths grow by one character over runs of similar length.  The same paths as
    ``best_path`` finds in one run."""

    #: most numbers that the scores of a batch's lattices may take up
    CELLS = 1 << 22

    def __init__(self, words: list[tuple[str, str, int]], unknown: int) -> None:
        self.unknown, self.longest = unknown, max((len(word) for word, _, _ in words), default=1)
        letters = sorted({ord(char) for word, _, _ in words for char in word})
        self.letter = np.zeros(0x110000, np.int32)  # 0: in no word
        self.letter[letters] = np.arange(1, len(letters) + 1)
        self.wide = len(letters) + 1
        nodes, ends = {}, {}
        for word, _, weight in words:
            node = 0
            for char in word:
                node = nodes.setdefault(node * self.wide + int(self.letter[ord(char)]), len(nodes) + 1)
            ends[node] = weight
        self.steps = np.array(sorted(nodes), np.int64)
        self.next = np.array([nodes[step] for step in self.steps.tolist()], np.int64)
        self.weights = np.full(len(nodes) + 1, NO_PATH, np.int64)
        self.weights[list(ends)] = list(ends.values())
        self.table = None
        if (len(nodes) + 1) * self.wide <= self.CELLS:  # else the steps are searched
            self.table = np.zeros((len(nodes) + 1) * self.wide, np.int32)
            self.table[self.steps] = self.next

    def step(self, steps: np.ndarray) -> np.ndarray:
        """The nodes that the steps lead to; 0 for none."""
        if self.table is not None:
            return self.table[steps]
        if not len(self.steps):
            return np.zeros(len(steps), np.int64)
        place = np.minimum(np.searchsorted(self.steps, steps), len(self.steps) - 1)
        return np.where(self.steps[place] == steps, self.next[place], 0)

    def paths(self, runs: list[str]) -> list[list[int]]:
        """For each run the ends of its words."""
        out: list = [[]] * len(runs)
        order = sorted((k for k, run in enumerate(runs) if run), key=lambda k: len(runs[k]))
        first = 0
        while first < len(order):
            last = first + 1  # runs of similar length, as many as fit
            while last < len(order) and (len(runs[order[last]]) + 1) * (last - first + 1) * self.longest <= self.CELLS and len(
                    runs[order[last]]) <= 1.2 * len(runs[order[first]]) + 2:
                last += 1
            group = order[first:last]
            for k, path in zip(group, self._solve([runs[k] for k in group])):
                out[k] = path
            first = last
        return out

    def _solve(self, runs: list[str]) -> list[list[int]]:
        sizes, many, deep = np.array([len(run) for run in runs]), len(runs), self.longest
        n = int(sizes.max())
        chars = np.frombuffer("".join(runs).encode("utf-32-le", "surrogatepass"), np.uint32)
        letters = np.zeros((n + deep, many), np.int64)  # by place, then run; 0 beyond a run's end
        run_of = np.repeat(np.arange(many), sizes)
        letters[np.arange(len(chars)) - np.repeat(np.cumsum(sizes) - sizes, sizes), run_of] = self.letter[chars]
        letters = letters.ravel()
        # weights[end, deep - length, run]: of equal scores argmax takes the first, the longest word
        weights = np.full((n + 1, deep, many), NO_PATH, np.int64)
        weights[:, deep - 1] = self.unknown
        flat = weights.ravel()
        at = np.flatnonzero(letters)
        node = np.zeros(len(at), np.int64)
        for length in range(1, deep + 1):
            node = self.step(node * self.wide + letters[at + (length - 1) * many])
            at, node = at[node > 0], node[node > 0]
            weight = self.weights[node]
            word = weight != NO_PATH
            to = (at[word] // many + length) * (deep * many) + (deep - length) * many + at[word] % many
            flat[to] = np.maximum(flat[to], weight[word])
        score = np.full((deep + n + 1, many), NO_PATH, np.int64)
        score[deep] = 0
        back, columns = np.zeros((n + 1, many), np.int32), np.arange(many)
        for end in range(1, n + 1):
            sums = score[end:end + deep] + weights[end]
            best = sums.argmax(axis=0)
            score[deep + end] = sums[best, columns]
            back[end] = deep - best
        which, ends = [], []
        end, run = sizes, columns
        while len(run):
            which.append(run)
            ends.append(end)
            end = end - back[end, run]
            run, end = run[end > 0], end[end > 0]
        which, ends = np.concatenate(which), np.concatenate(ends)
        order = np.lexsort((ends, which))
        ends, stops = ends[order].tolist(), np.cumsum(np.bincount(which, minlength=many)).tolist()
        return [ends[a:b] for a, b in zip([0, *stops], stops)]


def pieces_of(text: str, unspaced: str) -> list[tuple[str, bool]]:
    """Letter runs of ``text`` in order: runs of the unspaced script (True) and other words (False)."""
    return [(m.group(), m.group(1) is not None) for m in re.finditer(f"([{unspaced}]+)|(?:(?![{unspaced}])[^\\W\\d_])+", text)]


_SEGMENTED = pa.list_(pa.struct([("word", pa.string()), ("flag", pa.string())]))
_WORDS = "array<struct<word:string,flag:string>>"
_WORDS_TYPE = ArrayType(StructType([StructField("word", StringType()), StructField("flag", StringType())]))


def segment(df: DataFrame, text_col: str, lexicon: DataFrame, words_col: str = "words", unspaced: str = UNSPACED,
            trie_words: int = TRIE_WORDS) -> DataFrame:
    """``df`` with ``words_col``: (word, flag) of the letter runs of ``text_col`` in order; null text has none.

    Words keep the text's case, the lexicon is met in lower case (character by character)."""
    words = weighted_lexicon(lexicon)
    size = words.agg(F.count(F.lit(1)).alias("n"), F.max(F.char_length("word")).alias("longest"),
                     F.min("weight").alias("least")).first()
    unknown = min(size["least"] or 0, 0)
    if size["n"] <= trie_words and (size["longest"] or 0) <= TRIE_CHARS:
        return _by_trie(df, text_col, [tuple(r) for r in words.collect()], unknown, words_col, unspaced)
    return _by_join(df, text_col, words, size["longest"], unknown, words_col, unspaced)


def _by_trie(df: DataFrame, text_col: str, words: list, unknown: int, words_col: str, unspaced: str) -> DataFrame:
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattices, flags = Lattices(words, unknown), {w: f for w, f, _ in words}
        for batch in batches:
            for first in range(0, batch.num_rows, TEXTS):
                part = batch.slice(first, TEXTS)
                texts = [pieces_of(text or "", unspaced) for text in part.column(at).to_pylist()]
                runs = list(dict.fromkeys(lower_each(piece) for pieces in texts for piece, lattice in pieces if lattice))
                paths = dict(zip(runs, lattices.paths(runs)))
                found, kinds, stops = [], [], [0]
                for pieces in texts:
                    for piece, lattice in pieces:
                        low = lower_each(piece)
                        if lattice:
                            ends = paths[low]
                            found += [piece[a:b] for a, b in zip([0, *ends], ends)]
                            kinds += [flags.get(low[a:b], UNKNOWN) for a, b in zip([0, *ends], ends)]
                        else:
                            found.append(piece)
                            kinds.append(flags.get(low, OTHER))
                    stops.append(len(found))
                pairs = pa.StructArray.from_arrays([pa.array(found, pa.string()), pa.array(kinds, pa.string())], ["word", "flag"])
                lists = pa.ListArray.from_arrays(pa.array(stops, pa.int32()), pairs).cast(_SEGMENTED)
                yield pa.RecordBatch.from_arrays([*part.columns, lists], [*part.schema.names, words_col])

    return df.mapInArrow(run, StructType([*df.schema.fields, StructField(words_col, _WORDS_TYPE)]))


def lower_each(text: str) -> str:
    """Lower case character by character, so that places stay."""
    low = text.lower()
    if len(low) == len(text) and "Σ" not in text:  # a sigma's lower case depends on its neighbours
        return low
    return "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def fit(piece: str, words: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """The words cut from the text as it is written."""
    out, at = [], 0
    for word, flag in words:
        out.append((piece[at:at + len(word)], flag))
        at += len(word)
    return out


def _by_join(df: DataFrame, text_col: str, words: DataFrame, longest: int, unknown: int, words_col: str,
             unspaced: str) -> DataFrame:
    """The lattice by a join: distinct runs, their substrings up to the longest word, and the lexicon; the paths go back
    to the texts by the run."""
    def cut_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("piece", pa.string()), ("lattice", pa.bool_())]))
        for batch in batches:
            found = [[{"piece": p, "lattice": x} for p, x in pieces_of(t or "", unspaced)] for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], ["text", "pieces"])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, piece, lattice, edges in zip(*(c.to_pylist() for c in batch.columns)):
                found = [(e["a"], e["b"], e["weight"], e["flag"]) for e in edges]
                low = lower_each(piece)
                whole = [f for a, b, _, f in found if b - a == len(low)]
                got = fit(piece, path_words(low, found, unknown)) if lattice else [(piece, (whole or [OTHER])[0])]
                out.append([{"word": w, "flag": f} for w, f in got])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(out, _SEGMENTED)],
                                             ["text", "piece", "lattice", "found"])

    pieces = df.select(F.col(text_col).alias("text")).distinct().mapInArrow(
        cut_pieces, "text string, pieces array<struct<piece:string,lattice:boolean>>")
    runs = pieces.select(F.explode("pieces").alias("p")).select("p.*").distinct()
    n = F.char_length("piece")
    start = F.explode(F.sequence(F.lit(0), n - 1)).alias("a")
    spans = runs.select("piece", "lattice", start).select("piece", "lattice", "a", F.explode(F.sequence(
        F.lit(1), F.least(F.lit(longest), n - F.col("a")))).alias("len"))
    # a lattice needs every span, a whole word only itself
    spans = spans.where(F.col("lattice") | (F.col("len") == n)).withColumn(
        "word", F.lower(F.substring("piece", F.col("a") + 1, F.col("len"))))
    edges = spans.join(words, "word").groupBy("piece", "lattice").agg(F.collect_list(
        F.struct("a", (F.col("a") + F.col("len")).alias("b"), "weight", "flag")).alias("edges"))
    solved = runs.join(edges, ["piece", "lattice"], "left").select(
        F.lit("").alias("text"), "piece", "lattice", F.coalesce("edges", F.array().cast(
            "array<struct<a:int,b:int,weight:bigint,flag:string>>")).alias("edges")).mapInArrow(
        solve, f"text string, piece string, lattice boolean, found {_WORDS}").drop("text")
    placed = pieces.select("text", F.posexplode("pieces").alias("pos", "p")).select(
        "text", "pos", F.col("p.piece").alias("piece"), F.col("p.lattice").alias("lattice")).join(solved, ["piece", "lattice"])
    lists = placed.groupBy("text").agg(F.array_sort(F.collect_list(F.struct("pos", "found"))).alias("parts"))
    found = lists.select(F.col("text").alias("__text"), F.flatten(F.transform("parts", lambda p: p["found"])).alias(words_col))
    out = df.join(found, F.col(text_col) == F.col("__text"), "left").drop("__text")
    return out.withColumn(words_col, F.coalesce(words_col, F.array().cast(_WORDS)))


def nouns(words_col: str):
    """Column: the words whose flag names a noun."""
    return F.transform(F.filter(words_col, lambda w: F.contains(w["flag"], F.lit("n"))), lambda w: w["word"])
