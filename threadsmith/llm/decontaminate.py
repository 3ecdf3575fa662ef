"""Benchmark decontamination by pigeonhole edit matching.

A passage within k edits of a test item of k + 1 pieces holds at least one piece unchanged.  An
Aho-Corasick automaton finds all piece hits in a text, each hit gives a window where the item would
lie, overlapping windows of an item become one, and Myers' bit-parallel distance decides each window.  An item too short
for any edit is one piece, which must stand between word boundaries."""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadsmith.llm.common import text_or_empty

#: edits allowed: a share of the item's length, but a few edits for short items as well
EDIT_RATE, SHORT_EDITS, SHORT_PER_EDIT = 0.06, 6, 14
#: scripts written without spaces between words, where every character is a boundary
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
#: characters of items that one automaton holds; more items are searched block by block
BLOCK_CHARS = 1_000_000


def normalise(text: str | None) -> str:
    """Lower case, white space runs to one space, trimmed."""
    return " ".join((text or "").lower().split())


def edit_budget(length: int) -> int:
    return max(int(EDIT_RATE * length), min(SHORT_EDITS, length // SHORT_PER_EDIT))


def in_word(text: str, at: int) -> bool:
    """Whether a word goes on from before ``at`` to behind it."""
    if not 0 < at < len(text):
        return False
    sides = text[at - 1:at + 1]
    return sides[0].isalnum() and sides[1].isalnum() and not _UNSPACED.search(sides)


def pieces(item: str) -> list[tuple[int, str]]:
    """(offset, piece) of edit budget + 1 pieces of nearly equal length."""
    n = edit_budget(len(item)) + 1
    cuts = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def symbol_masks(item: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, ch in enumerate(item):
        masks[ch] = masks.get(ch, 0) | 1 << i
    return masks


def myers(masks: dict[str, int], length: int, text: str) -> tuple[int, int]:
    """(least edit distance of the item to a substring of ``text``, end of the first such substring)."""
    full, top = (1 << length) - 1, 1 << (length - 1)
    up, down, score, best, end = full, 0, length, length, 0
    for at, ch in enumerate(text, 1):
        eq = masks.get(ch, 0)
        vertical = eq | down
        across = (((eq & up) + up) ^ up) | eq
        rise = down | (full & ~(across | up))
        fall = up & across
        if rise & top:
            score += 1
        elif fall & top:
            score -= 1
            if score < best:
                best, end = score, at
        rise = rise << 1 & full
        fall = fall << 1 & full
        up = fall | (full & ~(vertical | rise))
        down = rise & vertical
    return best, end


class Matcher:
    """Items of one block, ready to search texts."""

    def __init__(self, items: list[tuple[object, str]]) -> None:
        self.ids = [i for i, _ in items]
        self.texts = [normalise(t) for _, t in items]
        self.masks: dict[int, dict[str, int]] = {}
        found: dict[str, list[tuple[int, int]]] = {}
        for k, text in enumerate(self.texts):
            for offset, piece in pieces(text) if text else ():
                found.setdefault(piece, []).append((k, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, places in found.items():
            self.automaton.add_word(piece, (len(piece), places))
        if found:
            self.automaton.make_automaton()
        self.empty = not found

    def search(self, raw: str | None) -> list[tuple[int, int, int]]:
        """(item number, edits, end in the normalised text), the best place of each item that matches."""
        text = normalise(raw)
        if self.empty or not text:
            return []
        exact: dict[int, int] = {}
        windows: dict[int, list[list[int]]] = {}
        for last, (size, places) in self.automaton.iter(text):
            for k, offset in places:
                length = len(self.texts[k])
                if not edit_budget(length):
                    if k not in exact and not in_word(text, last + 1 - size) and not in_word(text, last + 1):
                        exact[k] = last + 1
                    continue
                slack = edit_budget(length)
                start = last + 1 - size - offset
                a, b = max(0, start - slack), min(len(text), start + length + slack)
                mine = windows.setdefault(k, [])
                if mine and a <= mine[-1][1]:
                    mine[-1][0], mine[-1][1] = min(a, mine[-1][0]), max(b, mine[-1][1])
                else:
                    mine.append([a, b])
        out = [(k, 0, end) for k, end in exact.items()]
        for k, mine in windows.items():
            item = self.texts[k]
            masks = self.masks.get(k) or self.masks.setdefault(k, symbol_masks(item))
            best = None
            for a, b in mine:
                edits, end = myers(masks, len(item), text[a:b])
                if edits <= edit_budget(len(item)) and (best is None or edits < best[1]):
                    best = (k, edits, a + end)
            if best:
                out.append(best)
        return out


def item_blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[object, str]]]:
    """The test set in blocks of about ``BLOCK_CHARS`` characters, dealt by the hash of the text."""
    rows = items.select(F.col(f"`{id_col}`").alias("id"), text_or_empty(text_col).alias("text"))
    chars = rows.agg(F.sum(F.char_length("text"))).first()[0] or 0
    blocks = -(-int(chars) // BLOCK_CHARS)
    for b in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b).collect()
        yield sorted(((r["id"], r["text"]) for r in part), key=lambda x: (str(x[0]), x[1]))


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc id, item id, edits, end): each item's best place in each document that holds it.

    Null and empty texts and items match nothing.  Repeated items and documents each give their rows;
    null ids are carried.  Ends count characters of the normalised text.  The test set is a stated query set: it is
    searched against all documents block by block, each block one Arrow map without a shuffle."""
    doc_type, item_type = dict(docs.dtypes)[id_col], dict(items.dtypes)[item_id_col]
    schema = f"doc {doc_type}, item {item_type}, edits int, end_at long"
    rows = docs.select(F.col(f"`{id_col}`").alias("doc"), text_or_empty(text_col).alias("text"))
    out = None
    for block in item_blocks(items, item_id_col, item_text_col):
        def run(batches, block=block):
            matcher = Matcher(block)
            for batch in batches:
                at, item, edits, end = [], [], [], []
                for row, text in enumerate(batch.column(1)):
                    for k, e, stop in matcher.search(text.as_py()):
                        at.append(row)
                        item.append(matcher.ids[k])
                        edits.append(e)
                        end.append(stop)
                if at:
                    ids = batch.column(0).take(pa.array(at, pa.int64()))
                    yield pa.RecordBatch.from_arrays(
                        [ids, pa.array(item), pa.array(edits, pa.int32()), pa.array(end, pa.int64())],
                        ["doc", "item", "edits", "end_at"])
        part = rows.mapInArrow(run, schema)
        out = part if out is None else out.union(part)
    if out is None:
        out = docs.sparkSession.createDataFrame([], schema)
    return out.select(F.col("doc").alias(id_col), F.col("item").alias(item_id_col), "edits", "end_at")


def drop_leaks(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
               item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no test item, short ones included."""
    at = docs.columns.index(text_col)
    for block in item_blocks(items, item_id_col, item_text_col):
        def run(batches, block=block):
            matcher = Matcher(block)
            for batch in batches:
                keep = [not matcher.search(x.as_py()) for x in batch.column(at)]
                if any(keep):
                    yield batch.filter(pa.array(keep, pa.bool_()))
        docs = docs.mapInArrow(run, docs.schema)
    return docs
