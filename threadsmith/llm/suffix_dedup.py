"""Removal of repeated byte strings with suffix arrays.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts earlier: in a document of smaller id,
or earlier in the same one.  The work follows content, so that equal strings meet without comparing shards
pairwise:

1. Anchors.  In every window of ``LENGTH`` bytes the ``GRAM``-byte string of least hash is its anchor; equal
   windows have equal anchors at equal places.  An anchor's context is all that its own windows cover.  Anchors
   (hash, context hash, place) are dealt by hash, packed into one binary row a batch and place.
2. Equal contexts: all but the first are covered whole.  Firsts whose anchor has other contexts are contested.
3. Shards.  The contested contexts are cut from their texts and dealt by anchor, and trimmed to what another context
   of the anchor may share.  Each shard gets a suffix array by Larsson-Sadakane refinement and common prefixes after
   Kasai; neighbours that share ``LENGTH`` bytes are one string, and all but its first place are covered.
4. An anchor that a bounded sample finds in many texts is dealt over many shards by context, if another context is like it on
   either side of the anchor.  Each of these shards hands on its distinct windows as a sorted run; runs meet by ranges and
   are merged by binary search.
5. Covered spans join their texts, which are cut and hashed."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadsmith.llm.common import cut, text_or_empty

LENGTH, GRAM = 100, 24
REACH = LENGTH - GRAM
#: bytes of text whose anchors one place holds; bytes of contexts in one shard
PLACE_BYTES, SHARD_BYTES = 4 << 20, 3 << 19
#: an anchor is frequent if it is in so many texts of the sample of one text in SAMPLE_RATE
SAMPLE_RATE, FREQUENT, MOST_FREQUENT = 64, 40, 50_000
NULL_ID = (1 << 63) - 1
RECORD = np.dtype([("h", "<u8"), ("ctx", "<u8"), ("id", "<i8"), ("key", "<i4"), ("pos", "<u4")])
#: anchors also have the bytes of their context on either side of the anchor's first byte; frequent ones hashes of both halves
ANCHOR = np.dtype([*RECORD.descr, ("left", "u1"), ("right", "u1")])
OFTEN = np.dtype([*ANCHOR.descr, ("l", "<u8"), ("r", "<u8")])
SPAN = np.dtype([("id", "<i8"), ("key", "<i4"), ("a", "<u4"), ("b", "<u4")])

_BASE = 0x9E3779B97F4A7C15 | 1
_TABLE = np.random.default_rng(21).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class Powers:
    """Powers of the polynomial's base and their inverses, as far as asked for."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            steps = np.full(2 * n, _BASE, np.uint64)
            steps[0] = 1
            self.up = np.cumprod(steps, dtype=np.uint64)
            steps[1:] = pow(_BASE, -1, 1 << 64)
            self.down = np.cumprod(steps, dtype=np.uint64)
        return self.up, self.down


POWERS = Powers()
#: texts are hashed in pieces of so many bytes, whose places fit the mask and whose numbers fit a core's cache
PIECE = 1 << 15
PLACE_MASK = np.uint64((1 << 20) - 1)


def _sliding_min_places(h: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost minimum (of the upper 44 bits) of every window of ``width`` values."""
    low, reach = h & ~PLACE_MASK | np.arange(len(h), dtype=np.uint64), 1
    while reach < width:
        step = min(reach, width - reach)
        low = np.minimum(low[:-step], low[step:])
        reach += step
    return (low & PLACE_MASK).astype(np.int64)


#: a window around an anchor reaches as far on one side of it at least
HALF = REACH // 2


def anchors(data: np.ndarray, ends: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """(place, anchor hash, context hash, context's begin and end) of the anchors of texts that are joined in ``data``
    and end at ``ends``; none below ``LENGTH`` bytes."""
    ends = np.array([len(data)]) if ends is None else ends
    begins, n, out = np.append(0, ends[:-1]), len(data), []
    for at in range(0, n, PIECE):
        # anchors stand in [at, at + PIECE); their windows reach REACH bytes to the left and LENGTH to the right
        low, high = max(0, at - REACH), min(n, at + PIECE + LENGTH)
        if high - low < LENGTH:
            continue
        part = data[low:high]
        up, down = POWERS.upto(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_TABLE[part] * up[:len(part)], out=sums[1:])
        h = mixed((sums[GRAM:] - sums[:-GRAM]) * down[:len(part) - GRAM + 1])
        least = _sliding_min_places(h, REACH + 1)
        first = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
        place, last = least[first], np.append(first[1:], len(least)) - 1
        # windows that cross the end of a text are none
        text = np.searchsorted(ends, place + low, "right")
        first, last = np.maximum(first, begins[text] - low), np.minimum(last, ends[text] - LENGTH - low)
        kept = (first <= last) & (place >= at - low) & (place < at - low + PIECE)
        place, a, b = place[kept], first[kept], last[kept] + LENGTH
        shape = (place - a) * (LENGTH + 1) + (b - place)
        context = (sums[b] - sums[a]) * down[a] ^ mixed(shape.astype(np.uint64))
        out.append((place + low, h[place], mixed(context), a + low, b + low))
    if not out:
        empty = np.empty(0, np.int64)
        return empty, empty.view(np.uint64), empty.view(np.uint64), empty, empty
    return tuple(np.concatenate(x) for x in zip(*out))


def half_hashes(data: np.ndarray, place: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``HALF`` bytes before, and of those after, each anchor with it; 0 where its context has fewer."""
    width, out = GRAM + HALF, []
    for odd, start, whole in ((1, place - HALF, place - low >= HALF), (0, place, high - place >= width)):
        start, found = start[whole], np.zeros(len(place), np.uint64)
        sums = np.zeros(len(start), np.uint64)
        for k in range(width):
            sums = (sums + _TABLE[data[start + k]]) * np.uint64(_BASE)
        found[whole] = mixed(sums) & ~np.uint64(3) | np.uint64(2 + odd)
        out.append(found)
    return out[0], out[1]


def joined_texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(all bytes of a column of texts without nulls, where each begins, where each ends)."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets[:-1] - offsets[0], offsets[1:] - offsets[0]


def packed_bytes(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number, first byte highest; zeros past the end."""
    wide = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    out = np.zeros(len(data), np.uint64)
    for j in range(8):
        out = out << np.uint64(8) | wide[j:j + len(data)]
    return out


def prefix_ranks(data: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, ranks) by the first ``depth`` bytes or more: ranks double the bytes they speak for, and
    only groups that are still tied are sorted again."""
    n = len(data)
    packed = packed_bytes(data)
    order = np.argsort(packed)
    values = packed[order]
    head = np.ones(n, bool)
    head[1:] = values[1:] != values[:-1]
    del packed, values
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    known, past = 8, 2 * depth + 16
    while known < depth:
        tied = ~head
        tied[:-1] |= ~head[1:]
        slots = np.flatnonzero(tied)
        if not len(slots):
            break
        members = order[slots]
        after = members + known
        second = np.where(after < n, rank[np.minimum(after, n - 1)] + past, np.minimum(n - members, past - 1))
        pair = rank[members] * (n + past) + second
        sub = np.argsort(pair)
        members, pair = members[sub], pair[sub]
        order[slots] = members
        new = np.ones(len(slots), bool)
        new[1:] = pair[1:] != pair[:-1]
        head[slots] = new
        rank[members] = slots[np.maximum.accumulate(np.where(new, np.arange(len(slots)), 0))]
        known *= 2
    return order, rank


def common_prefixes(data: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Bytes (up to about ``most``) that each suffix shares with the one before it in ``order``.

    Kasai's lemma, by text position: if i follows j and i + 1 follows j + 1, the second pair shares one byte
    less.  Only positions where that chain starts, and every 16th of a chain, are compared, eight bytes at a time."""
    n = len(data)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    places = np.arange(n)
    starts = np.ones(n, bool)
    starts[1:] = (before[1:] != before[:-1] + 1) | (before[:-1] < 0)  # the first suffix follows none
    anchor = np.maximum.accumulate(np.where(starts, places, 0))
    starts |= (places - anchor) % 16 == 0
    packed = np.concatenate([packed_bytes(data), np.zeros(most + 32, np.uint64)])
    shared = np.zeros(n, np.int64)
    live = np.flatnonzero(starts & (before >= 0))
    for step in range(0, most + 16, 8):
        differ = packed[live + step] ^ packed[before[live] + step]
        same = differ == 0
        odd = differ[~same]
        shared[live[~same]] += sum((odd < np.uint64(1 << 8 * k)).astype(np.int64) for k in range(1, 8))
        live = live[same]
        shared[live] += 8
    shared = np.minimum(shared, n - np.maximum(places, before))
    anchor = np.maximum.accumulate(np.where(starts, places, 0))
    shared = np.maximum(shared[anchor] - (places - anchor), 0)
    shared[before < 0] = 0
    return shared[order]


#: a place in a document as one number: the document's number above, the start below
START_BITS = 33


def same_windows(snippets: list[bytes], doc: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every window of the snippets, equal ones next to each other: (place, place in the joined snippets, whether a
    new group begins).  Suffixes are sorted over the joined snippets, and neighbours with ``LENGTH`` common bytes are
    one group."""
    sizes = np.array([len(s) for s in snippets])
    data = np.frombuffer(b"".join(snippets), np.uint8)
    order, _ = prefix_ranks(data, LENGTH)
    group = np.cumsum(common_prefixes(data, order, LENGTH) < LENGTH)
    base = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(snippets)), sizes)[order]
    inside = order - base[owner]
    whole = inside + LENGTH <= sizes[owner]
    owner, inside, group, order = owner[whole], inside[whole], group[whole], order[whole]
    new = np.ones(len(group), bool)
    new[1:] = group[1:] != group[:-1]
    return (doc[owner] << START_BITS) + low[owner] + inside, order, new


def spans_of(place: np.ndarray, ids: np.ndarray, keys: np.ndarray) -> pd.DataFrame:
    """Merged spans (id, key, a, b) that windows at these places cover; ids and keys by document number."""
    place = np.unique(place)
    new = np.ones(len(place), bool)
    new[1:] = place[1:] > place[:-1] + LENGTH
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(place))[:len(first)] - 1
    doc, mask = place[first] >> START_BITS, (1 << START_BITS) - 1
    return pd.DataFrame({"id": ids[doc], "key": keys[doc], "a": place[first] & mask, "b": (place[last] & mask) + LENGTH})


def numbered_documents(ids: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of each row's document in the order of id and key, ids by number, keys by number)."""
    order = np.lexsort((keys, ids))
    ids, keys = ids[order], keys[order]
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1])
    number = np.empty(len(ids), np.int64)
    number[order] = np.cumsum(new) - 1
    return number, ids[new], keys[new]


def window_hashes(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of the ``LENGTH`` bytes at each place."""
    up, down = POWERS.upto(len(data) + 1)
    out = []
    for turn in (0, 1):
        values = _TABLE[data] if not turn else mixed(_TABLE[data] + np.uint64(77))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(values * up[:len(data)], out=sums[1:])
        out.append(mixed((sums[at + LENGTH] - sums[at]) * down[at]))
    return out[0], out[1]


_PLACED = "place bigint, often boolean, blob binary"
_FOUND = "id bigint, key int, a bigint, b bigint, gram int, h bigint, often boolean, ctx bigint, l bigint, r bigint"


def _pack(records: np.ndarray, place: np.ndarray, often: bool) -> list[tuple[int, bool, bytes]]:
    order = np.argsort(place, kind="stable")
    records, place = records[order], place[order]
    cuts = np.flatnonzero(np.append(True, place[1:] != place[:-1])) if len(place) else np.empty(0, np.int64)
    ends = np.append(cuts[1:], len(place))
    return [(int(place[a]), often, records[a:b].tobytes()) for a, b in zip(cuts, ends)]


def _first_of_context(records: np.ndarray, alone: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Distinct records sorted by (anchor, context, place), and whether each is the first of its context; ``alone``: also
    those whose anchor no other record has."""
    order = np.argsort(records["h"])
    h = records["h"][order]
    same = np.zeros(len(h) + 1, bool)
    same[1:-1] = h[1:] == h[:-1]
    tied = np.flatnonzero(same[1:] | same[:-1])
    members = order[tied]
    few = records[members]
    order[tied] = members[np.lexsort([few[c] for c in ("pos", "key", "id", "ctx", "h")])]
    records = records[order if alone else order[tied]]
    new = np.ones(len(records), bool)
    new[1:] = (records["h"][1:] != records["h"][:-1]) | (records["ctx"][1:] != records["ctx"][:-1])
    distinct = new.copy()
    for c in ("pos", "id", "key"):
        distinct[1:] |= records[c][1:] != records[c][:-1]
    return records[distinct], new[distinct]


def _found(records: np.ndarray, covered: bool, often: bool) -> pd.DataFrame:
    """Rows for ``_FOUND``: contexts from a to b that are covered (``gram`` is -1), or contested ones with the bytes before
    their anchor; of frequent anchors with the hashes of their halves."""
    pos, left = records["pos"].astype(np.int64), records["left"].astype(np.int32)
    out = pd.DataFrame({"id": records["id"], "key": records["key"], "a": pos - left, "b": pos + records["right"],
                        "gram": np.int32(-1) if covered else left, "h": records["h"].view(np.int64), "often": often,
                        "ctx": records["ctx"].view(np.int64), "l": 0, "r": 0})
    return out.assign(l=records["l"].view(np.int64), r=records["r"].view(np.int64)) if often else out


def _merge_spans(found: pd.DataFrame) -> pd.DataFrame:
    """Covered contexts of one document that touch become one row.  Contexts that begin later end later."""
    f = found.sort_values(["id", "key", "a", "b"])
    doc, key, a, b = (f[c].to_numpy() for c in ("id", "key", "a", "b"))
    new = np.ones(len(f), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (key[1:] != key[:-1]) | (a[1:] > b[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(f)) - 1
    return f.iloc[first].assign(b=b[last]) if len(f) else f


#: bytes of text whose anchors are found at a time
SLICE = 4 << 20


def _anchor_records(batch: pa.RecordBatch, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The records of all anchors of a batch of texts: of those that are not frequent, of frequent ones."""
    ids, keys = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
    data, begins, ends = joined_texts(batch.column(2))
    out = [[np.empty(0, ANCHOR)], [np.empty(0, OFTEN)]]
    cuts = np.unique(np.append(np.searchsorted(begins, np.arange(0, len(data), SLICE)), len(begins)))
    for i, j in zip(cuts, cuts[1:]):
        part, upto = data[begins[i]:ends[j - 1]], ends[i:j] - begins[i]
        pos, h, ctx, low, high = anchors(part, upto)
        row = np.searchsorted(upto, pos, "right") + i
        hot = np.isin(h, frequent)
        columns = {"h": h, "ctx": ctx, "id": ids[row], "key": keys[row], "pos": pos + begins[i] - begins[row],
                   "left": pos - low, "right": high - pos}
        halves = dict(zip("lr", half_hashes(part, pos[hot], low[hot], high[hot])))
        for found, mine in zip(out, (~hot, hot)):
            records = np.empty(np.count_nonzero(mine), found[0].dtype)
            for c in records.dtype.names:
                records[c] = halves[c] if c in halves else columns[c][mine]
            found.append(records)
    return np.concatenate(out[0]), np.concatenate(out[1])


def _anchor_batches(places: int, frequent: np.ndarray):
    def run(batches):
        for batch in batches:
            rows = []
            for often, records in enumerate(_anchor_records(batch, frequent)):
                records, first = _first_of_context(records)
                covered = _merge_spans(_found(records[~first], True, bool(often)))
                records = records[first]
                place = mixed(records["h"] ^ records["ctx"]) if often else records["h"]
                rows += _pack(records, place % np.uint64(places), bool(often))
                if len(covered):
                    spans = np.empty(len(covered), SPAN)
                    for c in SPAN.names:
                        spans[c] = covered[c]
                    rows.append((int(spans["id"][0]) % places, None, spans.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.bool_()),
                 pa.array([r[2] for r in rows], pa.binary())], ["place", "often", "blob"])
    return run


def _resolve_place(rows: pd.DataFrame) -> pd.DataFrame:
    """Anchors of one place: later equal contexts are covered, firsts of anchors with more contexts contested."""
    out = []
    spans = np.frombuffer(b"".join(rows["blob"][rows["often"].isna()]), SPAN)
    if len(spans):
        out.append(pd.DataFrame({c: spans[c].astype(np.int64) for c in SPAN.names}).assign(
            gram=-1, h=0, often=False, ctx=0, l=0, r=0))
    for often, part in rows[rows["often"].notna()].groupby("often"):
        records, first = _first_of_context(np.frombuffer(b"".join(part["blob"]), OFTEN if often else ANCHOR), bool(often))
        out.append(_merge_spans(_found(records[~first], True, bool(often))))
        heads = records[first]
        if not often:
            group = np.cumsum(np.append(True, heads["h"][1:] != heads["h"][:-1])[:len(heads)]) - 1
            heads = heads[np.bincount(group)[group] > 1]
        out.append(_found(heads, False, bool(often)))
    return pd.concat(out)


def with_partner(often: DataFrame) -> DataFrame:
    """The contested contexts of frequent anchors that have the same ``HALF`` bytes before or after the anchor as another
    one.  Contexts that share a window do, so the others have no repeated window.  Counted over all places in partial sums."""
    sides = often.select("*", F.explode(F.array("l", "r")).alias("side")).where("side != 0")
    shared = cut(sides.groupBy("h", "side").count().where("count > 1").select("h", "side"))
    return sides.join(shared, ["h", "side"], "left_semi").select(often.columns).dropDuplicates(["id", "key", "a"])


_SNIPPET = "id long, key int, low long, h long, often boolean, shard long, gram int, snippet binary"


def _cut_snippets(batches):
    """Contested contexts of each text."""
    for batch in batches:
        data, begins, _ = joined_texts(batch.column(2))
        spots = batch.column(3)
        row = np.repeat(np.arange(len(spots)), spots.value_lengths().to_numpy(zero_copy_only=False))
        a, b, gram, h, often, shard = spots.flatten().flatten()
        low, size, data = begins[row] + a.to_numpy(), b.to_numpy() - a.to_numpy(), memoryview(data)
        row = pa.array(row)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(row), batch.column(1).take(row), a, h, often, shard, gram,
             pa.array([bytes(data[i:i + k]) for i, k in zip(low.tolist(), size.tolist())], pa.binary())],
            ["id", "key", "low", "h", "often", "shard", "gram", "snippet"])


def shared_reach(h: np.ndarray, gram: np.ndarray, snippets: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """How many bytes before and from the anchor's first byte on another context of the anchor ``h`` shares at most.  Among
    sorted strings one of the neighbours shares the most."""
    sizes = np.array([len(x) for x in snippets])
    edge = np.zeros(LENGTH, np.uint8)
    data = np.concatenate([edge, np.frombuffer(b"".join(snippets), np.uint8), edge])
    start = np.cumsum(sizes) - sizes + gram + LENGTH
    head = h.astype(">i8").view(np.uint8).reshape(-1, 8)
    out = []
    for have, offsets in ((gram, -1 - np.arange(REACH)), (sizes - gram, np.arange(LENGTH))):
        side = data[start[:, None] + offsets]
        side[np.arange(len(offsets)) >= have[:, None]] = 0
        side = np.concatenate([head, side], axis=1)
        order = np.argsort(side.view(f"S{side.shape[1]}").ravel())
        side = side[order]
        differ = side[1:] != side[:-1]
        shared = np.where(differ.any(axis=1), differ.argmax(axis=1), side.shape[1]) - 8
        most = np.empty(len(have), np.int64)
        most[order] = np.maximum(np.append(0, shared), np.append(shared, 0))
        out.append(np.clip(most, 0, have))
    return out[0], out[1]


def _trimmed(rows: pd.DataFrame, doc: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """The contexts of a shard that holds all of their anchors, cut to what another context of the anchor shares at most;
    of equal ones the first: (strings, their documents, their places, all windows of the others as places)."""
    gram, low, h = (rows[c].to_numpy().astype(np.int64) for c in ("gram", "low", "h"))
    before, after = shared_reach(h, gram, list(rows["snippet"]))
    kept = np.flatnonzero(before + after >= LENGTH)
    place = (doc << START_BITS) + low + gram - before
    kept = kept[np.argsort(place[kept], kind="stable")]
    strings, firsts, again, seen = [], [], [], set()
    for i, x, g, s, l, r in zip(kept.tolist(), h[kept].tolist(), gram[kept].tolist(), rows["snippet"].iloc[kept],
                                before[kept].tolist(), after[kept].tolist()):
        string = s[g - l:g + r]
        if (x, l, string) in seen:
            again.append(i)
        else:
            seen.add((x, l, string))
            strings.append(string)
            firsts.append(i)
    firsts, again = np.array(firsts, np.int64), np.array(again, np.int64)
    windows = (before + after)[again] - LENGTH + 1
    covered = np.repeat(place[again] - (np.cumsum(windows) - windows), windows) + np.arange(windows.sum())
    return strings, doc[firsts], (low + gram - before)[firsts], covered


def _resolve_shard(rows: pd.DataFrame, range_bits: int) -> pd.DataFrame:
    """Spans of a shard's repeated windows; shards of frequent anchors also hand on their runs of distinct
    windows, sorted and cut by the upper bits of the hash."""
    often = bool(rows["often"].iloc[0])
    doc, ids, keys = numbered_documents(rows["id"].to_numpy(), rows["key"].to_numpy())
    if often:
        snippets, low, covered = list(rows["snippet"]), rows["low"].to_numpy(), np.empty(0, np.int64)
    else:
        snippets, doc, low, covered = _trimmed(rows, doc)
        if not snippets:
            return pd.DataFrame({c: [] for c in ("id", "key", "a", "b", "run", "span")})
    place, at, new = same_windows(snippets, doc, low)
    heads = np.flatnonzero(new)
    first = np.minimum.reduceat(place, heads) if len(heads) else place
    late = place[place != first[np.cumsum(new) - 1]]
    spans = spans_of(np.concatenate([late, covered]), ids, keys).assign(run=None, span=-1)
    if not often:
        return spans
    one, two = window_hashes(np.frombuffer(b"".join(snippets), np.uint8), at[heads])
    run = np.empty(len(heads), RECORD)
    run["h"], run["ctx"], run["pos"] = one, two, first & ((1 << START_BITS) - 1)
    run["id"], run["key"] = ids[first >> START_BITS], keys[first >> START_BITS]
    run = run[np.lexsort((run["ctx"], run["h"]))]
    ranges = (run["h"] >> np.uint64(64 - range_bits)).astype(np.int64)
    edges = np.searchsorted(ranges, np.arange((1 << range_bits) + 1))
    runs = [{"id": 0, "key": 0, "a": 0, "b": 0, "run": run[a:b].tobytes(), "span": r}
            for r, (a, b) in enumerate(zip(edges, edges[1:])) if a < b]
    return pd.concat([spans, pd.DataFrame(runs)]) if runs else spans


def _merged(best: np.ndarray, run: np.ndarray) -> np.ndarray:
    """Two sorted runs as one: of a window in both the earlier place."""
    best = best.copy()
    at = np.searchsorted(best["h"], run["h"])
    at_safe = np.minimum(at, len(best) - 1)
    known = (best["h"][at_safe] == run["h"]) & (best["ctx"][at_safe] == run["ctx"])
    spot, mine = at_safe[known], run[known]
    earlier = _earlier(mine, best[spot])
    best[spot[earlier]] = mine[earlier]
    return np.insert(best, at[~known], run[~known])


def _merge_runs(rows: pd.DataFrame) -> pd.DataFrame:
    """Merges the sorted runs of one range by binary search, two by two: a window that is earlier in another run is covered."""
    runs = [np.frombuffer(b, RECORD) for b in rows["run"]]
    level = runs
    while len(level) > 1:
        level = [_merged(*level[i:i + 2]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    best = level[0]
    later = []
    for run in runs:
        spot = np.searchsorted(best["h"], run["h"])
        first = best[spot]
        later.append(run[(first["id"] != run["id"]) | (first["key"] != run["key"]) | (first["pos"] != run["pos"])])
    late = np.concatenate(later)
    doc, ids, keys = numbered_documents(late["id"], late["key"])
    return spans_of((doc << START_BITS) + late["pos"], ids, keys)


def _earlier(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (x["id"] < y["id"]) | (x["id"] == y["id"]) & (
        (x["key"] < y["key"]) | (x["key"] == y["key"]) & (x["pos"] < y["pos"]))


def frequent_anchors(texts: DataFrame) -> np.ndarray:
    """Anchor hashes found in ``FREQUENT`` or more texts of a sample (one text in ``SAMPLE_RATE`` by hash), at most
    ``MOST_FREQUENT``.  They only decide how the work is dealt, not its result."""
    def run(batches):
        for batch in batches:
            data, _, ends = joined_texts(batch.column(0))
            place, h = anchors(data, ends)[:2]
            row = np.searchsorted(ends, place, "right")
            order = np.lexsort((h, row))
            row, h = row[order], h[order]
            once = np.ones(len(h), bool)
            once[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(h[once].view(np.int64))], ["h"])
    sample = texts.where(F.pmod(F.xxhash64("key", "id"), F.lit(SAMPLE_RATE)) == 0).select("text")
    often = sample.mapInArrow(run, "h bigint").groupBy("h").count().where(F.col("count") >= FREQUENT)
    rows = often.orderBy(F.desc("count"), "h").limit(MOST_FREQUENT).collect()
    return np.array([r["h"] for r in rows], np.int64).view(np.uint64)


def repeated_spans(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(texts (id, key, text) with the order key, spans (id, key, a, b) that cover all bytes to be removed)."""
    texts = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NULL_ID)).alias("id"),
                        text_or_empty(text_col).alias("text")).select("id", F.hash("text").alias("key"), "text")
    total = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    places = max(1, int(total) // PLACE_BYTES)
    frequent = frequent_anchors(texts)
    packed = texts.where(F.octet_length("text") >= LENGTH).mapInArrow(_anchor_batches(places, frequent), _PLACED)
    found = cut(packed.groupBy("place").applyInPandas(_resolve_place, _FOUND))
    spans, contested = found.where("gram < 0").select("id", "key", "a", "b"), found.where("gram >= 0")
    if len(frequent):
        often = cut(with_partner(contested.where("often")))
        contested = contested.where("not often").union(often)
    # contexts of frequent anchors have shards and ranges of their own, as runs are as many as both multiplied
    held = {r["often"]: r["n"] for r in contested.groupBy("often").agg(F.sum(F.col("b") - F.col("a")).alias("n")).collect()}
    shards, often_shards = (max(1, held.get(often, 0) // SHARD_BYTES) for often in (False, True))
    shard = F.when(F.col("often"), F.pmod(F.xxhash64("ctx"), F.lit(often_shards))).otherwise(F.pmod(F.xxhash64("h"), F.lit(shards)))
    contested = contested.withColumn("shard", shard.cast("long")).groupBy("id", "key").agg(
        F.collect_list(F.struct("a", "b", "gram", "h", "often", "shard")).alias("spots"))
    snippets = texts.join(contested, ["id", "key"]).dropDuplicates(["id", "key"]).select("id", "key", "text", "spots")
    dealt = snippets.mapInArrow(_cut_snippets, _SNIPPET)
    range_bits = 2 + often_shards.bit_length()
    resolved = cut(dealt.groupBy("shard", "often").applyInPandas(
        lambda rows: _resolve_shard(rows, range_bits), "id long, key int, a long, b long, run binary, span long"))
    merged = resolved.where("span >= 0").groupBy("span").applyInPandas(
        _merge_runs, "id long, key int, a long, b long")
    spans = spans.union(resolved.where("span < 0").select("id", "key", "a", "b")).union(merged)
    return texts, spans


def _cut_texts(batches):
    """Merges each text's spans, cuts them out and hashes the rest."""
    for batch in batches:
        data, begins, ends = joined_texts(batch.column(1))
        lists = batch.column(2)
        many = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(many)), many)
        a, b = (x.to_numpy(zero_copy_only=False) for x in lists.flatten().flatten())
        a, b = a + begins[row], np.minimum(b + begins[row], ends[row])
        order = np.argsort(a, kind="stable")
        row, a, b = row[order], a[order], np.maximum.accumulate(b[order])
        new = np.ones(len(a), bool)
        new[1:] = (row[1:] != row[:-1]) | (a[1:] > b[:-1])
        first = np.flatnonzero(new)
        row, a, b = row[first], a[first], b[np.append(first[1:], len(b))[:len(first)] - 1]
        runs = np.bincount(row, minlength=len(many))
        gone = np.append(0, np.cumsum(b - a))
        upto = np.cumsum(runs)
        view, a, b, digest = memoryview(data), a.tolist(), b.tolist(), []
        for begin, end, n, k in zip(begins.tolist(), ends.tolist(), runs.tolist(), (upto - runs).tolist()):
            kept = hashlib.sha256()
            for i in range(k, k + n):
                kept.update(view[begin:a[i]])
                begin = b[i]
            kept.update(view[begin:end])
            digest.append(kept.hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(ends - begins), pa.array(gone[upto] - gone[upto - runs]), pa.array(runs, pa.int64()),
             pa.array(digest, pa.string())], ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` -> (id, n_bytes, n_removed, n_spans, kept_sha256), one row a document; ids are integers.

    Null counts as the empty text; texts below ``LENGTH`` bytes keep all.  Null ids come after all others.  Rows of one id with
    different texts are documents in the order of their texts' hash; rows that repeat id and text are one
    document and get the same result each.  Other columns are ignored."""
    texts, spans = repeated_spans(docs, id_col, text_col)
    lists = spans.groupBy("id", "key").agg(F.collect_list(F.struct("a", "b")).alias("spans"))
    joined = texts.join(lists, ["id", "key"], "left").select("id", "text", "spans")
    out = joined.mapInArrow(_cut_texts, "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return out.select(F.when(F.col("id") != NULL_ID, F.col("id")).cast(dict(docs.dtypes)[id_col]).alias(id_col),
                      "n_bytes", "n_removed", "n_spans", "kept_sha256")
