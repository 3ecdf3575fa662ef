"""Near duplicates: an n-gram Jaccard self-join by MinHash banding.

Equal normalised texts form a class first.  Each class has a MinHash signature of its set of five-word
shingles; band and row counts are chosen for the target recall.  Classes are shuffled on their band
hashes, each bucket is joined to its least member (a star, never all pairs), and the connected candidates come
together once, with their full shingle sets, to be verified.  A large candidate group is dealt over blocks; a task
sees two blocks and returns counts and a spanning forest, not pairs."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from threadsmith.llm.common import cut, text_or_empty

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.9999
MAX_HASHES = 128
#: classes in one block of a candidate group; classes that one verifying task holds
BLOCK, SHARD = 768, 1500
STEP = 50_000


def choose_bands(threshold: float, recall: float, most: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows a band, hence the fewest chance hits, that reach ``recall`` at ``threshold``."""
    best = None
    for rows in range(1, 17):
        hit = threshold ** rows
        bands = max(1, math.ceil(math.log(1 - recall) / math.log(1 - hit))) if hit < 1 else 1
        if bands * rows <= most:
            best = (bands, rows)
    if best is None:
        raise ValueError("no band count reaches the recall with so few hashes")
    return best


def normal_text(text: Column) -> Column:
    """Lower case, white space runs to one space, trimmed."""
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def _odd(seed: int, n: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Shingler:
    """Hashes of word n-grams from prefix sums of a polynomial over the bytes, modulo 2^64."""

    def __init__(self) -> None:
        self.table = _odd(11, 256)
        self.base = int(_odd(12, 1)[0])
        self._grow(1 << 16)

    def _grow(self, n: int) -> None:
        steps = np.full(n, self.base, np.uint64)
        steps[0] = 1
        self.power = np.cumprod(steps, dtype=np.uint64)
        steps[1:] = pow(self.base, -1, 1 << 64)
        self.inverse = np.cumprod(steps, dtype=np.uint64)

    def hashes(self, text: str) -> np.ndarray:
        """Distinct shingle hashes, sorted; a text of fewer words is one shingle, an empty one has none."""
        data = np.frombuffer(text.encode(), np.uint8)
        if not len(data):
            return np.empty(0, np.uint64)
        gaps = np.flatnonzero(data == 32)
        starts, ends = np.append(0, gaps + 1), np.append(gaps, len(data))
        n = max(1, len(starts) - WORDS + 1)
        parts = []
        for a in range(0, n, STEP):
            s = starts[a:min(a + STEP, n)]
            e = ends[min(WORDS, len(starts)) - 1:][a:a + len(s)]
            low = s[0]
            part = data[low:e[-1]]
            if len(part) >= len(self.power):
                self._grow(2 * len(part))
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(self.table[part] * self.power[:len(part)], out=sums[1:])
            parts.append((sums[e - low] - sums[s - low]) * self.inverse[s - low])
        return np.unique(mixed(np.concatenate(parts)))


def mixed(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def band_hashes(shingles: np.ndarray, flips: np.ndarray, factors: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One hash a band of the MinHash signature of a set."""
    low = np.full(len(factors), np.iinfo(np.uint64).max)
    for a in range(0, len(shingles), 2048):
        low = np.minimum(low, ((shingles[a:a + 2048, None] ^ flips) * factors).min(axis=0))
    weights = _odd(15, rows)
    keys = (low.reshape(bands, rows) * weights).sum(axis=1, dtype=np.uint64)
    return mixed(keys + np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def signatures(docs: DataFrame, id_col: str, text_col: str, threshold: float, recall: float) -> DataFrame:
    """(id, key, bands): key is the md5 of the normalised text."""
    bands, rows = choose_bands(threshold, recall)
    plain = docs.select(F.col(f"`{id_col}`").alias("id"), normal_text(text_or_empty(text_col)).alias("text"))
    plain = plain.select("id", F.md5("text").alias("key"), "text")

    def run(batches):
        shingler = Shingler()
        flips, factors = _odd(13, bands * rows), _odd(14, bands * rows)
        for batch in batches:
            found, ends = [], [0]
            for text in batch.column(2):
                shingles = shingler.hashes(text.as_py())
                if len(shingles):
                    found.append(band_hashes(shingles, flips, factors, bands, rows))
                ends.append(ends[-1] + (bands if len(shingles) else 0))
            flat = np.concatenate(found) if found else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64()))],
                ["id", "key", "bands"])
    return plain.mapInArrow(run, f"id {dict(docs.dtypes)[id_col]}, key string, bands array<bigint>")


#: a node is a hub if it has more than one in so many of all edge ends; there are fewer hubs than that
HUB_SHARE = 5000


def _with_least(edges: DataFrame, nodes: DataFrame, ends: int) -> DataFrame:
    """``edges`` (a, b) with the least neighbour m of a, its edges numbering n, from ``nodes`` (a, m, n).  Edges of hubs
    meet a broadcast table of the hubs, of which there are fewer than ``HUB_SHARE``, so that no task gathers a hub's
    edges.  Band buckets and their members are dealt alike."""
    limit = max(1000, ends // HUB_SHARE)
    hubs = F.broadcast(nodes.where(F.col("n") > limit).select("a", "m"))
    rest = edges.join(hubs.select("a"), "a", "left_anti").join(nodes.where(F.col("n") <= limit).select("a", "m"), "a")
    return edges.join(hubs, "a").union(rest)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b): root is the least node of its connected component.

    Alternating stars: every node hands its larger neighbours to its least one, then its smaller ones.  Each
    round is cut and ends when the edges repeat; rounds grow with the logarithm of the nodes."""
    def neighbours(e: DataFrame) -> DataFrame:
        return e.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))

    stars = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen, count = None, stars.count()
    while True:
        both = stars.union(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = neighbours(both).select("a", F.least("a", "m").alias("m"), "n")
        large = _with_least(both, least, 2 * count).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = cut(large.where("a <> b").distinct())
        least = neighbours(large)
        small = _with_least(large, least, 2 * count).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        stars = cut(small.union(least.select("a", F.col("m").alias("b"))).distinct())
        now = tuple(stars.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == seen:
            break
        seen, count = now, now[0]
    roots = stars.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Matrix of intersection sizes; only shingles in two sets or more are counted out."""
    n = len(sets)
    codes = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    _, column, count = np.unique(codes, return_inverse=True, return_counts=True)
    shared = count[column] > 1
    owner, column = owner[shared], column[shared]
    out = np.zeros((n, n), np.int64)
    if not len(column):
        return out
    if n == 2:
        out[0, 1] = out[1, 0] = len(column) // 2
        return out
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    column = np.append(0, np.cumsum(np.diff(column) > 0))
    width = max(64, 4_000_000 // n)
    for a in range(0, column[-1] + 1, width):
        lo, hi = np.searchsorted(column, (a, a + width))
        part = np.zeros((n, min(width, column[-1] + 1 - a)), np.float32)
        part[owner[lo:hi], column[lo:hi] - a] = 1
        out += (part @ part.T).astype(np.int64)
    return out


def forest(linked: np.ndarray) -> np.ndarray:
    """For each row of a symmetric link matrix the least row that it is connected with."""
    n = len(linked)
    root = np.arange(n)
    todo = np.ones(n, bool)
    for i in range(n):
        if todo[i]:
            edge = [i]
            todo[i] = False
            while edge:
                near = linked[edge].any(axis=0) & todo
                edge = np.flatnonzero(near).tolist()
                todo[edge] = False
                root[edge] = i
    return root


def verify_shard(threshold: float):
    """Function for ``applyInPandas``: one shard of candidate groups or one pair of blocks of a large one."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        shingler, out = Shingler(), []
        for _, part in rows.sort_values("key").groupby("root", sort=False):
            sets = [shingler.hashes(t) for t in part["text"]]
            size = np.array([len(s) for s in sets])
            inter = overlaps(sets)
            linked = inter >= threshold * (size[:, None] + size - inter) - 1e-9
            linked &= inter > 0
            np.fill_diagonal(linked, False)
            block = part["block"].to_numpy()
            counted = linked & (block[:, None] != block) if part["two"].iloc[0] else linked
            key = part["key"].to_numpy()
            out.append(pd.DataFrame({"key": key, "links": counted.astype(np.int64) @ part["n"].to_numpy(),
                                     "other": key[forest(linked)]}))
        return pd.concat(out)
    return run


def near_duplicate_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                           threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[DataFrame, DataFrame]:
    """(rows, classes): rows (id, key) of every document; classes (key, n, first_id, root, links) of every
    distinct normalised text: copies, least id, key that heads its group, linked documents in other classes."""
    found = cut(signatures(docs, id_col, text_col, threshold, recall))
    classes = cut(found.groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("first_id"),
                                           F.any_value("bands").alias("bands")))
    buckets = classes.select(F.explode("bands").alias("a"), F.col("key").alias("b"))
    heads = buckets.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")).where("n > 1")
    stars = _with_least(buckets, heads, classes.count() * choose_bands(threshold, recall)[0]).where("b <> m")
    groups = components(stars.select(F.col("b").alias("a"), F.col("m").alias("b")))
    sizes = groups.groupBy(F.col("root").alias("a")).agg(F.count("*").alias("n")).withColumn("m", F.col("n"))
    groups = _with_least(groups.select(F.col("root").alias("a"), F.col("node").alias("key")), sizes, classes.count())
    groups = cut(groups.select("key", F.col("a").alias("root"), F.col("m").alias("size")).join(
        classes.select("key", "n", "first_id"), "key"))
    shards = max(1, groups.count() // SHARD)
    text = docs.select(F.col(f"`{id_col}`").alias("id"), normal_text(text_or_empty(text_col)).alias("text"))
    text = text.select("id", F.md5("text").alias("key"), "text")
    chosen = text.join(groups, (text["key"] == groups["key"]) & text["id"].eqNullSafe(groups["first_id"])).select(
        groups["key"], "root", "size", "n", "text").dropDuplicates(["key"])
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    dealt = chosen.withColumn("blocks", blocks).withColumn(
        "block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")).select(
        "key", "root", "n", "text", "block", "blocks",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("with"))
    place = F.when(F.col("blocks") == 1, F.concat(F.lit("s"), F.pmod(F.xxhash64("root"), F.lit(shards)))).otherwise(
        F.concat_ws(":", "root", F.least("block", "with"), F.greatest("block", "with")))
    tasks = dealt.select(place.alias("place"), "key", "root", "n", "text", "block", "with").withColumn(
        "two", F.col("block") != F.col("with"))
    checked = cut(tasks.select("place", "key", "root", "n", "text", "block", "two").groupBy("place").applyInPandas(
        verify_shard(threshold), "key string, links long, other string"))
    links = checked.groupBy("key").agg(F.sum("links").alias("links"))
    joined = components(checked.where("key <> other").select(F.col("key").alias("a"), F.col("other").alias("b")))
    classes = classes.select("key", "n", "first_id").join(links, "key", "left").join(
        joined.select(F.col("node").alias("key"), "root"), "key", "left")
    return found.select("id", "key"), classes.select(
        "key", "n", "first_id", F.coalesce("root", "key").alias("root"), F.coalesce("links", F.lit(0)).alias("links"))


def similarity_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
                    recall: float = RECALL) -> DataFrame:
    """``docs`` -> (id, class_id, n_links), one row a document.

    n_links counts the other documents whose shingle set has at least ``threshold`` Jaccard similarity, copies
    included; class_id is the least id of all documents connected by links.  Null counts as the empty text; empty texts are
    copies of one another.  Null ids are carried (a class of null ids alone has a null class_id), repeated rows are copies, other
    columns are ignored."""
    rows, classes = near_duplicate_classes(docs, id_col, text_col, threshold, recall)
    named = classes.groupBy(F.col("root").alias("a")).agg(F.min("first_id").alias("m"), F.count("*").alias("n"))
    classes = _with_least(classes.withColumnRenamed("root", "a"), named, classes.count()).select(
        "key", F.col("m").alias("class_id"), (F.col("links") + F.col("n") - 1).alias("n_links"))
    return rows.join(classes, "key").select(F.col("id").alias(id_col), "class_id", "n_links")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
               recall: float = RECALL) -> DataFrame:
    """One row of ``docs``, with all its columns, of each class of ``similarity_join``: the one of the least id."""
    _, classes = near_duplicate_classes(docs, id_col, text_col, threshold, recall)
    order = F.struct(F.col("first_id").isNull(), "first_id", "key")
    first = classes.groupBy("root").agg(F.min_by(F.struct("key", "first_id"), order).alias("first"))
    keepers = first.select(F.col("first.key").alias("__key"), _id_text(F.col("first.first_id")).alias("__id"))
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                        F.md5(normal_text(text_or_empty(text_col))).alias("__key"), _id_text(F.col(f"`{id_col}`")).alias("__id"))
    # copies of one text have one key but many ids: both deal them out, and only rows that repeat an id meet
    row = F.row_number().over(W.partitionBy("__key", "__id").orderBy("__key"))
    return keyed.join(keepers, ["__key", "__id"]).withColumn("__row", row).where("__row = 1").select("doc.*")


def _id_text(doc_id: Column) -> Column:
    """The id as text, null as a text that no id has."""
    return F.coalesce(doc_id.cast("string"), F.lit("\0"))
