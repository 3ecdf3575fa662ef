"""Quality score of a text by a byte-level convolutional network in numpy.

The text's UTF-8 bytes are cut into overlapping chunks that cover it whole.  Learned filters of
``WIDTH`` bytes slide over each chunk; a filter's answer is its mean rectified response there.  One more
channel holds the chunk's share of repeated 4-byte strings, which no filter of fixed bytes can see.
Each channel is max-pooled over all chunks and one logistic unit combines them.  Trained on a bounded
sample of labelled rows (``TRAIN_PER_CLASS`` whole texts a class, of at most ``TRAIN_CHARS``
characters each), scored on every byte of every text."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadsmith.llm.common import map_batches, text_or_empty

WIDTH, STRIDE, FILTERS = 8, 2, 12
CHUNK, HOP = 256, 128
PIECE = 1 << 18
#: a chunk's mean is over so many responses at least (a few bytes are weak evidence); weight of the repeat channel
LEAST, REPEAT_SCALE = 40, 6.0
TRAIN_PER_CLASS, TRAIN_CHARS, EPOCHS, RATE = 800, 20_000, 6, 0.02
ACCEPT = 0.7


class Net:
    """Filter table (WIDTH, 256, FILTERS), bias by filter, weights of the pooled channels, intercept."""

    def __init__(self, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        self.table = (rng.standard_normal((WIDTH, 256, FILTERS)) * 0.3).astype(np.float32)
        self.bias = np.zeros(FILTERS, np.float32)
        self.out = (np.where(np.arange(FILTERS) % 2, 1.0, -1.0) * 0.5).astype(np.float32)
        self.out = np.append(self.out, np.float32(-1.0))
        self.intercept = np.float32(1.0)
        self.params = ("table", "bias", "out", "intercept")

    def respond(self, data: np.ndarray) -> np.ndarray:
        """Rectified responses at every STRIDE-th byte of the zero-padded bytes."""
        n = max(1, -(-len(data) // STRIDE))
        padded = np.zeros(n * STRIDE + WIDTH, np.uint8)
        padded[:len(data)] = data
        total = np.take(self.table[0], padded[:n * STRIDE:STRIDE], axis=0)
        for j in range(1, WIDTH):
            total += np.take(self.table[j], padded[j:j + n * STRIDE:STRIDE], axis=0)
        total += self.bias
        return np.maximum(total, 0, out=total)


def chunk_starts(n: int) -> np.ndarray:
    """Starts of the chunks of an n-byte text: every HOP bytes, the last one ends with the text."""
    if n <= CHUNK:
        return np.zeros(1, np.int64)
    starts = np.arange(0, n - CHUNK + 1, HOP)
    return starts if starts[-1] == n - CHUNK else np.append(starts, (n - CHUNK) // STRIDE * STRIDE)


def repeated_share(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Share of each chunk's 4-byte strings that occur earlier in the chunk."""
    if len(data) < 8:
        return np.zeros(len(starts), np.float32)
    size = min(CHUNK, len(data)) - 3
    wide = data.astype(np.uint32)
    grams = wide[:-3] | wide[1:-2] << 8 | wide[2:-1] << 16 | wide[3:] << 24
    rows = np.sort(np.lib.stride_tricks.sliding_window_view(grams, size)[np.minimum(starts, len(grams) - size)], axis=1)
    return (rows[:, 1:] == rows[:, :-1]).mean(axis=1, dtype=np.float32)


def chunk_channels(net: Net, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(channels by chunk, first and last response of each chunk) of one piece."""
    starts = chunk_starts(len(data))
    responses = net.respond(data)
    first = starts // STRIDE
    last = np.minimum(first + max(1, (min(CHUNK, len(data)) - WIDTH) // STRIDE + 1), len(responses))
    sums = np.zeros((len(responses) + 1, FILTERS))
    np.cumsum(responses, axis=0, dtype=np.float64, out=sums[1:])
    means = (sums[last] - sums[first]) / np.maximum(last - first, LEAST)[:, None]
    return np.column_stack([means, REPEAT_SCALE * repeated_share(data, starts)]), first, last


def pooled(net: Net, data: np.ndarray) -> np.ndarray:
    """Maximum of each channel over all chunks; long texts go piece by piece, pieces overlap by a chunk."""
    best = None
    for at in range(0, max(1, len(data) - CHUNK + HOP), PIECE):
        channels = chunk_channels(net, data[at:at + PIECE + CHUNK - HOP])[0].max(axis=0)
        best = channels if best is None else np.maximum(best, channels)
    return best


def probability(net: Net, data: np.ndarray) -> float:
    z = float(pooled(net, data) @ net.out + net.intercept)
    return 1.0 / (1.0 + float(np.exp(-np.clip(z, -30, 30))))


def train(texts: list[bytes], labels: list[int], seed: int = 7) -> Net:
    """Adam on the logistic loss, classes weighted alike; only each filter's best chunk gets a gradient."""
    net = Net(seed)
    rng = np.random.default_rng(seed)
    weight = {y: len(labels) / (2 * max(1, labels.count(y))) for y in (0, 1)}
    moments = {p: [np.zeros_like(getattr(net, p)), np.zeros_like(getattr(net, p))] for p in net.params}
    offsets = np.arange(WIDTH)
    step = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(texts))
        for batch in np.array_split(order, max(1, len(order) // 32)):
            grad = {p: np.zeros_like(getattr(net, p)) for p in net.params}
            for i in batch:
                data = np.frombuffer(texts[i], np.uint8)
                channels, first, last = chunk_channels(net, data)
                best = channels.argmax(axis=0)
                top = channels[best, np.arange(FILTERS + 1)]
                p = 1 / (1 + np.exp(-np.clip(top @ net.out + net.intercept, -30, 30)))
                d = np.float32((p - labels[i]) * weight[labels[i]] / len(batch))
                grad["out"] += d * top.astype(np.float32)
                grad["intercept"] += d
                responses = net.respond(data)
                padded = np.zeros(len(responses) * STRIDE + WIDTH, np.uint8)
                padded[:len(data)] = data
                for f in range(FILTERS):
                    a, b = first[best[f]], last[best[f]]
                    live = a + np.nonzero(responses[a:b, f] > 0)[0]
                    if len(live):
                        g = d * net.out[f] / np.float32(max(b - a, LEAST))
                        codes = padded[live[:, None] * STRIDE + offsets].astype(np.int64) + offsets * 256
                        grad["table"].reshape(-1, FILTERS)[:, f] += g * np.bincount(
                            codes.ravel(), minlength=WIDTH * 256).astype(np.float32)
                        grad["bias"][f] += g * len(live)
            step += 1
            for p in net.params:
                m, v = moments[p]
                m = 0.9 * m + 0.1 * grad[p]
                v = 0.99 * v + 0.01 * grad[p] ** 2
                moments[p] = [m, v]
                move = RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-6)
                setattr(net, p, (getattr(net, p) - move).astype(np.float32))
    return net


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned: crc32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", per_class: int = TRAIN_PER_CLASS) -> Net | None:
    """Network from the rows that are not held out; None when these hold fewer than two classes.

    The sample is bounded: the ``per_class`` rows a class with the least hashed ids, texts of at most
    ``TRAIN_CHARS``.  Only their ids are broadcast, so that the texts are not shuffled."""
    known = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("y")).where(
        F.col("id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("id")))
    picked = None
    for y in (0, 1):
        part = known.where(F.col("y") == y).groupBy("id").agg(F.min("y").alias("y")).orderBy(
            F.xxhash64("id"), "id").limit(per_class)
        picked = part if picked is None else picked.union(part)
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), text_or_empty(text_col).alias("text")).where(
        F.char_length("text").between(1, TRAIN_CHARS))
    rows = texts.join(F.broadcast(picked), "id").groupBy("id").agg(
        F.min("text").alias("text"), F.min("y").alias("y")).collect()
    rows.sort(key=lambda r: (str(r["id"]), r["y"]))
    if len({r["y"] for r in rows}) < 2:
        return None
    return train([r["text"].encode() for r in rows], [r["y"] for r in rows])


def _scores(net: Net | None, column: pa.Array) -> np.ndarray:
    if net is None:
        return np.ones(len(column))
    return np.array([probability(net, np.frombuffer((x.as_py() or "").encode(), np.uint8)) for x in column])


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` -> (id, held_out, score, predicted), one row a document.

    A null text counts as empty and gets a score too.  Null or repeated ids are carried; other
    columns are no inputs.  Without labels of both classes every score is 1 (nothing is known against a text)."""
    net = fit(docs, labels, id_col, text_col)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text_or_empty(text_col).alias("text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(_scores(net, batch.column(1)))], ["id", "score"])

    scored = map_batches(rows, run, f"id {dict(docs.dtypes)[id_col]}, score double")
    return scored.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "score",
                         (F.col("score") >= ACCEPT).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that ``score_quality`` predicts as 1."""
    net = fit(docs, labels, id_col, text_col)
    at = docs.columns.index(text_col)

    def each(batches):
        for batch in batches:
            keep = _scores(net, batch.column(at)) >= ACCEPT
            if keep.any():
                yield batch.filter(pa.array(keep))
    return docs.mapInArrow(each, docs.schema)
