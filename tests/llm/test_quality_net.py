import zlib

import numpy as np
from pyspark.sql import functions as F

from tests.conftest import SF01
from tests.llm.helpers import docs_of, with_clashes
from threadsmith.llm import quality_net as q


def test_held_out_accuracy_and_crc(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    rows = q.score_quality(docs, labels).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    right = {y: np.mean([r.predicted == y for r in held if r.quality == y]) for y in (0, 1)}
    assert right[0] > 0.85 and right[1] > 0.97


def test_chunks_cover_every_byte():
    for n in (1, 100, 256, 257, 1000, 1 << 12):
        seen = np.zeros(n, bool)
        for s in q.chunk_starts(n):
            seen[s:s + q.CHUNK + q.STRIDE] = True
        assert seen.all()


def test_pieces_do_not_change_the_pooled_channels(monkeypatch):
    net, data = q.Net(), np.random.default_rng(1).integers(32, 120, 9001).astype(np.uint8)
    whole = q.pooled(net, data)
    monkeypatch.setattr(q, "PIECE", 1024)
    assert np.allclose(q.pooled(net, data), whole, atol=0.05)


def test_odd_rows(spark):
    rows = [(1, "good text here"), (1, "good text here"), (None, None), (3, ""), (4, "x" * 300_000)]
    docs = with_clashes(docs_of(spark, rows))
    none = spark.createDataFrame([], "doc_id long, quality int")
    out = q.score_quality(docs, none).collect()
    assert len(out) == 5 and all(r.score == 1.0 and r.predicted == 1 for r in out)
    kept = q.keep_good(docs, none)
    assert kept.columns == docs.columns and kept.count() == 5
    some = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(None, 1), (7, None)], "doc_id long, quality int")
    texts = docs_of(spark, {i: ("clean words in a row. " if i % 2 else "BAD!! *** BAD!! ") * 20 for i in range(40)})
    scored = {r.doc_id: r.score for r in q.score_quality(texts, some).collect()}
    assert all(0 <= s <= 1 for s in scored.values())
    assert scored[1] > scored[0]
    assert q.score_quality(docs.limit(0), some).count() == 0


def test_labels_of_held_out_rows_are_not_learned(spark):
    ids = list(range(60))
    texts = docs_of(spark, {i: ("clean words. " if i % 2 else "BAD!! *** ") * 20 for i in ids})
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, quality int")
    turned = labels.withColumn("quality", F.when(q.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (sorted(q.score_quality(texts, x).collect()) for x in (labels, turned))
    assert a == b
