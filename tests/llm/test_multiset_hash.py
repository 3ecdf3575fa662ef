import hashlib

from pyspark.sql import functions as F

from tests.llm.helpers import docs_of, with_clashes
from threadsmith.llm import multiset_hash as m


def test_order_does_not_matter_and_paragraphs_add_up(spark):
    a, b = "one line here.\ntwo, and more\n", "three; three\nfour"
    rows = {1: a + b, 2: b + "\n" + a, 3: a, 4: b, 5: a + b + "\nfour"}
    got = {r.doc_id: r for r in m.fingerprints(docs_of(spark, rows)).collect()}
    assert got[1].fingerprint == got[2].fingerprint != got[5].fingerprint
    parts = spark.createDataFrame([(got[3].words, got[4].words)], "v array<long>, w array<long>")
    both = parts.select("v", "w", m.add(F.col("v"), F.col("w")).alias("x")).select(
        "v", "x", m.add(F.col("x"), F.col("w"), -1).alias("y")).first()
    assert both.x == got[1].words and both.y == both.v


def test_edited_texts_and_likeness(spark):
    texts = {i: "".join(f"Sentence {i} {k} goes here. " + "\n" * (k % 3 == 0) for k in range(30)) for i in range(20)}
    texts |= {30: None, 31: "", 32: "ab", 33: "é" * 100, 40: texts[3]}
    rows = {r.doc_id: r for r in m.edited_fingerprints(with_clashes(docs_of(spark, texts))).collect()}
    order = sorted(texts, reverse=True)
    for i, k in zip(order, order[1:] + order[:1]):
        t, nxt = texts[i] or "", texts[k] or ""
        cut = len(t) // 3
        edited = t[:len(t) - cut] + nxt[:cut]
        assert rows[i].n_chars == len(t)
        assert rows[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= rows[i].near_next <= 1 and 0 <= rows[i].near_edited <= 1
        assert (rows[i].fingerprint == rows[i].edited_fingerprint) == (rows[i].near_edited == 1.0)
    assert all(rows[i].near_edited > 0.4 > rows[i].near_next for i in range(1, 20))
    assert rows[40].fingerprint == rows[3].fingerprint


def test_odd_rows(spark):
    rows = [(None, "x y"), (1, "same"), (1, "same"), (1, "other"), (None, None)]
    out = m.edited_fingerprints(docs_of(spark, rows)).collect()
    assert len(out) == 5 and len({r.fingerprint for r in out if r.n_chars == 4}) == 1
    one = m.edited_fingerprints(docs_of(spark, {9: "alone in here"})).first()
    assert one.near_next == 1.0
    assert m.edited_fingerprints(docs_of(spark, rows).limit(0)).count() == 0


def test_successors_cross_partitions(spark):
    keys = spark.range(1000).selectExpr("id * 7 AS id", "0L AS key", "1L AS n").repartition(13)
    got = {r.id: r.next_id for r in m.successors(keys).collect()}
    assert got == {7 * k: 7 * ((k - 1) % 1000) for k in range(1000)}
