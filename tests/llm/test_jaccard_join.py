import random
from collections import defaultdict

import numpy as np
import pytest

from tests.conftest import SF001
from tests.llm.helpers import docs_of, with_clashes
from threadsmith.llm import jaccard_join as j


def brute(texts):
    """{id: (class id, links)} by comparing full shingle sets of all pairs that share one."""
    sets = {}
    for i, t in texts.items():
        w = (t or "").lower().split()
        sets[i] = frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4)))
    where = defaultdict(set)
    for i, s in sets.items():
        for g in s:
            where[g].add(i)
    links = {i: {k for g in s for k in where[g] if k != i and len(s & sets[k]) >= 0.8 * len(s | sets[k])}
             for i, s in sets.items()}
    label = {}
    for i in sorted(texts):
        stack = [i]
        while stack:
            u = stack.pop()
            if u not in label:
                label[u] = i
                stack += links[u]
    return {i: (label[i], len(links[i])) for i in texts}


def words(rng, n):
    return [rng.choice("abcdefghijklmnop") * rng.randint(1, 4) for _ in range(n)]


def near_copies(rng, base, count, edits):
    for _ in range(count):
        w = list(base)
        for _ in range(edits):
            w[rng.randrange(len(w))] = "z%d" % rng.randrange(10 ** 6)
        yield " ".join(w)


@pytest.mark.parametrize("block", [768, 7])
def test_matches_brute_force_with_a_hot_group(spark, monkeypatch, block):
    monkeypatch.setattr(j, "BLOCK", block)
    rng = random.Random(5)
    texts = [" ".join(words(rng, rng.randint(1, 120))) for _ in range(60)]
    texts += list(near_copies(rng, words(rng, 150), 40, 3)) + ["same text for all of these rows"] * 15
    texts += ["", "", None, "two words", "Two  WORDS\n", "word " * 30_000]
    docs = dict(enumerate(texts))
    got = {r.doc_id: (r.class_id, r.n_links) for r in j.similarity_join(with_clashes(docs_of(spark, docs))).collect()}
    assert got == brute(docs)


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    want = brute(texts)
    got = {r.doc_id: (r.class_id, r.n_links) for r in j.similarity_join(docs).collect()}
    assert got == want
    kept = j.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for c, _ in want.values()})


def test_null_and_repeated_ids_and_empty_table(spark):
    docs = docs_of(spark, [(None, "a b c d e f"), (5, "a b c d e f"), (5, "a b c d e f"), (None, "q r s t u v")])
    got = sorted((r.doc_id or 0, r.class_id or 0, r.n_links) for r in j.similarity_join(docs).collect())
    assert got == [(0, 0, 0), (0, 5, 2), (5, 5, 2), (5, 5, 2)]
    assert sorted(r.doc_id or 0 for r in j.keep_first(docs).collect()) == [0, 5]
    assert j.similarity_join(docs.limit(0)).count() == 0 and j.keep_first(docs.limit(0)).count() == 0


def test_bands_reach_the_recall():
    bands, rows = j.choose_bands(0.8, 0.9999)
    assert bands * rows <= j.MAX_HASHES and 1 - (1 - 0.8 ** rows) ** bands >= 0.9999


def test_shingles_do_not_depend_on_pieces(monkeypatch):
    text = " ".join(str(k % 97) for k in range(3000))
    whole = j.Shingler().hashes(text)
    monkeypatch.setattr(j, "STEP", 100)
    assert np.array_equal(j.Shingler().hashes(text), whole)


@pytest.mark.parametrize("limit", [1000, 3])
def test_components_with_hubs(spark, monkeypatch, limit):
    monkeypatch.setattr(j, "max", lambda a, b: limit, raising=False)
    edges = [("h0", f"x{k:03d}") for k in range(300)] + [("h1", f"y{k:03d}") for k in range(50)] + [("x007", "y003"), ("p", "q")]
    got = {r.node: r.root for r in j.components(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert got == {n: ("p" if n in "pq" else "h0") for e in edges for n in e}


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(f"{k:04d}", f"{k + 1:04d}") for k in range(200) if k % 50 != 49], "a string, b string")
    got = {r.node: r.root for r in j.components(edges).collect()}
    assert got == {f"{k:04d}": f"{k // 50 * 50:04d}" for k in range(200)}


def test_keep_first_returns_clashing_columns_unchanged(spark):
    docs = with_clashes(docs_of(spark, [(1, "a b c d e f"), (1, "a b c d e f"), (2, "A b  c d e f"), (3, "quite another text"), (None, None)]))
    rows = j.keep_first(docs).collect()
    assert sorted(r.doc_id or 0 for r in rows) == [0, 1, 3]
    kept = [c for c in docs.columns if c not in ("doc_id", "text", "lang", "source", "n_chars")]
    assert all(r[c] == "clash" for r in rows for c in kept) and {"__key", "__id", "__row"} <= set(kept)
