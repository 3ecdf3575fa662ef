import re
from collections import Counter

import numpy as np
import pytest

from tests.llm.helpers import DOCS, docs_of, with_clashes
from threadsmith.llm import collocations

UPPER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def brute(rows, least=10, top=2000):
    """The contract over (lang, text) rows."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(UPPER)):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            f.update((lang, *words[i:i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1))
    found = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    hidden = {(p[0], *part) for p, a in found.items() if len(p) == 4 for part in (p[1:3], p[2:4]) if 100 * a >= 50 * f[(p[0], *part)]}
    by_lang = {}
    for p, a in found.items():
        if p in hidden:
            continue
        score, k = min((10**6 * a * a // (f[p[:k + 1]] * f[(p[0], *p[k + 1:])]), k) for k in range(1, len(p) - 1))
        by_lang.setdefault(p[0], []).append((-score, -a, " ".join(p[1:]).encode(), f[p[:k + 1]], f[(p[0], *p[k + 1:])]))
    return {(lang, i + 1, phrase.decode(), -a, left, right, n[lang], -score) for lang, rows in by_lang.items()
            for i, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top])}


def mined(docs, **options):
    got = collocations.mine_phrases(docs, **options).collect()
    assert len(set(got)) == len(got)
    return {tuple(r) for r in got}


def table(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, lang, "s", 0) for i, (lang, t) in enumerate(rows)], DOCS).repartition(parts)


def rows_of(seed=1, n=90):
    rng = np.random.default_rng(seed)
    words = ["The", "the", "new", "York", "Times", "said", "é", "naïve", "a\tb", "of", "the,", "end.", "x" * 20, "漢字", "q\x00q",
             "City!\r\n", "non breaking", "z\x00", "z", "l" * 20 + "\x00", "l" * 20, "of the", "New York", "new york times"]
    return [(["en", "de", None, ""][rng.integers(4)], " ".join(words[k] for k in rng.zipf(1.2, 60) % len(words))) for _ in range(n)]


@pytest.mark.parametrize("dense, side", [(1 << 22, 256), (0, 256), (1 << 22, 2)])
def test_equals_brute_force(spark, monkeypatch, dense, side):
    monkeypatch.setattr(collocations, "DENSE", dense)
    monkeypatch.setattr(collocations, "_EDGES", np.array([side * 4**k for k in range(27)], np.int64))
    monkeypatch.setattr(collocations, "SPLIT_BLOCKS", 2)
    monkeypatch.setattr(collocations, "BLOCK_BYTES", 1500)
    rows = rows_of() + [("en", None), ("en", ""), ("xx", "too few words"), (None, "und is the same language")] + [("und", "new york")] * 9
    want = brute(rows)
    assert len(want) > 100
    assert mined(with_clashes(table(spark, rows))) == want
    assert mined(table(spark, rows, 1), top=5, least=20) == brute(rows, 20, 5)


def test_overlaps_ties_and_repeated_rows(spark):
    rows = [("en", "ha ha ha ha")] * 4 + [("en", "b a, a b. B A; a b")] * 5
    assert mined(table(spark, rows)) == brute(rows)


def test_empty_table_and_no_candidates(spark):
    assert mined(docs_of(spark, {1: "x y"}).where("false")) == set()
    assert mined(docs_of(spark, {1: "x y", 2: None, 3: "..."})) == set()


@pytest.mark.parametrize("scale", [1, 1 << 33])
def test_tiles_count_alike_dense_and_sparse(scale):
    rng = np.random.default_rng(2)
    band = int(np.searchsorted(collocations._EDGES, scale, "right"))
    low, high = collocations.band_bounds(band)
    left, right = (rng.integers(low, low + 9, 500) for _ in range(2))
    want = Counter(zip(left.tolist(), right.tolist()))
    n = rng.integers(1, 1 << 40, 500)
    weighed = Counter()
    for a, b, c in zip(left.tolist(), right.tolist(), n.tolist()):
        weighed[a, b] += c
    for dense in (0, 1 << 22):
        collocations.DENSE, kept = dense, collocations.DENSE
        try:
            a, b, c = collocations.count_tile(band * 33, left, right)
            assert dict(zip(zip(a.tolist(), b.tolist()), c.tolist())) == want
            a, b, c = collocations.count_tile(band * 33, left, right, n)
            assert dict(zip(zip(a.tolist(), b.tolist()), c.tolist())) == weighed
        finally:
            collocations.DENSE = kept
    assert (high - low) * (high - low) > 0


def test_distinct_pairs_of_large_ids():
    left, right = np.array([1 << 40, 3, 1 << 40, 3]), np.array([5, 1 << 35, 5, 2])
    a, b, place = collocations.distinct_pairs(left, right)
    assert list(zip(a[place].tolist(), b[place].tolist())) == list(zip(left.tolist(), right.tolist())) and len(a) == 3


def test_score_passes_64_bits(spark):
    a = 10**12
    row = spark.range(1).select(collocations._score(*[collocations.F.lit(a)] * 3).alias("s")).first()
    assert row.s == 10**6
