import hashlib
import random

import numpy as np
import pandas as pd
import pytest

from tests.conftest import SF001
from tests.llm.helpers import docs_of, with_clashes
from threadsmith.llm import suffix_dedup as s

LINE = "The quick brown fox jumps over the lazy dog and runs through the wide green forest until the night falls down. "


def brute(texts):
    seen, out = {}, {}
    for i, t in sorted(texts.items()):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for a in range(len(b) - 99):
            if seen.setdefault(b[a:a + 100], (i, a)) != (i, a):
                gone[a:a + 100] = b"\1" * 100
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[i] = (len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def found(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in s.remove_repeats(df).collect()}


def mixture(rng, n):
    noise = lambda k: "".join(rng.choice("abcde ") for _ in range(rng.randint(0, k)))
    texts = {i: noise(300) + LINE * rng.randint(0, 3) + noise(200) for i in range(n)}
    odd = ["de " * 200, "x" + "de " * 150, "", None, LINE, LINE[:99], "a" * 1000, "é" * 300, LINE * 40, "\0" * 250 + LINE]
    return texts | {n + k: t for k, t in enumerate(odd)}


@pytest.mark.parametrize("hot", [False, True])
def test_matches_brute_force(spark, monkeypatch, hot):
    """The same result whether anchors count as frequent (dealt over shards, runs merged) or not."""
    if hot:
        for name, value in (("FREQUENT", 2), ("SAMPLE_RATE", 3), ("SHARD_BYTES", 1 << 13), ("PLACE_BYTES", 1 << 13)):
            monkeypatch.setattr(s, name, value)
    texts = mixture(random.Random(4), 120)
    df = docs_of(spark, texts)
    if hot:
        assert len(s.frequent_anchors(df.selectExpr("doc_id AS id", "hash(text) AS key", "coalesce(text, '') AS text")))
    assert found(with_clashes(df)) == brute(texts)


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    assert found(docs) == brute({r.doc_id: r.text for r in docs.collect()})


def test_null_and_repeated_ids_and_empty_table(spark):
    rows = [(None, LINE), (1, LINE), (1, LINE), (2, LINE)]
    got = sorted((str(r.doc_id), r.n_removed) for r in s.remove_repeats(docs_of(spark, rows)).collect())
    assert got == [("1", 0), ("1", 0), ("2", len(LINE)), ("None", len(LINE))]
    assert s.remove_repeats(docs_of(spark, rows).limit(0)).count() == 0


def test_suffix_array_and_common_prefixes():
    rng = random.Random(9)
    data = ("".join(rng.choice("ab") for _ in range(300)) + "abc" * 100 + "z" * 150).encode()
    order, _ = s.prefix_ranks(np.frombuffer(data, np.uint8), 100)
    assert sorted(order) == list(range(len(data)))
    cut = [data[i:i + 100] for i in order]
    assert cut == sorted(cut)
    lcp = s.common_prefixes(np.frombuffer(data, np.uint8), order, 100)
    for k in range(1, len(order)):
        a, b = data[order[k - 1]:], data[order[k]:]
        true = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert min(lcp[k], 100) == min(true, 100)


def test_pieces_of_long_texts_have_the_same_anchors(monkeypatch):
    data = np.random.default_rng(3).integers(97, 101, 5000).astype(np.uint8)
    whole = s.anchors(data)
    monkeypatch.setattr(s, "PIECE", 512)
    assert all(np.array_equal(a, b) for a, b in zip(whole, s.anchors(data)))


def test_texts_that_begin_alike(spark):
    """All bytes of a shared beginning go, also if several anchors lie near it."""
    rng = random.Random(8)
    text = lambda k: "".join(rng.choice("abcdef ") for _ in range(k))
    heads = [text(rng.randint(100, 180)) for _ in range(60)]
    texts = {2 * i + k: head + text(90) for i, head in enumerate(heads) for k in (0, 1)}
    texts |= {200: "En " * 36 + "x" * 30, 201: "y" * 30 + "En " * 70, 202: "En " * 43 + "antre " * 60}
    assert found(docs_of(spark, texts)) == brute(texts)


def test_spans_that_begin_at_one_place_are_merged_to_the_last_end():
    spans = s._merge_spans(pd.DataFrame({"id": [1, 1, 1, 2], "key": 0, "a": [0, 0, 90, 0], "b": [129, 105, 190, 100]}))
    assert spans[["id", "a", "b"]].to_numpy().tolist() == [[1, 0, 190], [2, 0, 100]]
    spans = s._merge_spans(pd.DataFrame({"id": 1, "key": 0, "a": [0, 0], "b": [129, 105]}))
    assert spans["b"].tolist() == [129]


def test_common_prefixes_after_the_first_suffix():
    text = b"the same words at the start and after the byte that sorts first, "
    data = np.frombuffer(text + b"\1" + text + b"z", np.uint8)
    order, _ = s.prefix_ranks(data, 100)
    shared = dict(zip(order.tolist(), s.common_prefixes(data, order, 100).tolist()))
    assert order[0] == len(text) and shared[len(text) + 1] == len(text)


def test_anchors_of_joined_texts_are_those_of_each():
    rng = np.random.default_rng(5)
    texts = [rng.integers(97, 100, n).astype(np.uint8) for n in (0, 99, 100, 350, 5, 1000, 101)]
    ends = np.cumsum([len(t) for t in texts])
    got = s.anchors(np.concatenate(texts), ends)
    row = np.searchsorted(ends, got[0], "right")
    for k, text in enumerate(texts):
        alone = s.anchors(text)
        for c, (x, y) in enumerate(zip(got, alone)):
            assert np.array_equal(x[row == k] - (ends[k] - len(text) if c in (0, 3, 4) else 0), y)


def test_a_window_lies_in_the_context_of_its_anchor_alone():
    data = np.frombuffer((LINE * 2 + "En " * 80 + LINE).encode(), np.uint8)
    _, _, _, low, high = s.anchors(data)
    starts = np.concatenate([np.arange(a, b - s.LENGTH + 1) for a, b in zip(low, high)])
    assert np.array_equal(np.sort(starts), np.arange(len(data) - s.LENGTH + 1))


def test_contexts_of_frequent_anchors_without_a_like_half_are_not_cut(spark):
    """Many texts share an anchor, few of them a window: only these go on."""
    rows = [(i, 0, 0, 100 + i, 30, 7, True, i, left, right) for i, (left, right) in
            enumerate([(11, 2), (11, 4), (13, 4), (15, 6), (17, 0), (0, 8), (0, 0)])]
    often = spark.createDataFrame(rows, s._FOUND)
    assert sorted(r.id for r in s.with_partner(often).collect()) == [0, 1, 2]


def test_runs_of_a_range_are_merged_to_the_earliest_places():
    def run(*windows):
        out = np.zeros(len(windows), s.RECORD)
        out["h"], out["id"], out["pos"] = zip(*windows)
        return out.tobytes()
    runs = [run((1, 5, 0), (4, 2, 9)), run((1, 3, 7), (2, 9, 0)), run((2, 8, 1)), run((1, 4, 0), (4, 2, 0), (5, 1, 1))]
    spans = s._merge_runs(pd.DataFrame({"run": runs}))
    assert sorted(zip(spans["id"], spans["a"])) == [(2, 9), (4, 0), (5, 0), (9, 0)]


def test_contexts_are_trimmed_to_what_others_share():
    gram, same = "g" * s.GRAM, "s" * 50
    strings = [same + gram + "a" * 60, same + gram + "b" * 60, same + gram + "a" * 40 + "c" * 20, "d" * 30 + gram + "e" * 50]
    before, after = s.shared_reach(np.full(4, 9), np.array([50, 50, 50, 30]), [x.encode() for x in strings])
    assert before.tolist() == [50, 50, 50, 0] and after.tolist() == [s.GRAM + 40, s.GRAM, s.GRAM + 40, s.GRAM]
