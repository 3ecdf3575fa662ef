import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.helpers import DOCS, docs_of, with_clashes
from threadsmith.llm import divergence

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
UPPER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


def brute(rows, top=200):
    """The contract, term by term in Python integers, over (lang, source, text) rows."""
    df, n, total, groups = Counter(), Counter(), Counter(), defaultdict(set)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        found = terms(text)
        df.update({(lang, t) for t in found})
        n.update((lang, source, t) for t in found)
        total.update((lang, t) for t in found)
    out = set()
    for lang, sources in groups.items():
        kept = [t for (x, t), c in df.items() if x == lang and c >= 3]
        sizes = {s: sum(n[lang, s, t] for t in kept) + len(kept) for s in sources}
        whole = sum(total[lang, t] for t in kept) + len(kept)
        p = {s: {t: 1 + 10**9 * (n[lang, s, t] + 1) // sizes[s] for t in kept} for s in sources}
        q = {t: 1 + 10**9 * (total[lang, t] + 1) // whole for t in kept}
        for s in sources:
            pairs = [(b, sum((p[s][t] - p[b][t]) ** 2 // p[b][t] for t in kept)) for b in sources if b != s]
            over = [(t, (p[s][t] - q[t]) ** 2 // q[t]) for t in kept if n[lang, s, t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", over, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out |= {(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(found[:most])}
    return out


def rows_of(seed=0, n=60):
    rng = np.random.default_rng(seed)
    words = ["The", "the", "naïve", "Ünder", "über", "it's", "Straße", "x" * 8, "x" * 9, "y" * 16, "y" * 17, "é" * 30,
             "漢字漢字漢字漢字漢字", "Q" * 700, "q1w", " ", "a_b", "ZZ[z]", "\U0001f600", "abcdefgh", "abcdefghi", "ABCDEFGHIJKLMNOP"]
    return [(["en", "de", None][rng.integers(3)], ["s1", "s2", "ß", None, "s10"][rng.integers(5)],
             " ".join(words[k] for k in rng.zipf(1.3, 40) % len(words))) for _ in range(n)]


def audited(docs, **options):
    got = divergence.audit_sources(docs, **options).collect()
    assert len(set(got)) == len(got)
    return {tuple(r) for r in got}


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, source, 0) for i, (lang, source, t) in enumerate(rows)], DOCS).repartition(3)


@pytest.mark.parametrize("cells", [1, 1 << 20])
def test_equals_brute_force(spark, monkeypatch, cells):
    monkeypatch.setattr(divergence, "CELLS", cells)
    rows = rows_of() + [("en", "only nulls", None), ("lone", "a", "no kept term"), ("lone", "b", ""), ("single", "a", "w w")]
    assert audited(with_clashes(table(spark, rows))) == brute(rows)
    assert audited(table(spark, rows), top_terms=3) == brute(rows, top=3)


def test_repeated_rows_are_documents_of_their_own(spark):
    rows = [("en", "a", "twice told")] * 3 + [("en", "b", "told")]
    assert audited(table(spark, rows)) == brute(rows)


def test_empty_table(spark):
    assert audited(docs_of(spark, {1: "x"}).where("false")) == set()


def test_one_source_in_many_batches(spark):
    rows = [("en", "hot", f"w{k % 7} long{'g' * (k % 40)} the the") for k in range(300)] + rows_of(3, 20)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    try:
        assert audited(table(spark, rows)) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_counted_terms_of_random_bytes():
    import pyarrow as pa
    rng = np.random.default_rng(5)
    texts = ["".join(map(chr, rng.choice([65, 90, 97, 122, 64, 91, 96, 123, 32, 0, 0x80, 0x3b1, 0x4e00, 0x1f600], k)))
             for k in rng.integers(0, 60, 200)]
    group = rng.integers(0, 70000, 5)[rng.integers(0, 5, 200)].astype(np.uint32)
    n, df = Counter(), Counter()
    for text, g in zip(texts, group):
        n.update((g, t) for t in terms(text))
        df.update({(g, t) for t in terms(text)})
    sliced = pa.array(["AB cd", *texts, "end"]).slice(1, 200)
    found = [((g, t.as_py()), a, b) for gs, ts, ns, ds in divergence.count_terms(sliced, group) for g, t, a, b in zip(gs, ts, ns, ds)]
    assert len(found) == len(n)
    assert {k: v for k, v, _ in found} == n and {k: v for k, _, v in found} == df


def test_shares_are_exact_where_products_pass_64_bits():
    counts, whole = np.array([[10**12, 7, 0]]), np.array([10**15 + 3, 3 * 10**15, 8])
    assert divergence.shares(counts, whole).tolist() == [[1 + 10**9 * (c + 1) // w for c, w in zip(counts[0].tolist(), whole.tolist())]]
