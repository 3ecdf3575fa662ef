"""Words of text without spaces, against every segmentation of short texts."""

import random

import pytest
from pyspark.sql import functions as F

from threadsmith.config import CorpusConfig
from threadsmith.operators import segment, topics

LEXICON = [("今天", "t", 50), ("天气", "n", 40), ("天", "n", 5), ("今", "x", 2), ("很好", "a", 30), ("好", "a", 60), ("北京", "ns", 25),
           ("北京大学", "nt", 9), ("大学", "n", 20), ("大学生", "n", 8), ("生", "v", 6), ("Ab", "nz", 3), ("ab", "x", 1), ("", "n", 9), ("無", "n", 0)]


def all_paths(text):
    if not text:
        return [[]]
    return [[text[:k], *rest] for k in range(1, len(text) + 1) for rest in all_paths(text[k:])]


def brute(text, weights, unknown):
    """Best path: weight first; of equal ones the longest last word, then the one before it, and so on."""
    def weight(path):
        if any(w not in weights and len(w) > 1 for w in path):
            return None
        return sum(max(weights.get(w, unknown), unknown if len(w) == 1 else -10**18) for w in path)
    best = [(weight(p), [len(w) for w in reversed(p)], p) for p in all_paths(text) if weight(p) is not None]
    return max(best)[2]


def lexicon_of(spark, rows=LEXICON):
    return spark.createDataFrame(rows, "word string, flag string, freq long")


@pytest.mark.parametrize("trie_words", [0, 10**6])
def test_equals_brute_force(spark, trie_words):
    rng = random.Random(3)
    texts = ["".join(rng.choice("今天气很好北京大学生無") for _ in range(rng.randint(1, 11))) for _ in range(80)]
    lexicon = lexicon_of(spark)
    words = {r.word: r for r in segment.weighted_lexicon(lexicon).collect()}
    weights = {w: r.weight for w, r in words.items()}
    df = spark.createDataFrame([(i, t, "kept") for i, t in enumerate(texts)], "id int, text string, words_too string")
    got = {r.id: r.words for r in segment.segment(df, "text", lexicon, trie_words=trie_words).collect()}
    for i, text in enumerate(texts):
        want = brute(text, weights, min(weights.values()))
        assert [w.word for w in got[i]] == want, text
        assert [w.flag for w in got[i]] == [words[w].flag if w in words else "x" for w in want]


@pytest.mark.parametrize("trie_words", [0, 10**6])
def test_mixed_scripts_case_nulls_and_repeats(spark, trie_words):
    rows = [(1, "今天 Hello, AB北京大学!x"), (1, "今天 Hello, AB北京大学!x"), (2, None), (3, ""), (4, "123 ... ")]
    df = spark.createDataFrame(rows, "id int, text string").repartition(3)
    got = sorted((r.id, [(w.word, w.flag) for w in r.words])
                 for r in segment.segment(df, "text", lexicon_of(spark), trie_words=trie_words).collect())
    first = (1, [("今天", "t"), ("Hello", "eng"), ("AB", "nz"), ("北京大学", "nt"), ("x", "eng")])
    assert got == [first, first, (2, []), (3, []), (4, [])]


def test_empty_lexicon_cuts_characters(spark):
    df = spark.createDataFrame([(1, "今天")], "id int, text string")
    got = segment.segment(df, "text", lexicon_of(spark).where("false")).first()
    assert [(w.word, w.flag) for w in got.words] == [("今", "x"), ("天", "x")]


def test_topics_of_unspaced_text(spark):
    df = spark.createDataFrame([(i, "今天天气很好。北京大学生好！") for i in range(40)] + [(99, "今天")], "id int, text string")
    got = topics.choose_topics(df, ["id"], "text", lexicon_of(spark), CorpusConfig(), unspaced=segment.UNSPACED).collect()
    assert {r.id: r.topic for r in got}[99] is None
    assert {r.topic for r in got if r.id < 99} == {"天气", "北京", "大学生"}


def test_nouns_column(spark):
    df = segment.segment(spark.createDataFrame([("北京很好",)], "text string"), "text", lexicon_of(spark))
    assert df.select(segment.nouns("words").alias("n")).first().n == ["北京"]
    assert df.select(F.size("words").alias("n")).first().n == 2


@pytest.mark.parametrize("table", [True, False])
def test_lattices_of_many_runs_equal_one_path_at_a_time(table):
    rng = random.Random(1)
    for _ in range(40):
        letters = "abcdé漢\U0001f600"[:rng.randint(1, 7)]
        words = {"".join(rng.choice(letters) for _ in range(rng.randint(1, 6))): -rng.randint(0, 6) for _ in range(rng.randint(0, 30))}
        rows = [(w, "n", k) for w, k in words.items()]
        unknown = min(words.values(), default=0)
        lattices, trie = segment.Lattices(rows, unknown), segment.Trie(rows)
        lattices.table = lattices.table if table else None
        runs = ["".join(rng.choice(letters + "z") for _ in range(rng.choice([0, 1, 5, 40, 200]))) for _ in range(40)]
        for run, ends in zip(runs, lattices.paths(runs)):
            assert ends == segment.best_path(len(run), [e[:3] for e in trie.edges(run)], unknown), (rows, run)


def test_lower_case_keeps_places():
    for text in ("ΑΣ ΑΣ", "İstanbul", "ÀÉ漢", ""):
        assert segment.lower_each(text) == "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
