"""Sub-word encoding against a plain merge loop and the library of the same vocabulary."""

import base64
import random

import public_tokenizers
import tiktoken

from tests.conftest import SF001
from threadsmith.config import ASCII
from threadsmith.operators import subword, trainset
from threadsmith.plans import trainset_plans as TP

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
RANKS = subword.read_ranks(PATH)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
FIRST = 4


def loop(word, ranks):
    parts = [bytes([b]) for b in word]
    while len(parts) > 1:
        found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not found:
            break
        _, i = min(found)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[p] for p in parts]


def test_merges_equal_the_loop():
    rng = random.Random(2)
    words = [bytes(rng.choice(b"aeinrst h") for _ in range(rng.randint(1, 40))) for _ in range(400)]
    words += [b"", b"a" * 999, bytes(range(256)), "déjà vu 漢字".encode(), b"ab" * 300]
    for w in words:
        if w:
            assert subword.merged(w, RANKS) == loop(w, RANKS), w


def test_own_rank_file(tmp_path):
    tokens = [b"a", b"b", b"c", b"ab", b"bc", b"abc", b"aa"]
    path = tmp_path / "own.ranks"
    path.write_bytes(b"\n".join(base64.b64encode(t) + b" %d" % i for i, t in enumerate(tokens)) + b"\n\n")
    ranks = subword.read_ranks(str(path))
    assert subword.merged(b"aabcbc", ranks) == loop(b"aabcbc", ranks) == [0, 5, 4]


def test_encoded_texts_equal_the_library(spark):
    texts = ["It's   a test,\n\n ok?  ", "naïve 漢字 \U0001f600  x", "", " ", "y" * 300, "tab\there \x85 nb space 　wide", "I'LL we'll 12a"]
    df = spark.createDataFrame([(i, t, t[::-1]) for i, t in enumerate(texts)] + [(50, None, "x"), (51, texts[0], None)],
                               "k int, a string, b string").repartition(3)
    pieces = subword.piece_table(df, ["a", "b"], PATH, ASCII)
    got = trainset.encode(df, ["k"], ["a", "b"], pieces, ASCII, subword.pre_tokens).collect()
    assert len(got) == len(texts) + 2
    for r in df.collect():
        row = next(x for x in got if x.k == r.k)
        for text, ids in ((r.a, row.a_ids), (r.b, row.b_ids)):
            assert ids == [i + FIRST for i in LIBRARY.encode_ordinary(text or "")], text


def test_corpus_rows_equal_the_library(spark):
    rows = {tuple(r[k] for k in TP.KEYS): r for r in TP.formatted(spark, SF001).collect()}
    got = TP.subword_encoded(spark, SF001, PATH).collect()
    assert len(got) == len(rows) > 0
    m = ASCII.max_seq_length
    for r in got:
        row = rows[tuple(r[k] for k in TP.KEYS)]
        prompt, target = ([i + FIRST for i in LIBRARY.encode_ordinary(t)] for t in (row.context, row.target))
        prompt = prompt[:m - 1] + [ASCII.bos_id]
        assert r.seq_len == len(prompt) and r.input_ids == (prompt + target[:m] + [ASCII.eos_id])[:m]


def test_repeated_keys_and_texts_keep_their_rows(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (1, "c")], "k int, text string")
    vocab = trainset.build_vocab(df, ["text"], ASCII)
    got = trainset.encode(df, ["k"], ["text"], vocab, ASCII).collect()
    assert sorted(len(r.text_ids) for r in got) == [1, 2, 2]


def test_pieces_of_a_token_are_found_once_for_all_it_was_met_with(spark):
    met = spark.createDataFrame([(c, p, t) for c in range(3) for p, t in enumerate(["It", " is", " 漢字"])] + [(9, 0, "It")],
                                "cell int, place int, token string")
    got = subword.with_pieces(met, PATH, ASCII).collect()
    assert len(got) == 10 and {(r.cell, r.place) for r in got} == {(r.cell, r.place) for r in met.collect()}
    assert all(r.ids == [i + FIRST for i in LIBRARY.encode_ordinary(r.token)] for r in got)


def test_corpus_texts_are_shuffled_once(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = TP.subword_rows(spark, SF001)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum("REPARTITION_BY_COL" in line and "Reused" not in line for line in plan.splitlines()) == 1
