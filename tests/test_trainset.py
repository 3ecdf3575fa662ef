"""Training-set invariants: masks, padding, batches, chat trimming."""

import random
from collections import Counter

from pyspark.sql import functions as F

from tests.conftest import SF001
from threadsmith.config import ASCII, IGNORE_LABEL
from threadsmith.functions.draws import uniform
from threadsmith.operators import trainset
from threadsmith.plans import trainset_plans as TP


def test_padding_and_label_mask(spark):
    b = TP.batched(spark, SF001).collect()
    assert b
    for r in b:
        assert len(r.padded_ids) == r.longest == len(r.labels)
        assert r.padded_ids[r.length:] == [ASCII.pad_id] * (r.longest - r.length)
        assert r.labels[: r.seq_len - 1] == [IGNORE_LABEL] * (r.seq_len - 1)
        assert r.labels[r.seq_len - 1: r.length] == r.input_ids[r.seq_len - 1:]
        assert len(r.input_ids) <= ASCII.max_seq_length
    batches = {}
    for r in b:
        batches.setdefault(r.batch, []).append(r)
    for rows in batches.values():
        assert len(rows) <= ASCII.batch_size
        ordered = sorted(rows, key=lambda r: r.pos_in_batch)
        assert [r.length for r in ordered] == sorted((r.length for r in rows), reverse=True)


def test_format_rows_input_branch(spark):
    df = spark.createDataFrame([("q", "", "a"), ("q", "ctx", "a"), ("q", None, "a")], "instruction string, input string, output string")
    got = [r.context for r in trainset.format_rows(df).collect()]
    assert got == ["Instruction: q\nAnswer: ", "Instruction: q\nInput: ctx\nAnswer: ", "Instruction: q\nAnswer: "]


def py_left_trim(ctx, cutoff, step):
    while len(ctx.split()) > cutoff:
        ctx = ctx[step:]
    return ctx


def test_left_trim_matches_loop(spark):
    import random
    rnd = random.Random(5)
    texts = [" ".join("w" * rnd.randint(1, 9) for _ in range(rnd.randint(0, 80))) + (" " * rnd.randint(0, 3))
             for _ in range(60)] + ["", "   ", "a b"]
    cfg = ASCII.with_(chat_cutoff=10, chat_trim_step=7)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.x for r in df.select("i", trainset.left_trim_to_budget(F.col("t"), cfg).alias("x")).collect()}
    assert all(got[i] == py_left_trim(t, 10, 7) for i, t in enumerate(texts))


def test_chat_window_history(spark):
    pairs = spark.createDataFrame([(1, i, f"q{i}<br>", f"a{i}") for i in range(6)],
                                  "conv_id int, pair_no long, question string, answer string")
    got = {r.pair_no: r.context for r in trainset.chat_windows(pairs, ASCII).collect()}
    assert got[0] == "q0"
    assert got[1] == "q0||a0||q1"
    assert got[5] == "q2||a2||q3||a3||q4||a4||q5"


def test_vocab_ids_and_encoding(spark):
    df = spark.createDataFrame([(1, "a b a c"), (2, "b a zz")], "k int, text string")
    v = trainset.build_vocab(df, ["text"], ASCII.with_(vocab_size=2))
    assert {r.token: r.token_id for r in v.collect()} == {"a": 4, "b": 5}
    enc = trainset.encode(df, ["k"], ["text"], v, ASCII).collect()
    assert {r.k: list(r.text_ids) for r in enc} == {1: [4, 5, 4, 1], 2: [5, 4, 1]}


def test_chat_window_hot_conversation_matches_loop(spark):
    """One conversation of 400 pairs next to small ones, against the reference-style loop
    (append the pair, keep the last 4, join earlier pairs then the current question)."""
    rows = [(7, i, f"q{i}" + ("<br>" if i % 5 == 0 else ""), f"a{i}" if i % 3 else "") for i in range(400)]
    rows += [(c, i, f"c{c}q{i}", f"c{c}a{i}") for c in (1, 2) for i in range(3)]
    pairs = spark.createDataFrame(rows, "conv_id int, pair_no long, question string, answer string")
    got = {(r.conv_id, r.pair_no): r.context for r in trainset.chat_windows(pairs, ASCII).collect()}
    want = {}
    for conv in (7, 1, 2):
        hist = []
        for c, i, q, a in [r for r in rows if r[0] == conv]:
            hist.append((q, a))
            hist = hist[-ASCII.chat_history_pairs:]
            ctx = "".join(f"{hq}||{ha}||" for hq, ha in hist[:-1]) + hist[-1][0]
            want[(c, i)] = ctx.replace("<br>", "")
    assert got == want


def test_vocabulary_without_a_cap_numbers_by_frequency_then_token(spark):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcé") for _ in range(rng.randint(1, 5))) for _ in range(4000)]
    v = trainset.build_vocab(spark.createDataFrame([(" ".join(words),)], "text string"), ["text"], ASCII)
    order = [w for w, _ in sorted(Counter(words).items(), key=lambda x: (-x[1], x[0].encode()))]
    assert {r.token: r.token_id for r in v.collect()} == {w: k + 4 for k, w in enumerate(order)}


def test_sequence_length_equals_the_encoded_length(spark):
    rows = [(1, "a b c", "d e"), (2, "", "x"), (3, "a " * 50, "b " * 50)]
    df = spark.createDataFrame(rows, "k int, context string, target string")
    for cfg in (ASCII, ASCII.with_(max_seq_length=20)):
        enc = trainset.assemble(trainset.encode(df, ["k"], ["context", "target"], trainset.build_vocab(
            df, ["context", "target"], cfg), cfg), cfg)
        want = {r.k: len(r.input_ids) for r in enc.collect()}
        got = df.select("k", trainset.sequence_length(F.col("context"), F.col("target"), cfg).alias("n")).collect()
        assert {r.k: r.n for r in got} == want


def test_drop_overlength(spark):
    df = spark.createDataFrame([([1, 2],), ([1, 2, 3],), ([],)], "input_ids array<int>")
    assert sorted(len(r.input_ids) for r in trainset.drop_overlength(df, 2).collect()) == [0, 2]


def test_only_the_distinct_tokens_of_a_cell_meet_the_vocabulary(spark):
    """One row a token and cell, however often the texts hold it; texts are shuffled once for the two uses."""
    texts = ["a bb ccc " * 300] * 30 + [None, "", "dddd a"]
    df = spark.createDataFrame([(i, t, "bb") for i, t in enumerate(texts)], "k int, text string, more string")
    seen = []

    def lengths(met):
        seen.append(met)
        return met.withColumn("ids", F.array_repeat(F.length("token"), 2)).where("token <> 'ccc'")
    got = {r.k: r for r in trainset.encode(df, ["k"], ["text", "more"], lengths, ASCII).collect()}
    assert got[0].text_ids == [1, 1, 2, 2, ASCII.unk_id] * 300 and got[0].more_ids == [2, 2]
    assert (got[30].text_ids, got[31].text_ids, got[32].text_ids) == ([], [], [4, 4, 1, 1])
    assert seen[0].count() <= 4 * len(texts) and seen[0].select("cell", "token").distinct().count() == seen[0].count()


def static_plan(spark, query):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return query(spark, SF001)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def shuffles_of_texts(spark, query):
    """Shuffles that deal the rows with their texts, without those that are used again."""
    plan = static_plan(spark, query)
    return sum("REPARTITION_BY_COL" in line and "Reused" not in line for line in plan.splitlines())


def test_encode_rows_shuffles_the_texts_once(spark):
    assert shuffles_of_texts(spark, TP.encode_rows) == 1


def test_batches_and_masks_shuffle_the_texts_once(spark):
    for query in (TP.padded_batches, TP.label_mask):
        assert shuffles_of_texts(spark, query) == 1


def test_no_shuffle_follows_the_encoding(spark):
    """The plan above the cogrouped cells, which it lists first, deals no row again."""
    for query in (TP.padded_batches, TP.label_mask):
        plan = static_plan(spark, query)
        assert plan.count("FlatMapCoGroupsInArrow") == 1
        above = plan[:plan.index("FlatMapCoGroupsInArrow")]
        assert "Exchange" not in above and "Window" not in above


def test_cut_texts_keeps_the_tokens_that_rows_take(spark):
    spaces = [" ", "\t", "\n", "\u3000", "\x1c", "\xa0 ", "  \u2028"]
    rng = random.Random(4)
    texts = ["".join(rng.choice(spaces) + rng.choice(["a", "bé", "𝒳𝒴", "c.d"]) for _ in range(n)) for n in range(12)] + ["", " \t", None, "a" * 9]
    cfg = ASCII.with_(max_seq_length=5)
    df = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    for r in trainset.cut_texts(df, ["text"], cfg).collect():
        whole = texts[r.k]
        assert r.text is None if whole is None else r.text.split() == whole.split()[:5] and len(r.text) <= len(whole)


def test_batches_across_cells_equal_batches_of_one_order(spark):
    """Few rows in many cells, so that batches lie across several cells, and many rows in few, with null and equal keys."""
    rng = random.Random(8)

    def row(i):
        words = lambda: " ".join(rng.choice("abcdefg") for _ in range(rng.choice([0, 1, 4, 30, 500])))
        return (rng.choice(["o", "r", None]), f"i{i // 2}" if i % 9 else "same", i % 2, words(), words())
    prev = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts, n in (("9", 61), ("1", 150), ("2", 3)):
            rows = [row(i) for i in range(n)]
            rows.append((rows[0][0], rows[0][1], rows[0][2], None, None))
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            df = spark.createDataFrame(rows, "source string, id string, round long, context string, target string")
            entries = spark.createDataFrame([(w, k + 4) for k, w in enumerate("abcdef")], "token string, token_id int")
            got = TP.batches_of(df, entries).collect()
            draw = {tuple(r)[:3]: r.u for r in df.select(*TP.KEYS, uniform(TP.KEYS, "order", ASCII.seed).alias("u")).collect()}

            def ids(text):
                return ["abcdef".find(w) + 4 if w in "abcdef" else ASCII.unk_id for w in (text or "").split()]

            def whole(r):
                prompt = ids(r[3])[:ASCII.max_seq_length - 1] + [ASCII.bos_id]
                return (prompt + ids(r[4]) + [ASCII.eos_id])[:ASCII.max_seq_length]
            none_first = lambda key: [(v is not None, v) for v in key]
            order = sorted(((draw[r[:3]], none_first(r[:3])) for r in rows))
            assert sorted(map(tuple, (r.input_ids for r in got))) == sorted(tuple(whole(r)) for r in rows)
            batches = {}
            for r in got:
                batches.setdefault(r.batch, []).append(r)
            for k in range(0, len(order), ASCII.batch_size):
                b = sorted(batches.pop(k // ASCII.batch_size), key=lambda r: r.pos_in_batch)
                assert sorted((draw[tuple(r)[:3]], none_first(tuple(r)[:3])) for r in b) == order[k:k + ASCII.batch_size]
                assert [r.pos_in_batch for r in b] == list(range(1, len(b) + 1))
                assert [len(r.input_ids) for r in b] == [r.length for r in b] == sorted((r.length for r in b), reverse=True)
                assert all(r.longest == b[0].length == len(r.padded_ids) == len(r.labels) for r in b)
            assert not batches
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", prev)


def test_rounds_of_a_text_share_a_cell_and_its_tokens(spark):
    """Each text comes twice, as in the corpus: its tokens meet the vocabulary once.  Rows without an id are spread."""
    rows = [("original", None if i > 39 else f"d{i}", r, f"w{i} x{i} y{i}", "") for i in range(80) for r in (0, 1)]
    df = spark.createDataFrame(rows, "source string, id string, round long, context string, target string")
    seen = []

    def ids(met):
        seen.append(met)
        return met.withColumn("ids", F.array(F.length("token")))
    cell = TP.text_cell(df)
    trainset.encode(df.where("id is not null"), TP.KEYS, TP.FIELDS, ids, ASCII, cell=cell).collect()
    assert seen[0].count() == 3 * 40
    by_id = df.select("id", cell.alias("c")).groupBy("id").agg(F.countDistinct("c").alias("n")).collect()
    assert all(r.n == 1 for r in by_id if r.id is not None) and next(r.n for r in by_id if r.id is None) > 1


def test_texts_cut_before_the_topic_join_give_the_same_rows(spark):
    cfg = ASCII.with_(max_seq_length=5)
    got = TP.formatted(spark, SF001, cfg).collect()
    want = trainset.cut_texts(TP.formatted(spark, SF001), TP.FIELDS, cfg).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and max(len(r.target.split()) for r in got) == 5
