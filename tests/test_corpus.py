"""Corpus invariants on the driver's documents (sf0.001/0.01)."""

from pyspark.sql import functions as F

from tests.conftest import SF001, SF01
from threadsmith.config import ASCII
from threadsmith.functions.draws import uniform
from threadsmith.functions.text import split_sentences
from threadsmith.operators import corpus
from threadsmith.plans import corpus_plans as C


def test_arm_shares_follow_thresholds(spark):
    d = spark.read.parquet(f"{SF01}/documents.parquet").select(F.col("doc_id").alias("id"))
    r = corpus.rounds(d, 2).withColumn("arm", corpus.arm_of(uniform(["id", "round"], "arm"), ASCII.arm_thresholds()))
    n = r.count()
    shares = {x.arm: x.c / n for x in r.groupBy("arm").agg(F.count("*").alias("c")).collect()}
    assert abs(shares["open"] - 0.35) < 0.04 and abs(shares["complete"] - 0.15) < 0.03
    assert abs(shares["topic"] - 0.45) < 0.04 and abs(shares["plain"] - 0.05) < 0.02


def test_completion_prefix_and_rest_reassemble(spark):
    d = C.posts(spark, SF001)
    rows = C.originals(spark, SF001).filter(F.col("arm") == "complete").join(d, "doc_id")
    rows = rows.withColumn("joined", F.array_join(split_sentences(F.col("text"), ASCII.delimiters), ""))
    multi = rows.filter(F.size(split_sentences(F.col("text"), ASCII.delimiters)) > 1)
    assert multi.count() > 0
    assert multi.filter(F.concat("instruction", "output") != F.col("joined")).count() == 0


def test_rounds_guard_and_unconditional_rows(spark):
    d = C.posts(spark, SF001)
    assert corpus.rounds(d, 0).count() == 0
    rows = C.originals(spark, SF001)
    plain = rows.filter(F.col("arm") == "plain")
    assert plain.filter(F.col("instruction") != "").count() == 0
    assert rows.filter(F.col("input") != "").count() == 0


def test_partition_invariance(spark):
    def run(n):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        return sorted(tuple(r) for r in C.instruction_corpus(spark, SF001).collect())
    try:
        one, eight = run(1), run(8)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert one == eight and len(one) > 0


def test_reply_pairs_gate(spark):
    pairs = C.reply_pairs_df(spark, SF001)
    assert pairs.filter(F.col("n_context") < 1).count() == 0
    hist = {r.n_context: r.n_pairs for r in corpus.context_histogram(pairs).collect()}
    assert sum(hist.values()) == pairs.count()


def test_gated_replies_of_a_hot_conversation_match_the_contexts(spark):
    """Numbers from strides equal those from whole contexts, also for a conversation with a third of all rows."""
    rows = [(0, t, "x" * (t % 9) + " (media)") for t in range(300)] + [(c, t, "y " * (c + t)) for c in range(1, 60) for t in range(10)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, text string")
    pairs = corpus.reply_rows(corpus.thread_contexts(turns), ASCII, ["conv_id", "turn"])
    want = {(r.conv_id, r.turn): r.n_context for r in pairs.collect()}
    assert {(r.conv_id, r.turn): r.n_context for r in corpus.gated_replies(turns, ASCII).collect()} == want


def test_topics_take_sentences_through_their_shuffle(spark):
    """Rows of equal keys and text count once, and no whole text is gathered for that."""
    text = "one fine morning. two cold evenings, three dark nights."
    df = spark.createDataFrame([(i, t) for i in range(40) for t in (text, text, text + " more")], "id long, text string")
    lex = spark.createDataFrame([("morning", "n"), ("evenings", "n")], "word string, flag string")
    rows = corpus.original_rows(df, C.CFG, lex)
    assert "first(text" not in rows._jdf.queryExecution().optimizedPlan().toString()
    topic = [tuple(r) for r in rows.where("arm = 'topic'").collect()]
    once = {tuple(r) for r in corpus.original_rows(df.dropDuplicates(), C.CFG, lex).where("arm = 'topic'").collect()}
    assert once and set(topic) == once
    assert all(topic.count(r) == (2 if r[-1] == text else 1) for r in once)


def test_last_text_of_the_wanted_turns(spark):
    df = spark.createDataFrame([(c, i, f"t{c}.{i}", i % 3 == 1) for c in (1, 2) for i in range(7)],
                               "conv_id int, n_context long, text string, lucky boolean")
    want = corpus.with_last_text(df).where("lucky").collect()
    got = corpus.with_last_text(df, wanted=F.col("lucky")).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(got) == 4
    assert all(r.last_context == f"t{r.conv_id}.{r.n_context - 1}" for r in got)
