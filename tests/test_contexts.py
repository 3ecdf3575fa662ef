"""Reply contexts by the segmented scan, drawn suffixes, last texts, against loops over the turns."""

import random

import pytest
from pyspark.sql import functions as F

from threadsmith.config import ASCII
from threadsmith.operators import corpus


def turns_of(seed=4):
    rng = random.Random(seed)
    rows = [(0, t, f"h{t} " + "w" * (t % 4) if t % 11 else None, f"k{t}") for t in range(400)]  # a third of all rows
    for c in range(1, 90):
        at = 0
        for _ in range(rng.randint(1, 14)):
            at += rng.choice([1, 1, 5000])
            rows.append((c if c > 1 else None, at, rng.choice(["a b c", "(media)", "long enough text", ""]), "x"))
    return rows


def loop_contexts(rows):
    out, said = {}, {}
    for conv, turn, text, _ in sorted(rows, key=lambda r: (r[0] is None, r[0], r[1])):
        out[conv, turn] = list(said.get(conv, []))
        if text is not None:
            said.setdefault(conv, []).append(text)
    return out


@pytest.mark.parametrize("segment", [1, 7, 64, 1000])
def test_contexts_equal_the_loop(spark, segment):
    rows = turns_of()
    df = spark.createDataFrame(rows, "conv_id long, turn long, text string, extra string").repartition(5)
    got = corpus.thread_contexts(df, segment=segment)
    assert got.columns == ["conv_id", "turn", "text", "extra", "context"]
    assert {(r.conv_id, r.turn): r.context for r in got.collect()} == loop_contexts(rows)


def test_wanted_turns_only_and_empty(spark):
    rows = turns_of()
    df = spark.createDataFrame(rows, "conv_id long, turn long, text string, extra string")
    got = corpus.thread_contexts(df, wanted=F.col("turn") % 3 == 0, segment=8).collect()
    want = {k: v for k, v in loop_contexts(rows).items() if k[1] % 3 == 0}
    assert {(r.conv_id, r.turn): r.context for r in got} == want and len(got) == len(want)
    assert corpus.thread_contexts(df.where("false")).count() == 0


def test_no_window_over_a_conversation(spark):
    df = spark.createDataFrame(turns_of()[:50], "conv_id long, turn long, text string, extra string")
    plan = corpus.thread_contexts(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list(text" not in plan.split("Window")[1].split("\n")[0]


def test_last_text(spark):
    rows = [r for r in turns_of() if r[2] is not None]
    df = spark.createDataFrame(rows, "conv_id long, turn long, text string, extra string")
    marked = corpus.gated_replies(df, ASCII, mark="ok")
    got = {(r.conv_id, r.turn): r.last_context for r in corpus.with_last_text(marked).collect()}
    assert got == {k: (v[-1] if v else None) for k, v in loop_contexts(rows).items()}
    passing = {(r.conv_id, r.turn) for r in marked.where("ok").collect()}
    assert passing == {(r.conv_id, r.turn) for r in corpus.gated_replies(df, ASCII).collect()}


def gate(text):
    for part in ("\n", " ", "(media)", "(link)"):
        text = text.replace(part, "")
    return len(text)


@pytest.mark.parametrize("temperature", [0.0, 1.0, 2.5])
def test_suffixes_follow_the_conditioned_power_law(spark, temperature):
    ctx = ["x" * 9, "ab", "(media)", "c d", "e f g", "h"]
    cfg = ASCII.with_(reply_temperature=temperature)
    df = spark.range(6000).select("id", F.lit("a reply text").alias("text"), F.array(*map(F.lit, ctx)).alias("context"))
    got = corpus.suffix_rows(df, cfg, ["id"]).groupBy("n_context", "instruction").count().collect()
    n = len(ctx)
    allowed = [r for r in range(1, n) if sum(map(gate, ctx[n - r:])) >= cfg.response_thresh]
    assert allowed == [3, 4, 5]
    weights = {n: 1.0, **{r: (r + 1) ** -temperature for r in allowed}}
    total = sum(weights.values())
    assert {r.n_context: r.instruction for r in got} == {r: "\n".join(ctx[n - r:]) for r in weights}
    for r in got:
        assert abs(r["count"] / 6000 - weights[r.n_context] / total) < 0.03


def test_suffix_of_a_short_context_is_the_whole(spark):
    rows = [(1, "a reply text", ["long enough"]), (2, "a reply text", ["abc", "def"]), (3, "no", ["long enough"]), (4, "a reply text", []),
            (5, "a reply text", ["ab", "c"]), (6, "a reply text", None)]
    df = spark.createDataFrame(rows, "id int, text string, context array<string>")
    got = {r.id: r.instruction for r in corpus.suffix_rows(df, ASCII, ["id"]).collect()}
    assert got == {1: "long enough", 2: "abc\ndef"}
