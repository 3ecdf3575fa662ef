"""Streaming corpus equals the batch corpus; sinks and dataset readers round-trip."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001
from threadsmith.config import ASCII
from threadsmith.operators import corpus, generation
from threadsmith.plans import corpus_plans as C
from threadsmith.sinks import writers
from threadsmith.sources import datasets
from threadsmith.streaming.incremental import stream_original_rows


def test_stream_equals_batch(spark, tmpdir_fresh):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select(F.col("doc_id").alias("id"), "text")
    src = os.path.join(tmpdir_fresh, "in")
    docs.filter("id < 100").write.parquet(os.path.join(src, "a"))
    docs.filter("id >= 100").write.parquet(os.path.join(src, "b"))
    lex = C.lexicon(spark, SF001)
    out, ck = os.path.join(tmpdir_fresh, "out"), os.path.join(tmpdir_fresh, "ck")
    q = stream_original_rows(spark, os.path.join(src, "*"), "id long, text string", out, ck, ASCII, lex)
    q.awaitTermination(300)
    streamed = sorted(tuple(r) for r in spark.read.parquet(out).drop("batch_id").collect())
    batch = sorted(tuple(r) for r in corpus.original_rows(docs, ASCII, lex).collect())
    assert streamed == batch and len(batch) > 0


def test_sinks_and_readers(spark, tmpdir_fresh):
    rows = spark.createDataFrame([("original", "1", 0, "q", "", "a"), ("reply", "2:1", 0, "", "", "b")],
                                 "source string, id string, round int, instruction string, input string, output string")
    p = os.path.join(tmpdir_fresh, "k1")
    writers.write_instruction_dataset(rows, p)
    back = datasets.read_json_lines(spark, p, datasets.INSTRUCTION_SCHEMA)
    assert sorted(r.output for r in back.collect()) == ["a", "b"]
    arr = os.path.join(tmpdir_fresh, "arr.json")
    with open(arr, "w") as f:
        json.dump([{"instruction": "i", "input": "", "output": "o"}], f, indent=4)
    assert datasets.read_instruction_array(spark, arr).first().output == "o"
    cache = os.path.join(tmpdir_fresh, "cache")
    os.makedirs(cache)
    with open(os.path.join(cache, "7.txt"), "w") as f:
        json.dump(["r0", "r1"], f)
    with open(os.path.join(cache, "8.txt"), "w") as f:
        f.write("not json")
    c = datasets.read_cache_dir(spark, cache)
    assert {r.id: list(r.responses) for r in c.collect()} == {"7": ["r0", "r1"]}
    tbl = os.path.join(tmpdir_fresh, "ctable")
    writers.append_cache(spark.createDataFrame([("7", ["old"], 1)], "id string, responses array<string>, version int"), tbl)
    writers.append_cache(spark.createDataFrame([("7", ["new"], 2)], "id string, responses array<string>, version int"), tbl)
    assert datasets.read_cache_table(spark, tbl).first().responses == ["new"]
    rep = spark.createDataFrame([("following", "b x"), ("following", "a y")], "kind string, line string")
    assert writers.write_report(rep, os.path.join(tmpdir_fresh, "rep")) == {"following": 2, "followers": 0}
    with open(os.path.join(tmpdir_fresh, "rep", "following.txt")) as f:
        assert f.read() == "a y\nb x"


def test_generation_modes(spark):
    posts = spark.createDataFrame([("1", "long enough text"), ("2", "also long enough"), ("3", "tiny")], "id string, text string")
    cache = spark.createDataFrame([("1", ["c0", "c1"]), ("2", ["c0"])], "id string, responses array<string>")
    pend = sorted((r.id, r.idx) for r in generation.pending_requests(posts, cache, ASCII).collect())
    assert pend == [("2", 1)]
    assert generation.pending_requests(posts, cache, ASCII.with_(cache_only=True)).count() == 0
    rows = sorted((r.id, r.round, r.instruction) for r in generation.response_rows(posts, cache, ASCII).collect())
    assert rows == [("1", 0, "c0"), ("1", 1, "c1"), ("2", 0, "c0")]
    only = sorted((r.id, r.round) for r in generation.response_rows(posts, cache, ASCII.with_(cache_only=True)).collect())
    assert only == [("1", 0), ("1", 1)]
    body = generation.request_json(generation.render_requests(
        generation.pending_requests(posts, cache, ASCII), ASCII)).first().body
    assert json.loads(body)["max_tokens"] == 128


def test_replayed_batch_replaces_its_rows_and_keys_are_explicit(spark, tmpdir_fresh):
    from threadsmith.sinks.writers import write_instruction_dataset
    rows = spark.createDataFrame([("d", i, "q", "", f"a{i}") for i in range(9)],
                                 "kind string, doc_id int, instruction string, input string, output string")
    with pytest.raises(ValueError):
        write_instruction_dataset(rows, os.path.join(tmpdir_fresh, "x"))
    path = os.path.join(tmpdir_fresh, "y")
    write_instruction_dataset(rows, path, id_cols=("doc_id",))
    assert spark.read.json(path).count() == 9


def test_malformed_lines_are_an_error(spark, tmpdir_fresh):
    from threadsmith.sources.datasets import read_json_lines
    path = os.path.join(tmpdir_fresh, "bad.json")
    with open(path, "w") as f:
        f.write('{"context": "a", "target": "b"}\n{"context": "a", \n')
    with pytest.raises(Exception, match="(?i)malformed|corrupt|parse"):
        read_json_lines(spark, path).collect()
