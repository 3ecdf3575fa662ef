"""Archives read by byte ranges equal the whole-file reader; named files; cache compaction; retry rounds."""

import os
import random

import pytest
from pyspark.sql import functions as F

from tests.archive_fixture import _js, build
from threadsmith.operators import media
from threadsmith.sinks import cache_table, named_files, writers
from threadsmith.sources import archive, datasets, js_split


def rows(df):
    return sorted((r.file.rsplit("/", 1)[-1], r.row_ord, r.json) for r in df.select("file", "row_ord", "json").collect())


def post(rng, i):
    text = "".join(rng.choice(['"', "\\", "{", "}", "[", "]", "a", "é漢", "\n", " ", ",", " "]) for _ in range(rng.randint(0, 60)))
    return {"tweet": {"id_str": str(i), "full_text": text, "entities": {"urls": [{"k": {}}] * (i % 3)}, "n": None}}


@pytest.fixture()
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield spark
    for k in keys:
        spark.conf.unset(k)


def test_ranges_equal_whole_files(small_splits, tmpdir_fresh):
    spark, rng = small_splits, random.Random(1)
    data = os.path.join(tmpdir_fresh, "a", "data")
    os.makedirs(data)
    _js(os.path.join(data, "tweets.js"), "tweets", [post(rng, i) for i in range(150)])
    _js(os.path.join(data, "tweets-part1.js"), "tweets", [post(rng, i) for i in range(40)], first_has_brace=True)
    _js(os.path.join(data, "tweets-part2.js"), "tweets", [{"tweet": {"full_text": "x" * 5000, "many": [{"k": i} for i in range(300)]}}] * 3)
    with open(os.path.join(data, "tweets-part3.js"), "w") as f:  # elements share lines
        f.write("window.x = [ {\n" + '"a": 1}, {"b": "}{"}, {\n"c": {"d": 2}\n}, {"e": 3}\n]\n')
    with open(os.path.join(data, "tweet.js"), "w") as f:
        f.write("window.YTD.tweet.part0 = [ {} ]")
    whole, split = archive.read_posts(spark, data), archive.read_posts(spark, data, split=True)
    want = rows(whole)
    assert len(want) == 150 + 40 + 3 + 4 and rows(split) == want
    ranges = spark.read.text(data).select("_metadata.file_path", "_metadata.file_block_start").distinct().count()
    assert ranges > 40
    assert sorted(split.columns) == sorted(whole.columns)
    assert {(r.archive, r.file_ord) for r in split.collect()} == {(r.archive, r.file_ord) for r in whole.collect()}


def test_every_reader_takes_ranges(small_splits, tmpdir_fresh):
    data = os.path.join(build(os.path.join(tmpdir_fresh, "one")), "data")
    for reader in (archive.read_following, archive.read_followers, archive.read_dms, archive.group_events_from_archive):
        assert sorted(map(str, reader(small_splits, data, split=True).collect())) == sorted(map(str, reader(small_splits, data).collect()))


@pytest.mark.parametrize("text", ["x = [\n{\"a\": 1}\n{\"b\": 2} oops\n]", "x = [\n{\"a\": 1}}\n]", "x = [\n{\"a\": [1}\n]", "x = [\n{\"a\": {\"b\": 1}\n]"])
def test_malformed_files_are_an_error(spark, tmpdir_fresh, text):
    path = os.path.join(tmpdir_fresh, "bad.js")
    with open(path, "w") as f:
        f.write(text)
    with pytest.raises(Exception):
        js_split.read_js_split(spark, path).collect()


def test_elements_of_a_text():
    assert js_split.cut_elements(' , {"a": "}"} , {"b"', 0) == [('{"a": "}"}', True, True), ('{"b"', True, False)]
    assert js_split.cut_elements(': 1}, {}', 1) == [(": 1}", False, True), ("{}", True, True)]
    assert js_split.cut_elements("x", 2) == [("x", False, False)] and js_split.cut_elements(" ]; \n", 0) == []


# ---------------------------------------------------------------- named files
def files_below(root):
    return {os.path.relpath(os.path.join(d, f), root): open(os.path.join(d, f), encoding="utf-8", newline="").read()
            for d, _, names in os.walk(root) for f in names}


def test_named_files_hold_exact_bytes(spark, tmpdir_fresh):
    root = os.path.join(tmpdir_fresh, "out")
    rows = [("a/x.md", "one\r\ntwo\n"), ("b.txt", ""), ("a/y.md", None), ("é/漢.md", "漢字")] + [(f"many/{i}", str(i)) for i in range(50)]
    named_files.write_named_files(spark.createDataFrame(rows, "name string, content string").repartition(7), root)
    assert files_below(root) == {n: c or "" for n, c in rows}
    named_files.write_named_files(spark.createDataFrame([("b.txt", "new")], "name string, content string"), f"file://{root}")
    assert files_below(root)["b.txt"] == "new" and len(files_below(root)) == len(rows)


def test_a_failed_task_leaves_nothing_and_a_repeated_name_is_an_error(spark, tmpdir_fresh):
    root = os.path.join(tmpdir_fresh, "out")
    df = spark.range(20).select(F.concat(F.lit("f"), "id").alias("name"), F.raise_error(F.lit("boom")).cast("string").alias("content"))
    with pytest.raises(Exception):
        named_files.write_named_files(df, root)
    twice = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "3")], "name string, content string").repartition(3)
    with pytest.raises(Exception, match="several rows"):
        named_files.write_named_files(twice, root)
    for bad in ("/etc/x", "../x", ""):
        with pytest.raises(Exception, match="no name"):
            named_files.write_named_files(spark.createDataFrame([(bad, "1")], "name string, content string"), root)
    assert not os.path.isdir(root) or files_below(root) == {}


def test_attempts_that_did_not_commit_leave_no_file(tmpdir_fresh):
    """Two attempts of one task stage their files apart; only the committed message's are moved."""
    root = os.path.join(tmpdir_fresh, "out")
    writer = named_files.NamedFilesWriter(root)
    rows = [{"name": "a.md", "content": "x"}, {"name": "b.md", "content": "y"}]
    writer.write(iter(rows))
    second = writer.write(iter(rows))
    writer.commit([second, None])
    assert files_below(root) == {"a.md": "x", "b.md": "y"} and sorted(os.listdir(root)) == ["a.md", "b.md"]
    writer.write(iter(rows))
    writer.abort([None])
    assert sorted(os.listdir(root)) == ["a.md", "b.md"]


def test_transcripts_and_reports_by_name(spark, tmpdir_fresh):
    tr = spark.createDataFrame([("c1", "bob", 1, "t1", 5), ("c1", "bob", 2, "t2", 3), ("c2", "Bob", None, "t3", 1), ("c3", "amy", None, "t4", 2)],
                               "conversation_id string, name string, part long, transcript string, n_messages long")
    root = os.path.join(tmpdir_fresh, "out")
    assert writers.write_transcripts(tr, root, "name") == {"n_conversations": 3, "n_files": 4, "n_messages": 11}
    assert files_below(root) == {"DMs/DMs-bob-part001.md": "t1", "DMs/DMs-bob-part002.md": "t2", "DMs/DMs-Bob-c2.md": "t3", "DMs/DMs-amy.md": "t4"}
    lines = spark.createDataFrame([("A", "following", "b"), ("A", "following", "a"), ("A", "followers", "é"), ("B", "following", "z"), ("A", "followers", "Z")],
                                  "archive string, kind string, line string")
    root = os.path.join(tmpdir_fresh, "rep")
    assert writers.write_report(lines, root, scope=("archive",)) == {"following": 3, "followers": 2}
    assert files_below(root) == {"A/following.txt": "a\nb", "A/followers.txt": "Z\né", "B/following.txt": "z"}


# ---------------------------------------------------------------- cache compaction
CACHE = "id string, responses array<string>, version int"


def held(spark, path):
    return {r.id: r.responses for r in datasets.read_cache_table(spark, path).collect()}


def test_compaction_keeps_what_readers_see(spark, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "cache")
    rng, want, seen = random.Random(5), {}, {}
    for version in range(1, 7):
        batch = {str(rng.randrange(60)): [f"v{version}"] for _ in range(15)}
        want.update(batch)
        writers.append_cache(spark.createDataFrame([(i, r, version) for i, r in batch.items()], CACHE).coalesce(2), path)
        assert held(spark, path) == want
        if version % 2 == 0:
            made = cache_table.compact(spark, path, buckets=8)
            assert made["generation"] == version // 2 and made["files"] >= 1
            assert held(spark, path) == want
            folders = {r.bucket: r.folder for r in cache_table.manifest(spark, path).where("folder IS NOT NULL").collect()}
            kept = [b for b in folders if seen.get(b) == folders[b]]
            assert len(folders) - len(kept) == made["buckets"]
            seen = folders
    assert cache_table.compact(spark, path)["files"] == 0


def test_only_touched_buckets_are_rewritten_and_a_crash_loses_nothing(spark, tmpdir_fresh, monkeypatch):
    path = os.path.join(tmpdir_fresh, "cache")
    writers.append_cache(spark.createDataFrame([(str(i), ["old"], 1) for i in range(100)], CACHE), path)
    cache_table.compact(spark, path, buckets=16)
    writers.append_cache(spark.createDataFrame([("7", ["new"], 2)], CACHE), path)
    want = {**{str(i): ["old"] for i in range(100)}, "7": ["new"]}
    with monkeypatch.context() as m:  # the buckets are written, the manifest is not
        m.setattr(type(spark), "createDataFrame", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            cache_table.compact(spark, path)
    assert held(spark, path) == want and cache_table.manifest(spark, path).first().gen == 1
    made = cache_table.compact(spark, path)
    assert (made["generation"], made["buckets"]) == (2, 1)
    assert held(spark, path) == want
    assert len(spark.read.parquet(path).inputFiles()) >= 2  # appends stay where they are


def test_of_equal_versions_the_same_row_wins(spark, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "cache")
    writers.append_cache(spark.createDataFrame([("a", ["x"], 1), ("a", ["y"], 1)], CACHE), path)
    before = held(spark, path)
    cache_table.compact(spark, path, buckets=2)
    assert held(spark, path) == before == {"a": ["y"]}


# ---------------------------------------------------------------- retries, prefixes, manifest
def loop_ledger(results, tries=5):
    out = {}
    for file in {r[0] for r in results}:
        attempts, state, size = 0, "pending", 0
        for n in range(1, tries + 1):
            found = sorted((r[2], r[3]) for r in results if r[0] == file and r[1] == n)
            if not found:
                break
            attempts, size = n, size + found[-1][1]
            if found[-1][0]:
                state = "best"
                break
        else:
            state = "failed"
        out[file] = (attempts, state, size)
    return out


def test_retry_ledger_equals_the_rounds(spark):
    rng = random.Random(9)
    results = [(f"f{i}", n, rng.random() < 0.3, rng.randrange(99)) for i in range(80) for n in range(1, 8) if rng.random() < 0.9]
    results += [("twice", 1, False, 5), ("twice", 1, True, 2), ("late", 3, True, 1)]
    df = spark.createDataFrame(results, "file string, round int, success boolean, bytes long")
    ledger = media.retry_ledger(df)
    want = loop_ledger(results)
    assert {r.file: (r.attempts, r.state, r.bytes) for r in ledger.collect()} == want
    for r in media.retry_rounds(ledger).collect():
        tested = [w for w in want.values() if w[0] >= r["round"]]
        won = [w for w in tested if w[1] == "best" and w[0] == r["round"]]
        assert (r.n_tested, r.n_success, r.n_left, r.pause) == (len(tested), len(won), len(tested) - len(won), 0.25 + 2 * (r["round"] - 1))


def test_any_prefix_takes_longer_ids_too(spark):
    names = ["12-a.jpg", "123-b.mp4", "1-c.mp4", "x12.jpg", "12", "99999999999999999999999-d.jpg"]
    files = spark.createDataFrame([(n, n.split("-")[0]) for n in names], "file string, post_id string")
    for post in ("1", "12", "123", "5", "9" * 20):
        for wide in (False, True):
            got = {r.file for r in media.files_of_posts(files, wide).where(F.col("post_id") == post).collect()}
            assert got == {n for n in names if (n.startswith(post) if wide else n.split("-")[0] == post)}, (post, wide)


def test_media_manifest(spark):
    items = spark.createDataFrame([("1", 0, "http://m/a.jpg"), ("2", 0, "http://m/thumb.jpg"), ("2", 1, "http://m/t2.jpg"), ("3", 0, "http://m/c.jpg")],
                                  "post_id string, pos int, media_url string")
    files = spark.createDataFrame([("1-a.jpg", "1"), ("2-v1.mp4", "2"), ("2-v2.mp4", "2"), ("23-w.mp4", "23")], "file string, post_id string")
    best = spark.createDataFrame([("2", 0, "best")], "post_id string, pos int, best_url string")
    got = {tuple(r) for r in media.media_manifest(items, files, best).collect()}
    assert got == {("1", 0, "photo", "1-a.jpg", "https://pbs.twimg.com/media/a.jpg:orig"), ("2", 0, "video", "2-v1.mp4", "best"),
                   ("2", 0, "video", "2-v2.mp4", "best")}
    wide = {r.media_file for r in media.media_manifest(items, files, best, any_prefix=True).collect()}
    assert wide == {"1-a.jpg", "2-v1.mp4", "2-v2.mp4", "23-w.mp4"}


def test_observed_counts_come_from_the_write(spark, tmpdir_fresh):
    df = spark.range(1000).select(F.lit("original").alias("source"), F.col("id").cast("string").alias("id"), F.lit(0).alias("round"),
                                  F.lit("q").alias("instruction"), F.lit("").alias("input"), F.lit("a").alias("output"))
    assert writers.write_instruction_dataset(df, os.path.join(tmpdir_fresh, "k1")) == {"n_rows": 1000}
    assert writers.write_instruction_dataset(df.where("false"), os.path.join(tmpdir_fresh, "k2")) == {"n_rows": 0}
