"""Transcripts with one hot conversation: parts, order and content against plain Python."""

import os

from pyspark.sql import functions as F

from threadsmith.config import ASCII, TRANSCRIPT_SEPARATOR
from threadsmith.operators import threads, transcripts
from threadsmith.sinks import writers


def test_hot_conversation_parts(spark):
    cfg = ASCII.with_(part_size=50)
    rows = []
    for i in range(230):                      # the hot conversation: 230 messages
        rows.append(("1-2", i, "1" if i % 2 else "2", "2" if i % 2 else "1", f"m{i}",
                     f"2022-01-01T00:{i // 60:02d}:{i % 60:02d}.000Z"))
    for c in range(3, 8):                     # small ones
        for i in range(4):
            rows.append((f"1-{c}", i, "1", str(c), f"s{c}-{i}", f"2022-02-01T00:00:0{i}.000Z"))
    msgs = spark.createDataFrame(rows, "conversation_id string, msg_ord int, sender_id string, recipient_id string, "
                                       "text string, created_at string")
    users = spark.createDataFrame([("1", "me")], "user_id string, handle string")
    lines = transcripts.other_party(transcripts.dm_lines(msgs, users, cfg), users, "me", cfg)
    t = transcripts.transcripts(lines, "other_user_id", ["ts", "conversation_id", "msg_ord"],
                                transcripts.dm_header("me", F.col("other_user_id")), cfg.part_size)
    got = {(r.other_user_id, r.part): (r.n_messages, r.transcript) for r in t.collect()}
    hot = sorted(k[1] for k in got if k[0] == "2")
    assert hot == [1, 2, 3, 4, 5]
    assert [got[("2", p)][0] for p in hot] == [50, 50, 50, 50, 30]
    part3 = got[("2", 3)][1]
    assert part3.startswith("### Conversation between me and 2, part 3: ###" + TRANSCRIPT_SEPARATOR)
    bodies = [seg.split("\n\n> ")[1] for seg in part3.split(TRANSCRIPT_SEPARATOR)[1:]]
    assert bodies == [f"m{i}" for i in range(100, 150)]
    assert got[("3", None)][0] == 4


def test_thread_cache_join_modes(spark):
    replies = spark.createDataFrame([("a", "r1"), ("b", "r2")], "id string, text string")
    cache = spark.createDataFrame([("a", ["x", "y"])], "id string, context array<string>")
    assert threads.join_thread_cache(replies, cache, ASCII.with_(cache_only=True)).count() == 1
    both = {r.id: r.context for r in threads.join_thread_cache(replies, cache, ASCII).collect()}
    assert both == {"a": ["x", "y"], "b": None}


def test_partitioned_sinks(spark, tmpdir_fresh):
    posts = spark.createDataFrame([("original", 2019, 3, "1", "a"), ("reply", 2020, 1, "2", "b")],
                                  "kind string, year int, month int, id string, body string")
    p = os.path.join(tmpdir_fresh, "posts")
    assert writers.write_posts_by_month(posts, p) == {"n_posts": 2}
    back = spark.read.parquet(p).filter("kind = 'reply' AND year = 2020")
    assert [r.id for r in back.collect()] == ["2"]
