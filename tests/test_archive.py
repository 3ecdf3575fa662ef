"""Archive scan, normalisation, media, routing and identity on the synthetic archive."""

import os

import pytest
from pyspark.sql import functions as F

from tests.archive_fixture import build
from threadsmith.config import CJK_DELIMITERS, CorpusConfig
from threadsmith.operators import identity, media, posts, transcripts
from threadsmith.plans.archive_corpus import corpus_from_archive, normalised_posts
from threadsmith.sources import archive


@pytest.fixture(scope="module")
def arch(tmp_path_factory):
    return build(str(tmp_path_factory.mktemp("archive")))


def test_scan_parts_and_one_line_file(spark, arch):
    data = os.path.join(arch, "data")
    rows = archive.read_posts(spark, data)
    per_file = {os.path.basename(r.file): r.n for r in rows.groupBy("file").agg(F.count("*").alias("n")).collect()}
    assert per_file == {"tweets.js": 12, "tweets-part1.js": 1}
    assert archive.account_usernames(spark, data).first().username == "me_owner"
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        archive.read_posts(spark, os.path.join(arch, "nope")).collect()


def test_malformed_file_is_an_error(spark, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "following.js")
    with open(path, "w") as f:
        f.write('window.YTD.following.part0 = [\n {"following": {"accountId": "1"}}, {"following": ')
    with pytest.raises(Exception, match="(?i)malformed"):
        archive.read_following(spark, tmpdir_fresh).collect()


def test_many_archives_in_paths_with_spaces(spark, tmpdir_fresh):
    """Three archives read by one glob: owners, files and repeated post ids stay with their archive."""
    for k in range(3):
        root = os.path.join(tmpdir_fresh, f"my archive+{k}")
        os.makedirs(root)
        build(root)
    dirs = os.path.join(tmpdir_fresh, "*", "data")
    one = normalised_posts(spark, os.path.join(tmpdir_fresh, "my archive+0", "data")).collect()
    got = normalised_posts(spark, dirs)
    assert got.count() == 3 * len(one) and got.select("archive").distinct().count() == 3
    bodies = {(r.archive, r.file_ord, r.row_ord): r.body for r in got.collect()}
    assert {b for (_, _, _), b in bodies.items()} == {r.body for r in one}
    rows, replies, users = corpus_from_archive(spark, dirs, CorpusConfig(delimiters=CJK_DELIMITERS),
                                               thread_cache=spark.createDataFrame([("2", ["an earlier long enough message"])],
                                                                                  "id string, context array<string>"))
    assert replies.count() == 9 and {(r.user_id, r.handle) for r in users.collect()} == {("55", "bob")}
    assert rows.filter("arm = 'reply'").count() == 3


def test_media_post_in_two_parts(spark, tmpdir_fresh):
    """A media post that two parts hold stays two rows with one placeholder each."""
    from tests.archive_fixture import _js, post
    root = build(tmpdir_fresh)
    twice = post("800", "https://t.co/m8", entities={"urls": [], "media": [{"url": "https://t.co/m8"}], "user_mentions": []},
                 extended_entities={"media": [{"url": "https://t.co/m8", "media_url": "http://pbs.twimg.com/media/AAA.jpg"}]})
    _js(os.path.join(root, "data", "tweets-part2.js"), "tweets", [twice])
    got = [r.body for r in normalised_posts(spark, os.path.join(root, "data")).collect() if r.id == "800"]
    assert got == ["(media)", "(media)"]


def test_entities_without_url_and_split_dm_records(spark):
    from threadsmith.config import ASCII
    urls = "array<struct<url:string,expanded_url:string,display_url:string,indices:array<int>>>"
    df = spark.createDataFrame([("go a b", [(None, "x", None, None), ("a", None, None, None), ("b", "B", None, None)])],
                               f"t string, u {urls}")
    assert df.select(posts.link_markdown(F.col("t"), F.col("u")).alias("m")).first().m == "go a (link)"
    message = lambda s: {"messageCreate": {"senderId": "1", "recipientId": "2", "text": s,
                                           "createdAt": "2022-01-27T15:58:52.744Z", "urls": None, "mediaUrls": None}}
    rows = [(0, k, {"conversationId": "1-2", "messages": [message(f"r{k}a"), message(f"r{k}b")]}) for k in range(2)]
    convs = spark.createDataFrame(rows, "file_ord int, row_ord int, " + archive.DM_SCHEMA.replace(" struct", ": struct", 1).replace(
        "dmConversation: ", "dmConversation "))
    msgs = transcripts.dm_messages_from_archive(convs)
    users = spark.createDataFrame([], "user_id string, handle string")
    lines = transcripts.dm_lines(msgs, users, ASCII).orderBy("ts", "msg_ord").collect()
    assert [r.line[-3:] for r in lines] == ["r0a", "r0b", "r1a", "r1b"]


def test_group_name_counts_all_known_handles(spark):
    from threadsmith.config import ASCII
    users = spark.createDataFrame([(str(i), h) for i, h in enumerate(["amy", "bob", "cat"])], "user_id string, handle string")
    counts = spark.createDataFrame([("g", str(i), 3 - i) for i in range(3)],
                                   "conversation_id string, participant_id string, n_messages long")
    names = spark.createDataFrame([("g", "g")], "conversation_id string, official_name string")
    got = transcripts.group_names(names, counts, users, "me", ASCII).first()
    assert got.group_name == "amy_and_bob_and_1_more"


def test_marked_threads_of_captured_pages(spark):
    from threadsmith.operators.threads import extract_marked_threads
    item = '<article role="x"><b>name</b><div data-testid="tweetText" lang="en">{}</div>{}</article>'
    mark = '<a data-testid="bookmark"></a>'
    pages = [(1, item.format("first &amp; <i>best</i>", "") + item.format("", "") + item.format("the target", mark) + item.format("later", mark)),
             (2, item.format("no target", "")), (3, ""), (4, item.format("alone", mark))]
    df = spark.createDataFrame(pages, "id int, html string")
    got = {r.id: (r.target_pos, r.target_text, r.context) for r in extract_marked_threads(df, "id", "html").collect()}
    assert got == {1: (3, "the target", ["first & best", ""]), 2: (None, None, []), 3: (None, None, []), 4: (1, "alone", [])}


def test_marked_threads_with_nested_markup(spark):
    """First body and all its text, quoted items in order, stray and missing closings, raw text and comments."""
    from threadsmith.operators.threads import extract_marked_threads
    body, mark = '<div data-testid="tweetText">', '<i data-testid="bookmark"/>'
    quoted = f"<article>{body}quoted<div>!</div></div>{{}}</article>"
    pages = [
        (1, f"<article>{body}first <div>inner</div> tail</div></article><article>{body}t</div>{mark}</article>"),
        (2, f"<article>{body}outer</div>{quoted.format('')}</article><article>{mark}{body}t</div></article>"),
        (3, f"<article>{body}a</div></article><article>{body}outer</div>{quoted.format(mark)}</article>"),
        (4, f"</div></article><p>x</article><article>{body}a</div></article><article>{mark}</article>"),
        (5, f"<article>{body}open <b>body</article>rest<article>{body}t</div>{mark}</article>"),
        (6, f"<script>'<article>'</script><!-- <article> > --><article><div>no body</div></article><ARTICLE>{body}t</div>{mark}</ARTICLE>"),
        (7, f"<article><div/>{body}1 < 2 &amp; 3</div>{body}second</div></article><article>{body}t</div>{mark}"),
        (8, None), (9, "text only"), (10, f"<article>{body}t</div></article>"), (None, f"<article>{body}t</div>{mark}</article>")]
    df = spark.createDataFrame(pages + pages[:1], "id int, html string").repartition(3)
    got = {r.id: (r.target_pos, r.target_text, r.context) for r in extract_marked_threads(df, "id", "html").collect()}
    assert got == {1: (2, "t", ["first inner tail"]), 2: (3, "t", ["outer", "quoted!"]), 3: (2, "outer", ["a"]), 4: (2, None, ["a"]),
                   5: (2, "t", ["open body"]), 6: (2, "t", []), 7: (2, "t", ["1 < 2 & 3"]), 8: (None, None, []),
                   9: (None, None, []), 10: (None, None, []), None: (1, "t", [])}


def test_normalise_branches(spark, arch):
    n = {r.id + ("" if r.file_ord == 1 else "#%d" % r.file_ord): r for r in normalised_posts(spark, os.path.join(arch, "data")).collect()}
    assert "11" not in n and "12" not in n                      # no created_at / epoch 0
    assert n["1"].ts == 1553004317 and n["1"].is_reply is False
    assert n["2"].body == "thanks for the tip" and n["2"].is_reply
    assert n["2"].html == ('Replying to <a href="https://twitter.com/bob/status/111">@bob and @carol</a><br>'
                           '<p><blockquote>thanks for the tip</blockquote>'
                           '<a href="https://twitter.com/me_owner/status/2"><img src="../../media/tweet.ico" width="12" />&nbsp;'
                           'Tue Mar 19 14:05:17 +0000 2019</a></p>')
    foot = lambda i: (f'</blockquote><a href="https://twitter.com/me_owner/status/{i}"><img src="../../media/tweet.ico" width="12" />&nbsp;'  # noqa: E731
                      'Tue Mar 19 14:05:17 +0000 2019</a></p>')
    video = '<video controls><source src="../../media/{}">Your browser does not support the video tag.</video>'
    assert n["800"].html == '<p><blockquote><img src="../../media/800-AAA.jpg"/>' + foot(800)
    assert n["900"].html == ('<p><blockquote>clip <br>' + video.format("900-vid1.mp4") + "<br>\n" + video.format("900-vid2.mp4") + foot(900))
    assert n["1000"].html == '<p><blockquote>pic <br><a href="https://t.co/m10">https://t.co/m10</a>' + foot(1000)
    assert n["5"].html.startswith('<p><blockquote>look at this <a href="https://twitter.com/someone/status/12345">')
    assert n["3"].body == "following up on my own post" and n["3"].is_reply
    assert n["4"].is_reply                                     # key present with JSON null
    assert n["5"].body == "look at this (link)" and n["5"].is_quote
    assert n["6"].is_retweet
    assert n["7"].body == "see (link) and (link) plus http://cut.org/abc…"
    assert n["800"].body == "(media)"
    assert n["900"].body == "clip \n\n(video)(video)"
    assert n["1000"].body == "pic \n\n(media)"


def test_media_manifest_of_an_archive(spark, arch):
    from threadsmith.plans.archive_corpus import media_manifest
    data = os.path.join(arch, "data")
    got = {(r.post_id, r.kind, r.media_file, r.source) for r in media_manifest(spark, normalised_posts(spark, data), data).collect()}
    assert got == {("800", "photo", "800-AAA.jpg", "https://pbs.twimg.com/media/AAA.jpg:orig"), ("900", "video", "900-vid1.mp4", "v2"),
                   ("900", "video", "900-vid2.mp4", "v2")}


def test_group_ids_of_an_archive(spark, arch):
    from threadsmith.operators.identity import group_ids
    from threadsmith.sources.archive import group_events_from_archive
    ids = {r.user_id for r in group_ids(group_events_from_archive(spark, os.path.join(arch, "data"))).collect()}
    assert ids == {"55", "66", "1", "77", "88"}


def test_synthesised_entities_and_reply_header(spark):
    df = spark.createDataFrame([("see http://www.example.com/a/b?x=1&y=long and http://x.org/ok http://cut.org/a…",)], "t string")
    ents = df.select(posts.synth_url_entities(F.col("t")).alias("e")).first().e
    assert [(e.url, e.display_url, list(e.indices)) for e in ents] == [
        ("http://www.example.com/a/b?x=1&y=long", "example.com/a/b?x=1&y=long…", [4, 41]),
        ("http://x.org/ok", "x.org/ok", [46, 61])]
    r = spark.createDataFrame([("@a @b_2 hi",), ("plain",)], "b string").select(
        *[c.alias(k) for k, c in posts.reply_parts(F.col("b"), "me", F.lit("a"), F.lit(False), F.lit("9")).items()
          if k in ("body", "name_list", "url")]).collect()
    assert (r[0].body, r[0].name_list, r[0].url) == ("hi", "@a and @b_2", "https://twitter.com/@a/status/9")
    assert (r[1].body, r[1].name_list) == ("plain", "@me")


def test_route_and_corpus(spark, arch):
    rows, replies, users = corpus_from_archive(spark, os.path.join(arch, "data"), CorpusConfig(delimiters=CJK_DELIMITERS))
    assert sorted(r.id for r in replies.collect()) == ["2", "3", "4"]
    ids = sorted({r.id for r in rows.collect()})
    assert "800" not in ids and "5" not in ids and "6" not in ids
    assert set(ids) <= {"1", "7", "900", "1000"}
    assert {(r.user_id, r.handle) for r in users.collect()} == {("55", "bob")}


def test_best_variant(spark):
    v = spark.createDataFrame([("m", 0, None, "v0"), ("m", 1, "0", "v1"), ("m", 2, "832000", "v2"),
                               ("m", 3, "832000", "v3"), ("n", 0, None, "w0")],
                              "k string, pos int, bitrate string, url string")
    got = {r.k: (r.best_url, r.best_bitrate) for r in media.best_variants(v, ["k"]).collect()}
    assert got == {"m": ("v2", 832000)}


def test_identity_sets(spark, arch):
    data = os.path.join(arch, "data")
    fo = archive.read_following(spark, data)
    fr = archive.read_followers(spark, data)
    assert sorted(r.user_id for r in fo.collect()) == ["55", "55", "77"]
    dms = identity.dm_ids(archive.read_dms(spark, data).select(F.col("dmConversation.conversationId").alias("conversation_id")))
    without, only, everyone = identity.universe(fo, fr, dms)
    assert sorted(r.user_id for r in only.collect()) == ["88"]
    assert sorted(r.user_id for r in everyone.collect()) == ["1", "2", "55", "77", "88"]


def test_dm_and_group_from_archive(spark, arch):
    data = os.path.join(arch, "data")
    users = spark.createDataFrame([("1", "me_owner"), ("2", "alice"), ("55", "bob")], "user_id string, handle string")
    from threadsmith.config import ASCII
    msgs = transcripts.dm_messages_from_archive(archive.read_dms(spark, data))
    assert msgs.count() == 2                       # the message without text is dropped
    lines = transcripts.other_party(transcripts.dm_lines(msgs, users, ASCII), users, "me_owner", ASCII)
    got = sorted((r.other_user_id, r.ts, r.line) for r in lines.collect())
    assert got[0][0] == "2" and got[0][1] == 1643299133
    assert got[0][2] == "me_owner -> alice: (2022-01-27T15:58:52.744Z) \n\n> hi there https://example.org/x\n> second line"
    ev = transcripts.group_events(archive.group_events_from_archive(spark, data))
    parts = sorted(r.participant_id for r in transcripts.group_participants(ev).collect())
    assert parts == ["1", "55", "66", "77", "88"]
    counts = {r.participant_id: r.n_messages for r in transcripts.message_counts(ev, transcripts.group_participants(ev)).collect()}
    assert counts == {"1": 0, "55": 1, "66": 0, "77": 0, "88": 0}
    names = transcripts.latest_names(ev, ev.select("conversation_id").distinct())
    gn = transcripts.group_names(names, transcripts.message_counts(ev, transcripts.group_participants(ev)), users,
                                 "me_owner", ASCII).first()
    assert (gn.official_name, gn.group_name) == ("Our: Group.", "Our__Group_")
    rendered = {r.kind: r.line for r in transcripts.group_lines(ev, users, "me_owner", ASCII).collect()}
    assert rendered["leave"].endswith("_https://twitter.com/i/user/66 left the group_")
    assert rendered["add"].endswith("_bob added https://twitter.com/i/user/77 and https://twitter.com/i/user/88 to the group_")


def test_group_conversation_split_across_records(spark, tmpdir_fresh):
    """One conversation in two records: every event keeps its own msg_ord and line."""
    from tests.archive_fixture import _js
    data = os.path.join(tmpdir_fresh, "data")
    os.makedirs(data)
    rec = lambda msgs: {"dmConversation": {"conversationId": "g9", "messages": msgs}}
    add = lambda i, who: {"participantsJoin": {"initiatingUserId": "1", "userIds": [who],
                                               "createdAt": f"2022-01-0{i}T00:00:00.000Z"}}
    _js(os.path.join(data, "direct-messages-group.js"), "groups", [rec([add(1, "2"), add(2, "3")]),
                                                                   rec([add(3, "4"), add(4, "5")])])
    ev = archive.group_events_from_archive(spark, data)
    assert ev.select("msg_ord").distinct().count() == 4
    users = spark.createDataFrame([("1", "me")], "user_id string, handle string")
    from threadsmith.config import ASCII
    lines = transcripts.group_lines(transcripts.group_events(ev), users, "me", ASCII)
    got = sorted(r.line for r in lines.collect())
    assert len(got) == 4
    assert [g.split(" added ")[1].split(" to")[0] for g in got] == [
        f"https://twitter.com/i/user/{i}" for i in (2, 3, 4, 5)]
