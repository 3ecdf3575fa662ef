"""A tiny synthetic archive covering the branch cases (never real data)."""

import json
import os


def _js(path, var, elements, first_has_brace=False):
    body = json.dumps(elements, indent=2, ensure_ascii=False)
    assert body.startswith("[")
    if first_has_brace and elements:
        # "window... = [ {" on the first line, the rest of the first object below it
        inner = body[1:].lstrip()
        assert inner.startswith("{")
        text = f"window.YTD.{var}.part0 = [ {{\n" + inner[1:]
    else:
        text = f"window.YTD.{var}.part0 = " + body
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def post(pid, text, created="Tue Mar 19 14:05:17 +0000 2019", **extra):
    p = {"id_str": pid, "full_text": text, "entities": {"urls": [], "user_mentions": []}}
    if created is not None:
        p["created_at"] = created
    p.update(extra)
    return p


def build(root):
    data = os.path.join(root, "data")
    os.makedirs(os.path.join(data, "tweets_media"))
    for name in ("800-AAA.jpg", "900-vid1.mp4", "900-vid2.mp4"):
        with open(os.path.join(data, "tweets_media", name), "wb") as f:
            f.write(b"x" * 10)
    _js(os.path.join(data, "account.js"), "account", [{"account": {"username": "me_owner"}}], first_has_brace=True)
    posts = [
        {"tweet": post("1", "Hello world, this is a fine day. Another sentence here!")},
        post("2", "@bob @carol thanks for the tip", in_reply_to_status_id="111", in_reply_to_status_id_str="111",
             in_reply_to_user_id="55", in_reply_to_screen_name="bob",
             entities={"urls": [], "user_mentions": [{"id": "55", "screen_name": "bob"},
                                                     {"id": "-1", "screen_name": "x"},
                                                     {"id": "66", "screen_name": None}]}),
        post("3", "following up on my own post", in_reply_to_status_id="1", in_reply_to_status_id_str="1"),
        post("4", "reply key present but null", in_reply_to_status_id=None, in_reply_to_status_id_str=None),
        post("5", "look at this https://t.co/q",
             entities={"urls": [{"url": "https://t.co/q", "expanded_url": "https://twitter.com/someone/status/12345",
                                 "display_url": "twitter.com/someone", "indices": [13, 27]}], "user_mentions": []}),
        post("6", "RT @someone: original words"),
        post("7", "see http://www.example.com/a/b?x=1&y=long_query_value and http://x.org/ok plus http://cut.org/abc…"),
        post("800", "https://t.co/m8",
             entities={"urls": [], "media": [{"url": "https://t.co/m8"}], "user_mentions": []},
             extended_entities={"media": [{"url": "https://t.co/m8", "media_url": "http://pbs.twimg.com/media/AAA.jpg"}]}),
        post("900", "clip https://t.co/m9",
             entities={"urls": [], "media": [{"url": "https://t.co/m9"}], "user_mentions": []},
             extended_entities={"media": [{"url": "https://t.co/m9",
                                           "media_url": "http://pbs.twimg.com/ext_tw_video_thumb/BBB.jpg",
                                           "video_info": {"variants": [{"url": "v0"}, {"bitrate": "0", "url": "v1"},
                                                                       {"bitrate": "832000", "url": "v2"},
                                                                       {"bitrate": "832000", "url": "v3"}]}}]}),
        post("1000", "pic https://t.co/m10",
             entities={"urls": [], "media": [{"url": "https://t.co/m10"}], "user_mentions": []},
             extended_entities={"media": [{"url": "https://t.co/m10", "media_url": "http://pbs.twimg.com/media/CCC.jpg"}]}),
        post("11", "no creation time", created=None),
        post("12", "epoch zero", created="Thu Jan 01 00:00:00 +0000 1970"),
    ]
    _js(os.path.join(data, "tweets.js"), "tweets", posts)
    _js(os.path.join(data, "tweets-part1.js"), "tweets", [post("1", "Hello world, this is a fine day. Again!")])
    with open(os.path.join(data, "tweet.js"), "w") as f:
        f.write("window.YTD.tweet.part0 = []")
    _js(os.path.join(data, "following.js"), "following",
        [{"following": {"accountId": "55"}}, {"following": {"accountId": "77"}}, {"following": {}},
         {"following": {"accountId": "55"}}])
    _js(os.path.join(data, "follower.js"), "follower", [{"follower": {"accountId": "88"}}, {"follower": {"accountId": "55"}}])
    msgs = [{"messageCreate": {"senderId": "1", "recipientId": "2", "text": "hi there https://t.co/a\nsecond line",
                               "createdAt": "2022-01-27T15:58:52.744Z", "id": "m1",
                               "urls": [{"url": "https://t.co/a", "expanded": "https://example.org/x"}],
                               "mediaUrls": []}},
            {"messageCreate": {"senderId": "2", "recipientId": "1", "createdAt": "2022-01-27T15:59:00.500Z", "id": "m2"}},
            {"messageCreate": {"senderId": "2", "recipientId": "1", "text": "reply", "createdAt": "2022-01-27T16:00:00.500Z",
                               "id": "m3", "urls": [], "mediaUrls": []}}]
    _js(os.path.join(data, "direct-messages.js"), "dms", [{"dmConversation": {"conversationId": "1-2", "messages": msgs}}])
    gmsgs = [
        {"joinConversation": {"initiatingUserId": "55", "participantsSnapshot": ["55", "66", "1"],
                              "createdAt": "2022-01-01T00:00:00.000Z"}},
        {"messageCreate": {"senderId": "55", "text": "hello group", "createdAt": "2022-01-01T00:01:00.000Z", "id": "g1"}},
        {"conversationNameUpdate": {"initiatingUserId": "66", "name": "Our: Group.", "createdAt": "2022-01-01T00:02:00.000Z"}},
        {"participantsJoin": {"initiatingUserId": "55", "userIds": ["77", "88"], "createdAt": "2022-01-01T00:03:00.000Z"}},
        {"participantsLeave": {"userIds": ["66"], "createdAt": "2022-01-01T00:04:00.000Z"}},
    ]
    _js(os.path.join(data, "direct-messages-group.js"), "groups",
        [{"dmConversation": {"conversationId": "g-1", "messages": gmsgs}}])
    return root
