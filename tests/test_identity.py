"""The one-aggregation membership table equals the chained set algebra."""

import random

from threadsmith.operators import identity


def test_membership_equals_set_algebra(spark):
    rnd = random.Random(7)

    def ids(n, hi):
        return spark.createDataFrame([(str(rnd.randrange(hi)),) for _ in range(n)], "user_id string")

    # duplicates on purpose, and one hot id repeated many times
    fo = ids(200, 300).unionByName(spark.createDataFrame([("5",)] * 500, "user_id string"))
    fr, dm, us = ids(300, 400), ids(100, 500).distinct(), ids(150, 500).distinct()
    without, only, everyone = identity.universe(fo, fr, dm)
    unk = identity.unknown(everyone, us)
    m = identity.membership(fo, fr, dm, us)

    def s(df):
        return {r.user_id for r in df.collect()}

    assert s(m.filter("in_all")) == s(everyone)
    assert s(m.filter("only_follower")) == s(only)
    assert s(m.filter("in_all AND NOT only_follower")) == s(without)
    assert s(m.filter("unknown")) == s(unk)
    assert s(m.filter("unknown_follower")) == s(unk.join(only, "user_id", "left_semi"))
    assert m.filter("user_id = '5'").first().n_following >= 500


def test_participant_counts_equal_participants_join_counts(spark):
    """A4+A5 in one aggregation equals participants LEFT JOIN message counts."""
    from tests.conftest import SF001
    from threadsmith.operators import transcripts as TR
    from threadsmith.plans import transcript_plans as T
    ev, parts = T.group_parts(spark, SF001)
    a = sorted(tuple(r) for r in TR.participant_message_counts(ev).collect())
    b = sorted(tuple(r) for r in TR.message_counts(ev, parts).select("conversation_id", "participant_id",
                                                                     "n_messages").collect())
    assert a == b and len(a) > 0


def test_latest_names_one_aggregation_matches_seeded_union(spark):
    """Edge cases: a rename at ts 0 loses to the seed, equal times keep the earlier event,
    a conversation without renames keeps its id."""
    from threadsmith.operators import transcripts as TR
    rows = [("a", 1, "rename", "A-first", 0), ("b", 1, "rename", "B1", 5), ("b", 2, "rename", "B2", 5),
            ("b", 3, "message", None, 9), ("c", 1, "message", None, 3), ("d", 4, "rename", "D4", 7),
            ("d", 2, "rename", "D2", 8)]
    ev = spark.createDataFrame(rows, "conversation_id string, msg_ord long, kind string, name string, ts long")
    a = sorted(tuple(r) for r in TR.latest_names_from_events(ev).collect())
    b = sorted(tuple(r) for r in TR.latest_names(ev, ev.select("conversation_id").distinct()).collect())
    assert a == b == [("a", "a"), ("b", "B1"), ("c", "c"), ("d", "D2")]


def test_looked_up_handles_overwrite(spark):
    users = spark.createDataFrame([("1", "old"), ("2", "two")], "user_id string, handle string")
    found = spark.createDataFrame([("1", "new"), ("3", "three"), ("4", None)], "user_id string, handle string")
    got = {r.user_id: r.handle for r in identity.merge_users(users, found).collect()}
    assert got == {"1": "new", "2": "two", "3": "three"}
