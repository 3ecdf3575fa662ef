"""Direct-message and group transcripts.

Plan shape: messages are flat rows; handles come from a lookup join;
conversations are numbered with the skew-safe ordered index and cut into parts of
``part_size`` messages, so the string aggregation of a part never exceeds ``part_size``
messages even for a conversation holding a third of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadsmith.config import IMAGE_MARKUP, TRANSCRIPT_SEPARATOR, USER_URL_PREFIX, VIDEO_MARKUP, CorpusConfig
from threadsmith.functions.text import english_list, escape_markdown, filename_safe, quote_body
from threadsmith.functions.timefmt import dm_epoch
from threadsmith.operators.ordering import DAY, part_numbers

# The sentences and headers that transcripts are rendered with below are fixed values.
MESSAGE = "message"
RENAME = "rename"
SELF_JOIN = "join"
ADD = "add"
LEAVE = "leave"


def user_url(uid: Column) -> Column:
    return F.concat(F.lit(USER_URL_PREFIX), uid)


def expand_urls(body: Column, urls: Column) -> Column:
    """Replace every short url by its expansion, in entity order; entities lacking either are skipped."""
    whole = F.filter(F.coalesce(urls, F.array().cast("array<struct<url:string,expanded:string>>")),
                     lambda u: u["url"].isNotNull() & u["expanded"].isNotNull())
    return F.aggregate(whole, body,
                       lambda acc, u: F.replace(acc, u["url"], u["expanded"]))


def with_handles(df: DataFrame, users: DataFrame, pairs: list[tuple[str, str]], cfg: CorpusConfig) -> DataFrame:
    """J1 for several id columns: ``out = handle`` or the profile-url template."""
    u = users.select("user_id", "handle")
    for id_col, out_col in pairs:
        uu = u.select(F.col("user_id").alias("__lk_u"), F.col("handle").alias("__lk_h"))
        df = (df.join(uu, df[id_col] == F.col("__lk_u"), "left")
              .withColumn(out_col, escape_markdown(F.coalesce(F.col("__lk_h"), user_url(F.col(id_col)))))
              .drop("__lk_u", "__lk_h"))
    return df


def dm_messages_from_archive(convs: DataFrame) -> DataFrame:
    """``dmConversation`` records -> one row per message carrying every required
    field (senderId, recipientId, text, createdAt).  ``msg_ord`` packs file, record and
    position, so that a conversation split over records keeps its order at equal times."""
    record = F.lit(0).cast("bigint")
    if {"file_ord", "row_ord"} <= set(convs.columns):
        record = F.shiftleft(F.col("file_ord").cast("bigint"), 55) + F.shiftleft(F.col("row_ord").cast("bigint"), 28)
    m = convs.select(F.col("dmConversation.conversationId").alias("conversation_id"), record.alias("__rec"),
                     F.posexplode("dmConversation.messages").alias("__pos", "m"))
    m = m.withColumn("msg_ord", F.col("__rec") + F.col("__pos"))
    mc = F.col("m.messageCreate")
    return m.filter(mc.isNotNull()).select(
        "conversation_id", "msg_ord",
        mc["senderId"].alias("sender_id"), mc["recipientId"].alias("recipient_id"),
        mc["text"].alias("text"), mc["createdAt"].alias("created_at"), mc["urls"].alias("urls"),
        mc["id"].alias("message_id"), mc["mediaUrls"].alias("media_urls"),
    ).filter(F.col("sender_id").isNotNull() & F.col("recipient_id").isNotNull()
             & F.col("text").isNotNull() & F.col("created_at").isNotNull())


def with_message_media(msgs: DataFrame, listing: DataFrame, media_dir: str) -> DataFrame:
    """``media_markup`` of messages with exactly one media url and a url to replace: the image named
    ``<message id>-<name>`` if the listing (``file``) has it, else the first file of the message as a video, else
    null (the link stays).  One equi-join on the file name, one on the message id."""
    single = (F.size("media_urls") == 1) & (F.size("urls") > 0)
    name = F.concat(F.col("message_id"), F.lit("-"), F.element_at(F.split(F.get("media_urls", F.lit(0)), "/"), -1))
    x = msgs.withColumn("__name", F.when(single, name)).withColumn("__mid", F.when(single, F.col("message_id")))
    exact = listing.select(F.col("file").alias("__exact")).distinct()
    others = listing.groupBy(F.substring_index("file", "-", 1).alias("__of")).agg(F.min("file").alias("__first"))
    x = x.join(exact, F.col("__name") == F.col("__exact"), "left").join(others, F.col("__mid") == F.col("__of"), "left")

    def markup(parts: tuple, file: Column) -> Column:
        return F.concat(F.lit(f"{parts[0]}{media_dir.rstrip('/')}/"), file, F.lit(parts[1]))
    return x.withColumn("media_markup", F.when(F.col("__exact").isNotNull(), markup(IMAGE_MARKUP, F.col("__exact"))).when(
        F.col("__first").isNotNull(), markup(VIDEO_MARKUP, F.col("__first")))).drop(
        "__name", "__mid", "__exact", "__of", "__first")


def message_body(df: DataFrame) -> Column:
    """P8 and D2 on a message's text, as far as the columns ``urls`` and ``media_markup`` are there."""
    body = F.col("text")
    if "urls" in df.columns:
        body = expand_urls(body, F.col("urls"))
        if "media_markup" in df.columns:
            expanded = F.get("urls", F.lit(0))["expanded"]
            body = F.coalesce(F.replace(body, expanded, F.col("media_markup")), body)
    return body


def dm_lines(msgs: DataFrame, users: DataFrame, cfg: CorpusConfig) -> DataFrame:
    """D3: ``from -> to: (created_at) \\n\\n> body`` plus the epoch used for ordering."""
    body = message_body(msgs)
    x = with_handles(msgs, users, [("sender_id", "__from"), ("recipient_id", "__to")], cfg)
    line = F.concat(F.col("__from"), F.lit(" -> "), F.col("__to"), F.lit(": ("), F.col("created_at"),
                    F.lit(") \n\n"), quote_body(body))
    return x.withColumn("line", line).withColumn("ts", dm_epoch(F.col("created_at"))).drop("__from", "__to")


def other_party(lines: DataFrame, users: DataFrame, owner: str, cfg: CorpusConfig) -> DataFrame:
    """The conversation's identifying user: the second id when the first one is the
    owner's, else the first."""
    parts = F.split(F.col("conversation_id"), "-")
    x = lines.withColumn("__u1", F.get(parts, 0)).withColumn("__u2", F.get(parts, 1))
    u = users.select(F.col("user_id").alias("__u1"), F.col("handle").alias("__h1"))
    x = x.join(u, "__u1", "left")
    other = F.when(F.col("__h1") == F.lit(owner), F.col("__u2")).otherwise(F.col("__u1"))
    return x.withColumn("other_user_id", other).drop("__u1", "__u2", "__h1")


def transcripts(lines: DataFrame, group_col: str, order_cols: list, header: Column, part_size: int,
                title_cols: list[str] | None = None, titles: DataFrame | None = None,
                counted: DataFrame | None = None) -> DataFrame:
    """A12 + W1: per ``(group, part)`` the header and the lines joined by the separator in
    ``order_cols`` order; ``part`` is NULL for conversations of at most ``part_size``.
    ``header`` may use ``part`` (NULL when unnumbered).  Per-conversation ``titles`` (keyed
    by ``group_col``) are joined after the aggregation, i.e. to one row per part, so a hot
    conversation's messages never meet a join on the conversation id.  ``counted`` may hold
    the lines' groups and times before they are rendered."""
    numbered = part_numbers(lines, [group_col], order_cols, part_size, idx_col="__idx", part_col="part", stride=DAY, counted=counted)
    keep = [c for c in (title_cols or []) if c in numbered.columns]
    agg = numbered.groupBy(group_col, "part").agg(
        F.count(F.lit(1)).alias("n_messages"),
        F.array_sort(F.collect_list(F.struct(F.col("__idx"), F.col("line")))).alias("__lines"),
        *[F.any_value(c).alias(c) for c in keep])
    if titles is not None:
        agg = agg.join(titles, group_col, "left")
    body = F.array_join(F.transform("__lines", lambda s: s["line"]), TRANSCRIPT_SEPARATOR)
    return agg.withColumn("transcript", F.concat(header, body)).drop("__lines")


def totals(parts: DataFrame, group_col: str, kind: str) -> DataFrame:
    """Conversations, files (parts) and messages of a kind of transcripts; one partial aggregation."""
    per = parts.groupBy(group_col).agg(F.count(F.lit(1)).alias("__files"), F.sum("n_messages").alias("__messages"))
    return per.agg(F.count(F.lit(1)).alias("n_conversations"), F.coalesce(F.sum("__files"), F.lit(0)).alias("n_files"),
                   F.coalesce(F.sum("__messages"), F.lit(0)).alias("n_messages")).withColumn("kind", F.lit(kind))


def dm_header(owner: str, other_name: Column) -> Column:
    part_txt = F.when(F.col("part").isNotNull(), F.concat(F.lit(", part "), F.col("part").cast("string"))).otherwise("")
    return F.concat(F.lit(f"### Conversation between {owner} and "), other_name, part_txt,
                    F.lit(": ###" + TRANSCRIPT_SEPARATOR))


# ------------------------------------------------------------------ groups
def group_events(events: DataFrame) -> DataFrame:
    """G1: required-field filters per event kind.  Input columns: conversation_id,
    msg_ord, kind, actor_id, text, name, user_ids (array<string>), created_at."""
    k = F.col("kind")
    ok = (F.col("created_at").isNotNull() & (
        ((k == MESSAGE) & F.col("actor_id").isNotNull() & F.col("text").isNotNull())
        | ((k == RENAME) & F.col("actor_id").isNotNull() & F.col("name").isNotNull())
        | ((k == SELF_JOIN) & F.col("actor_id").isNotNull())
        | ((k == ADD) & F.col("actor_id").isNotNull() & F.col("user_ids").isNotNull())
        | ((k == LEAVE) & F.col("user_ids").isNotNull())))
    return events.filter(ok).withColumn("ts", dm_epoch(F.col("created_at")))


def group_participants(events: DataFrame) -> DataFrame:
    """A5: senders, join initiators and snapshots, adders and added ids (not leavers)."""
    k = F.col("kind")
    ids = F.when(k == MESSAGE, F.array("actor_id")).when(
        k.isin(SELF_JOIN, ADD), F.concat(F.array("actor_id"), F.coalesce("user_ids", F.array().cast("array<string>"))))
    return (events.select("conversation_id", F.explode(ids).alias("participant_id"))
            .filter(F.col("participant_id").isNotNull()).distinct())


def message_counts(events: DataFrame, participants: DataFrame) -> DataFrame:
    """A4: messages per participant, zero for silent ones (pre-aggregated before the join)."""
    sent = (events.filter(F.col("kind") == MESSAGE)
            .groupBy("conversation_id", F.col("actor_id").alias("participant_id"))
            .agg(F.count(F.lit(1)).alias("n_messages")))
    return (participants.join(sent, ["conversation_id", "participant_id"], "left")
            .withColumn("n_messages", F.coalesce("n_messages", F.lit(0)).cast("bigint")))


def participant_message_counts(events: DataFrame) -> DataFrame:
    """A4 + A5 in one aggregation: every participant (as in ``group_participants``) with
    its message count.  Each event emits ``(participant, is_message)`` rows; one partial
    aggregation on ``(conversation, participant)`` gives the set and the counts (every
    sender is a participant), instead of two scans and a join."""
    k = F.col("kind")
    one = lambda pid, m: F.struct(pid.alias("participant_id"), F.lit(m).alias("__m"))
    rows = (F.when(k == MESSAGE, F.array(one(F.col("actor_id"), 1)))
            .when(k.isin(SELF_JOIN, ADD),
                  F.concat(F.array(one(F.col("actor_id"), 0)),
                           F.transform(F.coalesce("user_ids", F.array().cast("array<string>")), lambda u: one(u, 0)))))
    x = events.select("conversation_id", F.inline(rows)).filter(F.col("participant_id").isNotNull())
    return x.groupBy("conversation_id", "participant_id").agg(F.sum("__m").cast("bigint").alias("n_messages"))


def latest_names(events: DataFrame, conversations: DataFrame) -> DataFrame:
    """Latest official name, seeded with ``(0, conversation_id)``; on equal times the
    earlier entry wins.  ``max_by`` combines partially before the shuffle."""
    seed = conversations.select("conversation_id", F.col("conversation_id").alias("name"),
                                F.lit(0).cast("bigint").alias("ts"), F.lit(-1).cast("bigint").alias("msg_ord"))
    upd = events.filter(F.col("kind") == RENAME).select("conversation_id", "name", "ts",
                                                        F.col("msg_ord").cast("bigint"))
    allv = seed.unionByName(upd)
    return allv.groupBy("conversation_id").agg(
        F.max_by("name", F.struct(F.col("ts"), F.negative(F.col("msg_ord")))).alias("official_name"))


def latest_names_from_events(events: DataFrame) -> DataFrame:
    """A6 in one aggregation over all events: the latest rename wins if it sorts after the
    seed ``(ts 0, msg_ord -1)``, else the conversation id (equal times: earlier wins)."""
    ren = F.col("kind") == RENAME
    key = F.when(ren, F.struct(F.col("ts").cast("bigint").alias("t"),
                               F.negative(F.col("msg_ord").cast("bigint")).alias("o")))
    agg = events.groupBy("conversation_id").agg(F.max_by(F.when(ren, F.col("name")), key).alias("__n"),
                                                 F.max(key).alias("__k"))
    seed = F.struct(F.lit(0).cast("bigint").alias("t"), F.lit(1).cast("bigint").alias("o"))
    wins = F.col("__k").isNotNull() & (F.col("__k") > seed)
    return agg.select("conversation_id",
                      F.when(wins, F.col("__n")).otherwise(F.col("conversation_id")).alias("official_name"))


def group_names(names: DataFrame, counts: DataFrame, users: DataFrame, owner: str, cfg: CorpusConfig) -> DataFrame:
    """File-safe official name; too short -> id; when it is the id, derive one from the
    two most active known handles other than the owner's (count desc, handle asc)."""
    u = users.select(F.col("user_id").alias("participant_id"), "handle")
    c = counts.join(u, "participant_id", "left")
    is_known = F.col("handle").isNotNull() & (F.col("handle") != owner)
    n_part = c.groupBy("conversation_id").agg(F.count(F.lit(1)).alias("n_participants"),
                                              F.count_if(is_known).alias("__known"))
    # top-2 known handles (count desc, handle asc): a ranked window with a limit, which
    # Spark plans as a group limit applied before the shuffle (no full group is collected)
    known = c.filter(is_known)
    rank = F.row_number().over(Window.partitionBy("conversation_id").orderBy(F.desc("n_messages"), F.asc("handle")))
    top = known.withColumn("__r", rank).filter(F.col("__r") <= 2).groupBy("conversation_id").agg(
        F.array_sort(F.collect_list(F.struct(F.col("__r"), F.col("handle")))).alias("__hs"))
    per = n_part.join(top, "conversation_id", "left")
    x = names.join(per, "conversation_id", "left").withColumn("n_participants", F.coalesce("n_participants", F.lit(0)))
    safe = filename_safe(F.col("official_name"))
    base = F.when(F.length(safe) < 2, F.col("conversation_id")).otherwise(safe)
    hs = F.transform(F.coalesce("__hs", F.array()), lambda s: s["handle"])
    nh, n = F.coalesce("__known", F.lit(0)), F.col("n_participants")
    derived = (F.when(nh == 1, F.concat(F.get(hs, 0), F.lit("_and_"), (n - 1).cast("string"), F.lit("_more")))
               .when((nh == 2) & (n == 3), F.concat(F.get(hs, 0), F.lit("_and_"), F.get(hs, 1), F.lit("_and_" + owner)))
               .when(nh >= 2, F.concat(F.get(hs, 0), F.lit("_and_"), F.get(hs, 1), F.lit("_and_"),
                                       (n - 2).cast("string"), F.lit("_more")))
               .otherwise(F.col("conversation_id")))
    name = F.when(base == F.col("conversation_id"), derived).otherwise(base)
    return x.select("conversation_id", "official_name", name.alias("group_name"), "n_participants")


def handle_lists(events: DataFrame, users: DataFrame, cfg: CorpusConfig, carry: list[str] | None = None) -> DataFrame:
    """``user_ids`` -> ``'a, b and c'`` of handles (url template when unknown), order
    kept; one explode + lookup + ordered re-aggregation per event.  ``carry`` columns ride
    along on the first element only, so the re-aggregation returns the whole event."""
    carry = carry or []
    x = events.select("conversation_id", "msg_ord", *carry, F.posexplode_outer("user_ids").alias("__p", "__id"))
    first = F.coalesce(F.col("__p"), F.lit(0)) == 0
    x = x.select("conversation_id", "msg_ord", "__p", "__id", *[F.when(first, F.col(c)).alias(c) for c in carry])
    x = with_handles(x, users, [("__id", "__h")], cfg)
    return x.groupBy("conversation_id", "msg_ord").agg(
        english_list(F.transform(F.array_sort(F.collect_list(F.struct("__p", "__h"))), lambda s: s["__h"]))
        .alias("names"),
        *[F.any_value(c, ignoreNulls=True).alias(c) for c in carry])


def group_lines(events: DataFrame, users: DataFrame, owner: str, cfg: CorpusConfig) -> DataFrame:
    """Render each event.  Only add/leave events need a handle list; they are
    re-aggregated with their own fields, the other kinds are rendered in place (no join
    of every event with the lists)."""
    x = with_handles(events, users, [("actor_id", "__from")], cfg)
    listed = F.col("kind").isin(ADD, LEAVE)
    plain = x.filter(~listed).withColumn("names", F.lit(None).cast("string"))
    carry = [c for c in x.columns if c not in ("conversation_id", "msg_ord")]
    lists = handle_lists(x.filter(listed), users, cfg, carry=carry)
    x = plain.unionByName(lists.select(*plain.columns))
    k, frm, when = F.col("kind"), F.col("__from"), F.concat(F.lit(": ("), F.col("created_at"), F.lit(")\n\n"))
    line = (F.when(k == MESSAGE, F.concat(frm, when, quote_body(message_body(x))))
            .when(k == RENAME, F.concat(frm, when, F.lit("_changed group name to: "), escape_markdown(F.col("name")),
                                        F.lit("_")))
            .when(k == SELF_JOIN, F.concat(frm, when, F.lit("_"), frm, F.lit(f" added {owner} to the group_")))
            .when(k == ADD, F.concat(frm, when, F.lit("_"), frm, F.lit(" added "), F.col("names"),
                                     F.lit(" to the group_")))
            .when(k == LEAVE, F.concat(F.col("names"), when, F.lit("_"), F.col("names"), F.lit(" left the group_"))))
    return x.withColumn("line", line).drop("__from", "names")


def group_header(official_name: Column, participant_names: Column) -> Column:
    part_txt = F.when(F.col("part").isNotNull(), F.concat(F.lit(", part "), F.col("part").cast("string"))).otherwise("")
    return F.concat(F.lit("## "), official_name, F.lit(" ##\n\n### Group conversation between "), participant_names,
                    part_txt, F.lit(": ###" + TRANSCRIPT_SEPARATOR))
