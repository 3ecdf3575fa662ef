"""Transcript queries.

DM binding: every ``conversations`` conversation is a two-party DM between the owner
(user id ``0``, customer 0) and user ``conv_id + 1``; assistant turns are sent by the
owner, user turns by the counterpart, system turns lack a sender and are dropped; the
creation time is derived from ``(conv_id, turn)``.  Group binding: each ``events`` user is
a group conversation ``g<user_id>``; the event type picks the event kind (view =
message, click = rename, signup = self-join, purchase = add, error = leave) and
``props.k`` the acting user."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadsmith.config import ASCII, TRANSCRIPT_SEPARATOR, USER_URL_PREFIX
from threadsmith.functions.text import LINE_BREAK, english_list, escape_markdown
from threadsmith.functions.timefmt import dm_epoch, render_dm_time
from threadsmith.operators import transcripts as TR
from threadsmith.operators.ordering import DAY, part_numbers
from threadsmith.plans import sqlfrag as S
from threadsmith.plans.identity_plans import users
from threadsmith.plans.registry import register, table

CFG = ASCII
OWNER = "Customer#000000000"
EVENT_PART = 25
FMT = "2022-%02d-%02dT%02d:%02d:%02d.%03dZ"


def dm_messages(spark, sf) -> DataFrame:
    c = table(spark, sf, "conversations")
    cid, turn, role = F.col("conv_id"), F.col("turn"), F.col("role")
    cp = (cid + 1).cast("string")
    created = F.format_string(FMT, 1 + cid % 12, 1 + cid % 28, cid % 24, turn % 60, (cid * 7 + turn) % 60,
                              (cid * 37 + turn * 11) % 1000)
    m = c.select(F.when(cid % 2 == 0, F.concat(F.lit("0-"), cp)).otherwise(F.concat(cp, F.lit("-0")))
                 .alias("conversation_id"),
                 turn.alias("msg_ord"),
                 F.when(role == "assistant", F.lit("0")).when(role == "user", cp).alias("sender_id"),
                 F.when(role == "assistant", cp).when(role == "user", F.lit("0")).alias("recipient_id"),
                 F.col("text"), created.alias("created_at"))
    return m.filter(F.col("sender_id").isNotNull() & F.col("recipient_id").isNotNull()
                    & F.col("text").isNotNull() & F.col("created_at").isNotNull())


def dm_transcripts(spark, sf) -> DataFrame:
    u = users(spark, sf)
    lines = TR.dm_lines(dm_messages(spark, sf), u, CFG)
    lines = TR.other_party(lines, u, OWNER, CFG)
    # the other party's name is looked up once per part, after the aggregation
    titles = u.select(F.col("user_id").alias("other_user_id"), F.col("handle").alias("__other_handle"))
    other_name = escape_markdown(F.coalesce(F.col("__other_handle"), TR.user_url(F.col("other_user_id"))))
    t = TR.transcripts(lines.select("other_user_id", "ts", "conversation_id", "msg_ord", "line"), "other_user_id",
                       ["ts", "conversation_id", "msg_ord"], TR.dm_header(OWNER, other_name), CFG.part_size,
                       titles=titles)
    return t.select("other_user_id", "part", F.col("n_messages").cast("bigint"), "transcript")


def group_raw(spark, sf) -> DataFrame:
    e = table(spark, sf, "events")
    k = F.get_json_object("props", "$.k")
    ki = k.cast("int")
    et = F.col("event_type")
    kind = (F.when(et == "view", TR.MESSAGE).when(et == "click", TR.RENAME).when(et == "signup", TR.SELF_JOIN)
            .when(et == "purchase", TR.ADD).when(et == "error", TR.LEAVE))
    s = lambda c: c.cast("string")
    return e.select(
        F.concat(F.lit("g"), s(F.col("user_id"))).alias("conversation_id"),
        F.col("event_id").alias("msg_ord"), kind.alias("kind"),
        F.when(et != "error", k).alias("actor_id"),
        F.when(et == "view", F.concat(F.lit("note "), s(F.col("event_id")))).alias("text"),
        F.when(et == "click", F.when(ki < 3, F.lit("x")).otherwise(
            F.concat(F.lit("Room: "), k, F.lit("."), s(F.col("event_id") % 5)))).alias("name"),
        F.when(et == "signup", F.array(k, s(ki + 1))).when(et == "purchase", F.array(s(ki + 1), s(ki + 2)))
        .when(et == "error", F.array(k)).alias("user_ids"),
        render_dm_time(F.col("ts")).alias("created_at"))


def group_parts(spark, sf):
    """Rendered events pass the required-field filters; participants come from all events."""
    raw = group_raw(spark, sf)
    return TR.group_events(raw), TR.group_participants(raw)


# ---------------------------------------------------------------- SQL
LB = S.q(LINE_BREAK)


def quote_sql(x: str) -> str:
    return (f"('> ' || regexp_replace(regexp_replace({x}, {S.q(LINE_BREAK + chr(92) + 'z')}, ''), {LB}, "
            f"chr(10) || '> ', 'g'))")


SEP = S.lit_text(TRANSCRIPT_SEPARATOR)
URL = S.q(USER_URL_PREFIX)
US_SQL = "us AS (SELECT CAST(c_custkey AS VARCHAR) AS user_id, c_name AS handle FROM customer WHERE c_acctbal >= 0)"
EPOCH = "CAST(round_even(epoch_ms(strptime(created_at, '%Y-%m-%dT%H:%M:%S.%gZ')) / 1000.0, 0) AS BIGINT)"
DM_SQL = f"""{US_SQL},
m AS (SELECT turn AS msg_ord,
             CASE WHEN conv_id % 2 = 0 THEN '0-' || CAST(conv_id + 1 AS VARCHAR) ELSE CAST(conv_id + 1 AS VARCHAR) || '-0'
             END AS conversation_id,
             CASE role WHEN 'assistant' THEN '0' WHEN 'user' THEN CAST(conv_id + 1 AS VARCHAR) END AS sender_id,
             CASE role WHEN 'assistant' THEN CAST(conv_id + 1 AS VARCHAR) WHEN 'user' THEN '0' END AS recipient_id,
             text, printf('{FMT}', 1 + conv_id % 12, 1 + conv_id % 28, conv_id % 24, turn % 60, (conv_id * 7 + turn) % 60,
                          (conv_id * 37 + turn * 11) % 1000) AS created_at
      FROM conversations),
ok AS (SELECT * FROM m WHERE sender_id IS NOT NULL AND recipient_id IS NOT NULL AND text IS NOT NULL
                         AND created_at IS NOT NULL),
ln AS (SELECT ok.*, coalesce(a.handle, {URL} || sender_id) || ' -> ' || coalesce(b.handle, {URL} || recipient_id) ||
              ': (' || created_at || ') ' || chr(10) || chr(10) || {quote_sql('text')} AS line, {EPOCH} AS ts
       FROM ok LEFT JOIN us a ON a.user_id = sender_id LEFT JOIN us b ON b.user_id = recipient_id),
op AS (SELECT ln.*, CASE WHEN h1.handle = '{OWNER}' THEN split_part(conversation_id, '-', 2)
                         ELSE split_part(conversation_id, '-', 1) END AS other_user_id
       FROM ln LEFT JOIN us h1 ON h1.user_id = split_part(conversation_id, '-', 1))"""

GROUP_SQL = f"""{US_SQL},
graw AS (SELECT 'g' || CAST(user_id AS VARCHAR) AS conversation_id, event_id AS msg_ord,
                CASE event_type WHEN 'view' THEN 'message' WHEN 'click' THEN 'rename' WHEN 'signup' THEN 'join'
                                WHEN 'purchase' THEN 'add' WHEN 'error' THEN 'leave' END AS kind,
                CASE WHEN event_type <> 'error' THEN json_extract_string(props, '$.k') END AS actor_id,
                CASE WHEN event_type = 'view' THEN 'note ' || CAST(event_id AS VARCHAR) END AS text,
                CASE WHEN event_type = 'click' THEN CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) < 3 THEN 'x'
                     ELSE 'Room: ' || json_extract_string(props, '$.k') || '.' || CAST(event_id % 5 AS VARCHAR) END END
                  AS name,
                CASE event_type
                  WHEN 'signup' THEN [json_extract_string(props, '$.k'),
                                      CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) + 1 AS VARCHAR)]
                  WHEN 'purchase' THEN [CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) + 1 AS VARCHAR),
                                        CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) + 2 AS VARCHAR)]
                  WHEN 'error' THEN [json_extract_string(props, '$.k')] END AS user_ids,
                strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS created_at
         FROM events),
gev AS (SELECT *, {EPOCH} AS ts FROM graw WHERE created_at IS NOT NULL AND (
          (kind = 'message' AND actor_id IS NOT NULL AND text IS NOT NULL)
          OR (kind = 'rename' AND actor_id IS NOT NULL AND name IS NOT NULL)
          OR (kind = 'join' AND actor_id IS NOT NULL)
          OR (kind = 'add' AND actor_id IS NOT NULL AND user_ids IS NOT NULL)
          OR (kind = 'leave' AND user_ids IS NOT NULL))),
gp AS (SELECT DISTINCT conversation_id, participant_id FROM (
         SELECT conversation_id, unnest(CASE WHEN kind = 'message' THEN [actor_id]
                                             WHEN kind IN ('join', 'add') THEN list_concat([actor_id], user_ids) END)
                AS participant_id FROM gev) WHERE participant_id IS NOT NULL),
gc AS (SELECT gp.conversation_id, gp.participant_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_messages
       FROM gp LEFT JOIN (SELECT conversation_id, actor_id AS participant_id, count(*) AS n FROM gev
                          WHERE kind = 'message' GROUP BY ALL) s USING (conversation_id, participant_id)),
gn AS (SELECT conversation_id, arg_max(name, (ts, -msg_ord)) AS official_name FROM (
         SELECT DISTINCT conversation_id, conversation_id AS name, CAST(0 AS BIGINT) AS ts, CAST(-1 AS BIGINT) AS msg_ord
         FROM gev
         UNION ALL SELECT conversation_id, name, ts, msg_ord FROM gev WHERE kind = 'rename') GROUP BY conversation_id)"""
FORBID = "[\"'*/\\\\:<>?|!@;,=." + "\\t\\n\\x0b\\x0c\\r\\x1c-\\x1f \\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}" \
         "\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"
SAFE = f"regexp_replace(regexp_replace(official_name, {S.q(FORBID)}, '_', 'g'), '[\\x00-\\x1f]', '', 'g')"


@register("dm_transcript", oracle=f"""WITH {DM_SQL},
nb AS (SELECT op.*, row_number() OVER (PARTITION BY other_user_id ORDER BY ts, conversation_id, msg_ord) - 1 AS idx,
              count(*) OVER (PARTITION BY other_user_id) AS cnt FROM op),
pt AS (SELECT *, CASE WHEN cnt > {CFG.part_size} THEN CAST(floor(idx / {CFG.part_size}) + 1 AS BIGINT) END AS part FROM nb)
SELECT other_user_id, part, CAST(count(*) AS BIGINT) AS n_messages,
       '### Conversation between {OWNER} and ' || coalesce(any_value(o.handle), {URL} || other_user_id) ||
       coalesce(', part ' || CAST(part AS VARCHAR), '') || ': ###' || {SEP} || string_agg(line, {SEP} ORDER BY idx)
         AS transcript
FROM pt LEFT JOIN us o ON o.user_id = other_user_id GROUP BY other_user_id, part""")
def dm_transcript(spark: SparkSession, sf: str) -> DataFrame:
    return dm_transcripts(spark, sf)


MEDIA_DIR = "media"
DM_MEDIA_SQL = f"""
WITH m AS (SELECT conv_id * 100 + turn AS id FROM conversations),
f AS (SELECT DISTINCT file FROM (
        SELECT id || '-pic' || (id % 2) || '.jpg' AS file FROM m WHERE id % 5 = 0
        UNION ALL SELECT id || '-clip' || c || '.mp4' FROM m, (SELECT unnest(['B', 'A']) AS c) WHERE id % 5 = 1)),
o AS (SELECT split_part(file, '-', 1) AS mid, min(file) AS file FROM f GROUP BY mid),
j AS (SELECT id, id % 3 AS n_media, e.file AS exact, o.file AS other FROM m
      LEFT JOIN f e ON e.file = id || '-pic' || (id % 2) || '.jpg' LEFT JOIN o ON o.mid = CAST(id AS VARCHAR))
SELECT id AS message_id, 'see ' || CASE
         WHEN n_media = 1 AND exact IS NOT NULL THEN {S.lit_text(TR.IMAGE_MARKUP[0])} || '{MEDIA_DIR}/' || exact || {S.lit_text(TR.IMAGE_MARKUP[1])}
         WHEN n_media = 1 AND other IS NOT NULL THEN {S.lit_text(TR.VIDEO_MARKUP[0])} || '{MEDIA_DIR}/' || other || {S.lit_text(TR.VIDEO_MARKUP[1])}
         ELSE 'https://long/' || id END AS body
FROM j"""


@register("dm_media", oracle=DM_MEDIA_SQL)
def dm_media(spark: SparkSession, sf: str) -> DataFrame:
    """One message a turn with 0 to 2 media urls; every fifth message has its image and every fifth two videos."""
    ident = F.col("conv_id") * 100 + F.col("turn")
    m = table(spark, sf, "conversations").select(ident.alias("id"), ident.cast("string").alias("message_id"))
    image = F.concat(F.lit("pic"), (F.col("id") % 2).cast("string"), F.lit(".jpg"))
    short = F.concat(F.lit("https://t.co/"), "message_id")
    msgs = m.select("id", "message_id", F.concat(F.lit("see "), short).alias("text"),
                    F.array(F.struct(short.alias("url"), F.concat(F.lit("https://long/"), "message_id").alias("expanded"))).alias("urls"),
                    F.array_repeat(F.concat(F.lit("https://host/7/"), image), (F.col("id") % 3).cast("int")).alias("media_urls"))
    files = F.when(F.col("id") % 5 == 0, F.array(image)).when(
        F.col("id") % 5 == 1, F.array(F.lit("clipB.mp4"), F.lit("clipA.mp4"))).otherwise(F.array().cast("array<string>"))
    listing = m.select("message_id", F.explode(files).alias("f")).select(F.concat_ws("-", "message_id", "f").alias("file"))
    x = TR.with_message_media(msgs, listing, MEDIA_DIR)
    return x.select(F.col("id").alias("message_id"), TR.message_body(x).alias("body"))


@register("dm_parts", oracle=f"""
WITH nb AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS idx,
                   count(*) OVER (PARTITION BY user_id) AS cnt FROM events),
pt AS (SELECT *, CASE WHEN cnt > {EVENT_PART} THEN CAST(floor(idx / {EVENT_PART}) + 1 AS BIGINT) END AS part FROM nb)
SELECT user_id, part, CAST(any_value(cnt) AS BIGINT) AS group_size, CAST(count(*) AS BIGINT) AS n_messages,
       arg_min(event_id, idx) AS first_event_id, arg_max(event_id, idx) AS last_event_id
FROM pt GROUP BY user_id, part""")
def dm_parts(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select("user_id", "event_id", "ts")
    p = part_numbers(e, ["user_id"], ["ts", "event_id"], EVENT_PART)
    return p.groupBy("user_id", "part").agg(
        F.any_value("group_size").cast("bigint").alias("group_size"),
        F.count(F.lit(1)).cast("bigint").alias("n_messages"),
        F.min_by("event_id", "msg_idx").alias("first_event_id"),
        F.max_by("event_id", "msg_idx").alias("last_event_id"))


@register("group_participants", oracle=f"WITH {GROUP_SQL} SELECT conversation_id, participant_id FROM gp")
def group_participants(spark: SparkSession, sf: str) -> DataFrame:
    return group_parts(spark, sf)[1]


@register("group_msg_counts", oracle=f"WITH {GROUP_SQL} SELECT * FROM gc")
def group_msg_counts(spark: SparkSession, sf: str) -> DataFrame:
    ev, _ = group_parts(spark, sf)
    return TR.participant_message_counts(ev)


@register("group_latest_name", oracle=f"WITH {GROUP_SQL} SELECT * FROM gn")
def group_latest_name(spark: SparkSession, sf: str) -> DataFrame:
    ev, _ = group_parts(spark, sf)
    return TR.latest_names_from_events(ev)


@register("group_name", oracle=f"""WITH {GROUP_SQL},
per AS (SELECT conversation_id, CAST(count(*) AS BIGINT) AS n_participants,
               list(us.handle ORDER BY gc.n_messages DESC, us.handle ASC)
                 FILTER (WHERE us.handle IS NOT NULL AND us.handle <> '{OWNER}') AS hs
        FROM gc LEFT JOIN us ON us.user_id = gc.participant_id GROUP BY conversation_id),
x AS (SELECT gn.conversation_id, official_name, coalesce(n_participants, 0) AS n, coalesce(hs, []) AS hs,
             CASE WHEN length({SAFE}) < 2 THEN gn.conversation_id ELSE {SAFE} END AS base
      FROM gn LEFT JOIN per USING (conversation_id))
SELECT conversation_id, official_name,
       CASE WHEN base <> conversation_id THEN base
            WHEN len(hs) = 1 THEN hs[1] || '_and_' || CAST(n - 1 AS VARCHAR) || '_more'
            WHEN len(hs) = 2 AND n = 3 THEN hs[1] || '_and_' || hs[2] || '_and_{OWNER}'
            WHEN len(hs) >= 2 THEN hs[1] || '_and_' || hs[2] || '_and_' || CAST(n - 2 AS VARCHAR) || '_more'
            ELSE conversation_id END AS group_name,
       CAST(n AS BIGINT) AS n_participants
FROM x""")
def group_name(spark: SparkSession, sf: str) -> DataFrame:
    ev, _ = group_parts(spark, sf)
    counts = TR.participant_message_counts(ev)
    names = TR.latest_names_from_events(ev)
    g = TR.group_names(names, counts, users(spark, sf), OWNER, CFG)
    return g.withColumn("n_participants", F.col("n_participants").cast("bigint"))


RENDER_SQL = f"""{GROUP_SQL},
hl AS (SELECT conversation_id, msg_ord, list(coalesce(us.handle, {URL} || x.id) ORDER BY x.p) AS hs
       FROM (SELECT conversation_id, msg_ord, unnest(generate_series(1, len(user_ids))) AS p, unnest(user_ids) AS id
             FROM gev WHERE kind IN ('add', 'leave')) x LEFT JOIN us ON us.user_id = x.id GROUP BY ALL),
rl AS (SELECT gev.conversation_id, gev.msg_ord, gev.kind, gev.ts,
              coalesce(us.handle, {URL} || gev.actor_id) AS frm, {S.english_list('hl.hs')} AS names, gev.created_at,
              gev.text, gev.name FROM gev LEFT JOIN us ON us.user_id = gev.actor_id
              LEFT JOIN hl ON hl.conversation_id = gev.conversation_id AND hl.msg_ord = gev.msg_ord),
rend AS (SELECT conversation_id, msg_ord, kind, ts,
                CASE kind
                  WHEN 'message' THEN frm || ': (' || created_at || ')' || chr(10) || chr(10) || {quote_sql('text')}
                  WHEN 'rename' THEN frm || ': (' || created_at || ')' || chr(10) || chr(10) ||
                                     '_changed group name to: ' || name || '_'
                  WHEN 'join' THEN frm || ': (' || created_at || ')' || chr(10) || chr(10) || '_' || frm ||
                                   ' added {OWNER} to the group_'
                  WHEN 'add' THEN frm || ': (' || created_at || ')' || chr(10) || chr(10) || '_' || frm || ' added ' ||
                                  names || ' to the group_'
                  WHEN 'leave' THEN names || ': (' || created_at || ')' || chr(10) || chr(10) || '_' || names ||
                                    ' left the group_' END AS line
         FROM rl)"""


def rendered(spark, sf):
    ev, parts = group_parts(spark, sf)
    return ev, parts, TR.group_lines(ev, users(spark, sf), OWNER, CFG)


@register("group_events_render", oracle=f"WITH {RENDER_SQL} SELECT conversation_id, msg_ord, kind, line FROM rend")
def group_events_render(spark: SparkSession, sf: str) -> DataFrame:
    return rendered(spark, sf)[2].select("conversation_id", "msg_ord", "kind", "line")


@register("group_transcript", oracle=f"""WITH {RENDER_SQL},
pn AS (SELECT gp.conversation_id, list(coalesce(us.handle, {URL} || gp.participant_id) ORDER BY gp.participant_id)
              AS pl FROM gp LEFT JOIN us ON us.user_id = gp.participant_id GROUP BY gp.conversation_id),
nb AS (SELECT rend.*, row_number() OVER (PARTITION BY conversation_id ORDER BY ts, msg_ord) - 1 AS idx,
              count(*) OVER (PARTITION BY conversation_id) AS cnt FROM rend),
pt AS (SELECT *, CASE WHEN cnt > {CFG.part_size} THEN CAST(floor(idx / {CFG.part_size}) + 1 AS BIGINT) END AS part FROM nb)
SELECT pt.conversation_id, part, CAST(count(*) AS BIGINT) AS n_messages,
       '## ' || any_value(gn.official_name) || ' ##' || chr(10) || chr(10) || '### Group conversation between ' ||
       any_value({S.english_list('pn.pl')}) || coalesce(', part ' || CAST(part AS VARCHAR), '') || ': ###' || {SEP} ||
       string_agg(line, {SEP} ORDER BY idx) AS transcript
FROM pt LEFT JOIN gn USING (conversation_id) LEFT JOIN pn USING (conversation_id)
GROUP BY pt.conversation_id, part""")
def group_transcript(spark: SparkSession, sf: str) -> DataFrame:
    ev, parts, lines = rendered(spark, sf)
    u = users(spark, sf)
    names = TR.latest_names_from_events(ev)
    pn = TR.with_handles(parts, u, [("participant_id", "__h")], CFG)
    pn = pn.groupBy("conversation_id").agg(
        english_list(F.transform(F.array_sort(F.collect_list(F.struct("participant_id", "__h"))),
                                 lambda s: s["__h"])).alias("participant_names"))
    t = TR.transcripts(lines.select("conversation_id", "ts", "msg_ord", "line"), "conversation_id", ["ts", "msg_ord"],
                       TR.group_header(F.col("official_name"), F.col("participant_names")), CFG.part_size,
                       titles=names.join(pn, "conversation_id", "left"), counted=ev.select("conversation_id", "ts"))
    return t.select("conversation_id", "part", F.col("n_messages").cast("bigint"), "transcript")


def totals_sql(rows: str, group: str, kind: str) -> str:
    return (f"SELECT '{kind}' AS kind, count(*) AS n_conversations, "
            f"CAST(coalesce(sum(ceil(n / {float(CFG.part_size)})), 0) AS BIGINT) AS n_files, "
            f"CAST(coalesce(sum(n), 0) AS BIGINT) AS n_messages FROM (SELECT count(*) AS n FROM {rows} GROUP BY {group})")


@register("transcript_totals", oracle=f"""WITH {DM_SQL}, {GROUP_SQL.replace(US_SQL + ",", "", 1)}
{totals_sql("op", "other_user_id", "dm")} UNION ALL {totals_sql("gev", "conversation_id", "group")}""")
def transcript_totals(spark: SparkSession, sf: str) -> DataFrame:
    lines = TR.other_party(dm_messages(spark, sf).filter(
        F.col("sender_id").isNotNull() & F.col("recipient_id").isNotNull() & F.col("text").isNotNull()),
        users(spark, sf), OWNER, CFG).withColumn("ts", dm_epoch(F.col("created_at")))
    dm = part_numbers(lines, ["other_user_id"], ["ts", "conversation_id", "msg_ord"], CFG.part_size, stride=DAY)
    dm = dm.groupBy("other_user_id", "part").agg(F.count(F.lit(1)).alias("n_messages"))
    group = part_numbers(group_parts(spark, sf)[0], ["conversation_id"], ["ts", "msg_ord"], CFG.part_size, stride=DAY)
    group = group.groupBy("conversation_id", "part").agg(F.count(F.lit(1)).alias("n_messages"))
    return TR.totals(dm, "other_user_id", "dm").unionByName(TR.totals(group, "conversation_id", "group"))
