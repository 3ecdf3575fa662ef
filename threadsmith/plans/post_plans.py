"""Post-normalisation queries.

Bindings: ``pages`` supply urls (bodies are assembled around them: short links with
expansions, raw links for entity synthesis, status-url shaped links for the quote flag);
``events`` supply replies with leading mentions and the routing flags (event type ->
reply/quote, purchases are reposts, small values are media-only bodies); ``orders``
dates drive the month buckets."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadsmith.config import ASCII
from threadsmith.functions import urls as U
from threadsmith.functions.text import PY_SPACE_CLASS
from threadsmith.functions.timefmt import dm_epoch, post_epoch
from threadsmith.operators import posts as P
from threadsmith.plans import sqlfrag as S
from threadsmith.plans.registry import register, table

CFG = ASCII
OWNER = "owner_handle"
RE = S.q(U.URL_RE)
TOK = S.q(f"[^{PY_SPACE_CLASS}]+")
EPOCH0 = datetime.datetime(1970, 1, 1)


def epoch_ntz(c):
    return F.timestamp_diff("SECOND", F.lit(EPOCH0).cast("timestamp_ntz"), c)


def short_links(spark, sf) -> DataFrame:
    pg = table(spark, sf, "pages").select("page_id", "url")
    s1 = F.concat(F.lit("https://t.co/"), F.substring(F.md5(F.col("url")), 1, 10))
    s2 = F.concat(F.lit("https://t.co/"), F.substring(F.md5(F.concat(F.col("url"), F.lit("#2"))), 1, 10))
    ent = F.array(F.struct(s1.alias("url"), F.col("url").alias("expanded_url")),
                  F.struct(s2.alias("url"), F.concat(F.col("url"), F.lit("#2")).alias("expanded_url")))
    body = F.concat(F.lit("Read "), s1, F.lit(" then "), s2, F.lit(" and again "), s1)
    return pg.select("page_id", body.alias("body"), ent.alias("urls"))


SHORT_SQL = """sl AS (SELECT page_id, url, 'https://t.co/' || substr(md5(url), 1, 10) AS s1,
                  'https://t.co/' || substr(md5(url || '#2'), 1, 10) AS s2 FROM pages),
sb AS (SELECT *, 'Read ' || s1 || ' then ' || s2 || ' and again ' || s1 AS body FROM sl)"""


@register("link_placeholder", oracle=f"""WITH {SHORT_SQL}
SELECT page_id, body, replace(replace(body, s1, '(link)'), s2, '(link)') AS body_markdown,
       replace(replace(body, s1, '<a href="' || url || '">' || url || '</a>'), s2,
               '<a href="' || url || '#2">' || url || '#2</a>') AS body_html
FROM sb""")
def link_placeholder(spark: SparkSession, sf: str) -> DataFrame:
    s = short_links(spark, sf)
    return s.select("page_id", "body", P.link_markdown(F.col("body"), F.col("urls")).alias("body_markdown"),
                    P.link_html(F.col("body"), F.col("urls")).alias("body_html"))


@register("url_expand", oracle=f"""WITH {SHORT_SQL}
SELECT page_id, replace(replace(body, s1, url), s2, url || '#2') AS expanded FROM sb""")
def url_expand(spark: SparkSession, sf: str) -> DataFrame:
    s = short_links(spark, sf)
    return s.select("page_id", P.replace_urls(F.col("body"), F.col("urls"), lambda u: u["expanded_url"])
                    .alias("expanded"))


def _display_sql(w: str) -> str:
    host = f"regexp_extract({w}, {RE}, 3)"
    pq = f"(regexp_extract({w}, {RE}, 4) || '?' || regexp_extract({w}, {RE}, 6))"
    return (f"(CASE WHEN starts_with({host}, 'www.') THEN substr({host}, 5) ELSE {host} END || "
            f"CASE WHEN length({pq}) < 15 THEN regexp_extract({w}, {RE}, 4) ELSE substr({pq}, 1, 15) || '…' END)")


@register("synth_urls", oracle=f"""
WITH b AS (SELECT page_id, 'See ' || url || ' or www.' || regexp_extract(url, {RE}, 3) || ' and ' || url ||
                  '… mailto:team@' || regexp_extract(url, {RE}, 3) || ' ' || url AS body FROM pages),
w AS (SELECT page_id, body, unnest(generate_series(0, len(ws) - 1)) AS pos, unnest(ws) AS w
      FROM (SELECT page_id, body, list_filter(regexp_extract_all(body, {TOK}), lambda x:
              regexp_extract(x, {RE}, 1) <> '' AND regexp_extract(x, {RE}, 3) <> '' AND NOT suffix(x, '…')) AS ws
            FROM b))
SELECT page_id, CAST(pos AS BIGINT) AS pos, w AS url, {_display_sql('w')} AS display_url,
       CAST(instr(body, w) - 1 AS BIGINT) AS idx_start, CAST(instr(body, w) - 1 + length(w) AS BIGINT) AS idx_end
FROM w""")
def synth_urls(spark: SparkSession, sf: str) -> DataFrame:
    pg = table(spark, sf, "pages").select("page_id", "url")
    host = U.netloc(F.col("url"))
    body = F.concat(F.lit("See "), F.col("url"), F.lit(" or www."), host, F.lit(" and "), F.col("url"),
                    F.lit("… mailto:team@"), host, F.lit(" "), F.col("url"))
    ents = pg.select("page_id", P.synth_url_entities(body).alias("e"))
    x = ents.select("page_id", F.posexplode("e").alias("pos", "u"))
    return x.select("page_id", F.col("pos").cast("bigint"), F.col("u.url").alias("url"),
                    F.col("u.display_url").alias("display_url"),
                    F.col("u.indices")[0].cast("bigint").alias("idx_start"),
                    F.col("u.indices")[1].cast("bigint").alias("idx_end"))


MENTION_SQL = f"""e AS (SELECT event_id, user_id, event_type, json_extract_string(props, '$.k') AS k,
                  event_type IN ('click', 'view', 'purchase') AS has_reply_key, event_type <> 'purchase' AS has_screen
           FROM events),
eb AS (SELECT *, CASE event_id % 3 WHEN 0 THEN '' WHEN 1 THEN '@u' || CAST(user_id AS VARCHAR) || ' '
                 ELSE '@u' || CAST(user_id AS VARCHAR) || ' @k' || k || ' ' END || 'did ' || event_type AS body FROM e),
ep AS (SELECT *, regexp_extract(body, {S.q(P.MENTION_PREFIX)}, 1) AS prefix FROM eb),
en AS (SELECT *, CASE WHEN length(prefix) > 0 THEN regexp_extract_all(prefix, {TOK}) ELSE ['@{OWNER}'] END AS names
       FROM ep)"""


@register("mention_strip", oracle=f"""WITH {MENTION_SQL}
SELECT event_id,
       CASE WHEN has_reply_key AND length(prefix) > 0 THEN substr(body, length(prefix) + 1) ELSE body END AS body,
       CASE WHEN has_reply_key THEN {S.english_list('names')} END AS name_list,
       CASE WHEN has_reply_key THEN 'https://twitter.com/' ||
            CASE WHEN has_screen THEN 'u' || CAST(user_id AS VARCHAR) ELSE names[1] END ||
            '/status/' || CAST(event_id - 1 AS VARCHAR) END AS reply_url
FROM en""")
def mention_strip(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    k = F.get_json_object("props", "$.k")
    uid = F.col("user_id").cast("string")
    body = F.concat(F.when(F.col("event_id") % 3 == 0, F.lit(""))
                    .when(F.col("event_id") % 3 == 1, F.concat(F.lit("@u"), uid, F.lit(" ")))
                    .otherwise(F.concat(F.lit("@u"), uid, F.lit(" @k"), k, F.lit(" "))),
                    F.lit("did "), F.col("event_type"))
    x = e.select("event_id", body.alias("body"), F.col("event_type").isin("click", "view", "purchase").alias("rk"),
                 (F.col("event_type") != "purchase").alias("sk"), F.concat(F.lit("u"), uid).alias("screen"),
                 (F.col("event_id") - 1).cast("string").alias("status_id"))
    rp = P.reply_parts(F.col("body"), OWNER, F.col("screen"), F.col("sk"), F.col("status_id"))
    return x.select("event_id", F.when(F.col("rk"), rp["body"]).otherwise(F.col("body")).alias("body"),
                    F.when(F.col("rk"), rp["name_list"]).alias("name_list"),
                    F.when(F.col("rk"), rp["url"]).alias("reply_url"))


@register("url_shape_quote_flag", oracle=f"""
WITH p AS (SELECT page_id, url, regexp_extract(regexp_extract(url, {RE}, 3), '^([^.]*)', 1) AS label,
                  regexp_extract(html, '<title>(.*?)</title>', 1) AS title FROM pages),
f AS (SELECT page_id,
             url LIKE '%/en/%' AS is_reply,
             (regexp_matches(url, {S.q(U.STATUS_URL_RE)}) OR (starts_with(url, 'https') AND
              regexp_matches('https://twitter.com/' || label || '/status/' || CAST(page_id AS VARCHAR),
                             {S.q(U.STATUS_URL_RE)}))) AS is_quote,
             starts_with(CASE WHEN page_id % 4 = 0 THEN 'RT @' || label || ': ' || title ELSE title END, 'RT @')
               AS is_retweet FROM p)
SELECT *, CASE WHEN is_reply AND is_quote THEN NULL WHEN is_reply THEN 'reply' WHEN is_quote THEN NULL
               WHEN is_retweet THEN NULL ELSE 'original' END AS kind FROM f""")
def url_shape_quote_flag(spark: SparkSession, sf: str) -> DataFrame:
    pg = table(spark, sf, "pages")
    label = F.regexp_extract(U.netloc(F.col("url")), "^([^.]*)", 1)
    title = F.regexp_extract("html", "<title>(.*?)</title>", 1)
    status = F.concat(F.lit("https://twitter.com/"), label, F.lit("/status/"), F.col("page_id").cast("string"))
    urls = F.when(F.col("url").startswith("https"), F.array(F.col("url"), status)).otherwise(F.array(F.col("url")))
    ents = F.transform(urls, lambda u: F.struct(u.alias("url"), u.alias("expanded_url")))
    body = F.when(F.col("page_id") % 4 == 0, F.concat(F.lit("RT @"), label, F.lit(": "), title)).otherwise(title)
    r, q, rt = P.type_flags(ents, F.col("url").like("%/en/%"), body)
    x = pg.select("page_id", r.alias("is_reply"), q.alias("is_quote"), rt.alias("is_retweet"))
    kind = (F.when(F.col("is_reply") & F.col("is_quote"), None).when(F.col("is_reply"), "reply")
            .when(F.col("is_quote"), None).when(F.col("is_retweet"), None).otherwise("original"))
    return x.withColumn("kind", kind)


@register("post_route", oracle=f"""
WITH e AS (SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS ts_raw, event_type, user_id,
                  json_extract_string(coalesce(json_extract_string(props, '$.tweet'), props), '$.k') AS k, value
           FROM events),
b AS (SELECT event_id, ts_raw AS ts,
             CASE WHEN value < 0.5 THEN ' (media) ' WHEN value < 1.0 THEN '(media)'
                  WHEN value < 2.0 THEN '(media)' || chr(10) || chr(10) || '(media)'
                  WHEN event_type = 'purchase' THEN 'RT @u' || CAST(user_id AS VARCHAR) || ': bought'
                  ELSE 'event ' || CAST(event_id AS VARCHAR) || ' k=' || k END AS body,
             event_type IN ('click', 'error') AS is_reply, event_type IN ('view', 'error') AS is_quote
      FROM e WHERE ts_raw IS NOT NULL AND ts_raw <> 0),
r AS (SELECT *, starts_with(body, 'RT @') AS is_retweet FROM b)
SELECT event_id, ts, CASE WHEN is_reply THEN 'reply' ELSE 'original' END AS kind, body
FROM r WHERE {S.py_strip('body')} <> '(media)'
  AND NOT (is_reply AND is_quote) AND (is_reply OR (NOT is_quote AND NOT is_retweet))
ORDER BY ts, event_id""")
def post_route(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    env = P.unwrap_envelope(F.col("props"))
    k = F.get_json_object(env, "$.k")
    v = F.col("value")
    body = (F.when(v < 0.5, F.lit(" (media) ")).when(v < 1.0, F.lit("(media)"))
            .when(v < 2.0, F.lit("(media)\n\n(media)"))
            .when(F.col("event_type") == "purchase", F.concat(F.lit("RT @u"), F.col("user_id").cast("string"),
                                                               F.lit(": bought")))
            .otherwise(F.concat(F.lit("event "), F.col("event_id").cast("string"), F.lit(" k="), k)))
    x = e.select("event_id", epoch_ntz(F.col("ts")).alias("ts"), body.alias("body"),
                 F.col("event_type").isin("click", "error").alias("is_reply"),
                 F.col("event_type").isin("view", "error").alias("is_quote"))
    x = P.valid_time(x).withColumn("is_retweet", F.col("body").startswith("RT @"))
    return P.route(x).select("event_id", "ts", "kind", "body").orderBy("ts", "event_id")


@register("monthly_posts", oracle="""
SELECT CAST(year(o_orderdate) AS BIGINT) AS year, CAST(month(o_orderdate) AS BIGINT) AS month,
       CAST(count(*) AS BIGINT) AS n_posts FROM orders GROUP BY ALL""")
def monthly_posts(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select(epoch_ntz(F.col("o_orderdate")).alias("ts"))
    m = P.month_columns(o, "ts")
    return m.groupBy(F.col("year").cast("bigint").alias("year"), F.col("month").cast("bigint").alias("month")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_posts"))


@register("timestamp_parse", oracle="""
WITH t AS (SELECT event_id, strftime(ts, '%a %b %d %H:%M:%S') || ' +0000 ' || strftime(ts, '%Y') AS created_at,
                  strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS dm_created_at FROM events)
SELECT event_id, created_at, CAST(epoch(strptime(created_at, '%a %b %d %H:%M:%S %z %Y')) AS BIGINT) AS post_epoch,
       dm_created_at,
       CAST(round_even(epoch_ms(strptime(dm_created_at, '%Y-%m-%dT%H:%M:%S.%gZ')) / 1000.0, 0) AS BIGINT) AS dm_epoch
FROM t""")
def timestamp_parse(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    created = F.concat(F.date_format("ts", "EEE MMM dd HH:mm:ss"), F.lit(" +0000 "), F.date_format("ts", "yyyy"))
    dm = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("Z"))
    x = e.select("event_id", created.alias("created_at"), dm.alias("dm_created_at"))
    return x.select("event_id", "created_at", post_epoch(F.col("created_at")).cast("bigint").alias("post_epoch"),
                    "dm_created_at", dm_epoch(F.col("dm_created_at")).alias("dm_epoch"))
