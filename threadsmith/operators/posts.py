"""Post normalisation and classification.

Posts arrive as JSON strings (one archive element each).  Typed fields come from
``from_json``; key *presence* (which differs from a JSON null) comes from
``json_object_keys``.  All rewrites are column expressions and higher-order functions,
so normalisation is a single narrow stage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadsmith.config import LINK_PLACEHOLDER, MEDIA_PLACEHOLDER, STATUS_URL_PREFIX
from threadsmith.functions import urls as U
from threadsmith.functions.text import LINE_BREAK, english_list, escape_markdown, py_strip, whitespace_tokens
from threadsmith.functions.timefmt import post_epoch

URL_ENTITY = "struct<url:string,expanded_url:string,display_url:string,indices:array<int>>"
POST_SCHEMA = (
    "created_at string, id_str string, full_text string, in_reply_to_status_id string, "
    "in_reply_to_status_id_str string, in_reply_to_user_id string, in_reply_to_screen_name string, "
    f"entities struct<urls:array<{URL_ENTITY}>, media:array<struct<url:string>>, "
    "user_mentions:array<struct<id:string,screen_name:string>>>, "
    "extended_entities struct<media:array<struct<url:string,media_url:string,"
    "video_info:struct<variants:array<struct<bitrate:string,url:string>>>>>>"
)


def unwrap_envelope(j: Column) -> Column:
    """The ``tweet`` member when present, else the element itself."""
    return F.coalesce(F.get_json_object(j, "$.tweet"), j)


def has_key(j: Column, key: str) -> Column:
    """True when the JSON object has ``key`` (also when its value is null)."""
    return F.coalesce(F.array_contains(F.json_object_keys(j), key), F.lit(False))


def parse_posts(raw: DataFrame, json_col: str = "json") -> DataFrame:
    """P1 + typed projection + key-presence flags."""
    j = unwrap_envelope(F.col(json_col))
    keep = [c for c in raw.columns if c != json_col]
    return raw.select(*keep, j.alias("__j")).select(
        *keep, F.from_json("__j", POST_SCHEMA, {"mode": "FAILFAST"}).alias("p"),
        has_key(F.col("__j"), "in_reply_to_status_id").alias("has_reply_key"),
        has_key(F.col("__j"), "in_reply_to_status_id_str").alias("has_reply_str_key"),
        has_key(F.col("__j"), "in_reply_to_screen_name").alias("has_screen_key"),
        has_key(F.col("__j"), "entities").alias("has_entities"),
        has_key(F.get_json_object("__j", "$.entities"), "media").alias("has_media_key"),
        has_key(F.col("__j"), "created_at").alias("has_created_at"),
    )


def synth_url_entities(text: Column) -> Column:
    """Url entities for whitespace words that have a scheme and a netloc and do not
    end in an ellipsis; index = first occurrence of the word."""
    ws = F.filter(whitespace_tokens(text), U.is_link_word)
    return F.transform(ws, lambda w: F.struct(
        w.alias("url"), w.alias("expanded_url"), U.display_url(w).alias("display_url"),
        F.array((F.instr(text, w) - 1).cast("int"), (F.instr(text, w) - 1 + F.length(w)).cast("int")).alias("indices")))


def effective_urls(p: Column, has_entities: Column, has_media_key: Column, text: Column) -> Column:
    """Entity urls, synthesised only when entities exist without media and with no urls."""
    given = F.coalesce(p["entities"]["urls"], F.array().cast(f"array<{URL_ENTITY}>"))
    synth = has_entities & ~has_media_key & (F.size(given) == 0)
    return F.when(synth, synth_url_entities(text)).otherwise(given)


def replace_urls(body: Column, url_list: Column, replacement) -> Column:
    """Sequentially replace each entity's ``url`` (all occurrences) with
    ``replacement(entity)``; entities without a url or its expansion are skipped."""
    whole = F.filter(url_list, lambda u: u["url"].isNotNull() & u["expanded_url"].isNotNull())
    return F.aggregate(whole, body, lambda acc, u: F.replace(acc, u["url"], replacement(u)))


def link_markdown(body: Column, url_list: Column) -> Column:
    return replace_urls(body, url_list, lambda u: F.lit(LINK_PLACEHOLDER))


def link_html(body: Column, url_list: Column) -> Column:
    return replace_urls(body, url_list, lambda u: F.concat(F.lit('<a href="'), u["expanded_url"], F.lit('">'),
                                                           u["expanded_url"], F.lit("</a>")))


def as_column(owner: str | Column) -> Column:
    return owner if isinstance(owner, Column) else F.lit(owner)


# Fixed value: what counts as leading mentions of a reply.
MENTION_PREFIX = "^((@[0-9A-Za-z_]* )*)"


def reply_parts(body: Column, owner: str | Column, screen_name: Column, has_screen: Column, status_id: Column) -> dict:
    """Leading-mention strip, name list (owner when none) and the parent link."""
    prefix = F.regexp_extract(body, MENTION_PREFIX, 1)
    stripped = F.when(F.length(prefix) > 0, F.substr(body, F.length(prefix) + 1)).otherwise(body)
    names = F.when(F.length(prefix) > 0, whitespace_tokens(prefix)).otherwise(F.array(F.concat(F.lit("@"), as_column(owner))))
    screen = F.when(has_screen, screen_name).otherwise(F.get(names, 0))
    url = F.concat(F.lit(STATUS_URL_PREFIX), screen, F.lit("/status/"), status_id)
    name_list = english_list(names)
    header_md = F.concat(F.lit("Replying to ["), escape_markdown(name_list), F.lit("]("), url, F.lit(")\n\n"))
    header_html = F.concat(F.lit('Replying to <a href="'), url, F.lit('">'), name_list, F.lit("</a><br>"))
    return {"body": stripped, "names": names, "name_list": name_list, "url": url,
            "header_markdown": header_md, "header_html": header_html}


def type_flags(url_list: Column, has_reply_str_key: Column, full_text: Column) -> tuple:
    """(in_reply_to, quote, retweet)."""
    quote = F.exists(url_list, lambda u: U.is_status_url(u["expanded_url"]))
    return has_reply_str_key, F.coalesce(quote, F.lit(False)), F.coalesce(full_text.startswith("RT @"), F.lit(False))


def route(df: DataFrame, body_col: str = "body", reply_col: str = "is_reply", quote_col: str = "is_quote",
          retweet_col: str = "is_retweet") -> DataFrame:
    """P16 + P17: drop media-only bodies, then reply&quote -> drop, reply -> 'reply',
    quote -> drop, retweet -> drop, else 'original'."""
    r, q, rt = F.col(reply_col), F.col(quote_col), F.col(retweet_col)
    kind = (F.when(r & q, None).when(r, "reply").when(q, None).when(rt, None).otherwise("original"))
    return (df.filter(py_strip(F.col(body_col)) != MEDIA_PLACEHOLDER)
            .withColumn("kind", kind).filter(F.col("kind").isNotNull()))


def valid_time(df: DataFrame, ts_col: str = "ts") -> DataFrame:
    """Drop posts without a creation time or with time 0."""
    return df.filter(F.col(ts_col).isNotNull() & (F.col(ts_col) != 0))


def month_columns(df: DataFrame, epoch_col: str = "ts") -> DataFrame:
    """Year and month (UTC) for the partitioned archive layout."""
    t = F.timestamp_seconds(F.col(epoch_col))
    return df.withColumn("year", F.year(t)).withColumn("month", F.month(t))


# Where a post's page finds media and the icon of its footer.
MEDIA_FOLDER = "../../media"
ICON = f"{MEDIA_FOLDER}/tweet.ico"


def page_html(header: Column, body: Column, permalink: Column, created_at: Column, icon: str = ICON) -> Column:
    """Header, the body's lines as a block quote, and the footer with the icon, the time and the link."""
    lines = F.regexp_replace(F.regexp_replace(body, LINE_BREAK + r"\z", ""), LINE_BREAK, "<br>\n")
    return F.concat(header, F.lit("<p><blockquote>"), lines, F.lit('</blockquote><a href="'), permalink,
                    F.lit(f'"><img src="{icon}" width="12" />&nbsp;'), created_at, F.lit("</a></p>"))


def normalize(parsed: DataFrame, owner: str | Column) -> DataFrame:
    """convert_tweet as one projection: ``ts, id, body, html_header, html_body, permalink, created_at, html, is_reply,
    is_quote, is_retweet, media_url0`` (media links in both bodies are resolved by
    :func:`threadsmith.operators.media.resolve_media` and ``media_tags``)."""
    p = F.col("p")
    text = p["full_text"]
    urls = effective_urls(p, F.col("has_entities"), F.col("has_media_key"), text)
    x = parsed.withColumn("__urls", urls)
    md = link_markdown(text, F.col("__urls"))
    html = link_html(text, F.col("__urls"))
    rp = reply_parts(md, owner, p["in_reply_to_screen_name"], F.col("has_screen_key"), p["in_reply_to_status_id"])
    rp_html = reply_parts(html, owner, p["in_reply_to_screen_name"], F.col("has_screen_key"),
                          p["in_reply_to_status_id"])
    is_reply_hdr = F.col("has_reply_key")
    body = F.when(is_reply_hdr, rp["body"]).otherwise(md)
    html_body = F.when(is_reply_hdr, rp_html["body"]).otherwise(html)
    permalink = F.concat(F.lit(STATUS_URL_PREFIX), as_column(owner), F.lit("/status/"), p["id_str"])
    header = F.when(is_reply_hdr, rp["header_html"]).otherwise(F.lit(""))
    r, q, rt = type_flags(F.col("__urls"), F.col("has_reply_str_key"), text)
    return x.select(
        *[c for c in parsed.columns if c not in ("p",) and not c.startswith("has_")],
        F.when(F.col("has_created_at"), post_epoch(p["created_at"])).alias("ts"),
        p["id_str"].alias("id"), escape_markdown(body).alias("body"), header.alias("html_header"), html_body.alias("html_body"),
        permalink.alias("permalink"), p["created_at"].alias("created_at"),
        page_html(header, html_body, permalink, p["created_at"]).alias("html"),
        r.alias("is_reply"), q.alias("is_quote"), rt.alias("is_retweet"),
        p["entities"]["media"].getItem(0)["url"].alias("media_url0"),
        p["extended_entities"]["media"].alias("media"),
        p["in_reply_to_user_id"].alias("in_reply_to_user_id"),
        p["in_reply_to_screen_name"].alias("in_reply_to_screen_name"),
        p["entities"]["user_mentions"].alias("user_mentions"),
        F.col("has_screen_key"),
    )


def user_observations(norm: DataFrame, ord_cols: list[str]) -> DataFrame:
    """``(user_id, handle, ord)`` from the replied-to user and every mention, in
    write order (file, row, reply-before-mentions, mention position)."""
    base = [F.col(c) for c in ord_cols]
    reply = norm.filter(F.col("has_screen_key") & F.col("in_reply_to_screen_name").isNotNull()).select(
        F.col("in_reply_to_user_id").alias("user_id"), F.col("in_reply_to_screen_name").alias("handle"),
        F.struct(*base, F.lit(0).alias("src"), F.lit(0).alias("pos")).alias("ord"))
    men = norm.select(*ord_cols, F.posexplode_outer("user_mentions").alias("__pos", "__m")).filter(
        F.col("__m").isNotNull())
    mention = men.select(F.col("__m.id").alias("user_id"), F.col("__m.screen_name").alias("handle"),
                         F.struct(*[F.col(c) for c in ord_cols], F.lit(1).alias("src"),
                                  F.col("__pos").alias("pos")).alias("ord"))
    return reply.unionByName(mention)
