"""Thread context from captured pages (X18) and the thread-cache join.

A page holds ordered item blocks; the *target* is the first block carrying the marker and
its context is the text of every earlier block that has text.  Plain items are computed
inside the row with higher-order functions; captured pages with nested markup are cut into
tags and texts, whose elements are matched by running depths."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadsmith.config import CorpusConfig


def strip_tags(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, F.lit("<[^>]*>"), F.lit("")), F.lit(" \t\n\r\x0b\x0c"))


#: character references of markup; the ampersand last
REFERENCES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", "\u00a0"),
              ("&amp;", "&"))
#: what a captured page marks its target item and the items' bodies with
TARGET_MARK = 'data-testid="bookmark"'
BODY_MARK = 'data-testid="tweetText"'


def decoded(c: Column) -> Column:
    for name, char in REFERENCES:
        c = F.replace(c, F.lit(name), F.lit(char))
    return c


def page_items(html: Column, container: str = "article", item_sep: str = "<p>") -> Column:
    """Blocks of the container element, split at ``item_sep`` (the first block is what
    precedes the first separator)."""
    inner = F.regexp_extract(html, f"(?s)<{container}>(.*)</{container}>", 1)
    return F.split(inner, item_sep)


def thread_from_items(texts: Column, marked: Column) -> tuple:
    """``(target_pos, context)``: the 1-based position of the first marked item, and the non-empty
    texts before it."""
    at = F.array_position(marked, F.lit(True))
    target = F.when(at > 0, at)
    context = F.when(target.isNotNull(), F.filter(texts, lambda t, i: (i + 1 < target) & (t != ""))).otherwise(
        F.array().cast("array<string>"))
    return target, context


def extract_threads(pages: DataFrame, id_col: str, html_col: str,
                    is_target: Callable[[Column, Column], Column]) -> DataFrame:
    """``id, target_pos, target_text, context`` for every page (empty context when the
    page has no target).  ``is_target(page_id, pos)`` is the marker predicate."""
    items = F.transform(page_items(F.col(html_col)), strip_tags)
    p = pages.select(F.col(id_col), items.alias("__texts"))
    marked = F.transform(F.col("__texts"), lambda t, i: is_target(F.col(id_col), i + 1))
    return _threads(p, id_col, marked)


#: what a page is cut into: comments, tags, and the text between
TOKEN = r"(?s)<!--.*?-->|</?[A-Za-z][^>]*>|<[!?][^>]*>|[^<]+|<"
#: elements whose content is no markup
RAW = r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>"


def page_tokens(pages: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """``id, page, pos, tok``: the tags and texts of each page in order, ``page`` being a hash of it.  A page captured
    twice under one id is one page; one without tokens has a row without."""
    clean = F.regexp_replace(F.col(html_col), F.lit(RAW), F.lit(""))
    toks = pages.select(F.col(id_col).alias("id"), F.xxhash64(html_col).alias("page"),
                        F.posexplode_outer(F.regexp_extract_all(clean, F.lit(TOKEN), F.lit(0))).alias("pos", "tok"))
    return toks.repartition("id", "page").dropDuplicates(["id", "page", "pos"])


def element_ends(tokens: DataFrame, names: list[str]) -> DataFrame:
    """``tokens`` of opening tags of ``names`` with ``name`` and ``end``, the place of the matching closing tag (null where
    it is missing).

    The depth of a tag is the running sum of openings less closings of its name; closings without an opening do
    not count, so the sum never falls below its least value so far.  Tags of one name and level take turns to
    open and close, and the one after an opening is its closing."""
    name = F.lower(F.regexp_extract("tok", r"^</?([A-Za-z][A-Za-z0-9]*)", 1))
    tags = tokens.withColumn("name", name).where(F.col("name").isin(*names) & ~F.endswith("tok", F.lit("/>")))
    closes = F.startswith("tok", F.lit("</"))
    order = Window.partitionBy("id", "page", "name").orderBy("pos")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    tags = tags.withColumn("closes", closes).withColumn("sum", F.sum(F.when(closes, -1).otherwise(1)).over(so_far))
    depth = F.col("sum") - F.least(F.lit(0), F.min("sum").over(so_far))
    tags = tags.withColumn("depth", depth).withColumn("level", F.when(F.col("closes"), F.col("depth") + 1).otherwise(F.col("depth")))
    level = Window.partitionBy("id", "page", "name", "level").orderBy("pos")
    return tags.withColumn("end", F.lead("pos").over(level)).where(~F.col("closes")).select(
        "id", "page", "pos", "tok", "name", "end")


def extract_marked_threads(pages: DataFrame, id_col: str, html_col: str, target_mark: str = TARGET_MARK,
                           body_mark: str = BODY_MARK) -> DataFrame:
    """``id, target_pos, target_text, context`` of captured pages: items are the ``article`` elements in the order in
    which they open, also those inside others; the target is the first one with ``target_mark`` anywhere in it; an
    item's text is all text of the first ``div`` in it that carries ``body_mark``.  The context is the texts of the
    items before the target (an item without such a body has none).

    Elements are matched by running depths over the page's tags; all tokens of a page meet in one group."""
    tokens = page_tokens(pages, id_col, html_col)
    places = element_ends(tokens, ["article", "div"])
    past = F.lit(2147483647)
    article, body = F.col("name") == "article", (F.col("name") == "div") & F.contains("tok", F.lit(body_mark))
    span = F.struct("pos", F.coalesce("end", past).alias("end"))
    elements = places.groupBy("id", "page").agg(F.array_sort(F.collect_list(F.when(article, span))).alias("articles"),
                                                F.array_sort(F.collect_list(F.when(body, span))).alias("bodies"))
    is_tag = F.startswith("tok", F.lit("<")) & (F.col("tok") != "<")
    texts = tokens.groupBy("id", "page").agg(
        F.array_sort(F.collect_list(F.when(~is_tag, F.struct("pos", "tok")))).alias("texts"),
        F.collect_list(F.when(is_tag & F.contains("tok", F.lit(target_mark)), F.col("pos"))).alias("marks"))
    same = F.col("id").eqNullSafe(F.col("e_id")) & F.col("page").eqNullSafe(F.col("e_page"))
    p = texts.join(elements.withColumnsRenamed({"id": "e_id", "page": "e_page"}), same, "left")
    none = F.array().cast("array<struct<pos:int,end:int>>")
    p = p.withColumns({c: F.coalesce(c, none) for c in ("articles", "bodies")})

    def text_of(a: Column) -> Column:
        own = F.get(F.filter("bodies", lambda b: (b["pos"] > a["pos"]) & (b["pos"] < a["end"])), 0)
        # a body left open ends with the innermost article around it
        around = F.filter("articles", lambda x: (x["pos"] < own["pos"]) & (x["end"] > own["pos"]))
        end = F.least(own["end"], F.array_min(F.transform(around, lambda x: x["end"])))
        inside = F.filter("texts", lambda t: (t["pos"] > own["pos"]) & (t["pos"] < end))
        return F.when(own.isNotNull(), decoded(F.array_join(F.transform(inside, lambda t: t["tok"]), "")))

    p = p.withColumn("__texts", F.transform("articles", text_of))
    marked = F.transform("articles", lambda a: F.exists("marks", lambda m: (m > a["pos"]) & (m < a["end"])))
    p = p.withColumn("target_pos", F.array_position(marked, F.lit(True))).withColumn(
        "target_pos", F.when(F.col("target_pos") > 0, F.col("target_pos")))
    before = F.filter("__texts", lambda t, i: (i + 1 < F.col("target_pos")) & t.isNotNull())
    return p.select(F.col("id").alias(id_col), "target_pos", F.get("__texts", (F.col("target_pos") - 1).cast("int")).alias("target_text"),
                    F.when(F.col("target_pos").isNotNull(), before).otherwise(F.array().cast("array<string>")).alias("context"))


def _threads(p: DataFrame, id_col: str, marked: Column) -> DataFrame:
    target, context = thread_from_items(F.col("__texts"), marked)
    return p.select(id_col, target.alias("target_pos"), F.get(F.col("__texts"), (target - 1).cast("int")).alias("target_text"),
                    context.alias("context"))


def join_thread_cache(replies: DataFrame, thread_cache: DataFrame, cfg: CorpusConfig,
                      id_col: str = "id") -> DataFrame:
    """Attach cached thread context; in cache-only mode a miss drops the reply,
    otherwise it is kept with a NULL context (to be fetched)."""
    how = "inner" if cfg.cache_only else "left"
    return replies.join(thread_cache.select(id_col, "context"), id_col, how)
