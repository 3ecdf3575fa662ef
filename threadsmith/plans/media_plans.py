"""Media queries.

Bindings: ``orders`` are posts whose media link is ``https://t.co/m<orderkey>`` (the body
is only that link for status F); their ``lineitem`` rows are the media items
(``img<partkey>.jpg``) and also the video variants (bitrate from the quantity, none for
line status F); the listing holds the exact file for return flag R and a video file for
return flag A; ``lineitem`` rows are also the upgrade manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadsmith.functions.draws import uniform
from threadsmith.operators import media as MD
from threadsmith.operators.posts import ICON, MEDIA_FOLDER, page_html
from threadsmith.plans import sqlfrag as S
from threadsmith.plans.registry import register, table


def li(spark, sf):
    return table(spark, sf, "lineitem")


def media_inputs(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    pid = F.col("o_orderkey").cast("string")
    link = F.concat(F.lit("https://t.co/m"), pid)
    bodies = o.select(pid.alias("post_id"), F.when(F.col("o_orderstatus") == "F", link)
                      .otherwise(F.concat(F.lit("Look at this "), link)).alias("body"), link.alias("media_link"))
    l = li(spark, sf)
    lpid = F.col("l_orderkey").cast("string")
    media = l.select(lpid.alias("post_id"), F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("pos"),
                     F.concat(F.lit("http://pbs.twimg.com/media/img"), F.col("l_partkey").cast("string"),
                              F.lit(".jpg")).alias("media_url"))
    files = l.select(lpid.alias("post_id"),
                     F.when(F.col("l_returnflag") == "R",
                            F.concat(lpid, F.lit("-img"), F.col("l_partkey").cast("string"), F.lit(".jpg")))
                     .when(F.col("l_returnflag") == "A",
                           F.concat(lpid, F.lit("-vid"), F.col("l_suppkey").cast("string"), F.lit(".mp4")))
                     .alias("file")).filter(F.col("file").isNotNull()).distinct()
    return media, files, bodies


@register("media_resolve", oracle="""
WITH b AS (SELECT CAST(o_orderkey AS VARCHAR) AS post_id, 'https://t.co/m' || CAST(o_orderkey AS VARCHAR) AS link,
                  CASE WHEN o_orderstatus = 'F' THEN 'https://t.co/m' || CAST(o_orderkey AS VARCHAR)
                       ELSE 'Look at this https://t.co/m' || CAST(o_orderkey AS VARCHAR) END AS body FROM orders),
m AS (SELECT CAST(l_orderkey AS VARCHAR) AS post_id, l_linenumber AS pos, l_partkey AS pos2, l_suppkey AS pos3,
             CAST(l_orderkey AS VARCHAR) || '-img' || CAST(l_partkey AS VARCHAR) || '.jpg' AS exp FROM lineitem),
f AS (SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS post_id,
             CASE l_returnflag WHEN 'R' THEN CAST(l_orderkey AS VARCHAR) || '-img' || CAST(l_partkey AS VARCHAR) || '.jpg'
                               WHEN 'A' THEN CAST(l_orderkey AS VARCHAR) || '-vid' || CAST(l_suppkey AS VARCHAR) || '.mp4'
             END AS file FROM lineitem WHERE l_returnflag IN ('R', 'A')),
nf AS (SELECT post_id, count(*) AS nfiles FROM f GROUP BY post_id),
r AS (SELECT m.post_id, m.pos, m.pos2, m.pos3, (SELECT count(*) FROM f WHERE f.file = m.exp) > 0 AS exact, coalesce(nf.nfiles, 0) AS nfiles
      FROM m LEFT JOIN nf USING (post_id)),
ph AS (SELECT post_id, pos, pos2, pos3, CASE WHEN exact THEN '(media)' WHEN nfiles > 0 THEN repeat('(video)', nfiles)
                                 ELSE '(media)' END AS ph,
              CASE WHEN NOT exact AND nfiles > 0 THEN nfiles ELSE 0 END AS nv,
              CASE WHEN NOT exact AND nfiles = 0 THEN 1 ELSE 0 END AS miss FROM r),
per AS (SELECT post_id, string_agg(ph, chr(10) || chr(10) ORDER BY pos, pos2, pos3) AS phs, count(*) AS n_media, sum(nv) AS nvf,
               sum(miss) AS nmiss FROM ph GROUP BY post_id)
SELECT b.post_id, replace(b.body, b.link, CASE WHEN b.body = b.link THEN '' ELSE chr(10) || chr(10) END || per.phs)
         AS body, CAST(n_media AS BIGINT) AS n_media, CAST(nvf AS BIGINT) AS n_video_files,
       CAST(nmiss AS BIGINT) AS n_missing
FROM b JOIN per USING (post_id)""")
def media_resolve(spark: SparkSession, sf: str) -> DataFrame:
    media, files, bodies = media_inputs(spark, sf)
    r = MD.resolve_media(media, files, bodies)
    return r.select("post_id", "body", *[F.col(c).cast("bigint") for c in ("n_media", "n_video_files", "n_missing")])


@register("media_best_variant", oracle="""
WITH v AS (SELECT l_orderkey, l_linenumber AS pos,
                  CASE WHEN l_linestatus = 'F' THEN NULL
                       ELSE CAST(CAST(floor(l_quantity) AS BIGINT) % 10 * 1000 AS VARCHAR) END AS bitrate,
                  'https://video.example/' || CAST(l_orderkey AS VARCHAR) || '/' || CAST(l_linenumber AS VARCHAR) ||
                  '.mp4' AS url FROM lineitem)
SELECT l_orderkey, arg_max(url, CAST(bitrate AS BIGINT) * 1000 - pos) AS best_url,
       max(CAST(bitrate AS BIGINT)) AS best_bitrate
FROM v WHERE bitrate IS NOT NULL GROUP BY l_orderkey""")
def media_best_variant(spark: SparkSession, sf: str) -> DataFrame:
    l = li(spark, sf)
    br = F.when(F.col("l_linestatus") == "F", F.lit(None).cast("string")).otherwise(
        (F.floor("l_quantity").cast("bigint") % 10 * 1000).cast("string"))
    url = F.concat(F.lit("https://video.example/"), F.col("l_orderkey").cast("string"), F.lit("/"),
                   F.col("l_linenumber").cast("string"), F.lit(".mp4"))
    v = l.select("l_orderkey", F.col("l_linenumber").alias("pos"), br.alias("bitrate"), url.alias("url"))
    return MD.best_variants(v, ["l_orderkey"])


def manifest(spark, sf) -> DataFrame:
    l = li(spark, sf)
    q = F.floor("l_quantity").cast("bigint")
    local = q * 1000 + F.col("l_linenumber")
    remote = F.when(F.col("l_linenumber") == 1, local).otherwise(F.floor("l_extendedprice").cast("bigint"))
    unk_l = F.col("l_discount") < 0.01
    unk_r = F.col("l_tax") < 0.01
    return l.select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"),
                 F.lit(".jpg")).alias("file"),
        local.alias("local_bytes"), remote.alias("remote_bytes"),
        F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"), 404).otherwise(200).alias("status"),
        F.when(unk_l, -1).otherwise(100 + F.col("l_partkey") % 900).alias("local_w"),
        F.when(unk_l, -1).otherwise(100 + F.col("l_suppkey") % 400).alias("local_h"),
        F.when(unk_r, -1).otherwise(100 + (F.col("l_partkey") * 7) % 900).alias("remote_w"),
        F.when(unk_r, -1).otherwise(100 + (F.col("l_suppkey") * 3) % 400).alias("remote_h"))


UPGRADE_SQL = """m AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '.jpg' AS file,
         CAST(floor(l_quantity) AS BIGINT) * 1000 + l_linenumber AS lb,
         CASE WHEN l_linenumber = 1 THEN CAST(floor(l_quantity) AS BIGINT) * 1000 + l_linenumber
              ELSE CAST(floor(l_extendedprice) AS BIGINT) END AS rb,
         CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 404 ELSE 200 END AS status,
         CASE WHEN l_discount < 0.01 THEN -1 ELSE 100 + l_partkey % 900 END AS lw,
         CASE WHEN l_discount < 0.01 THEN -1 ELSE 100 + l_suppkey % 400 END AS lh,
         CASE WHEN l_tax < 0.01 THEN -1 ELSE 100 + (l_partkey * 7) % 900 END AS rw,
         CASE WHEN l_tax < 0.01 THEN -1 ELSE 100 + (l_suppkey * 3) % 400 END AS rh FROM lineitem),
d AS (SELECT *, lw = -1 AND lh = -1 AND rw = -1 AND rh = -1 AS allu, lw = -1 OR lh = -1 OR rw = -1 OR rh = -1 AS anyu,
             lw * lh AS pb, rw * rh AS pa FROM m),
e AS (SELECT *, CASE WHEN status <> 200 THEN 'fail' WHEN rb = lb THEN 'same_size' WHEN allu THEN 'replaced'
                     WHEN anyu THEN 'inconclusive' WHEN pa >= pb THEN 'replaced' ELSE 'smaller_pixels' END AS decision
      FROM d),
o AS (SELECT file, decision, decision IN ('same_size', 'replaced', 'smaller_pixels') AS success,
             CAST(CASE WHEN decision IN ('fail', 'same_size') THEN 0 ELSE rb END AS BIGINT) AS bytes_downloaded,
             CASE WHEN decision = 'replaced' THEN CAST(100.0 AS DOUBLE) * (rb - lb) / lb END AS pct_bytes,
             CASE WHEN decision IN ('replaced', 'smaller_pixels') AND NOT allu
                  THEN CAST(100.0 AS DOUBLE) * (pa - pb) / pb END AS pct_pixels
      FROM e)"""


@register("media_upgrade", oracle=f"WITH {UPGRADE_SQL} SELECT *, NOT success AS retry FROM o")
def media_upgrade(spark: SparkSession, sf: str) -> DataFrame:
    d = MD.upgrade_decisions(manifest(spark, sf))
    return d.select("file", "decision", "success", "bytes_downloaded", "pct_bytes", "pct_pixels", "retry")


@register("media_upgrade_summary", oracle=f"""WITH {UPGRADE_SQL}
SELECT CAST(count(*) AS BIGINT) AS n_files, CAST(count_if(success) AS BIGINT) AS n_success,
       CAST(count_if(NOT success) AS BIGINT) AS n_retry, CAST(sum(bytes_downloaded) AS BIGINT) AS total_bytes,
       sum(bytes_downloaded) / CAST(1048576 AS DOUBLE) AS total_mb, sum(bytes_downloaded) / CAST(1073741824 AS DOUBLE)
         AS total_gb
FROM o""")
def media_upgrade_summary(spark: SparkSession, sf: str) -> DataFrame:
    return MD.upgrade_summary(MD.upgrade_decisions(manifest(spark, sf)))


# ---------------------------------------------------------------- prefix match, manifest, retry rounds
@register("media_prefix", oracle="""
WITH b AS (SELECT CAST(o_orderkey AS VARCHAR) AS post_id FROM orders),
f AS (SELECT DISTINCT CAST(l_orderkey AS VARCHAR) || CASE l_returnflag
        WHEN 'R' THEN '-img' || CAST(l_partkey AS VARCHAR) || '.jpg' ELSE '-vid' || CAST(l_suppkey AS VARCHAR) || '.mp4' END AS file
      FROM lineitem WHERE l_returnflag IN ('R', 'A')),
d AS (SELECT file, length(regexp_extract(file, '^[0-9]{1,20}')) AS n FROM f),
p AS (SELECT file, unnest(list_transform(range(1, n + 1), lambda k: left(file, k))) AS post_id FROM d)
SELECT b.post_id, CAST(count(*) AS BIGINT) AS n_files, min(file) AS first_file, max(file) AS last_file
FROM b JOIN p USING (post_id) GROUP BY b.post_id""")
def media_prefix(spark: SparkSession, sf: str) -> DataFrame:
    """The files whose names start with a post's id, wherever the id ends."""
    _, files, bodies = media_inputs(spark, sf)
    found = bodies.select("post_id").join(MD.files_of_posts(files.select("file"), any_prefix=True), "post_id")
    return found.groupBy("post_id").agg(F.count(F.lit(1)).alias("n_files"), F.min("file").alias("first_file"),
                                        F.max("file").alias("last_file"))


@register("media_manifest", oracle="""
WITH m AS (SELECT CAST(l_orderkey AS VARCHAR) AS post_id, l_linenumber, l_partkey, l_suppkey, l_linestatus,
                  CAST(l_orderkey AS VARCHAR) || '-img' || CAST(l_partkey AS VARCHAR) || '.jpg' AS exp FROM lineitem),
f AS (SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS post_id, CAST(l_orderkey AS VARCHAR) || CASE l_returnflag
        WHEN 'R' THEN '-img' || CAST(l_partkey AS VARCHAR) || '.jpg' ELSE '-vid' || CAST(l_suppkey AS VARCHAR) || '.mp4' END AS file
      FROM lineitem WHERE l_returnflag IN ('R', 'A'))
SELECT post_id, l_linenumber AS line, 'photo' AS kind, exp AS file,
       'https://pbs.twimg.com/media/img' || CAST(l_partkey AS VARCHAR) || '.jpg:orig' AS source
FROM m WHERE exp IN (SELECT file FROM f)
UNION ALL
SELECT m.post_id, l_linenumber, 'video', f.file, 'https://video.example/' || CAST(l_suppkey AS VARCHAR) || '.mp4'
FROM m JOIN f USING (post_id) WHERE exp NOT IN (SELECT file FROM f) AND l_linestatus = 'O'""")
def media_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Post, file and best source of every kept medium; open lines have rated variants."""
    media, files, _ = media_inputs(spark, sf)
    pos = F.struct("l_linenumber", "l_partkey", "l_suppkey")
    best = li(spark, sf).where("l_linestatus = 'O'").select(
        F.col("l_orderkey").cast("string").alias("post_id"), pos.alias("pos"),
        F.concat(F.lit("https://video.example/"), F.col("l_suppkey").cast("string"), F.lit(".mp4")).alias("best_url")).distinct()
    found = MD.media_manifest(media, files, best)
    return found.select("post_id", F.col("pos.l_linenumber").alias("line"), "kind", F.col("media_file").alias("file"), "source")


def attempt_results(spark, sf) -> DataFrame:
    """Results of up to five rounds a file by a draw: under 0.45 a success, above 0.97 not there yet."""
    file = F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"), F.lit(".jpg"))
    # a given number of partitions, as names are short but the ledger keeps more for each: few large ones would spill
    files = li(spark, sf).select(file.alias("file")).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "file").distinct()
    rounds = files.select("file", F.explode(F.sequence(F.lit(1), F.lit(5))).alias("round"))
    drawn = rounds.withColumn("u", uniform(["file", "round"], "attempt"))
    return drawn.where("u <= 0.97").select("file", "round", (F.col("u") < 0.45).alias("success"),
                                           F.floor(F.col("u") * 1000).cast("bigint").alias("bytes"))


ATTEMPTS_SQL = f"""r AS (SELECT *, {S.u(['file', 'round'], 'attempt')} AS u FROM (
  SELECT file, unnest(range(1, 6)) AS round FROM (SELECT DISTINCT CAST(l_orderkey AS VARCHAR) || '-' ||
    CAST(l_linenumber AS VARCHAR) || '.jpg' AS file FROM lineitem))),
e AS (SELECT file, coalesce(min(round) FILTER (WHERE u > 0.97), 6) AS gap, coalesce(min(round) FILTER (WHERE u < 0.45), 99) AS won
      FROM r GROUP BY file HAVING count(*) FILTER (WHERE u <= 0.97) > 0),
l AS (SELECT file, CASE WHEN won < gap THEN won ELSE gap - 1 END AS attempts,
             CASE WHEN won < gap THEN 'best' WHEN gap = 6 THEN 'failed' ELSE 'pending' END AS state FROM e)"""


@register("media_retry", oracle=f"""WITH {ATTEMPTS_SQL}
SELECT l.file, CAST(attempts AS BIGINT) AS attempts, state,
       CAST(coalesce(sum(CAST(floor(u * 1000) AS BIGINT)), 0) AS BIGINT) AS bytes
FROM l LEFT JOIN r ON r.file = l.file AND r.round <= l.attempts GROUP BY ALL""")
def media_retry(spark: SparkSession, sf: str) -> DataFrame:
    """M2: attempts and final state of every file."""
    return MD.retry_ledger(attempt_results(spark, sf))


@register("media_retry_rounds", oracle=f"""WITH {ATTEMPTS_SQL},
p AS (SELECT unnest(range(1, attempts + 1)) AS round, attempts, state FROM l)
SELECT CAST(round AS BIGINT) AS round, count(*) AS n_tested, count(*) FILTER (WHERE state = 'best' AND round = attempts) AS n_success,
       count(*) FILTER (WHERE NOT (state = 'best' AND round = attempts)) AS n_left, 0.25::DOUBLE + (round - 1) * 2.0::DOUBLE AS pause
FROM p GROUP BY round""")
def media_retry_rounds(spark: SparkSession, sf: str) -> DataFrame:
    return MD.retry_rounds(MD.retry_ledger(attempt_results(spark, sf)))


@register("post_html", oracle=f"""
WITH b AS (SELECT CAST(o_orderkey AS VARCHAR) AS post_id, 'https://t.co/m' || CAST(o_orderkey AS VARCHAR) AS link,
                  strftime(o_orderdate, '%Y-%m-%d') AS created, o_orderstatus = 'F' AS alone FROM orders),
f AS (SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS post_id, CAST(l_orderkey AS VARCHAR) || CASE l_returnflag
        WHEN 'R' THEN '-img' || CAST(l_partkey AS VARCHAR) || '.jpg' ELSE '-vid' || CAST(l_suppkey AS VARCHAR) || '.mp4' END AS file
      FROM lineitem WHERE l_returnflag IN ('R', 'A')),
v AS (SELECT post_id, string_agg('{MD.HTML_VIDEO[0]}{MEDIA_FOLDER}/' || file || '{MD.HTML_VIDEO[1].strip()}' || chr(10), '' ORDER BY file) AS videos
      FROM f GROUP BY post_id),
m AS (SELECT CAST(l_orderkey AS VARCHAR) AS post_id, l_linenumber, l_partkey, l_suppkey,
             CAST(l_orderkey AS VARCHAR) || '-img' || CAST(l_partkey AS VARCHAR) || '.jpg' AS exp FROM lineitem),
t AS (SELECT m.*, CASE WHEN exp IN (SELECT file FROM f) THEN '<img src="{MEDIA_FOLDER}/' || exp || '"/>'
        ELSE coalesce(videos, '<a href="https://t.co/m' || post_id || '">https://t.co/m' || post_id || '</a>') END AS tag
      FROM m LEFT JOIN v USING (post_id)),
h AS (SELECT post_id, string_agg(tag, '<br>' ORDER BY l_linenumber, l_partkey, l_suppkey) AS tags FROM t GROUP BY post_id),
x AS (SELECT post_id, created, CASE WHEN alone THEN tags ELSE 'Look at' || chr(10) || 'this <br>' || tags END AS body FROM b JOIN h USING (post_id))
SELECT post_id, '<p><blockquote>' || replace(regexp_replace(body, chr(10) || '$', ''), chr(10), '<br>' || chr(10)) ||
       '</blockquote><a href="https://twitter.com/owner/status/' || post_id || '"><img src="{ICON}" width="12" />&nbsp;' || created || '</a></p>' AS html
FROM x""")
def post_html(spark: SparkSession, sf: str) -> DataFrame:
    """Whole pages of posts with images, videos and missing media."""
    media, files, _ = media_inputs(spark, sf)
    o = table(spark, sf, "orders")
    pid = F.col("o_orderkey").cast("string")
    link = F.concat(F.lit("https://t.co/m"), pid)
    body = F.when(F.col("o_orderstatus") == "F", link).otherwise(F.concat(F.lit("Look at\nthis "), link))
    bodies = o.select(pid.alias("post_id"), body.alias("html_body"), link.alias("media_link"),
                      F.date_format("o_orderdate", "yyyy-MM-dd").alias("created_at"))
    tagged = MD.media_tags(media, files, bodies).join(bodies.select("post_id", "created_at"), "post_id")
    permalink = F.concat(F.lit("https://twitter.com/owner/status/"), "post_id")
    return tagged.select("post_id", page_html(F.lit(""), F.col("html_body"), permalink, F.col("created_at")).alias("html"))
