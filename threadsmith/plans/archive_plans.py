"""Archives written from the driver tables and read back (S1-S5, S7, S9, O1), and the markdown escape (P5).

Two hundred documents make an archive: its posts, its account and its following are ``.js`` files of the archive layout,
media files carry their post's id; response caches are files of one JSON array each.  Writing goes through the
named-file sink, reading through the archive readers, posts by byte ranges and whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadsmith.functions.text import MARKDOWN_SPECIAL, class_body, escape_markdown
from threadsmith.plans import sqlfrag as S
from threadsmith.plans.cache_plans import CACHE_SQL, cache
from threadsmith.plans.registry import register, table
from threadsmith.plans.sink_plans import new_folder
from threadsmith.sinks.named_files import write_named_files
from threadsmith.sources import archive, datasets

PER_ARCHIVE = 200
ARCHIVE_SQL = f"'A' || CAST(doc_id // {PER_ARCHIVE} AS VARCHAR)"


def archive_of(doc_id: Column) -> Column:
    return F.concat(F.lit("A"), F.floor(doc_id / PER_ARCHIVE).cast("string"))


def js_files(rows: DataFrame, file: str, element: Column) -> DataFrame:
    """``name, content`` of an archive file of the rows' elements in the order of ``doc_id``, one an archive."""
    per = rows.groupBy(archive_of(F.col("doc_id")).alias("archive")).agg(
        F.array_sort(F.collect_list(F.struct("doc_id", element.alias("json")))).alias("rows"))
    body = F.array_join(F.transform("rows", lambda r: F.concat(F.lit("  "), r["json"])), ",\n")
    var = file.split(".")[0].replace("-", "_")
    return per.select(F.concat("archive", F.lit(f"/data/{file}")).alias("name"),
                      F.concat(F.lit(f"window.YTD.{var}.part0 = [\n"), body, F.lit("\n]")).alias("content"))


def last_folder(path: str) -> Column:
    return F.element_at(F.split(path, "/"), -1)


@register("archive_posts", oracle=f"""
WITH d AS (SELECT {ARCHIVE_SQL} AS archive, doc_id, doc_id % 5 = 0 AS second, text, lang FROM documents),
p AS (SELECT archive, CASE WHEN second THEN 2 ELSE 1 END AS file_ord, doc_id, text, lang,
             row_number() OVER (PARTITION BY archive, second ORDER BY doc_id) - 1 AS row_ord FROM d)
SELECT archive, CAST(file_ord AS BIGINT) AS file_ord, CAST(row_ord AS BIGINT) AS row_ord, CAST(doc_id AS VARCHAR) AS id,
       md5(text) AS text, first_value(lang) OVER (PARTITION BY archive ORDER BY doc_id) AS username FROM p""")
def archive_posts(spark: SparkSession, sf: str) -> DataFrame:
    """Posts of two parts by byte ranges, in archive order, with their owner."""
    root = new_folder(spark, "archives")
    d = table(spark, sf, "documents")
    post = F.to_json(F.struct(F.struct(F.col("doc_id").cast("string").alias("id_str"), F.col("text").alias("full_text")).alias("tweet")))
    second = F.col("doc_id") % 5 == 0
    write_named_files(js_files(d.where(~second), "tweets.js", post), root)
    write_named_files(js_files(d.where(second), "tweets-part1.js", post), root)
    first = d.groupBy(archive_of(F.col("doc_id")).alias("archive")).agg(F.min("doc_id").alias("doc_id"), F.min_by("lang", "doc_id").alias("lang"))
    account = F.to_json(F.struct(F.struct(F.col("lang").alias("username")).alias("account")))
    write_named_files(js_files(first, "account.js", account), root)
    posts = archive.read_posts(spark, f"{root}/*/data", split=True).join(archive.account_usernames(spark, f"{root}/*/data"), "archive")
    return posts.select(last_folder("archive").alias("archive"), F.col("file_ord").cast("bigint").alias("file_ord"),
                        F.col("row_ord").cast("bigint").alias("row_ord"), F.get_json_object("json", "$.tweet.id_str").alias("id"),
                        F.md5(F.get_json_object("json", "$.tweet.full_text")).alias("text"), "username")


@register("archive_ids", oracle="""
SELECT 'following' AS kind, CAST(n_chars AS VARCHAR) AS user_id, count(*) AS n FROM documents WHERE doc_id % 3 <> 0 GROUP BY n_chars
UNION ALL SELECT 'followers', CAST(doc_id AS VARCHAR), 1 FROM documents""")
def archive_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Following (elements without the key skipped, repeats kept) and follower ids, read whole."""
    root = new_folder(spark, "archives")
    d = table(spark, sf, "documents")
    account = lambda key, c: F.to_json(F.struct(F.struct(c.cast("string").alias("accountId")).alias(key)))
    following = F.when(F.col("doc_id") % 3 != 0, account("following", F.col("n_chars"))).otherwise(F.lit('{"following": {}}'))
    write_named_files(js_files(d, archive.FOLLOWING_FILE, following), root)
    write_named_files(js_files(d, archive.FOLLOWER_FILE, account("follower", F.col("doc_id"))), root)
    found = [reader(spark, f"{root}/*/data").select(F.lit(kind).alias("kind"), "user_id")
             for kind, reader in (("following", archive.read_following), ("followers", archive.read_followers))]
    return found[0].union(found[1]).groupBy("kind", "user_id").agg(F.count(F.lit(1)).alias("n"))


@register("archive_media", oracle=f"""
SELECT {ARCHIVE_SQL} AS archive, CAST(doc_id AS VARCHAR) || '-' || lang || '.jpg' AS file, CAST(doc_id AS VARCHAR) AS post_id
FROM documents WHERE doc_id % 7 = 0""")
def archive_media(spark: SparkSession, sf: str) -> DataFrame:
    """S3: the media files of archives by their names."""
    root = new_folder(spark, "archives")
    d = table(spark, sf, "documents").where("doc_id % 7 = 0")
    file = F.concat(F.col("doc_id").cast("string"), F.lit("-"), "lang", F.lit(".jpg"))
    write_named_files(d.select(F.concat(archive_of(F.col("doc_id")), F.lit("/data/tweets_media/"), file).alias("name"),
                               F.lit("x").alias("content")), root)
    found = archive.media_listing(spark, f"{root}/*/data", "tweets_media/*")
    return found.select(last_folder("archive").alias("archive"), "file", "post_id")


@register("instruction_array", oracle="SELECT 'About ' || lang AS instruction, CAST(doc_id AS VARCHAR) AS input, text AS output FROM documents")
def instruction_array(spark: SparkSession, sf: str) -> DataFrame:
    """JSON arrays of instruction rows, one file for every two hundred documents."""
    root = new_folder(spark, "arrays")
    row = F.to_json(F.struct(F.concat(F.lit("About "), "lang").alias("instruction"), F.col("doc_id").cast("string").alias("input"),
                             F.col("text").alias("output")))
    files = js_files(table(spark, sf, "documents"), "rows.json", row)
    write_named_files(files.select(F.replace("name", F.lit("/data/"), F.lit("-")).alias("name"),
                                   F.regexp_replace("content", r"^window[^\[]*", "").alias("content")), root)
    return datasets.read_instruction_array(spark, root)


@register("cache_files", oracle=f"""WITH {CACHE_SQL}
SELECT CAST(doc_id AS VARCHAR) AS id, array_to_string(responses, ',') AS responses FROM cache WHERE doc_id % 5 <> 0""")
def cache_files(spark: SparkSession, sf: str) -> DataFrame:
    """A folder of ``<id>.txt`` files of one JSON array each; every fifth is unreadable and so a miss."""
    root = new_folder(spark, "cache-files")
    c = cache(spark, sf)
    content = F.when(F.col("doc_id") % 5 == 0, F.lit("not json")).otherwise(F.to_json("responses"))
    write_named_files(c.select(F.concat(F.col("doc_id").cast("string"), F.lit(".txt")).alias("name"), content.alias("content")), root)
    return datasets.read_cache_dir(spark, root).select("id", F.array_join("responses", ",").alias("responses"))


@register("markdown_escape", oracle=f"""
SELECT doc_id, replace(regexp_replace(text, {S.q('([' + class_body(MARKDOWN_SPECIAL) + '])')}, '\\\\\\1', 'g'), chr(10), '  ' || chr(10)) AS escaped
FROM documents""")
def markdown_escape(spark: SparkSession, sf: str) -> DataFrame:
    """P5: the escape that is off by default."""
    return table(spark, sf, "documents").select("doc_id", escape_markdown(F.col("text"), enabled=True).alias("escaped"))
