"""Archive readers.

An archive ``.js`` file is one JavaScript assignment line followed by a JSON array.  A
file is read whole (``wholetext``; ``js_split`` reads it by byte ranges instead), its first line replaced by ``[`` (or ``[ {`` when that
line opens the first object), parsed as ``array<string>`` (each element kept as raw
JSON) and exploded with its position, so the file order and element order survive for
stable sorts and last-write-wins rules.  Files with at most one line yield no rows, malformed
ones are an error."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# File names of the archive layout.
POST_FILES = "{tweet,tweets,tweets-part*}.js"
ACCOUNT_FILE = "account.js"
FOLLOWING_FILE = "following.js"
FOLLOWER_FILE = "follower.js"
DM_FILE = "direct-messages.js"
GROUP_DM_FILE = "direct-messages-group.js"
MEDIA_FILES = "{tweet_media,tweets_media}/*"
DM_MEDIA_FILES = "direct_messages_media/*"
GROUP_MEDIA_FILES = "direct_messages_group_media/*"

#: malformed JSON is an error, not an empty result
STRICT = {"mode": "FAILFAST"}


def js_array_body(value):
    """Column transform: JS assignment text -> JSON array text (NULL for <= 1 line)."""
    nl = F.instr(value, "\n")
    first = F.substring_index(value, "\n", 1)
    rest = F.substr(value, nl + 1)
    head = F.when(F.instr(first, "{") > 0, F.lit("[ {")).otherwise(F.lit("["))
    return F.when(nl > 0, F.concat(head, F.lit("\n"), rest))


def _paths(data_dirs: str | list[str], name: str) -> list[str]:
    return [f"{d.rstrip('/')}/{name}" for d in ([data_dirs] if isinstance(data_dirs, str) else data_dirs)]


def file_columns(depth: int = 0) -> list:
    """``archive, file`` from Spark's file path, decoded: the archive is what precedes ``/data/`` and
    ``depth`` folders."""
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return [F.regexp_extract(path, f"^(.*)/data/(?:[^/]+/){{{depth}}}[^/]+$", 1).alias("archive"), path.alias("file")]


def read_js(spark: SparkSession, paths: list[str] | str, split: bool = False) -> DataFrame:
    """``archive, file, file_ord, row_ord, json`` for every element of every file.  Paths may be globs over
    many archives.  ``file_ord`` is the place of the file's kind in the archive layout; files of one kind are
    ordered by name.  With ``split`` files are read by byte ranges, so that none has to fit a row."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    name = F.element_at(F.split("file", "/"), -1)
    kind = F.when(name == "tweet.js", 0).when(name == "tweets.js", 1).when(name.startswith("tweets-part"), 2).otherwise(0)
    if split:
        from threadsmith.sources.js_split import read_js_split
        return read_js_split(spark, paths).select("archive", "file", kind.alias("file_ord"), "row_ord", "json")
    raw = spark.read.text(paths, wholetext=True).select(*file_columns(), "value")
    arr = F.from_json(js_array_body(F.col("value")), "array<string>", STRICT)
    return raw.select("archive", "file", kind.alias("file_ord"), F.posexplode(arr).alias("row_ord", "json"))


#: total order of an archive's elements
ROW_ORDER = ["file_ord", "file", "row_ord"]


def read_posts(spark: SparkSession, data_dirs: str | list[str], split: bool = False) -> DataFrame:
    """All post parts of the archives' data folders (paths or globs); no de-duplication across parts; it is an
    error if there are none."""
    return read_js(spark, _paths(data_dirs, POST_FILES), split)


def account_usernames(spark: SparkSession, data_dirs: str | list[str]) -> DataFrame:
    """``archive, username`` from each ``account.js``."""
    acc = read_js(spark, _paths(data_dirs, ACCOUNT_FILE))
    return acc.filter(F.col("row_ord") == 0).select(
        "archive", F.get_json_object("json", "$.account.username").alias("username"))


def read_following(spark: SparkSession, data_dir: str | list[str], split: bool = False) -> DataFrame:
    """Following ids (rows lacking the key skipped, duplicates kept)."""
    d = read_js(spark, _paths(data_dir, FOLLOWING_FILE), split)
    return d.select(F.get_json_object("json", "$.following.accountId").alias("user_id")).filter(
        F.col("user_id").isNotNull())


def read_followers(spark: SparkSession, data_dir: str | list[str], split: bool = False) -> DataFrame:
    """S9/R2."""
    d = read_js(spark, _paths(data_dir, FOLLOWER_FILE), split)
    return d.select(F.get_json_object("json", "$.follower.accountId").alias("user_id")).filter(
        F.col("user_id").isNotNull())


DM_SCHEMA = ("dmConversation struct<conversationId:string, messages:array<struct<"
             "messageCreate:struct<senderId:string,recipientId:string,text:string,createdAt:string,id:string,"
             "urls:array<struct<url:string,expanded:string>>,mediaUrls:array<string>>>>>")
GROUP_MESSAGE = ("struct<messageCreate:struct<senderId:string,text:string,createdAt:string,id:string,"
                 "urls:array<struct<url:string,expanded:string>>,mediaUrls:array<string>>,"
                 "conversationNameUpdate:struct<initiatingUserId:string,name:string,createdAt:string>,"
                 "joinConversation:struct<initiatingUserId:string,participantsSnapshot:array<string>,createdAt:string>,"
                 "participantsJoin:struct<initiatingUserId:string,userIds:array<string>,createdAt:string>,"
                 "participantsLeave:struct<userIds:array<string>,createdAt:string>>")
GROUP_SCHEMA = f"dmConversation struct<conversationId:string, messages:array<{GROUP_MESSAGE}>>"


def read_dms(spark: SparkSession, data_dir: str | list[str], split: bool = False) -> DataFrame:
    """Two-party DM conversations (typed)."""
    d = read_js(spark, _paths(data_dir, DM_FILE), split)
    return d.select("archive", "file_ord", "row_ord", F.from_json("json", DM_SCHEMA, STRICT).alias("c")).select(
        "archive", "file_ord", "row_ord", "c.dmConversation")


def group_events_from_archive(spark: SparkSession, data_dir: str | list[str], split: bool = False) -> DataFrame:
    """S9 + G1 input: one row per group event with ``kind`` chosen by which member is set.

    ``msg_ord`` packs ``(file_ord, row_ord, position in the record)`` into one bigint, so it
    is unique and in archive order even when a conversation is split across records (it
    keys the per-event handle lists).  Bit budget: 28 bits for the position and 27 for the
    record, far above what a single JSON row (< 2 GB) can hold, and 8 for the file."""
    d = read_js(spark, _paths(data_dir, GROUP_DM_FILE), split)
    c = d.select("archive", "file_ord", "row_ord", F.from_json("json", GROUP_SCHEMA, STRICT).alias("c")).select(
        "archive", "file_ord", "row_ord", "c.dmConversation.*")
    m = c.select("archive", F.col("conversationId").alias("conversation_id"),
                 (F.shiftleft(F.col("file_ord").cast("bigint"), 55) + F.shiftleft(F.col("row_ord").cast("bigint"), 28))
                 .alias("__rec"),
                 F.posexplode("messages").alias("__pos", "m"))
    m = m.withColumn("msg_ord", F.col("__rec") + F.col("__pos"))
    mc, nu, jc, pj, pl = (F.col(f"m.{k}") for k in ("messageCreate", "conversationNameUpdate",
                                                      "joinConversation", "participantsJoin", "participantsLeave"))
    kind = (F.when(mc.isNotNull(), "message").when(nu.isNotNull(), "rename").when(jc.isNotNull(), "join")
            .when(pj.isNotNull(), "add").when(pl.isNotNull(), "leave"))
    return m.select(
        "archive", "conversation_id", "msg_ord", kind.alias("kind"),
        F.coalesce(mc["senderId"], nu["initiatingUserId"], jc["initiatingUserId"], pj["initiatingUserId"]).alias("actor_id"),
        mc["text"].alias("text"), mc["urls"].alias("urls"),
        mc["id"].alias("message_id"), mc["mediaUrls"].alias("media_urls"), nu["name"].alias("name"),
        F.coalesce(jc["participantsSnapshot"], pj["userIds"], pl["userIds"]).alias("user_ids"),
        F.coalesce(mc["createdAt"], nu["createdAt"], jc["createdAt"], pj["createdAt"], pl["createdAt"]).alias("created_at"),
    ).filter(F.col("kind").isNotNull())


def media_listing(spark: SparkSession, data_dirs: str | list[str], folders: str = MEDIA_FILES) -> DataFrame:
    """S3: ``archive, file, post_id`` of the archives' media files (names only, no content is read); it is an
    error if there are none.  ``folders`` may name the message media folders instead."""
    files = spark.read.format("binaryFile").load(_paths(data_dirs, folders)).select(*file_columns(depth=1))
    name = F.element_at(F.split("file", "/"), -1)
    return files.select("archive", name.alias("file"), F.substring_index(name, "-", 1).alias("post_id"))
