"""Media resolution, best-quality sources and the upgrade decision table
(P11-P13, J5, A7, A14, M1, M2).

Plan: media items are exploded per post, joined to the media listing twice (exact file
name; then every file of the same post id - the prefix match is bounded at the ``-``
after the id so it stays an equi-join), and re-assembled per post in media order.  Each
post has a handful of media, so the re-aggregation is small per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadsmith.config import MEDIA_PLACEHOLDER, PHOTO_URL_PREFIX, VIDEO_PLACEHOLDER
from threadsmith.operators.posts import MEDIA_FOLDER


# The tag of a local video, before and after its path.
HTML_VIDEO = ('<video controls><source src="', '">Your browser does not support the video tag.</video>\n')


def basename(p: Column) -> Column:
    return F.element_at(F.split(p, "/"), -1)


def listing_from_paths(files: DataFrame, path_col: str = "path") -> DataFrame:
    """S3: a directory listing (e.g. ``binaryFile`` paths) -> ``file, post_id``."""
    f = files.select(basename(F.col(path_col)).alias("file"))
    return f.withColumn("post_id", F.substring_index("file", "-", 1))


#: longest post id, in digits
ID_DIGITS = 20


def files_of_posts(listing: DataFrame, any_prefix: bool = False) -> DataFrame:
    """``listing`` with ``post_id`` for each post a file may belong to: the one before its ``-``; with ``any_prefix``
    every post whose id the file's name starts with (``12*`` also takes ``123-a.jpg``), as a pattern search does.
    The second is still a join on equal ids: a name begins with at most ``ID_DIGITS`` of them."""
    if not any_prefix:
        return listing
    digits = F.length(F.regexp_extract("file", f"^[0-9]{{1,{ID_DIGITS}}}", 0))
    prefixes = F.when(digits > 0, F.transform(F.sequence(F.lit(1), digits), lambda k: F.left("file", k)))
    return listing.withColumn("post_id", F.explode(prefixes))


def resolve_media(media: DataFrame, listing: DataFrame, bodies: DataFrame, keys: tuple = ("post_id",),
                  scope: tuple = (), any_prefix: bool = False) -> DataFrame:
    """``media(keys, post_id, pos, media_url)``, ``listing(scope, file, post_id)``,
    ``bodies(keys, body, media_link)`` -> ``keys, body, n_media, n_video_files, n_missing`` with the media link
    replaced by the placeholders.  ``keys`` identify a post's row (a post id can occur in two parts), ``scope``
    columns (the archive) bound the search for files, ``any_prefix`` widens it (see ``files_of_posts``)."""
    keys, scope = list(keys), list(scope)
    m = media.withColumn("__exp", F.concat(F.col("post_id"), F.lit("-"), basename(F.col("media_url"))))
    exact = listing.select(*scope, F.col("file").alias("__exp"), F.lit(True).alias("__exact")).distinct()
    m = m.join(exact, [*scope, "__exp"], "left")
    per_post_files = files_of_posts(listing, any_prefix).groupBy(*scope, "post_id").agg(F.count(F.lit(1)).alias("__nfiles"))
    m = m.join(per_post_files, [*scope, "post_id"], "left")
    nfiles = F.coalesce(F.col("__nfiles"), F.lit(0))
    ph = (F.when(F.col("__exact").isNotNull(), F.lit(MEDIA_PLACEHOLDER))
          .when(nfiles > 0, F.expr(f"repeat('{VIDEO_PLACEHOLDER}', __nfiles)"))
          .otherwise(F.lit(MEDIA_PLACEHOLDER)))
    m = m.select(*keys, "pos", ph.alias("__ph"),
                 F.when(F.col("__exact").isNull() & (nfiles > 0), nfiles).otherwise(0).alias("__nv"),
                 (F.col("__exact").isNull() & (nfiles == 0)).cast("int").alias("__miss"))
    per = m.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("pos", "__ph"))).alias("__phs"),
        F.count(F.lit(1)).alias("n_media"), F.sum("__nv").alias("n_video_files"), F.sum("__miss").alias("n_missing"))
    x = bodies.join(per, keys, "inner")
    joined = F.array_join(F.transform("__phs", lambda s: s["__ph"]), "\n\n")
    md = F.concat(F.when(F.col("body") == F.col("media_link"), F.lit("")).otherwise(F.lit("\n\n")), joined)
    return x.select(*keys, F.replace(F.col("body"), F.col("media_link"), md).alias("body"),
                    "n_media", "n_video_files", "n_missing")


def media_tags(media: DataFrame, listing: DataFrame, bodies: DataFrame, keys: tuple = ("post_id",), scope: tuple = (),
               any_prefix: bool = False, folder: str = MEDIA_FOLDER) -> DataFrame:
    """``keys, html_body`` with the media link of ``bodies(keys, html_body, media_link)`` replaced by tags: a photo's own
    file as an image, else each file of the post (by name) as a video, else the link itself."""
    keys, scope = list(keys), list(scope)
    m = media.withColumn("__exp", F.concat(F.col("post_id"), F.lit("-"), basename(F.col("media_url"))))
    exact = listing.select(*scope, F.col("file").alias("__exp"), F.lit(True).alias("__exact")).distinct()
    m = m.join(exact, [*scope, "__exp"], "left")
    files = files_of_posts(listing, any_prefix).groupBy(*scope, "post_id").agg(F.sort_array(F.collect_set("file")).alias("__files"))
    m = m.join(files, [*scope, "post_id"], "left")
    src = lambda f: F.concat(F.lit(f"{folder}/"), f)
    image = F.concat(F.lit('<img src="'), src(F.col("__exp")), F.lit('"/>'))
    videos = F.array_join(F.transform("__files", lambda f: F.concat(F.lit(HTML_VIDEO[0]), src(f), F.lit(HTML_VIDEO[1]))), "")
    tag = F.when(F.col("__exact").isNotNull(), image).when(F.size("__files") > 0, videos)
    per = m.select(*keys, "pos", tag.alias("__tag")).groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("pos", "__tag"))).alias("__tags"))
    link, body = F.col("media_link"), F.col("html_body")
    anchor = F.concat(F.lit('<a href="'), link, F.lit('">'), link, F.lit("</a>"))
    tags = F.array_join(F.transform("__tags", lambda t: F.coalesce(t["__tag"], anchor)), "<br>")
    html = F.concat(F.when(body == link, F.lit("")).otherwise(F.lit("<br>")), tags)
    return bodies.join(per, keys).select(*keys, F.replace(body, link, html).alias("html_body"))


def photo_source(media_url: Column) -> Column:
    """P13 (photo): ``https://pbs.twimg.com/media/<name>:orig``."""
    return F.concat(F.lit(PHOTO_URL_PREFIX), basename(media_url), F.lit(":orig"))


def best_variants(variants: DataFrame, key_cols: list[str]) -> DataFrame:
    """Highest integer bitrate per media; variants without a bitrate are ignored,
    bitrate 0 is valid, the first variant wins ties; media with no rated variant get no
    row.  ``variants(key..., pos, bitrate string, url)``; ``max_by`` aggregates partially."""
    v = variants.withColumn("__br", F.col("bitrate").try_cast("bigint")).filter(F.col("bitrate").isNotNull())
    return v.groupBy(*key_cols).agg(
        F.max_by("url", F.struct(F.col("__br"), F.negative(F.col("pos")))).alias("best_url"),
        F.max("__br").alias("best_bitrate"))


def media_manifest(media: DataFrame, listing: DataFrame, best: DataFrame, keys: tuple = ("post_id",), scope: tuple = (),
                   any_prefix: bool = False) -> DataFrame:
    """Where the best version of every kept media file is found: ``keys, pos, kind, media_file, source``.

    A medium whose own file is in ``listing(scope, file, post_id)`` is a photo, its source the full-size url; otherwise
    every file of the post is a video's, its source the medium's best variant (``best(keys, pos, best_url)``; without
    one there is no row).  Media without any file have none."""
    keys, scope = list(keys), list(scope)
    m = media.withColumn("__exp", F.concat(F.col("post_id"), F.lit("-"), basename(F.col("media_url"))))
    exact = listing.select(*scope, F.col("file").alias("__exp"), F.lit(True).alias("__exact")).distinct()
    m = m.join(exact, [*scope, "__exp"], "left")
    photos = m.where("__exact").select(*keys, "pos", F.lit("photo").alias("kind"), F.col("__exp").alias("media_file"),
                                       photo_source(F.col("media_url")).alias("source"))
    files = files_of_posts(listing, any_prefix).select(*scope, "post_id", F.col("file").alias("media_file")).distinct()
    videos = m.where(F.col("__exact").isNull()).join(files, list(dict.fromkeys([*scope, "post_id"]))).join(best, [*keys, "pos"])
    return photos.unionByName(videos.select(*keys, "pos", F.lit("video").alias("kind"), "media_file", F.col("best_url").alias("source")))


def retry_ledger(results: DataFrame, tries: int = 5, key: str = "file") -> DataFrame:
    """M2: ``file, attempts, state, bytes`` after the retry rounds, from supplied results ``(file, round, success, bytes)``.

    A file takes part in round 1 and in each further one while all before it failed; results of rounds it does not
    reach do not count.  It ends as ``best`` with its first success, ``failed`` after ``tries`` failures, and is
    ``pending`` while the result of its next round is missing.  Of several results of one round a success counts."""
    # a few plain numbers for each round: one pass by hash, without lists to sort
    outcome = F.when(F.col("success"), 2).when(~F.col("success"), 1).otherwise(0)
    here = lambda n: F.col(key).isNotNull() & (F.col("round") == n)
    known = results.groupBy(key).agg(*[agg for n in range(1, tries + 1) for agg in (
        F.max(F.when(here(n), outcome)).alias(f"__best{n}"),
        *[F.max(F.when(here(n) & (outcome == k), F.col("bytes"))).alias(f"__bytes{n}_{k}") for k in range(3)])])

    def result(n):
        best = F.col(f"__best{n}")
        size = F.coalesce(*[F.when(best == k, F.col(f"__bytes{n}_{k}")) for k in range(3)])
        return F.when(best.isNotNull(), F.struct(F.lit(n).alias("round"), F.struct(
            F.when(best > 0, best == 2).alias("success"), size.alias("bytes")).alias("r")))

    start = F.struct(F.lit(0).cast("long").alias("attempts"), F.lit(False).alias("done"), F.lit(0).cast("long").alias("bytes"))

    def step(a, x):
        counts = ~a["done"] & (x["round"] == a["attempts"] + 1)
        return F.struct((a["attempts"] + counts.cast("long")).alias("attempts"), (a["done"] | (counts & x["r"]["success"])).alias("done"),
                        (a["bytes"] + F.when(counts, x["r"]["bytes"].cast("long")).otherwise(F.lit(0).cast("long"))).alias("bytes"))
    rounds = F.filter(F.array(*[result(n) for n in range(1, tries + 1)]), lambda x: x.isNotNull())
    end = F.aggregate(rounds, start, step)
    out = known.select(key, end.alias("e"))
    state = F.when(F.col("e.done"), "best").when(F.col("e.attempts") >= tries, "failed").otherwise("pending")
    return out.select(key, F.col("e.attempts").alias("attempts"), state.alias("state"), F.col("e.bytes").alias("bytes"))


def retry_rounds(ledger: DataFrame, first_pause: float = 0.25, longer_by: float = 2.0) -> DataFrame:
    """M2: ``round, n_tested, n_success, n_left, pause``: what each round of the ledger tested and left for the next, and
    the pause between its requests."""
    rounds = ledger.where("attempts > 0").select("state", "attempts", F.explode(F.sequence(F.lit(1).cast("long"), "attempts")).alias("round"))
    won = (F.col("state") == "best") & (F.col("round") == F.col("attempts"))
    out = rounds.groupBy("round").agg(F.count(F.lit(1)).alias("n_tested"), F.count_if(won).alias("n_success"))
    return out.withColumn("n_left", F.col("n_tested") - F.col("n_success")).withColumn(
        "pause", F.lit(first_pause) + (F.col("round") - 1) * longer_by)


def upgrade_decisions(files: DataFrame) -> DataFrame:
    """M1/M2: decision per file from local/remote byte sizes, pixel sizes (-1 unknown)
    and the response status; ``retry`` marks the failed ones."""
    lb, rb = F.col("local_bytes"), F.col("remote_bytes")
    lw, lh, rw, rh = F.col("local_w"), F.col("local_h"), F.col("remote_w"), F.col("remote_h")
    all_unknown = (lw == -1) & (lh == -1) & (rw == -1) & (rh == -1)
    any_unknown = (lw == -1) | (lh == -1) | (rw == -1) | (rh == -1)
    pb, pa = lw.cast("bigint") * lh, rw.cast("bigint") * rh
    unreadable = (lb == 0) | (pb == 0)
    decision = (F.when((F.col("status") != 200) | unreadable, "fail").when(rb == lb, "same_size")
                .when(all_unknown, "replaced").when(any_unknown, "inconclusive")
                .when(pa >= pb, "replaced").otherwise("smaller_pixels"))
    success = F.col("decision").isin("same_size", "replaced", "smaller_pixels")
    downloaded = F.when(F.col("decision").isin("fail", "same_size"), F.lit(0)).otherwise(rb)
    pct_bytes = F.when(F.col("decision") == "replaced", F.try_divide(F.lit(100.0) * (rb - lb), lb))
    pct_pixels = F.when(F.col("decision").isin("replaced", "smaller_pixels") & ~all_unknown,
                        F.try_divide(F.lit(100.0) * (pa - pb), pb))
    return (files.withColumn("decision", decision).withColumn("success", success)
            .withColumn("bytes_downloaded", downloaded.cast("bigint"))
            .withColumn("pct_bytes", pct_bytes).withColumn("pct_pixels", pct_pixels)
            .withColumn("retry", ~F.col("success")))


def upgrade_summary(decisions: DataFrame) -> DataFrame:
    """Files, successes, retries, bytes downloaded (also in MB and GB)."""
    return decisions.agg(
        F.count(F.lit(1)).cast("bigint").alias("n_files"),
        F.count_if("success").cast("bigint").alias("n_success"),
        F.count_if("retry").cast("bigint").alias("n_retry"),
        F.sum("bytes_downloaded").cast("bigint").alias("total_bytes"),
    ).withColumn("total_mb", F.col("total_bytes") / F.lit(float(2 ** 20))).withColumn(
        "total_gb", F.col("total_bytes") / F.lit(float(2 ** 30)))
