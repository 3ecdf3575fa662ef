"""Archive files of any size (S1): the array is cut at its elements' borders by byte range.

Spark's text source deals a file by byte ranges, and a JSON string never spans lines, so every line can be read
without knowing what came before but for one number, the depth of open braces.  A first pass takes from each range how
deep it leads and how many elements begin in it for each depth it may start at; a running sum over the ranges of a file
gives each range its depth and first element number.  A second pass then cuts each range into elements.  Only the
elements that cross a border are put together by a group."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from threadsmith.sources.archive import STRICT, file_columns

_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"|[{}]')
_BETWEEN = re.compile(r"[\s,\[\];]*")
_RANGE = ["file", "start"]


def first_line(line: str) -> str:
    """The assignment line counts for the brace it may open, and nothing else."""
    return "{" if "{" in line else ""


def depth_profile(line: str) -> tuple[int, Counter]:
    """(change of depth, openings by the depth before them, relative to the line's start)."""
    depth, opens = 0, Counter()
    for m in _TOKEN.finditer(line):
        if m.group() == "{":
            opens[depth] += 1
            depth += 1
        elif m.group() == "}":
            depth -= 1
    return depth, opens


def cut_elements(text: str, depth: int) -> list[tuple[str, bool, bool]]:
    """(fragment, whether the element begins here, whether it ends here) of a text that starts at ``depth``."""
    out, at, begins = [], 0, False
    for m in _TOKEN.finditer(text):
        if m.group() == "{":
            if depth == 0:
                if not _BETWEEN.fullmatch(text, at, m.start()):
                    raise ValueError(f"malformed archive: {text[at:m.start()][:80]!r} between elements")
                at, begins = m.start(), True
            depth += 1
        elif m.group() == "}":
            depth -= 1
            if depth < 0:
                raise ValueError("malformed archive: a brace closes that none has opened")
            if depth == 0:
                out.append((text[at:m.end()], begins, True))
                at, begins = m.end(), False
    rest = text[at:]
    if depth:
        out.append((rest, begins, False))
    elif not _BETWEEN.fullmatch(rest):
        raise ValueError(f"malformed archive: {rest[:80]!r} after an element")
    return out


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each range: its lines, its change of depth, and its openings by relative depth."""
    seen: dict[tuple[str, str, int], list] = {}
    for batch in batches:
        for archive, file, start, _, value in zip(*(c.to_pylist() for c in batch.columns)):
            new = (archive, file, start) not in seen
            total = seen.setdefault((archive, file, start), [0, 0, Counter()])
            change, opens = depth_profile(first_line(value) if new and start == 0 else value)
            total[2].update({total[1] + d: n for d, n in opens.items()})
            total[0] += 1
            total[1] += change
    keys = list(seen)
    opens = [[{"depth": d, "n": n} for d, n in seen[k][2].items()] for k in keys]
    yield pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
         pa.array([k[2] for k in keys], pa.int64()), pa.array([seen[k][0] for k in keys], pa.int64()),
         pa.array([seen[k][1] for k in keys], pa.int64()),
         pa.array(opens, pa.list_(pa.struct([("depth", pa.int64()), ("n", pa.int64())])))],
        ["archive", "file", "start", "lines", "change", "opens"])


_PROFILE = "archive string, file string, start long, lines long, change long, opens array<struct<depth:long,n:long>>"
_FRAGMENT = "archive string, file string, start long, row_ord long, text string, begins boolean, ends boolean"


def _cut_range(key: tuple, lines: pa.Table, places: pa.Table) -> pa.Table:
    """The fragments of one byte range; its lines are at most one split of the file."""
    empty = pa.table({"archive": [], "file": [], "start": [], "row_ord": [], "text": [], "begins": [], "ends": []}, pa.schema(
        [("archive", pa.string()), ("file", pa.string()), ("start", pa.int64()), ("row_ord", pa.int64()), ("text", pa.string()),
         ("begins", pa.bool_()), ("ends", pa.bool_())]))
    if not places.num_rows or not lines.num_rows:  # files of one line have no elements
        return empty
    place = places.to_pylist()[0]
    text = lines.sort_by("line")["value"].to_pylist()
    if place["start"] == 0:
        text[0] = first_line(text[0])
    found, number = [], place["first"] - (place["depth"] > 0)
    for fragment, begins, ends in cut_elements("\n".join(text), place["depth"]):
        found.append((number, fragment, begins, ends))
        number += 1
    n = len(found)
    rows = list(zip(*found)) if found else [[], [], [], []]
    return pa.table([[place["archive"]] * n, [place["file"]] * n, [place["start"]] * n, *map(list, rows)], schema=empty.schema)


def read_js_split(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """``archive, file, row_ord, json`` for every element of every file, as the whole-file reader gives them, without
    a file or a line of it being more than one split.  Elements are objects; files of one line have none; malformed
    ones are an error."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    lines = spark.read.option("lineSep", "\n").text(paths).select(
        *file_columns(), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("line"), "value")
    profiles = lines.mapInArrow(_profiles, _PROFILE)
    order = Window.partitionBy("file").orderBy("start")
    earlier, whole = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("file")
    placed = profiles.withColumn("depth", F.coalesce(F.sum("change").over(earlier), F.lit(0))).withColumn(
        "all_lines", F.sum("lines").over(whole))
    begun = F.aggregate(F.filter("opens", lambda o: o["depth"] == -F.col("depth")), F.lit(0).cast("long"), lambda a, o: a + o["n"])
    placed = placed.withColumn("begun", begun).withColumn("first", F.coalesce(F.sum("begun").over(earlier), F.lit(0)))
    placed = placed.where("all_lines > 1").select("archive", "file", "start", "depth", "first")
    fragments = lines.select("file", "start", "line", "value").groupBy(*_RANGE).cogroup(placed.groupBy(*_RANGE)).applyInArrow(
        _cut_range, _FRAGMENT)
    # the text is null where it is only a part, so that a filter on the element never parses one
    complete = F.col("begins") & F.col("ends")
    whole_ones = fragments.where(complete).select("archive", "file", "row_ord", F.when(complete, F.col("text")).alias("text"))
    parts = fragments.where("NOT (begins AND ends)").groupBy("archive", "file", "row_ord").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "text"))), lambda p: p["text"]), "\n").alias("text"))
    element = F.from_json(F.concat(F.lit("["), "text", F.lit("]")), "array<string>", STRICT)[0]
    return whole_ones.union(parts).select("archive", "file", F.col("row_ord").cast("int").alias("row_ord"), element.alias("json"))
