"""A sink of files with exact names: one row, one file (K5-K7).

Spark's own writers name files by task.  This data source stages each row's file under a folder of the write and the
task's attempt; only the driver's commit, which sees the messages of the attempts that succeeded, moves files to their
names.  So a retried task leaves no second file, and a write that fails leaves none."""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

STAGED = "_staged-"


def file_system(path: str):
    """(file system, path in it) of a local path or a URI that pyarrow knows."""
    from pyarrow import fs
    local = re.sub("^file:/+", "/", path)
    if "://" not in local:
        return fs.LocalFileSystem(), local.rstrip("/")
    system, inside = fs.FileSystem.from_uri(path)
    return system, inside.rstrip("/")


def parent(path: str) -> str:
    return path.rsplit("/", 1)[0]


@dataclass
class Staged(WriterCommitMessage):
    """Names and staged paths of one task's files."""
    files: list[tuple[str, str]]


class NamedFilesWriter(DataSourceWriter):
    def __init__(self, path: str) -> None:
        self.path, self.job = path, uuid.uuid4().hex

    def write(self, rows: Iterator[Row]) -> Staged:
        system, root = file_system(self.path)
        folder = f"{root}/{STAGED}{self.job}/{uuid.uuid4().hex}"  # an attempt of its own
        system.create_dir(folder, recursive=True)
        files = []
        for n, row in enumerate(rows):
            name = row["name"]
            if not name or name.startswith("/") or ".." in name.split("/"):
                raise ValueError(f"{name!r} is no name below the folder")
            staged = f"{folder}/{n}"
            with system.open_output_stream(staged) as out:
                out.write((row["content"] or "").encode())
            files.append((name, staged))
        return Staged(files)

    def commit(self, messages: list[Staged | None]) -> None:
        system, root = file_system(self.path)
        files = [f for m in messages if m for f in m.files]
        twice = [name for name, n in Counter(name for name, _ in files).items() if n > 1]
        if twice:
            self.abort(messages)
            raise ValueError(f"several rows for the files {sorted(twice)[:5]}")
        for folder in sorted({parent(f"{root}/{name}") for name, _ in files}):
            system.create_dir(folder, recursive=True)
        with ThreadPoolExecutor(16) as pool:
            list(pool.map(lambda f: system.move(f[1], f"{root}/{f[0]}"), files))
        self._clear()

    def abort(self, messages: list[Staged | None]) -> None:
        self._clear()

    def _clear(self) -> None:
        """Remove what this write alone has staged."""
        from pyarrow import fs
        system, root = file_system(self.path)
        staged = f"{root}/{STAGED}{self.job}"
        if system.get_file_info(staged).type != fs.FileType.NotFound:
            system.delete_dir(staged)


class NamedFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "named_files"

    def schema(self) -> str:
        return "name string, content string"

    def writer(self, schema, overwrite: bool) -> NamedFilesWriter:
        return NamedFilesWriter(self.options["path"])


def write_named_files(files: DataFrame, path: str) -> None:
    """Write ``files`` (name, content) below ``path``; a file of the same name is replaced, others stay."""
    files.sparkSession.dataSource.register(NamedFiles)
    files.select("name", "content").write.format("named_files").mode("append").save(path)


def apart(rows: DataFrame, id_col: str, name_col: str, scope: tuple = ()) -> DataFrame:
    """``rows`` with ``name_col`` made unlike for unlike ids within ``scope`` (the archive), letter case aside: the least
    id keeps a name, the others add their id."""
    same = [*scope, F.lower(name_col).alias("__name")]
    first = rows.groupBy(*same).agg(F.min(id_col).alias("__first"))
    x = rows.withColumn("__name", F.lower(name_col)).join(first, [*scope, "__name"])
    unlike = F.when(F.col(id_col) == F.col("__first"), F.col(name_col)).otherwise(
        F.concat_ws("-", F.col(name_col), F.col(id_col).cast("string")))
    return x.withColumn(name_col, unlike).drop("__name", "__first")
