"""Source files below a folder as rows ``path, content, length``.

Spark's own file readers leave out empty files and names that start with ``_`` or ``.``;
both count here, so folders are listed and files read by functions in tasks. Listing goes
level by level: the folders of a level are a table, tasks list them, and what they hold is
written to the shared folder before the next level starts from it. Neither file nor folder
names reach the driver, whatever the shape of the tree, and a lost executor repeats at most
its part of one level.

Which folders are entered and which files are taken are column expressions over this
listing. They, and any filter of the caller's on ``path`` or ``length``, are settled before
a file is opened: refused files are never read. The files left are dealt over tasks by
bytes and number, so one repository or folder with most of the files is spread like any
other.

Paths may be local (or on a mounted shared folder) or any URI that ``pyarrow.fs`` knows.
Links to folders are not followed.
"""

from __future__ import annotations

import os
import posixpath
import re
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codesift import fixed_values as fixed
from codesift.session import written
from codesift.sources.tables import FILE_SCHEMA

# What a task reads: about so many bytes, and at most so many files.
TASK_BYTES = 128 << 20
TASK_FILES = 4096
# Folders that a task lists.
TASK_FOLDERS = 256
_BATCH_BYTES = 32 << 20
_ENTRY_SCHEMA = "path string, name string, folder boolean, length long"
_ENTRY_ROWS = 10_000
_FILE = pa.schema([("path", pa.string()), ("content", pa.binary()), ("length", pa.int64())])


def filesystem_of(path: str) -> tuple[fs.FileSystem, str]:
    """The file system a path or URI names, and the path on it."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def enters(policy: str, folder: Column) -> Column:
    """Whether a folder of that name, below a repository's own folder, is read."""
    if policy == "mining":
        return ~folder.startswith(".") & ~F.lower(folder).contains("test")
    if policy == "scanning":
        return ~folder.isin(list(fixed.SCAN_SKIPPED_DIRECTORIES))
    if policy == "all":
        return F.lit(True)
    raise ValueError(f"unknown policy {policy!r}")


def takes(policy: str, path: Column, extensions: tuple[str, ...] = fixed.CODE_EXTENSIONS) -> Column:
    """Whether a file is read; no extensions stand for all of them."""
    named = F.lit(True)
    if extensions:
        # A dot that begins a name begins no extension.
        named = F.regexp_extract(path, r"[^/](\.[^./]*)$", 1).isin(list(extensions))
    if policy == "scanning":
        skipped = "|".join(re.escape(part) for part in fixed.SCAN_SKIPPED_PATH_PARTS)
        return named & ~path.rlike(skipped)
    return named


def _listed(filesystem: fs.FileSystem, folder: str) -> Iterator[tuple[str, bool, int | None]]:
    """``name, is a folder, length`` of what is in a folder, but for links to folders."""
    if isinstance(filesystem, fs.LocalFileSystem):
        with os.scandir(folder) as entries:
            for entry in entries:
                if entry.is_dir():
                    if not entry.is_symlink():
                        yield entry.name, True, None
                    continue
                try:
                    length = entry.stat().st_size
                except OSError:
                    length = None
                yield entry.name, False, length
        return
    for info in filesystem.get_file_info(fs.FileSelector(folder)):
        yield info.base_name, info.type == fs.FileType.Directory, info.size


def _entries(folders: DataFrame, given: str) -> DataFrame:
    """What is in the folders of column ``path``, listed by tasks.

    A folder that cannot be listed comes out as a file of that path, which cannot be read.
    """
    _, root = filesystem_of(given)

    def run(batches):
        filesystem, _ = filesystem_of(given)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows: list[tuple] = []
                try:
                    for name, folder, length in _listed(filesystem, root + path[len(given):] or "/"):
                        rows.append((f"{path.rstrip('/')}/{name}", name, folder, length))
                        if len(rows) == _ENTRY_ROWS:
                            yield _batch(rows, _ENTRY)
                            rows = []
                except OSError:
                    rows.append((path, posixpath.basename(path), False, None))
                yield _batch(rows, _ENTRY)

    return folders.select("path").mapInArrow(run, _ENTRY_SCHEMA)


_ENTRY = pa.schema([("path", pa.string()), ("name", pa.string()), ("folder", pa.bool_()), ("length", pa.int64())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kind) for column, kind in zip(columns, schema.types)], schema=schema)


def list_code_files(spark: SparkSession, root: str, policy: str = "all",
                    extensions: tuple[str, ...] = fixed.CODE_EXTENSIONS) -> DataFrame:
    """``path, length`` of the files that a policy takes below ``root``; none is opened.

    Folders right below the root of a mining job are repositories and are entered whatever
    their names. A single file as the root is taken as it is.
    """
    given = root.rstrip("/") or "/"
    filesystem, inner = filesystem_of(given)
    kind = filesystem.get_file_info(inner.rstrip("/") or "/").type
    if kind == fs.FileType.NotFound:
        raise FileNotFoundError(root)
    top = spark.range(1).select(F.lit(given).alias("path"), F.lit(None).cast("long").alias("length"))
    if kind == fs.FileType.File:
        return top
    found, folders, number = None, top.select("path"), 1
    enters(policy, F.lit(""))  # an unknown policy is refused before anything is listed
    repositories = policy == "mining"
    while number:
        parts = max(1, min(number, max(spark.sparkContext.defaultParallelism, -(-number // TASK_FOLDERS))))
        level = written(_entries(folders.repartition(parts, "path"), given), "listing")
        files = level.filter(~F.col("folder")).filter(takes(policy, F.col("path"), extensions)).select("path", "length")
        found = files if found is None else found.unionByName(files)
        folders = level.filter("folder")
        if not repositories:
            folders = folders.filter(enters(policy, F.col("name")))
        repositories = False
        folders = folders.select("path")
        number = folders.count()
    return found


def with_contents(files: DataFrame, root: str) -> DataFrame:
    """``path, content, length`` of listed files below ``root``, each read by one task.

    A file that cannot be read keeps a row without content.
    """
    given = root.rstrip("/") or "/"
    _, inner = filesystem_of(given)
    inner = inner.rstrip("/")
    size, number = files.agg(F.sum("length"), F.count("*")).first()
    parts = max(-(-(size or 0) // TASK_BYTES), -(-number // TASK_FILES),
                min(number, files.sparkSession.sparkContext.defaultParallelism * 4), 1)

    def run(batches):
        filesystem, _ = filesystem_of(given)
        for batch in batches:
            rows: list[tuple] = []
            held = 0
            for path in batch.column(0).to_pylist():
                try:
                    with filesystem.open_input_stream(inner + path[len(given.rstrip("/")):]) as stream:
                        content = stream.read()
                except OSError:
                    content = None
                rows.append((path, content, None if content is None else len(content)))
                held += len(content or b"")
                if held > _BATCH_BYTES:
                    yield _batch(rows, _FILE)
                    rows, held = [], 0
            yield _batch(rows, _FILE)

    return files.select("path").repartition(parts, "path").mapInArrow(run, FILE_SCHEMA)


def read_code_files(spark: SparkSession, root: str, policy: str = "all",
                    extensions: tuple[str, ...] = fixed.CODE_EXTENSIONS) -> DataFrame:
    """Rows of all files below ``root`` under a path policy.

    ``mining`` skips hidden and test folders, ``scanning`` skips a list of folder
    names and path parts, ``all`` takes every folder.
    """
    return with_contents(list_code_files(spark, root, policy, extensions), root)


def write_code_files(df: DataFrame, root: str, path: str = "path", content: str = "content") -> int:
    """Land rows as files below ``root``, from the tasks that hold them; gives the count.

    A task that runs again writes the same files again.
    """
    filesystem, base = filesystem_of(root)

    def land(batches):
        for batch in batches:
            for name, data in zip(batch[path], batch[content], strict=True):
                target = posixpath.join(base, name)
                filesystem.create_dir(posixpath.dirname(target), recursive=True)
                with filesystem.open_output_stream(target) as stream:
                    stream.write(bytes(data))
            yield batch[[path]].groupby(path).size().rename("n").reset_index()[["n"]]

    landed = df.select(path, content).mapInPandas(land, "n long")
    return landed.agg({"n": "sum"}).first()[0] or 0
