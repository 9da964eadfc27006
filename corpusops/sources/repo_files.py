"""Repository scan in two steps, and the same rules on a (path, content) table.

Spark's own file readers skip every path part that starts with ``_`` or ``.``; a corpus of
Python packages needs ``__init__.py``, so the listing is done here, by a Python data source. The
driver opens only enough folders to have work for the executors; each executor lists its own
subtrees. Paths and sizes are then dealt over tasks of about equal bytes, which read the files, so it
does not matter how the files lie in folders.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from corpusops.operators.skew import salted_left_join
from corpusops.schemas import FILE, LISTED
from corpusops.session import durable

# Folder names a scan skips unless the caller names others, and the file suffix.
IGNORED_DIRS = (".git", "__pycache__", "venv", ".venv", "node_modules", ".mypy_cache")
SUFFIX = ".py"

# bytes that one task of the second step reads, about, and that it hands over at once
TASK_BYTES = 64 << 20
FLUSH_BYTES = 8 << 20
# requested paths that are broadcast, in bytes
ASKED_BYTES = 8 << 20


class _Share(InputPartition):
    """One folder, with or without what lies below it, and one share of its own files."""

    def __init__(self, folder: str, deep: bool, share: int = 0, shares: int = 1):
        self.folder, self.deep, self.share, self.shares = folder, deep, share, shares


def _split_folder(folder: str, ignored: frozenset) -> tuple[list[str], list[str]]:
    """Sub-folders to enter and file names; an unreadable folder counts as empty.

    A symlinked folder is not entered, as links may form a loop.
    """
    folders, files = [], []
    try:
        with os.scandir(folder) as entries:
            for entry in entries:
                if entry.is_dir():
                    if entry.name not in ignored and not entry.is_symlink():
                        folders.append(entry.path)
                else:
                    files.append(entry.name)
    except OSError:
        pass
    return folders, files


class RepoReader(DataSourceReader):
    def __init__(self, root: str, ignored: frozenset, suffix: str, width: int):
        self.root, self.ignored, self.suffix, self.width = root, ignored, suffix, width

    def partitions(self) -> list[_Share]:
        opened, frontier = [], [self.root]
        while frontier and len(frontier) < self.width and len(opened) < self.width:
            folder = frontier.pop(0)
            opened.append(folder)
            frontier.extend(_split_folder(folder, self.ignored)[0])
        shares = max(1, self.width // max(1, len(opened)))
        own_files = [_Share(f, False, i, shares) for f in opened for i in range(shares)]
        return own_files + [_Share(f, True) for f in frontier]

    def read(self, partition: _Share) -> Iterator[tuple]:
        stack = [partition.folder]
        while stack:
            folder = stack.pop()
            below, names = _split_folder(folder, self.ignored)
            if partition.deep:
                stack.extend(below)
            for name in names:
                mine = partition.shares == 1 or zlib.crc32(os.fsencode(name)) % partition.shares == partition.share
                if mine and name.endswith(self.suffix):
                    path = os.path.join(folder, name)
                    yield os.path.relpath(path, self.root), _size_or_none(path)


def _size_or_none(path: str) -> int | None:
    try:
        return os.stat(path).st_size
    except OSError:
        return None


def _bytes_or_none(path: str) -> bytes | None:
    try:
        with open(path, "rb") as handle:
            return handle.read()
    except OSError:
        return None


class RepoFiles(DataSource):
    """(path, size) by ``spark.read.format("repo_files").load(root)``; options ``ignore`` (comma list), ``suffix``, ``width``."""

    @classmethod
    def name(cls) -> str:
        return "repo_files"

    def schema(self):
        return LISTED

    def reader(self, schema) -> RepoReader:
        ignore = self.options.get("ignore")
        ignored = frozenset(IGNORED_DIRS if ignore is None else [d for d in ignore.split(",") if d])
        return RepoReader(
            os.path.realpath(self.options["path"]),
            ignored,
            self.options.get("suffix", SUFFIX),
            int(self.options.get("width", "32")),
        )


def list_repo(spark: SparkSession, root: str, ignore_dirs=None, suffix: str = SUFFIX) -> DataFrame:
    """(path relative to ``root``, size) of every matching file on a mounted filesystem; no file is opened."""
    if not os.path.isdir(root):
        raise FileNotFoundError(f"no folder {root}")
    spark.dataSource.register(RepoFiles)
    reader = spark.read.format("repo_files").option("suffix", suffix)
    reader = reader.option("width", str(max(8, 2 * spark.sparkContext.defaultParallelism)))
    if ignore_dirs is not None:
        reader = reader.option("ignore", ",".join(ignore_dirs))
    return reader.load(root)


def read_listed(listed: DataFrame, root: str, task_bytes: int = TASK_BYTES) -> DataFrame:
    """(path, content) of listed files, each task reading about ``task_bytes``.

    A file is dealt by a hash of its path to one of as many bins as the sizes need; no folder is a task
    of its own. A file that can't be read has no content.
    """
    spark = listed.sparkSession
    total = listed.agg(F.sum("size")).first()[0] or 0
    bins = max(spark.sparkContext.defaultParallelism, -(-total // task_bytes))
    base = os.path.realpath(root)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, contents, held = [], [], 0
            for path in batch.column("path").to_pylist():
                content = _bytes_or_none(os.path.join(base, path))
                paths.append(path)
                contents.append(content)
                held += len(content or b"")
                if held >= FLUSH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(contents, pa.binary())], ["path", "content"])
                    paths, contents, held = [], [], 0
            if paths:
                yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(contents, pa.binary())], ["path", "content"])

    return listed.select("path").repartition(bins, "path").mapInArrow(read, FILE)


def scan_repo(spark: SparkSession, root: str, ignore_dirs=None, suffix: str = SUFFIX) -> DataFrame:
    """(path relative to ``root``, content bytes) of every matching file on a mounted filesystem."""
    # the listing is written, as it is read twice: for its bytes, and to deal it
    return read_listed(durable(list_repo(spark, root, ignore_dirs, suffix)), root)


def in_ignored_dir(path: Column, ignore_dirs=IGNORED_DIRS) -> Column:
    """True when a folder on the path (never the file name) carries an ignored name."""
    parts = F.split(path, "/")
    folders = F.slice(parts, F.lit(1), F.size(parts) - 1)
    return F.arrays_overlap(folders, F.array(*[F.lit(d) for d in ignore_dirs])) if ignore_dirs else F.lit(False)


def relative_path(path: Column, root: str) -> Column:
    prefix = root.rstrip("/") + "/"
    return F.when(path.startswith(prefix), F.substring(path, len(prefix) + 1, 2147483647)).otherwise(path)


def select_files(files: DataFrame, root: str, ignore_dirs=IGNORED_DIRS, suffix: str = SUFFIX) -> DataFrame:
    """The scan's rules on a (path, ...) table: suffix, ignored folders, path relative to the root."""
    relative = files.where(F.col("path").endswith(suffix)).withColumn("path", relative_path(F.col("path"), root))
    return relative.where(~in_ignored_dir(F.col("path"), tuple(ignore_dirs)))


def decode_files(files: DataFrame) -> DataFrame:
    """Adds ``text`` and ``reject``: bytes that are no UTF-8, or were unreadable, keep their row and a reason.

    Line endings become ``\\n``, as text-mode reading gives them.
    """
    as_text = F.col("content").cast("string")
    text = F.regexp_replace(F.try_validate_utf8(as_text), "\r\n?", "\n")
    reason = F.when(F.col("content").isNull(), "unreadable").when(~F.is_valid_utf8(as_text), "not utf-8")
    return files.select(*[c for c in files.columns if c != "content"], text.alias("text"), reason.alias("reject"))


def lookup_files(requests: DataFrame, files: DataFrame) -> DataFrame:
    """Content of each requested path, or a message: the path is not there, or its file has no readable text.

    Many requests may ask for one path, so the join is salted. A path listed twice counts once. Only
    files that are asked for move; few requests go to the files, so that not even these are shuffled
    before they are found.
    """
    # The not-found message and the head of the read-error message.
    missing = F.format_string("Error: %s not found in repo.", F.col("path"))
    unread = F.lit("Error reading file: ")
    reject = F.col("reject") if "reject" in files.columns else F.lit(None).cast("string")
    asked = requests.where(F.col("path").isNotNull()).select("path").distinct()
    if (requests.select(F.sum(F.octet_length("path"))).first()[0] or 0) <= ASKED_BYTES:
        asked = F.broadcast(asked)
    known = files.join(asked, "path", "left_semi").groupBy("path").agg(F.min("text").alias("text"), F.min(reject).alias("_reject")).withColumn("found", F.lit(True))
    return salted_left_join(requests, known, "path").select(
        *requests.columns,
        F.coalesce("found", F.lit(False)).alias("found"),
        F.when(F.col("found"), F.coalesce("text", F.concat(unread, F.coalesce("_reject", F.lit("no text"))))).otherwise(missing).alias("output"),
    )
