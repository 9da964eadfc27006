"""Structural, fixed-size and line chunking, and what a fixed size does to structural units."""

from __future__ import annotations

import ast
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusops.functions.text import NEWLINE
from corpusops.operators.arrow_rows import flat_map
from corpusops.schemas import CHUNK, PARSED_UNIT

# Chunk kinds, the name of a module's own chunk, the default chunk size.
KIND_OF = {ast.ClassDef: "class", ast.FunctionDef: "function", ast.AsyncFunctionDef: "function"}
MODULE_NAME, MODULE_KIND = "__module__", "module_docstring"
CHUNK_CHARS = 500

_NEWLINES = re.compile(NEWLINE)


def _units(file: str, text: str) -> Iterator[tuple]:
    """Chunk rows of one file in breadth-first order, or a single row that says why it has none."""
    try:
        tree = ast.parse(text)
        overview = ast.get_docstring(tree)
    except (SyntaxError, ValueError, RecursionError, MemoryError) as problem:
        error = "SyntaxError" if isinstance(problem, SyntaxError) else type(problem).__name__
        yield (None, file) + (None,) * 9 + (error,)
        return
    ordinal = 0
    if overview:
        yield (f"{file}::{MODULE_NAME}", file, MODULE_NAME, MODULE_KIND, 1, 1, overview, overview, 0, None, None, None)
        ordinal = 1
    # line i (1-based) is text[edges[2 * i - 2]:edges[2 * i - 1]]
    edges = [0]
    for found in _NEWLINES.finditer(text):
        edges += found.span()
    edges.append(len(text))
    for node in ast.walk(tree):
        kind = KIND_OF.get(type(node))
        if kind is None:
            continue
        start, end = edges[2 * node.lineno - 2], edges[2 * node.end_lineno - 1]
        code = _NEWLINES.sub("\n", text[start:end])
        yield (
            f"{file}::{node.name}", file, node.name, kind, node.lineno, node.end_lineno,
            ast.get_docstring(node), code, ordinal, start, end, None,
        )
        ordinal += 1


def parse_units(files: DataFrame) -> DataFrame:
    """Chunks of each (path, text) row, plus one row with ``error`` per file that does not parse."""
    ready = files.where(F.col("text").isNotNull()).select("path", "text")
    return flat_map(ready, _units, PARSED_UNIT)


def chunk_code(files: DataFrame) -> DataFrame:
    """One row per class or function at any depth, after the module docstring where there is one.

    A unit's text starts at its ``def`` or ``class`` line, so decorators are not part of it.
    """
    return parse_units(files).where(F.col("error").isNull()).select(*CHUNK.fieldNames())


def parse_failures(files: DataFrame) -> DataFrame:
    return parse_units(files).where(F.col("error").isNotNull()).select("file", "error")


def chunk_key() -> Column:
    """Surrogate key: ``id`` repeats when two classes of a file share a method name."""
    return F.md5(F.concat_ws("|", "file", F.col("start_line").cast("string"), "type", "name"))


def chunk_fixed(docs: DataFrame, text: str = "text", size: int = CHUNK_CHARS) -> DataFrame:
    """Runs of ``size`` characters; empty text has none, the last may be short.

    One regex pass is linear in the text, where a substring per chunk would restart at its head.
    """
    runs = F.regexp_extract_all(F.col(text), F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    rest = [c for c in docs.columns if c != text]
    return docs.select(*rest, F.posexplode(runs).alias("chunk_index", "chunk")).withColumn("n_chars", F.length("chunk"))


def _running(lengths: pa.Array) -> pa.Array:
    sizes = lengths.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    # the rows of a batch lie one behind another: one sum over all, less what it was where a row begins
    starts = lengths.flatten().to_numpy(zero_copy_only=False) + 1
    total = np.append(0, np.cumsum(starts))
    ends = np.cumsum(sizes)
    starts = total[:-1] - np.repeat(total[ends - sizes], sizes)
    return pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(starts), mask=lengths.is_null())


def _starts(lengths: Column) -> Column:
    """Offset of each line from the lengths of those before it, one newline after each."""
    return F.arrow_udf(_running, "array<bigint>")(lengths)


def chunk_lines(docs: DataFrame, text: str = "text") -> DataFrame:
    """Each non-empty line as a unit with its character offsets ``[char_start, char_end)``.

    Only the line lengths cross into Python; the text stays in the JVM, and nothing is shuffled.
    """
    rest = [c for c in docs.columns if c != text]
    split = docs.select(*rest, F.split(F.col(text), "\n", -1).alias("parts"))
    lengths = F.transform("parts", lambda line: F.length(line).cast("bigint"))
    placed = split.withColumn("starts", _starts(lengths))
    each = placed.select(*rest, F.posexplode(F.arrays_zip("parts", "starts")).alias("line_index", "line"))
    units = each.select(
        *rest,
        "line_index",
        F.col("line.starts").alias("char_start"),
        (F.col("line.starts") + F.length("line.parts")).alias("char_end"),
        F.col("line.parts").alias("unit"),
    )
    return units.where(F.col("unit") != "")


def filter_chunks(chunks: DataFrame, file: str | Column | None = None, kind: str = "function") -> DataFrame:
    """Chunks of one kind, in one file where one is named."""
    of_kind = chunks.where(F.col("type") == kind)
    return of_kind if file is None else of_kind.where(F.col("file") == file)


def first_named(chunks: DataFrame, *scope: str) -> DataFrame:
    """First chunk of each name, in ``scope`` (say, per file), by walk order; with its length.

    The first places are found from the keys alone; the text of no other chunk is aggregated. ``chunks``
    is read twice, so give a written table where it is costly to make.
    """
    keys = list(dict.fromkeys([*scope, "name"]))
    least = chunks.groupBy(*keys).agg(F.min(F.struct("file", "ordinal")).alias("_first"))
    places = least.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("_first.file").alias("_at_file"), F.col("_first.ordinal").alias("_at_ordinal"))
    pairs = [*[(k, f"_{k}") for k in keys], ("file", "_at_file"), ("ordinal", "_at_ordinal")]
    first = chunks.join(places, [F.col(a).eqNullSafe(F.col(b)) for a, b in pairs], "left_semi")
    # a file that was listed twice has its chunks twice
    others = [c for c in chunks.columns if c not in keys]
    return first.dropDuplicates(keys).select(*keys, *others).withColumn("n_chars", F.length("code"))


def is_cut(start: Column, end: Column, size: int = CHUNK_CHARS) -> Column:
    """A fixed boundary falls inside ``[start, end)`` when its ends lie in different chunks."""
    return F.floor(start / size) != F.floor((end - 1) / size)


def cut_pieces(start: Column, end: Column, size: int = CHUNK_CHARS) -> Column:
    return F.floor((end - 1) / size) - F.floor(start / size) + 1


def split_rate(units: DataFrame, *keys: str, size: int = CHUNK_CHARS) -> DataFrame:
    """How many units a fixed size would cut, and into how many pieces at most."""
    placed = units.where(F.col("char_end") > F.col("char_start"))
    start, end = F.col("char_start"), F.col("char_end")
    return placed.groupBy(*keys).agg(
        F.count("*").alias("units"),
        F.count_if(is_cut(start, end, size)).alias("cut_units"),
        F.max(cut_pieces(start, end, size)).alias("most_pieces"),
        F.avg(is_cut(start, end, size).cast("double")).alias("cut_rate"),
    )


def chunk_counts(chunks: DataFrame) -> DataFrame:
    return chunks.groupBy("type").agg(
        F.count("*").alias("chunks"),
        F.sum(F.length("code")).alias("chars"),
        F.max(F.length("code")).alias("longest"),
    )


def listing(chunks: DataFrame) -> DataFrame:
    """``(type, id, lines)`` per chunk."""
    return chunks.select("type", "id", F.format_string("%d-%d", "start_line", "end_line").alias("lines"))
