"""Chunking and mutation as table functions, for SQL: ``FROM files f, LATERAL chunk_units(f.path, f.text)``."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from corpusops.operators.chunking import _units
from corpusops.operators.mutation import _labelled
from corpusops.schemas import CHUNK, MUTANT


class ChunkUnits:
    """The structural chunks of one file; none if it has no text or does not parse."""

    def eval(self, path: str, text: str) -> Iterator[tuple]:
        for *row, error in _units(path, text) if text is not None else ():
            if error is None:
                yield tuple(row)


class CodeMutants:
    """The labelled defects of one source; none if it has no code or does not parse."""

    def eval(self, source_id: int, code: str) -> Iterator[tuple]:
        for row in _labelled(source_id, code) if code is not None else ():
            if row[1] == 1:
                yield row


def register(spark: SparkSession) -> None:
    """``chunk_units(path, text)`` and ``code_mutants(source_id, code)`` in the session's SQL; rows cross as Arrow batches."""
    spark.udtf.register("chunk_units", udtf(ChunkUnits, returnType=CHUNK, useArrow=True))
    spark.udtf.register("code_mutants", udtf(CodeMutants, returnType=MUTANT, useArrow=True))
