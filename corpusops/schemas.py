"""Declared row types of the tables the operators exchange."""

from pyspark.sql import types as T


def _row(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(name, kind, null) for name, kind, null in fields])


_S, _I, _L, _B = T.StringType(), T.IntegerType(), T.LongType(), T.BooleanType()

FILE = _row(("path", _S, False), ("content", T.BinaryType(), True))

LISTED = _row(("path", _S, False), ("size", _L, True))

CHUNK = _row(
    ("id", _S, True),
    ("file", _S, True),
    ("name", _S, True),
    ("type", _S, True),
    ("start_line", _I, True),
    ("end_line", _I, True),
    ("docstring", _S, True),
    ("code", _S, True),
    ("ordinal", _I, True),
    ("char_start", _I, True),
    ("char_end", _I, True),
)

# one CHUNK per row, or a row with only `file` and `error` when the file does not parse
PARSED_UNIT = T.StructType([*CHUNK.fields, T.StructField("error", _S, True)])

EXAMPLE = _row(("code", _S, True), ("label", _I, True), ("source_id", _L, True), ("mutation", _S, True))

MUTANT = T.StructType(
    [
        *EXAMPLE.fields,
        T.StructField("type_order", _I, True),
        T.StructField("site", _I, True),
        T.StructField("parses", _B, True),
        T.StructField("first_in_source", _B, True),
    ]
)

SITE_COUNT = _row(("source_id", _L, True), ("mutation", _S, True), ("sites", _I, True))

NORMALIZED = _row(("source_id", _L, True), ("code", _S, True), ("changed", _B, True))
