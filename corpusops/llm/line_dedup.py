"""Lines that many documents share are dropped: built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_DOCS = 10
MIN_CHARS = 1
# the six white-space bytes that are stripped, as in [\x20\x09-\x0D]
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z lower-cased."""
    return F.translate(F.trim(line, F.lit(BLANKS)), UPPER, LOWER)


def flagged_lines(docs: DataFrame, doc_id: str, text: str, min_docs: int, min_chars: int) -> DataFrame:
    """(row, n_lines, dropped, kept): each input row as a struct and what becomes of its lines."""
    value = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(doc_id).alias("id"),
        # texts that share an id keep their lines apart
        F.xxhash64(value).alias("tag"),
        value.alias("text"),
    )
    lines = rows.select("id", "tag", F.posexplode(F.split("text", "\n")).alias("pos", "line")).withColumn("key", line_key(F.col("line")))
    # blank keys never go; 128 bits stand for a line
    hashed = lines.where(F.char_length("key") >= min_chars).select("id", "tag", "pos", F.unhex(F.md5("key")).alias("hash"))
    # an id counts once per line: first within the map task, then over all tasks, so a frequent line arrives summed
    frequent = (
        hashed.groupBy("hash", "id").agg(F.lit(1).alias("one")).groupBy("hash").agg(F.count("*").alias("n")).where(F.col("n") >= min_docs)
    )
    drops = hashed.join(frequent.select("hash"), "hash", "left_semi").groupBy("id", "tag").agg(F.collect_set("pos").alias("drops"))
    joined = rows.join(
        drops.withColumnsRenamed({"id": "drop_id", "tag": "drop_tag"}),
        F.col("id").eqNullSafe(F.col("drop_id")) & (F.col("tag") == F.col("drop_tag")),
        "left",
    )
    # the dropped places in order, with the end of the text as the last, cut the lines into kept runs
    places = F.array_sort(F.concat("drops", F.array(F.size("lines"))))
    marked = joined.withColumn("lines", F.split("text", "\n")).withColumn("places", places)
    runs = F.transform(
        F.arrays_zip(
            F.concat(F.array(F.lit(-1)), F.slice("places", 1, F.size("places") - 1)).alias("low"), F.col("places").alias("high")
        ),
        lambda run: F.slice(F.col("lines"), run["low"] + 2, run["high"] - run["low"] - 1),
    )
    untouched = F.col("drops").isNull()
    return marked.select(
        "row",
        F.size("lines").cast("long").alias("n_lines"),
        F.when(untouched, F.lit(0)).otherwise(F.size("drops")).cast("long").alias("n_dropped"),
        F.when(untouched, F.col("text")).otherwise(F.array_join(F.flatten(runs), "\n")).alias("kept"),
    )


def drop_frequent_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS
) -> DataFrame:
    """(row, n_lines, n_dropped, kept): lines found in ``min_docs`` documents or more go from all of them.

    A null or empty text is one empty line. Lines whose key has fewer than ``min_chars`` code points
    stay. Rows with one id count as one document, null ids as one of their own; repeated rows each
    get the same result; an empty table gives no rows. Other columns stay in ``row``.
    """
    return flagged_lines(docs, doc_id, text, min_docs, min_chars)


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """The documents without frequent lines."""
    kept = drop_frequent_lines(docs, doc_id, text, min_docs, min_chars)
    return kept.select(*[F.col("kept").alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
