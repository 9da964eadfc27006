"""Spelling variants: words one edit apart, and the frequent form that each rare word stands for.

Two words are near if they differ by one inserted, deleted or replaced code point. With m the longer
length this holds if their common prefix and common suffix add up to m - 1 or more, so one of the two
covers half of m: words meet in groups of one half, where padded code-point matrices are compared
block against block. A group of any size is dealt in tiles of bounded size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusops.operators.skew import salted_left_join
from corpusops.session import durable

MIN_LENGTH = 7
MIN_COUNT = 2
# a form occurs at least so many times as often as its variant
DOMINANCE = 10
# one run in so many loses a code point, drawn by checksum
DRAW = 31
RUN = "[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# words of one group that a tile takes from either side, and matrix cells compared at once
BLOCK_WORDS = 2048
CELLS = 1 << 22
# entries of one task of the comparison
TASK_ENTRIES = 1 << 19


def lowered(run: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.when(F.octet_length(run) == F.char_length(run), F.lower(run)).otherwise(F.translate(run, UPPER, LOWER))


def thinned(run: Column, doc_id: Column) -> Column:
    """The run, without one code point where the checksum of document and run says so."""
    drawn = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (drawn % F.char_length(run)).cast("int")
    return F.when(drawn % DRAW == 0, F.concat(F.substr(run, F.lit(1), at), F.substr(run, at + 2))).otherwise(run)


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words that are long and frequent enough; counts are combined in the map tasks."""
    own, value = F.col(f"`{doc_id}`"), F.col(f"`{text}`")
    # a match that starts at a run's head and is greedy is the whole run; shorter runs give no words
    runs = docs.select(own.alias("id"), F.explode(F.regexp_extract_all(value, F.lit(f"{RUN}{{{min_length},}}"), F.lit(0))).alias("run"))
    lower = runs.select("id", lowered(F.col("run")).alias("run"))
    words = lower.select(thinned(F.col("run"), F.col("id")).alias("word")).where(F.char_length("word") >= min_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def _entries(words: DataFrame) -> DataFrame:
    """Each word under its halves, once as the longer and once as the shorter of a pair: (group, m, word, n)."""
    size = F.char_length("word")

    def under(m: Column, side: str) -> Column:
        half = F.floor(m / 2).cast("int") if side == "p" else F.ceil(m / 2).cast("int")
        part = F.left(F.col("word"), half) if side == "p" else F.right(F.col("word"), half)
        return F.struct(m.alias("m"), F.concat(F.lit(side), m.cast("string"), F.lit(":"), part).alias("group"))

    each = F.array(*[under(m, side) for m in (size, size + 1) for side in "ps"])
    return words.select("word", "n", F.explode(each).alias("e")).select("e.group", "e.m", "word", "n")


def _tiled(entries: DataFrame) -> DataFrame:
    """(group, i, j, right, m, word, n): a group with many words goes to one tile per pair of its blocks."""
    ways = F.ceil(F.col("size") / BLOCK_WORDS).cast("int")
    large = entries.groupBy("group").agg(F.count("*").alias("size")).where(F.col("size") > BLOCK_WORDS).select("group", ways.alias("ways"))
    dealt = salted_left_join(entries, durable(large), "group").withColumn("own", F.pmod(F.xxhash64("word"), F.coalesce("ways", F.lit(1))).cast("int"))
    tiles = F.transform(F.sequence(F.lit(0), F.coalesce("ways", F.lit(1)) - 1), lambda b: F.struct(F.least("own", b).alias("i"), F.greatest("own", b).alias("j")))
    each = dealt.withColumn("t", F.explode(tiles))
    return each.select("group", "t.i", "t.j", (F.col("own") == F.col("t.j")).alias("right"), "m", "word", "n")


def _padded(words: list[bytes], width: int, right: bool) -> np.ndarray:
    """Code points side by side, filled with zeros behind or, for suffixes, in front (then read backwards)."""
    sizes = np.array([len(w) for w in words])
    at = np.arange(width)
    out = np.zeros((len(words), width), np.uint8)
    out[at >= width - sizes[:, None] if right else at < sizes[:, None]] = np.frombuffer(b"".join(words), np.uint8)
    return out[:, ::-1] if right else out


def _agreement(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """(tile, a, b) common leading cells of rows a of the left and b of the right block; equal rows agree on all."""
    unlike = left[:, :, None, :] != right[:, None, :, :]
    return np.where(unlike.any(-1), unlike.argmax(-1), left.shape[-1])


def near_pairs(words: list[bytes], group: np.ndarray, m: np.ndarray, by_suffix: np.ndarray, block: np.ndarray, cells: int = CELLS) -> tuple[np.ndarray, np.ndarray]:
    """(a, b) places of near words of one group; ``group`` numbers are sorted, ``block`` tells a tile's two sides apart (-1: one side)."""
    starts = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(starts, len(group)))
    length = np.array([len(w) for w in words], np.int64)
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def compare(left: np.ndarray, right: np.ndarray, width: int) -> None:
        """Rows of either block, (tile, place) with -1 for none."""
        distinct, back = np.unique(np.concatenate([left.ravel(), right.ravel()]), return_inverse=True)
        chosen = [words[x] if x >= 0 else b"" for x in distinct]
        back = back.reshape(-1)
        a, b = back[: left.size].reshape(left.shape), back[left.size :].reshape(right.shape)
        ahead, behind = _padded(chosen, width, False), _padded(chosen, width, True)
        prefix, suffix = _agreement(ahead[a], ahead[b]), _agreement(behind[a], behind[b])
        x, y = left[:, :, None], right[:, None, :]
        longer = m[np.maximum(left[:, :1, None], 0)]
        good = (x >= 0) & (y >= 0) & (x < y) & (np.maximum(length[x], length[y]) == longer) & (prefix + suffix >= longer - 1)
        good &= (block[x] < 0) | (block[x] != block[y])
        # a pair that shares the front half too has been found there
        good &= ~(by_suffix[np.maximum(left[:, :1, None], 0)] & (prefix >= longer // 2))
        t, p, q = np.nonzero(good)
        found.append((left[t, p], right[t, q]))

    # small groups of one size class side by side, by length, so that padding stays small
    order = np.lexsort((m[starts], sizes)) if len(starts) else starts
    order = order[sizes[order] > 1]
    i = 0
    while i < len(order):
        size, width = int(sizes[order[i]]), int(m[starts[order[i]]])
        side = 1 << (size - 1).bit_length()
        if side * side * width <= cells:
            last = i
            while last < len(order) and sizes[order[last]] <= side and (last - i + 1) * side * side * max(width, int(m[starts[order[last]]])) <= cells:
                width = max(width, int(m[starts[order[last]]]))
                last += 1
            some = order[i:last]
            place = starts[some][:, None] + np.arange(side)
            place = np.where(np.arange(side) < sizes[some][:, None], place, -1)
            compare(place, place, width)
            i = last
            continue
        step = max(1, math.isqrt(cells // width)) if width < cells else 1
        rows = np.arange(starts[order[i]], starts[order[i]] + size)
        for low in range(0, size, step):
            for high in range(low, size, step):
                compare(rows[None, low : low + step], rows[None, high : high + step], width)
        i += 1
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(side) for side in zip(*found))


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n): both directions of every pair of near words of (word, n)."""
    spark = words.sparkSession
    tiles = _tiled(_entries(words))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-4 * words.count() // TASK_ENTRIES))
    dealt = tiles.repartition(parts, "group", "i", "j").sortWithinPartitions("group", "i", "j")

    def pairs(table: pa.Table, at: np.ndarray) -> pa.RecordBatch:
        names = [w.encode("latin-1") for w in table.column("word").to_pylist()]
        groups = table.column("group").to_pylist()
        one_side = (table.column("i").to_numpy() == table.column("j").to_numpy())
        block = np.where(one_side, -1, table.column("right").to_numpy().astype(np.int64))
        a, b = near_pairs(names, at, table.column("m").to_numpy().astype(np.int64), np.array([g[0] == "s" for g in groups]), block)
        here, there = table.take(pa.array(np.concatenate([a, b]))), table.take(pa.array(np.concatenate([b, a])))
        columns = [here.column("word"), here.column("n"), there.column("word"), there.column("n")]
        return pa.RecordBatch.from_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns], ["word", "n", "near", "near_n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            number = _numbers(held)
            # the last tile may go on in the next batch
            open_at = int(np.searchsorted(number, number[-1]))
            if open_at:
                yield pairs(held.slice(0, open_at), number[:open_at])
                held = held.slice(open_at).combine_chunks()
        if held is not None:
            yield pairs(held, _numbers(held))

    return dealt.mapInArrow(run, "word string, n long, near string, near_n long")


def _numbers(table: pa.Table) -> np.ndarray:
    """Numbers of the tiles of sorted rows."""
    fresh = np.zeros(table.num_rows, bool)
    for name in ("group", "i", "j"):
        column = table.column(name).combine_chunks().dictionary_encode()
        code = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).indices.to_numpy()
        fresh[1:] |= code[1:] != code[:-1]
    return np.cumsum(fresh)


def variant_roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of each word's chain of forms.

    ``forms`` is (word, form). A form is ``DOMINANCE`` times as frequent as its word, so chains have
    no circles and are no longer than the logarithm of the largest count.
    """
    steps = forms.select(F.col("word").alias("root"), F.col("form").alias("next"))
    now = durable(forms.select("word", F.col("form").alias("root")))
    while True:
        moved = durable(now.join(steps, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        now = moved.drop("moved")
        if moved.where("moved").isEmpty():
            return now


def variants(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
    min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, dominance: int = DOMINANCE,
) -> DataFrame:
    """(word, n, n_near, form, form_n, root) per word of the texts.

    Words are maximal runs of Latin letters in lower case; one run in ``DRAW`` loses a code point, as
    a checksum of document and run decides, so misspellings are there to be found. A word's form is
    its most frequent near word (ties: the smallest), if that is ``dominance`` times as frequent.
    Null and empty texts have no words; a null id counts as an empty one; repeated rows count each;
    runs of any length are whole words; an empty table gives no rows. Other columns are not read.
    """
    words = durable(vocabulary(docs, doc_id, text, min_length, min_count))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    near = near_words(words).groupBy("word", "n").agg(F.count("*").alias("n_near"), best)
    form_n = -F.col("best.less")
    frequent = form_n >= dominance * F.col("n")
    stats = durable(near.select("word", "n_near", F.when(frequent, F.col("best.near")).alias("form"), F.when(frequent, form_n).alias("form_n")))
    roots = variant_roots(stats.where(F.col("form").isNotNull()).select("word", "form"))
    joined = words.join(stats, "word", "left").join(roots, "word", "left")
    return joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form", "form_n", F.coalesce("root", "word").alias("root"))
