import statistics

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusops.functions import collections as C
from corpusops.functions import text as T


def one(spark, *columns):
    return list(spark.range(1).select(*columns).first())


def test_tail_and_defaults(spark):
    assert one(spark, T.tail(F.lit("abcdef"), 4), T.tail(F.lit("ab"), 4), T.tail(F.lit(""), 4)) == ["cdef", "ab", ""]
    blank, kept = one(spark, T.default_if_blank(F.lit(" \n\t "), "none"), T.default_if_blank(F.lit(" a "), "none"))
    assert (blank, kept) == ("none", " a ")
    assert one(spark, T.joined_output(F.lit("o"), F.lit(None))) == ["o\n"]


def section(spark, text, marker="Name"):
    df = spark.createDataFrame([(text,)], "text string").withColumn("parts", T.lines(F.col("text")))
    return df.select(T.section_from(F.col("parts"), F.lit(marker), F.col("text"))).first()[0]


def test_section_starts_at_the_first_marked_line(spark):
    assert section(spark, "x\nName  A\r\nrow\nName\n") == "Name  A\nrow\nName"
    assert section(spark, "x Name\n Name\n") == T.NO_SECTION + "x Name\n Name\n"
    assert section(spark, "y" * 3000) == T.NO_SECTION + "y" * 2000
    assert section(spark, "") == T.NO_SECTION


@settings(max_examples=30, deadline=None)
@given(st.text(alphabet="ab \n\r\x0b\x0c\x1c\x1d\x1e\x85  ", max_size=12))
def test_lines_are_those_of_python_text(spark, text):
    df = spark.createDataFrame([(text,)], "text string")
    found, first = df.select(T.lines(F.col("text")), T.first_line(F.col("text"))).first()
    assert found == text.splitlines()
    assert first == (text.splitlines() or [""])[0]


def test_slice_lines(spark):
    text = F.lit("a\nb\r\nc\rd")
    pick = [T.slice_lines(text, F.lit(s), F.lit(e)) for s, e in ((1, 1), (2, 3), (4, 9), (3, 2))]
    assert one(spark, *pick) == ["a", "b\nc", "d", ""]


def test_arithmetic(spark):
    assert one(spark, C.divide(F.lit(7), F.lit(2)), C.safe_divide(F.lit(1), F.lit(0), 9), C.safe_divide(F.lit(1), F.lit(4))) == [3.5, 9.0, 0.25]
    assert one(spark, C.safe_divide(F.lit(None).cast("int"), F.lit(2)), C.safe_divide(F.lit(2), F.lit(None).cast("int"))) == [None, None]
    with pytest.raises(Exception, match="division by zero"):
        one(spark, C.divide(F.lit(1), F.lit(0)))
    clamps = [C.clamp(F.lit(v).cast("int"), F.lit(0), F.lit(10)) for v in (-1, 5, 11, None)]
    assert one(spark, *clamps) == [0, 5, 10, None]


def test_statistics(spark):
    values = [2.0, 4.0, 4.0, 5.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    row = C.summarize(df, "v").first()
    assert (row["count"], row["sum"], row["mean"], row["min"], row["max"]) == (4, 15.0, 3.75, 2.0, 5.0)
    assert row.variance == pytest.approx(statistics.pvariance(values)) and row.std_dev == pytest.approx(statistics.pstdev(values))
    with pytest.raises(Exception, match="no values"):
        C.summarize(df.where("v > 9"), "v").collect()
    assert df.where("v > 9").agg(C.average_or_zero(F.col("v"))).first()[0] == 0.0
    assert df.agg(C.average_or_zero(F.col("v"))).first()[0] == 3.75


def test_strings(spark):
    assert one(spark, *[C.is_palindrome(F.lit(t)) for t in ("Never odd or even", "", "ab", "a\ta", "a b")]) == [True, True, False, True, False]
    spaced = " a \t\n b　 c\x1f"
    assert one(spark, C.collapse_whitespace(F.lit(spaced))) == [" ".join(spaced.split())]


LISTS = [[], [1], [1, 2, 1, 3, 2, 1], [5, 5, 5], list(range(10))]


@pytest.mark.parametrize("items", LISTS)
def test_arrays(spark, items):
    df = spark.createDataFrame([(items,)], "a array<int>")
    a = F.col("a")
    unique, repeated, runs, back, flat = df.select(
        C.deduplicate(a), C.duplicates(a), C.chunk_array(a, 3), F.reverse(a), C.flatten(F.array(a, a))
    ).first()
    assert unique == list(dict.fromkeys(items))
    assert repeated == sorted({i for i in items if items.count(i) > 1})
    assert runs == [items[i : i + 3] for i in range(0, len(items), 3)]
    assert back == items[::-1] and flat == items + items


def test_display_formats(spark):
    ratio = F.lit(0.875)
    assert one(spark, T.percent(ratio), T.percent(ratio, 0), T.decimals(ratio), T.decimals(ratio, 2, True)) == ["87.5%", "88%", "0.875", "+0.88"]


def test_a_null_held_twice_is_a_duplicate(spark):
    df = spark.createDataFrame([([None, 2, None, 2, 1],), ([],), (None,), ([None],)], "a array<int>")
    assert [r[0] for r in df.select(C.duplicates(F.col("a"))).collect()] == [[None, 2], [], None, []]
