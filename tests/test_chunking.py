import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusops.operators import chunking as C

SAMPLE = '''"""About
  this file."""
import x


@decorator
def top(a):
    """Doc."""
    def inner(b):
        return b
    return inner


class A:
    def same(self): pass


class B:
    """  """
    async def same(self):
        return 1
'''


def files(spark, *pairs):
    return spark.createDataFrame(list(pairs), "path string, text string")


def chunks(spark, *pairs):
    return C.chunk_code(files(spark, *pairs)).orderBy("file", "ordinal").collect()


def test_units_come_breadth_first_with_lines_and_docstrings(spark):
    rows = chunks(spark, ("m.py", SAMPLE))
    got = [(r.name, r.type, r.start_line, r.end_line, r.docstring) for r in rows]
    assert got == [
        ("__module__", "module_docstring", 1, 1, "About\nthis file."),
        ("top", "function", 7, 11, "Doc."),
        ("A", "class", 14, 15, None),
        ("B", "class", 18, 21, ""),
        ("inner", "function", 9, 10, None),
        ("same", "function", 15, 15, None),
        ("same", "function", 20, 21, None),
    ]
    assert [r.ordinal for r in rows] == list(range(7))
    assert rows[1].code.startswith("def top(a):") and rows[1].code.endswith("    return inner")
    assert rows[5].id == rows[6].id == "m.py::same"
    for row in rows[1:]:
        assert SAMPLE[row.char_start : row.char_end] == row.code


def test_surrogate_key_separates_equal_ids(spark):
    keyed = C.chunk_code(files(spark, ("m.py", SAMPLE))).select(C.chunk_key().alias("key"))
    assert keyed.distinct().count() == 7


@pytest.mark.parametrize("newline", ["\r\n", "\r"])
def test_other_newlines_give_the_same_chunks(spark, newline):
    plain, other = chunks(spark, ("m.py", SAMPLE)), chunks(spark, ("m.py", SAMPLE.replace("\n", newline)))
    assert [(r.name, r.code, r.docstring) for r in plain] == [(r.name, r.code, r.docstring) for r in other]


def test_form_feed_does_not_shift_the_slice(spark):
    rows = chunks(spark, ("m.py", "a = 1\n\x0c\ndef k():\n    return 2\n"))
    assert [(r.start_line, r.code) for r in rows] == [(3, "def k():\n    return 2")]


def test_files_without_units_and_files_that_do_not_parse(spark):
    deep = "(" * 5000 + ")" * 5000
    pairs = [("empty.py", ""), ("plain.py", "x = 1"), ("bad.py", "def f(:"), ("nul.py", "x\0"), ("deep.py", deep), ("gone.py", None)]
    assert chunks(spark, *pairs) == []
    failed = {r.file: r.error for r in C.parse_failures(files(spark, *pairs)).collect()}
    assert set(failed) == {"bad.py", "nul.py", "deep.py"}
    assert failed["bad.py"] == "SyntaxError"


def test_partitioning_does_not_change_chunks(spark):
    many = files(spark, *[(f"m{i}.py", SAMPLE) for i in range(40)])
    one, eight = (sorted(map(tuple, C.chunk_code(many.repartition(n)).collect()), key=str) for n in (1, 8))
    assert one == eight and len(one) == 280


@pytest.mark.parametrize("n,sizes", [(0, []), (1, [1]), (499, [499]), (500, [500]), (501, [500, 1]), (1500, [500, 500, 500])])
def test_fixed_chunk_sizes(spark, n, sizes):
    df = spark.createDataFrame([(1, "é" * n)], "doc_id int, text string")
    assert [r.n_chars for r in C.chunk_fixed(df).orderBy("chunk_index").collect()] == sizes


@settings(max_examples=12, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(codec="utf-8"), max_size=40), min_size=1, max_size=8), st.integers(1, 9))
def test_fixed_chunks_join_back_to_the_text(spark, texts, size):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    back = {i: "" for i in range(len(texts))}
    for row in C.chunk_fixed(df, size=size).orderBy("doc_id", "chunk_index").collect():
        assert row.chunk == texts[row.doc_id][row.chunk_index * size : (row.chunk_index + 1) * size]
        back[row.doc_id] += row.chunk
    assert list(back.values()) == texts


def test_line_units_keep_offsets(spark):
    text = "ab\n\ncde\n\n\nf"
    rows = C.chunk_lines(spark.createDataFrame([(1, text), (2, "")], "doc_id int, text string")).orderBy("line_index").collect()
    assert [(r.line_index, r.unit) for r in rows] == [(0, "ab"), (2, "cde"), (5, "f")]
    assert all(text[r.char_start : r.char_end] == r.unit for r in rows)


def test_split_rate_against_boundaries(spark):
    spans = [(s, s + n) for s in range(0, 40) for n in range(1, 15)]
    df = spark.createDataFrame(spans, "char_start int, char_end int")
    cut = [sum(1 for b in range(10, 100, 10) if s < b < e) for s, e in spans]
    row = C.split_rate(df, size=10).first()
    assert (row.units, row.cut_units, row.most_pieces) == (len(spans), sum(map(bool, cut)), max(cut) + 1)
    assert row.cut_rate == pytest.approx(sum(map(bool, cut)) / len(spans))


def test_filters_lookup_and_counts(spark):
    df = C.chunk_code(files(spark, ("b.py", SAMPLE), ("a.py", SAMPLE)))
    assert C.filter_chunks(df, "a.py").count() == 4
    first = {r.name: r for r in C.first_named(df).collect()}
    assert first["same"].file == "a.py" and first["same"].start_line == 15
    assert first["same"].n_chars == len(first["same"].code)
    counts = {r.type: r.chunks for r in C.chunk_counts(df).collect()}
    assert counts == {"module_docstring": 2, "function": 8, "class": 4}
    assert C.listing(df).where(F.col("type") == "class").first().lines in {"14-15", "18-21"}
