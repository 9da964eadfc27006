"""Scanning, decoding, parsing and chunking of the derived code corpus and of the documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusops.operators import chunking, lateral
from corpusops.plans.inputs import (
    FILES_CTE,
    PARTS_CTE,
    _parts,
    code_files,
    documents,
    py_files,
    sql_text,
    table,
)
from corpusops.session import durable, spread
from corpusops.sources.repo_files import decode_files, lookup_files, select_files

# Labelled searches over the code corpus; `expected` is a name without its number.
EVAL_SET = (
    ("e1", "raise ValueError when qty is low", "part_"),
    ("e2", "price of n", "price"),
    ("e3", "scale n by 100", "scale"),
    ("e4", "load a module from src", "load_"),
    ("e5", "inner helper that returns v", "inner"),
    ("e6", "class with price and scale", "Part"),
    ("e7", "what is this module", "__module__"),
    ("e8", "first of items above a bound", "part_"),
)
EVAL_COLUMNS = ("query_id", "query", "expected")
EVAL_VALUES = ", ".join(f"('{i}', '{q}', '{e}')" for i, q, e in EVAL_SET)


# expected chunks per template: ordinal, name, kind, start, end, docstring, code
_EXPECTED = {
    0: [(0, "part_{k}", "function", 1, 4, None, "def part_{k}(qty, rate):\n    if qty < {s}:\n        raise ValueError('low')\n    return qty * rate / 100 + {s}")],
    1: [(0, "part_{k}", "function", 1, 3, "Check part {k}.", 'def part_{k}(a, b):\n    """Check part {k}."""\n    return a >= {s} and b < {m} or a == b')],
    2: [(0, "part_{k}", "function", 1, 5, None, "def part_{k}(items):\n    for x in items:\n        if x > {s}:\n            return x\n    return -1")],
    3: [
        (0, "Part{k}", "class", 1, 7, None, "class Part{k}:\n\n    def price(self, n):\n        return n * {s}\n\n    def scale(self, n):\n        return n / 100"),
        (1, "price", "function", 3, 4, None, "    def price(self, n):\n        return n * {s}"),
        (2, "scale", "function", 6, 7, None, "    def scale(self, n):\n        return n / 100"),
    ],
    4: [
        (0, "__module__", "module_docstring", 1, 1, "Module {k}.", "Module {k}."),
        (1, "load_{k}", "function", 3, 7, None, "async def load_{k}(src):\n\n    def inner(v):\n        return v\n    return inner(src)"),
        (2, "inner", "function", 5, 6, None, "    def inner(v):\n        return v"),
    ],
}


def _chunk_select(template: int, row: tuple) -> str:
    ordinal, name, kind, start, end, doc, code = row
    docstring = sql_text(doc) if doc else "CAST(NULL AS VARCHAR)"
    return (
        f"SELECT path AS file, {sql_text(name)} AS name, '{kind}' AS type, {start} AS start_line, {end} AS end_line, "
        f"{docstring} AS docstring, {sql_text(code)} AS code, {ordinal} AS ordinal, content FROM py_files WHERE k % 6 = {template}"
    )


CHUNKS_CTE = (
    FILES_CTE
    + ",\nchunk_rows AS (\n"
    + "\nUNION ALL ".join(_chunk_select(t, row) for t, rows in _EXPECTED.items() for row in rows)
    + "),\nchunks AS (SELECT concat(file, '::', name) AS id, * FROM chunk_rows)"
)


def code_chunks(spark, sf_dir):
    return chunking.chunk_code(py_files(spark, sf_dir))


def repo_scan_files(spark, sf_dir):
    scanned = select_files(code_files(spark, sf_dir), "/corpus")
    return scanned.select("path", F.octet_length("content").cast("bigint").alias("bytes"))


def decode_utf8_quarantine(spark, sf_dir):
    """Every third document's bytes end in one that no UTF-8 text holds."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    content = F.col("text").cast("binary")
    broken = F.when(F.col("doc_id") % 3 == 0, F.concat(content, F.lit(bytes([0xFF])))).otherwise(content)
    decoded = decode_files(docs.select("doc_id", broken.alias("content")))
    return decoded.select("doc_id", "reject", F.length("text").cast("bigint").alias("n_chars"))


def parse_quarantine(spark, sf_dir):
    return chunking.parse_failures(py_files(spark, sf_dir))


def file_lookup(spark, sf_dir):
    """Each part asks for its file by the plain path; folders and suffixes make some miss."""
    wanted = F.format_string("pkg%d/part_%d.py", F.col("s") % 7, "k")
    requests = _parts(spark, sf_dir).select(F.col("k").alias("request_id"), wanted.alias("path"))
    files = py_files(spark, sf_dir).select("path", "text")
    return lookup_files(requests, files)


def inline_eval_set(spark, sf_dir):
    """A literal table of labelled queries against the names the corpus holds."""
    queries = spark.createDataFrame(EVAL_SET, list(EVAL_COLUMNS))
    family = F.regexp_replace("name", "[0-9]+$", "")
    names = code_chunks(spark, sf_dir).groupBy(family.alias("expected")).agg(
        F.count("*").alias("chunks"), F.countDistinct("file").alias("files")
    )
    joined = queries.join(names, "expected", "left")
    return joined.select(*EVAL_COLUMNS, F.coalesce("chunks", F.lit(0)).alias("chunks"), F.coalesce("files", F.lit(0)).alias("files"))


def chunk_code_units(spark, sf_dir):
    return code_chunks(spark, sf_dir).drop("char_start", "char_end")


def chunk_units_lateral(spark, sf_dir):
    """The same chunks by a table function in SQL."""
    lateral.register(spark)
    files = py_files(spark, sf_dir).select("path", "text")
    return spark.sql(
        "SELECT u.id, u.file, u.name, u.type, u.start_line, u.end_line, u.docstring, u.code, u.ordinal FROM {files} f, LATERAL chunk_units(f.path, f.text) u",
        files=files,
    )


def chunk_filter(spark, sf_dir):
    functions = chunking.filter_chunks(code_chunks(spark, sf_dir))
    return functions.select("file", "name", F.length("code").cast("bigint").alias("n_chars"))


def chunk_filter_file(spark, sf_dir):
    """The functions of one file, the last by name that has any."""
    chunks = durable(code_chunks(spark, sf_dir))
    first = chunks.where(F.col("type") == "function").agg(F.max("file")).scalar()
    return chunking.filter_chunks(chunks, first).select("file", "name", "start_line", F.length("code").cast("bigint").alias("n_chars"))


def chunk_lookup(spark, sf_dir):
    """First chunk of each name, and its length."""
    first = chunking.first_named(durable(code_chunks(spark, sf_dir)))
    return first.select("name", "id", "start_line", "code", F.col("n_chars").cast("bigint").alias("n_chars"))


def chunk_fixed(spark, sf_dir):
    chunks = chunking.chunk_fixed(documents(spark, sf_dir, "doc_id", "text"))
    return chunks.select(
        "doc_id", F.col("chunk_index").cast("bigint").alias("chunk_index"), F.col("n_chars").cast("bigint").alias("n_chars"), "chunk"
    )


def chunk_line_units(spark, sf_dir):
    units = chunking.chunk_lines(documents(spark, sf_dir, "doc_id", "text"))
    return units.select("doc_id", F.col("line_index").cast("bigint").alias("line_index"), "char_start", "char_end", "unit")


def chunk_split_rate(spark, sf_dir):
    """Document lines that a 500-character chunking would cut, per source."""
    units = chunking.chunk_lines(documents(spark, sf_dir, "doc_id", "source", "text"))
    return chunking.split_rate(units, "source").withColumn("cut_rate", F.round("cut_rate", 6))


def chunk_code_split_rate(spark, sf_dir):
    """Code units that a 60-character chunking would cut, per kind."""
    rates = chunking.split_rate(code_chunks(spark, sf_dir), "type", size=60)
    return rates.withColumn("cut_rate", F.round("cut_rate", 6))


def chunk_summary(spark, sf_dir):
    return chunking.chunk_counts(code_chunks(spark, sf_dir))


def chunk_listing(spark, sf_dir):
    return chunking.listing(code_chunks(spark, sf_dir))


_RATES = """count(*) AS units, CAST(sum(CAST(s // {n} <> (e - 1) // {n} AS INTEGER)) AS BIGINT) AS cut_units,
       max((e - 1) // {n} - s // {n} + 1) AS most_pieces, round(avg(CAST(s // {n} <> (e - 1) // {n} AS INTEGER)), 6) AS cut_rate"""

_LINES = """u AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS unit, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents),
  o AS (SELECT *, CAST(coalesce(sum(length(unit) + 1) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS s FROM u),
  placed AS (SELECT doc_id, source, i, unit, s, s + length(unit) AS e FROM o WHERE unit <> '')"""

QUERIES = {
    "repo_scan_files": (repo_scan_files, f"WITH {FILES_CTE} SELECT path, strlen(content) AS bytes FROM py_files"),
    "decode_utf8_quarantine": (
        decode_utf8_quarantine,
        """SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'not utf-8' END AS reject,
                  CASE WHEN doc_id % 3 <> 0 THEN length(text) END AS n_chars FROM documents""",
    ),
    "parse_quarantine": (
        parse_quarantine,
        f"WITH {FILES_CTE} SELECT path AS file, 'SyntaxError' AS error FROM py_files WHERE k % 6 = 5",
    ),
    "file_lookup": (
        file_lookup,
        f"""WITH {FILES_CTE},
            asked AS (SELECT k AS request_id, concat('pkg', CAST(s % 7 AS VARCHAR), '/part_', CAST(k AS VARCHAR), '.py') AS path FROM parts)
            SELECT request_id, path, content IS NOT NULL AS found,
                   coalesce(content, 'Error: ' || path || ' not found in repo.') AS output
            FROM asked LEFT JOIN (SELECT path, content FROM py_files) USING (path)""",
    ),
    "inline_eval_set": (
        inline_eval_set,
        f"""WITH {CHUNKS_CTE}, q(query_id, query, expected) AS (VALUES {EVAL_VALUES}),
            n AS (SELECT regexp_replace(name, '[0-9]+$', '') AS expected, count(*) AS chunks, count(DISTINCT file) AS files FROM chunks GROUP BY ALL)
            SELECT query_id, query, expected, coalesce(chunks, 0) AS chunks, coalesce(files, 0) AS files FROM q LEFT JOIN n USING (expected)""",
    ),
    "chunk_code_units": (
        chunk_code_units,
        f"WITH {CHUNKS_CTE} SELECT id, file, name, type, start_line, end_line, docstring, code, ordinal FROM chunks",
    ),
    "chunk_units_lateral": (
        chunk_units_lateral,
        f"WITH {CHUNKS_CTE} SELECT id, file, name, type, start_line, end_line, docstring, code, ordinal FROM chunks",
    ),
    "chunk_filter": (
        chunk_filter,
        f"WITH {CHUNKS_CTE} SELECT file, name, length(code) AS n_chars FROM chunks WHERE type = 'function'",
    ),
    "chunk_filter_file": (
        chunk_filter_file,
        f"""WITH {CHUNKS_CTE}, f AS (SELECT file, name, start_line, length(code) AS n_chars FROM chunks WHERE type = 'function')
            SELECT * FROM f WHERE file = (SELECT max(file) FROM f)""",
    ),
    "chunk_lookup": (
        chunk_lookup,
        f"""WITH {CHUNKS_CTE}, r AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY file, ordinal) AS rn FROM chunks)
            SELECT name, id, start_line, code, length(code) AS n_chars FROM r WHERE rn = 1""",
    ),
    "chunk_fixed": (
        chunk_fixed,
        """WITH n AS (SELECT doc_id, text, unnest(range((length(text) + 499) // 500)) AS chunk_index FROM documents)
           SELECT doc_id, chunk_index, length(substr(text, chunk_index * 500 + 1, 500)) AS n_chars,
                  substr(text, chunk_index * 500 + 1, 500) AS chunk FROM n""",
    ),
    "chunk_line_units": (
        chunk_line_units,
        f"WITH {_LINES} SELECT doc_id, i AS line_index, s AS char_start, e AS char_end, unit FROM placed",
    ),
    "chunk_split_rate": (
        chunk_split_rate,
        f"WITH {_LINES} SELECT source, {_RATES.format(n=500)} FROM placed GROUP BY source",
    ),
    "chunk_code_split_rate": (
        chunk_code_split_rate,
        f"""WITH {CHUNKS_CTE},
            placed AS (SELECT type, position(code IN content) - 1 AS s, position(code IN content) - 1 + length(code) AS e
                       FROM chunks WHERE type <> 'module_docstring')
            SELECT type, {_RATES.format(n=60)} FROM placed GROUP BY type""",
    ),
    "chunk_summary": (
        chunk_summary,
        f"""WITH {CHUNKS_CTE} SELECT type, count(*) AS chunks, CAST(sum(length(code)) AS BIGINT) AS chars,
            max(length(code)) AS longest FROM chunks GROUP BY type""",
    ),
    "chunk_listing": (
        chunk_listing,
        f"WITH {CHUNKS_CTE} SELECT type, id, concat(start_line, '-', end_line) AS lines FROM chunks",
    ),
}

__all__ = ["CHUNKS_CTE", "EVAL_SET", "EVAL_VALUES", "PARTS_CTE", "QUERIES", "code_chunks"]
