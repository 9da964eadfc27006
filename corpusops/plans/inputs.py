"""Inputs of the registered queries, derived from the given tables, each with its SQL twin.

The tables hold no program text, so a code corpus is derived from ``part``: one file per row, its
text one of six templates. The same SQL expression builds it in Spark and in the oracle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusops.session import durable, spread
from corpusops.sources.repo_files import IGNORED_DIRS, decode_files, select_files

ROOT = "/corpus"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select(*columns))


# ---------------------------------------------------------------- code corpus from part

# {k} part key, {s} part size, {m} key modulo 97; {s1}, {m1} one more
TEMPLATES = {
    0: "def part_{k}(qty, rate):\n    if qty < {s}:\n        raise ValueError('low')\n    return qty * rate / 100 + {s}",
    1: 'def part_{k}(a, b):\n    """Check part {k}."""\n    return a >= {s} and b < {m} or a == b',
    2: "def part_{k}(items):\n    for x in items:\n        if x > {s}:\n            return x\n    return -1",
    3: "class Part{k}:\n\n    def price(self, n):\n        return n * {s}\n\n    def scale(self, n):\n        return n / 100",
    4: '"""Module {k}."""\n\nasync def load_{k}(src):\n\n    def inner(v):\n        return v\n    return inner(src)',
    5: "def part_{k}(:",
}

_HOLES = {
    "{k}": "CAST(k AS STRING)",
    "{s}": "CAST(s AS STRING)",
    "{m}": "CAST(m AS STRING)",
    "{s1}": "CAST(s + 1 AS STRING)",
    "{m1}": "CAST(m + 1 AS STRING)",
    "\n": "chr(10)",
    "'": "chr(39)",
}


def sql_text(template: str) -> str:
    """A SQL expression, valid in Spark and DuckDB, that fills the template from k, s and m."""
    parts = [p for p in re.split(r"(\{\w+\}|\n|')", template) if p]
    return "concat('', " + ", ".join(_HOLES.get(p, f"'{p}'") for p in parts) + ")"


CONTENT_SQL = "CASE " + " ".join(f"WHEN k % 6 = {t} THEN {sql_text(x)}" for t, x in TEMPLATES.items()) + " END"
PATH_SQL = (
    "concat('/corpus/pkg', CAST(s % 7 AS STRING), '/', "
    "CASE WHEN k % 11 = 0 THEN 'venv/' WHEN k % 11 = 1 THEN '_internal/' ELSE '' END, "
    "'part_', CAST(k AS STRING), CASE WHEN k % 13 = 0 THEN '.txt' ELSE '.py' END)"
)

PARTS_CTE = "parts AS (SELECT p_partkey AS k, p_size AS s, p_partkey % 97 AS m FROM part)"
FILES_CTE = f"""{PARTS_CTE},
files AS (SELECT k, s, m, {PATH_SQL} AS full_path, {CONTENT_SQL} AS content FROM parts),
py_files AS (
  SELECT k, s, m, substr(full_path, {len(ROOT) + 2}) AS path, content FROM files
  WHERE full_path LIKE '%.py'
    AND NOT regexp_matches(full_path, '/({"|".join(re.escape(d) for d in IGNORED_DIRS)})/'))"""


def code_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(path, content bytes), one file per part."""
    parts = _parts(spark, sf_dir)
    return parts.select(F.expr(PATH_SQL).alias("path"), F.expr(CONTENT_SQL).cast("binary").alias("content"))


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two narrow columns are spread over the cluster before any text is made from them."""
    keys = spread(table(spark, sf_dir, "part").select("p_partkey", "p_size"))
    return keys.selectExpr("p_partkey AS k", "p_size AS s", "p_partkey % 97 AS m")


def py_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(path, text, reject) after the scan's rules and decoding."""
    return decode_files(select_files(code_files(spark, sf_dir), ROOT))


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source_id, code) for the mutation operators."""
    return _parts(spark, sf_dir).select(F.col("k").alias("source_id"), F.expr(CONTENT_SQL).alias("code"))


# odd keys carry a comment and doubled spacing, which normal form removes
RAW_SQL = f"CASE WHEN k % 2 = 1 THEN concat('# part', chr(10), {CONTENT_SQL}, '  # end') ELSE {CONTENT_SQL} END"


def raw_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parts(spark, sf_dir).select(F.col("k").alias("source_id"), F.expr(RAW_SQL).alias("code"))


# ---------------------------------------------------------------- predictions


def preds(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """Labelled documents with a rule's prediction: long texts are called good."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", *extra)
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("int").alias("label"))
    return labels.join(docs, "doc_id").withColumn("predicted", (F.col("n_chars") > 1000).cast("int"))


PREDS_CTE = """preds AS (
  SELECT l.doc_id, d.source, d.lang, d.n_chars, d.text, l.quality AS label,
         CAST(d.n_chars > 1000 AS INTEGER) AS predicted
  FROM labels l JOIN documents d USING (doc_id))"""


# ---------------------------------------------------------------- vector search

# one query per class: its first vector blended with the class mean; that vector is expected
BLEND_SQL = "0.02 + 0.01 * (label % 5)"


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = table(spark, sf_dir, "embeddings")
    return spread(emb).select(F.col("vec_id").alias("id"), "embedding", "label")


def class_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(query_id, expected_id, embedding): as many rows as the table has classes."""
    held = table(spark, sf_dir, "embeddings").select(
        "label", "vec_id", F.col("embedding").cast("array<double>").alias("v")
    )
    per_class = held.groupBy("label").agg(
        F.min("vec_id").alias("expected_id"),
        F.min_by("v", "vec_id").alias("first"),
        vector_to_array(Summarizer.mean(array_to_vector("v"))).alias("mean"),
    )
    w = F.expr(f"CAST({BLEND_SQL} AS DOUBLE)")
    blend = F.zip_with("first", "mean", lambda a, b: w * a + (1 - w) * b)
    queries = per_class.select(F.col("label").cast("bigint").alias("query_id"), "expected_id", blend.alias("embedding"))
    # read several times, and the means cost a scan of the table
    return durable(queries)


SEARCH_CTE = f"""held AS (SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
dims AS (SELECT label, id, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM held),
means AS (SELECT label, i, avg(x) AS x FROM dims GROUP BY label, i),
firsts AS (SELECT label, min(id) AS expected_id FROM held GROUP BY label),
asked AS (
  SELECT CAST(f.label AS BIGINT) AS query_id, f.expected_id,
         list(CAST({BLEND_SQL.replace("label", "f.label")} AS DOUBLE) * d.x
              + (1 - CAST({BLEND_SQL.replace("label", "f.label")} AS DOUBLE)) * m.x ORDER BY d.i) AS q
  FROM firsts f JOIN dims d ON d.id = f.expected_id JOIN means m ON m.label = f.label AND m.i = d.i
  GROUP BY f.label, f.expected_id)"""

# a second model: every component reduced to its sign
MODELS = ["full", "signs"]


def as_signs(df: DataFrame) -> DataFrame:
    return df.withColumn("embedding", F.transform("embedding", lambda x: F.signum(x) / 8))


def knn_cte(name: str, k: int, model: str = "full") -> str:
    q, v = ("q", "v") if model == "full" else (f"list_transform({c}, lambda x: sign(x) / 8.0)" for c in ("q", "v"))
    return f"""{name} AS (
  SELECT query_id, rank, id, distance FROM (
    SELECT query_id, id, round(distance, 6) AS distance, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank
    FROM (SELECT a.query_id, h.id, list_distance({q}, {v}) AS distance FROM asked a CROSS JOIN held h))
  WHERE rank <= {k})"""


# ---------------------------------------------------------------- hashed text vectors


def hashed_cte(prefix: str, rows: str, dims: int, fit_on: str | None = None) -> str:
    """Unit TF-IDF vectors of ``rows`` (id, text) as sparse rows {prefix}_vec(id, slot, w).

    Slot weights come from ``fit_on``'s {fit_on}_df and {fit_on}_n, its own by default.
    """
    ctes = f"""{prefix}_tok AS (
  SELECT id, unnest(list_filter(string_split_regex(lower(text), '[^\\p{{L}}\\p{{N}}_]+'), lambda t: t <> '')) AS t FROM {rows}),
{prefix}_tf AS (
  SELECT id, CAST(('0x' || substr(md5(t), 1, 6)) AS INTEGER) % {dims} AS slot, count(*) AS tf
  FROM {prefix}_tok GROUP BY ALL)"""
    if fit_on is None:
        fit_on = prefix
        ctes += f""",
{prefix}_df AS (SELECT slot, count(*) AS df FROM {prefix}_tf GROUP BY slot),
{prefix}_n AS (SELECT count(*) AS n FROM {rows})"""
    return ctes + f""",
{prefix}_raw AS (
  SELECT t.id, t.slot, t.tf * ln((n + 1) / (coalesce(df, 0) + 1)) AS w
  FROM {prefix}_tf t LEFT JOIN {fit_on}_df d ON d.slot = t.slot CROSS JOIN {fit_on}_n),
{prefix}_norm AS (
  SELECT r.id, sqrt(coalesce(sum(w * w), 0)) AS norm FROM {rows} r LEFT JOIN {prefix}_raw w USING (id) GROUP BY r.id),
{prefix}_vec AS (
  SELECT id, slot, w / norm AS w FROM {prefix}_raw JOIN {prefix}_norm USING (id) WHERE norm > 0)"""


def hashed_search_cte(name: str, queries: str, index: str, k: int) -> str:
    """Top-k by L2 over sparse unit vectors: |q|^2 + |v|^2 - 2 q.v."""
    return f"""{name}_dot AS (
  SELECT q.id AS query_id, v.id, sum(q.w * v.w) AS dot FROM {queries}_vec q JOIN {index}_vec v USING (slot) GROUP BY ALL),
{name}_all AS (
  SELECT q.id AS query_id, v.id,
         round(sqrt(greatest(CAST(q.norm > 0 AS INTEGER) + CAST(v.norm > 0 AS INTEGER) - 2 * coalesce(dot, 0), 0)), 6) AS distance
  FROM {queries}_norm q CROSS JOIN {index}_norm v LEFT JOIN {name}_dot d ON d.query_id = q.id AND d.id = v.id),
{name} AS (
  SELECT * FROM (
    SELECT query_id, id, distance, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank FROM {name}_all)
  WHERE rank <= {k})"""


# ---------------------------------------------------------------- passages inside documents

PATTERN_BYTES = 16 << 20


def passages_in_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id) wherever a document holds an item's text verbatim.

    One pass over each document finds all passages; passages come in slices of bounded size, so
    their number is not limited.
    """
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slices = max(1, -(-total // PATTERN_BYTES))
    found = None
    for turn in range(slices):
        mine = items.where(F.pmod(F.xxhash64("item_id"), F.lit(slices)) == turn).select("item_id", "text")
        shared = docs.sparkSession.sparkContext.broadcast([tuple(r) for r in mine.collect()])
        part = docs.select("doc_id", F.explode(_finder(shared)("text")).alias("item_id"))
        found = part if found is None else found.unionAll(part)
    return found


def _finder(shared):
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import ahocorasick

        by_text = {}
        for item, text in shared.value:
            if text:
                by_text.setdefault(text, []).append(item)
        words = ahocorasick.Automaton()
        for text, items in by_text.items():
            words.add_word(text, items)
        words.make_automaton()

        def inside(text: str | None) -> list[int]:
            return sorted({i for _, ids in words.iter(text) for i in ids}) if text and by_text else []

        for batch in batches:
            # one text at a time is a Python string
            yield pa.array([inside(t.as_py()) for t in batch], pa.list_(pa.int64()))

    return F.arrow_udf(find, "array<bigint>")
