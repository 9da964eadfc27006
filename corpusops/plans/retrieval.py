"""Vector and text search over whole tables, and its evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusops.operators import chunking, ireval
from corpusops.operators import vectors as V
from corpusops.plans.corpus import CHUNKS_CTE, EVAL_COLUMNS, EVAL_SET, EVAL_VALUES, code_chunks
from corpusops.plans.inputs import (
    MODELS,
    SEARCH_CTE,
    as_signs,
    class_queries,
    documents,
    hashed_cte,
    hashed_search_cte,
    knn_cte,
    passages_in_documents,
    table,
    vectors,
)
from corpusops.session import durable, scratch_path

TEXT_DIMS = 512
CODE_DIMS = 256
DEPTH = ireval.RANK_DEPTH


# sums over hashed vectors carry noise that differs by engine: equal to this many digits is a tie
TEXT_DIGITS = 6
SMALL = 1e-8


def _shown(hits):
    return hits.withColumn("distance", F.round("distance", 6))


def knn_topk(spark, sf_dir):
    return _shown(V.search(vectors(spark, sf_dir), class_queries(spark, sf_dir), DEPTH))


def knn_topk_small(spark, sf_dir):
    """Vectors a hundred million times shorter: the same hits, as exact distances rank."""
    held, asked = (
        df.withColumn("embedding", F.transform(F.col("embedding").cast("array<double>"), lambda x: x * SMALL))
        for df in (vectors(spark, sf_dir), class_queries(spark, sf_dir))
    )
    return _shown(V.search(held, asked, DEPTH).withColumn("distance", F.col("distance") / SMALL))


def index_roundtrip_search(spark, sf_dir):
    held = V.with_checked_vectors(vectors(spark, sf_dir), 64)
    path = V.save_index(held, scratch_path(spark, "index"))
    return _shown(V.search(V.load_index(spark, path), class_queries(spark, sf_dir)))


def _log(spark, sf_dir):
    queries = class_queries(spark, sf_dir)
    return ireval.retrieval_log(queries, V.search(vectors(spark, sf_dir), queries, DEPTH))


def _rounded(summary):
    return summary.withColumns({c: F.round(c, 6) for c in ("accuracy", "top1_accuracy", "mrr")})


def retrieval_log(spark, sf_dir):
    log = _log(spark, sf_dir)
    return log.withColumns(
        {"retrieved": F.array_join("retrieved", ","), "reciprocal_rank": F.round("reciprocal_rank", 6)}
    )


def retrieval_summary(spark, sf_dir):
    return _rounded(ireval.retrieval_summary(_log(spark, sf_dir)))


def _both_models(spark, sf_dir):
    queries, held = class_queries(spark, sf_dir), vectors(spark, sf_dir)
    full = V.search(held, queries, DEPTH).withColumn("model", F.lit(MODELS[0]))
    signs = V.search(as_signs(held), as_signs(queries), DEPTH).withColumn("model", F.lit(MODELS[1]))
    return ireval.retrieval_log(queries, full.unionByName(signs), MODELS)


def retrieval_failures(spark, sf_dir):
    """Searches whose first hit is not the expected one, of either model."""
    missed = ireval.retrieval_failures(_both_models(spark, sf_dir), on="top1_hit")
    return missed.select("model", "query_id", "expected_id", F.array_join("retrieved", ",").alias("retrieved"), "top_result", "rank")


def retrieval_model_compare(spark, sf_dir):
    return _rounded(ireval.retrieval_summary(_both_models(spark, sf_dir)))


# ---------------------------------------------------------------- text


def embed_text(spark, sf_dir):
    chunks = code_chunks(spark, sf_dir)
    return chunks.select("id", "start_line", V.embed_text().alias("content"))


def _code_index(spark, sf_dir):
    """Chunks with a key and the text that is embedded."""
    keyed = code_chunks(spark, sf_dir).withColumn("key", chunking.chunk_key())
    return durable(keyed.withColumn("content", V.embed_text()))


def _code_hits(spark, sf_dir, k=V.DEFAULT_K):
    chunks = _code_index(spark, sf_dir)
    queries = spark.createDataFrame(EVAL_SET, list(EVAL_COLUMNS))
    embedder = V.HashedEmbedder(CODE_DIMS).fit(chunks, "content")
    held = chunks.select("key", F.col("content").alias("text"))
    hits = V.search(held, embedder.embed(queries, "query"), k, id_col="key", digits=TEXT_DIGITS, embedder=embedder)
    return queries, V.describe_hits(hits, chunks, key="key")


def search_hits(spark, sf_dir):
    """Hits of the inline queries over the code chunks, with the fields shown to a reader."""
    _, described = _code_hits(spark, sf_dir)
    return described.select("query_id", "rank", "file", "name", "type", "lines", "content", V.hit_id().alias("hit_id"), "distance")


def search_hits_formatted(spark, sf_dir):
    queries, described = _code_hits(spark, sf_dir)
    return V.rendered_hits(queries.select("query_id", "query"), described)


def lexical_retrieval_eval(spark, sf_dir):
    """Benchmark passages as searches; the first document that holds the passage is expected."""
    docs = documents(spark, sf_dir, "doc_id", "text")
    items = table(spark, sf_dir, "benchmark")
    held = passages_in_documents(docs, items).groupBy("item_id").agg(F.min("doc_id").alias("expected_id"))
    embedder = V.HashedEmbedder(TEXT_DIMS).fit(docs)
    asked = embedder.embed(items).withColumnRenamed("item_id", "query_id")
    hits = V.search(docs, asked, DEPTH, id_col="doc_id", digits=TEXT_DIGITS, embedder=embedder)
    log = ireval.retrieval_log(held.withColumnRenamed("item_id", "query_id"), hits)
    return _rounded(ireval.retrieval_summary(log))


def lexical_topk(spark, sf_dir):
    """The five documents nearest to every benchmark passage."""
    docs = documents(spark, sf_dir, "doc_id", "text")
    embedder = V.HashedEmbedder(TEXT_DIMS).fit(docs)
    asked = embedder.embed(table(spark, sf_dir, "benchmark")).withColumnRenamed("item_id", "query_id")
    return V.search(docs, asked, DEPTH, id_col="doc_id", digits=TEXT_DIGITS, embedder=embedder)


# ---------------------------------------------------------------- SQL


def _log_cte(hits: str, keys: str = "query_id", asked: str = "asked", name: str = "log") -> str:
    return f"""{name} AS (
  SELECT {keys}, expected_id, coalesce(list(id ORDER BY rank) FILTER (id IS NOT NULL), []) AS retrieved,
         coalesce(bool_or(id = expected_id AND rank <= 3), false) AS hit,
         coalesce(bool_or(id = expected_id AND rank = 1), false) AS top1_hit,
         CAST(min(rank) FILTER (id = expected_id) AS INTEGER) AS rank,
         coalesce(1.0 / min(rank) FILTER (id = expected_id), 0.0)::DOUBLE AS reciprocal_rank
  FROM (SELECT {keys}, expected_id FROM {asked}) a LEFT JOIN {hits} h USING ({keys}) GROUP BY {keys}, expected_id)"""


_SUMMARY = """count(*) AS total, count(*) FILTER (hit) AS hits, round(avg(hit::INT), 6) AS accuracy,
  count(*) FILTER (top1_hit) AS top1_hits, round(avg(top1_hit::INT), 6) AS top1_accuracy, round(avg(reciprocal_rank), 6) AS mrr"""

_BOTH_CTE = f"""{SEARCH_CTE}, {knn_cte("f", DEPTH)}, {knn_cte("s", DEPTH, "signs")},
both_models AS (SELECT *, 'full' AS model FROM f UNION ALL SELECT *, 'signs' AS model FROM s),
per_model AS (SELECT query_id, expected_id, model FROM asked CROSS JOIN (VALUES ('full'), ('signs')) m(model)),
{_log_cte("both_models", "query_id, model", "per_model")}"""

_CONTENT = """concat('# ', file, '::', name, ' (', type, ')', chr(10),
  CASE WHEN docstring <> '' THEN concat('\"\"\"', docstring, '\"\"\"', chr(10)) ELSE '' END, code)"""

_CODE_CTE = f"""{CHUNKS_CTE},
content AS (SELECT * EXCLUDE (content), md5(concat_ws('|', file, start_line, type, name)) AS key, {_CONTENT} AS content FROM chunks),
held AS (SELECT key AS id, content AS text FROM content),
q(query_id, query, expected) AS (VALUES {EVAL_VALUES}),
asked AS (SELECT query_id AS id, query AS text FROM q),
{hashed_cte("h", "held", CODE_DIMS)},
{hashed_cte("a", "asked", CODE_DIMS, "h")},
{hashed_search_cte("hits", "a", "h", V.DEFAULT_K)},
described AS (
  SELECT query_id, rank, file, name, type, concat(start_line, '-', end_line) AS lines, content, distance
  FROM hits JOIN content ON content.key = hits.id)"""

_TEXT_CTE = f"""held AS (SELECT doc_id AS id, text FROM documents),
items AS (SELECT item_id AS id, text FROM benchmark),
{hashed_cte("h", "held", TEXT_DIMS)},
{hashed_cte("a", "items", TEXT_DIMS, "h")},
{hashed_search_cte("hits", "a", "h", DEPTH)}"""

QUERIES = {
    "knn_topk": (
        knn_topk,
        f"WITH {SEARCH_CTE}, {knn_cte('h', DEPTH)} SELECT query_id, CAST(rank AS INTEGER) AS rank, id, distance FROM h",
    ),
    # a common factor changes no rank
    "knn_topk_small": (
        knn_topk_small,
        f"WITH {SEARCH_CTE}, {knn_cte('h', DEPTH)} SELECT query_id, CAST(rank AS INTEGER) AS rank, id, distance FROM h",
    ),
    "index_roundtrip_search": (
        index_roundtrip_search,
        f"WITH {SEARCH_CTE}, {knn_cte('h', V.DEFAULT_K)} SELECT query_id, CAST(rank AS INTEGER) AS rank, id, distance FROM h",
    ),
    "retrieval_log": (
        retrieval_log,
        f"""WITH {SEARCH_CTE}, {knn_cte('h', DEPTH)}, {_log_cte('h')}
            SELECT query_id, expected_id, array_to_string(retrieved, ',') AS retrieved, hit, top1_hit, rank,
                   round(reciprocal_rank, 6) AS reciprocal_rank FROM log""",
    ),
    "retrieval_summary": (
        retrieval_summary,
        f"WITH {SEARCH_CTE}, {knn_cte('h', DEPTH)}, {_log_cte('h')} SELECT {_SUMMARY} FROM log",
    ),
    "retrieval_failures": (
        retrieval_failures,
        f"""WITH {_BOTH_CTE} SELECT model, query_id, expected_id, array_to_string(retrieved, ',') AS retrieved,
            retrieved[1] AS top_result, rank FROM log WHERE NOT top1_hit""",
    ),
    "retrieval_model_compare": (retrieval_model_compare, f"WITH {_BOTH_CTE} SELECT model, {_SUMMARY} FROM log GROUP BY model"),
    "embed_text": (embed_text, f"WITH {CHUNKS_CTE} SELECT id, start_line, {_CONTENT} AS content FROM chunks"),
    "search_hits": (
        search_hits,
        f"WITH {_CODE_CTE} SELECT query_id, CAST(rank AS INTEGER) AS rank, file, name, type, lines, content, concat(file, '::', name) AS hit_id, distance FROM described",
    ),
    "search_hits_formatted": (
        search_hits_formatted,
        f"""WITH {_CODE_CTE}, r AS (
              SELECT query_id, string_agg(concat('--- ', file, '::', name, ' (lines ', lines, ') ---', chr(10), content), chr(10) || chr(10) ORDER BY rank) AS output
              FROM described GROUP BY query_id)
            SELECT query_id, query, coalesce(output, 'No relevant code found.') AS output FROM q LEFT JOIN r USING (query_id)""",
    ),
    "lexical_topk": (lexical_topk, f"WITH {_TEXT_CTE} SELECT query_id, CAST(rank AS INTEGER) AS rank, id, distance FROM hits"),
    "lexical_retrieval_eval": (
        lexical_retrieval_eval,
        f"""WITH {_TEXT_CTE},
            gold AS (SELECT i.id AS query_id, min(d.id) AS expected_id FROM items i JOIN held d ON contains(d.text, i.text) GROUP BY i.id),
            {_log_cte("hits", "query_id", "gold")} SELECT {_SUMMARY} FROM log""",
    ),
}
