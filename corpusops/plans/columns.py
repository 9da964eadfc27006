"""Text, number, string and array expressions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusops.functions import collections as C
from corpusops.functions import text as T
from corpusops.plans.inputs import documents, table


def text_tail(spark, sf_dir):
    docs = documents(spark, sf_dir, "doc_id", "text")
    cut = docs.withColumns({"tail": T.tail(F.col("text")), "short_tail": T.tail(F.col("text"), T.FALLBACK_TAIL_CHARS)})
    return cut.select(
        "doc_id", "tail", F.length("tail").cast("bigint").alias("tail_chars"), F.md5("short_tail").alias("short_tail_md5")
    )


def log_section(spark, sf_dir):
    docs = documents(spark, sf_dir, "doc_id", "text").withColumn("parts", T.lines(F.col("text")))
    # the marker is the head of the row's own second line; rows without one have no section
    marker = F.coalesce(F.left(F.try_element_at("parts", F.lit(2)), F.lit(5)), F.lit("Name"))
    marked = docs.withColumn("marker", F.when(marker == "", "Name").otherwise(marker))
    return marked.select("doc_id", T.section_from(F.col("parts"), F.col("marker"), F.col("text")).alias("section"))


LINES_SQL = r"""CASE WHEN p[-1] = '' THEN p[:-2] ELSE p END"""
LOG_SECTION_SQL = rf"""
WITH s AS (SELECT doc_id, text, string_split_regex(text, '\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{{85}}\x{{2028}}\x{{2029}}]') AS p FROM documents),
l AS (SELECT doc_id, text, {LINES_SQL} AS parts FROM s),
m AS (SELECT doc_id, text, parts, CASE WHEN coalesce(substr(parts[2], 1, 5), '') = '' THEN 'Name' ELSE substr(parts[2], 1, 5) END AS marker FROM l),
a AS (SELECT doc_id, text, parts, list_position(list_transform(parts, lambda x: starts_with(x, marker)), true) AS hit FROM m)
SELECT doc_id, CASE WHEN hit > 0 THEN array_to_string(parts[hit:], chr(10))
  ELSE 'Could not find a coverage table in the output. Is pytest-cov installed? Raw output:' || chr(10) || right(text, 2000) END AS section
FROM a"""


def text_default_if_blank(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    # a user's turn stands for an empty output stream
    out = F.when(F.col("role") == "user", F.lit(" \n\t")).otherwise(F.col("text"))
    return turns.select(
        "conv_id",
        "turn",
        T.default_if_blank(out, "No linting issues found.").alias("output"),
        T.joined_output(F.col("text"), F.col("role")).alias("joined"),
    )


def first_line(spark, sf_dir):
    docs = documents(spark, sf_dir, "doc_id", "text")
    return docs.select("doc_id", T.first_line(F.col("text")).alias("first_line"))


def slice_lines(spark, sf_dir):
    docs = documents(spark, sf_dir, "doc_id", "text")
    count = F.size(F.split("text", T.NEWLINE, -1))
    middle = docs.withColumns({"start": F.ceil(count / 3).cast("int"), "end": F.ceil(2 * count / 3).cast("int")})
    return middle.select("doc_id", "start", "end", T.slice_lines(F.col("text"), F.col("start"), F.col("end")).alias("code"))


def arith_basic(spark, sf_dir):
    q, p = F.col("l_quantity"), F.col("l_extendedprice")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.round(p + q, 6).alias("added"),
        F.round(p - q, 6).alias("subtracted"),
        F.round(p * q, 4).alias("multiplied"),
        F.round(C.divide(p, q), 8).alias("divided"),
    )


def safe_arith(spark, sf_dir):
    q, d, p = F.col("l_quantity"), F.col("l_discount"), F.col("l_extendedprice")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.round(C.safe_divide(q, d, -1), 4).alias("safe"),
        C.clamp(q, F.lit(10.0), F.lit(40.0)).alias("clamped"),
        F.round(C.safe_divide(p, q - F.lit(10)), 8).alias("safe_default"),
    )


def stats_summary(spark, sf_dir):
    stats = C.summarize(table(spark, sf_dir, "lineitem"), "l_quantity", "l_returnflag", "l_linestatus")
    rounded = [F.round(c, 6).alias(c) for c in ("sum", "mean", "min", "max", "variance", "std_dev")]
    return stats.select("l_returnflag", "l_linestatus", "count", *rounded)


def average_by_key(spark, sf_dir):
    """Mean order value of every customer, 0 for one without orders.

    Customers enter as rows without a value, so tasks combine before the one shuffle and no join is needed.
    """
    values = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_totalprice", F.lit(False).alias("known"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.lit(None).cast("double").alias("o_totalprice"), F.lit(True).alias("known"))
    means = values.union(customers).groupBy("c_custkey").agg(C.average_or_zero(F.col("o_totalprice")).alias("mean"), F.bool_or("known").alias("known"))
    return means.where("known").select("c_custkey", F.round("mean", 8).alias("average"))


def string_funcs(spark, sf_dir):
    docs = documents(spark, sf_dir, "doc_id", "text", "lang")
    t = F.col("text")
    # a text followed by its own reverse reads the same both ways
    mirrored = F.when(F.col("doc_id") % 2 == 0, F.concat(t, F.lit(" "), F.reverse(t))).otherwise(t)
    return docs.select(
        "doc_id",
        F.reverse(t).alias("reversed"),
        C.is_palindrome(mirrored).alias("palindrome"),
        C.collapse_whitespace(t).alias("collapsed"),
    )


WORDS_SQL = "string_split(text, ' ')"


def _words(spark, sf_dir):
    return documents(spark, sf_dir, "doc_id", "text").select("doc_id", F.split("text", " ").alias("words"))


def array_funcs(spark, sf_dir):
    words = _words(spark, sf_dir)
    nested = words.withColumn("nested", F.transform("words", lambda w: F.split(w, "\n")))
    return nested.select(
        "doc_id",
        F.array_join(F.reverse("words"), " ").alias("reversed"),
        F.array_join(C.deduplicate(F.col("words")), " ").alias("distinct_words"),
        F.array_join(C.flatten(F.col("nested")), "|").alias("flat"),
    )


def array_duplicates(spark, sf_dir):
    words = _words(spark, sf_dir).withColumn("repeated", C.duplicates(F.col("words")))
    return words.select("doc_id", F.size("repeated").cast("bigint").alias("n"), F.array_join("repeated", " ").alias("repeated"))


def array_chunk(spark, sf_dir):
    words = _words(spark, sf_dir)
    runs = words.select("doc_id", F.posexplode(C.chunk_array(F.col("words"), 7)).alias("pos", "run"))
    return runs.select("doc_id", F.col("pos").cast("bigint").alias("pos"), F.array_join("run", " ").alias("run"))


QUERIES = {
    "text_tail": (
        text_tail,
        """SELECT doc_id, right(text, 4000) AS tail, length(right(text, 4000)) AS tail_chars,
                  md5(right(text, 2000)) AS short_tail_md5 FROM documents""",
    ),
    "log_section": (log_section, LOG_SECTION_SQL),
    "text_default_if_blank": (
        text_default_if_blank,
        """SELECT conv_id, turn, CASE WHEN role = 'user' THEN 'No linting issues found.' ELSE text END AS output,
                  text || chr(10) || role AS joined FROM conversations""",
    ),
    "first_line": (
        first_line,
        r"""SELECT doc_id, string_split_regex(text, '[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]')[1] AS first_line FROM documents""",
    ),
    "slice_lines": (
        slice_lines,
        r"""WITH p AS (SELECT doc_id, string_split_regex(text, '\r\n|\n|\r') AS parts FROM documents),
            b AS (SELECT doc_id, parts, CAST(ceil(len(parts) / 3) AS INTEGER) AS s, CAST(ceil(2 * len(parts) / 3) AS INTEGER) AS e FROM p)
            SELECT doc_id, s AS start, e AS "end", array_to_string(parts[s:e], chr(10)) AS code FROM b""",
    ),
    "arith_basic": (
        arith_basic,
        """SELECT l_orderkey, l_linenumber, round(l_extendedprice + l_quantity, 6) AS added,
                  round(l_extendedprice - l_quantity, 6) AS subtracted, round(l_extendedprice * l_quantity, 4) AS multiplied,
                  round(l_extendedprice / l_quantity, 8) AS divided FROM lineitem""",
    ),
    "safe_arith": (
        safe_arith,
        """SELECT l_orderkey, l_linenumber,
                  round(CASE WHEN l_discount = 0 THEN -1.0 ELSE l_quantity / l_discount END, 4) AS safe,
                  greatest(10.0::DOUBLE, least(l_quantity, 40.0::DOUBLE)) AS clamped,
                  round(CASE WHEN l_quantity = 10 THEN 0.0 ELSE l_extendedprice / (l_quantity - 10) END, 8) AS safe_default
           FROM lineitem""",
    ),
    "stats_summary": (
        stats_summary,
        """SELECT l_returnflag, l_linestatus, count(l_quantity) AS "count", round(sum(l_quantity), 6) AS "sum",
                  round(avg(l_quantity), 6) AS mean, round(min(l_quantity), 6) AS "min", round(max(l_quantity), 6) AS "max",
                  round(var_pop(l_quantity), 6) AS variance, round(stddev_pop(l_quantity), 6) AS std_dev
           FROM lineitem GROUP BY l_returnflag, l_linestatus""",
    ),
    "average_by_key": (
        average_by_key,
        """SELECT c_custkey, round(coalesce(avg(o_totalprice), 0), 8) AS average
           FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey""",
    ),
    "string_funcs": (
        string_funcs,
        r"""WITH m AS (SELECT doc_id, text, CASE WHEN doc_id % 2 = 0 THEN text || ' ' || reverse(text) ELSE text END AS mirrored FROM documents),
            c AS (SELECT doc_id, text, replace(lower(mirrored), ' ', '') AS cleaned FROM m)
            SELECT doc_id, reverse(text) AS reversed, cleaned = reverse(cleaned) AS palindrome,
                   trim(regexp_replace(text, '[\s\x0b\x1c-\x1f\x{85}\p{Z}]+', ' ', 'g')) AS collapsed FROM c""",
    ),
    "array_funcs": (
        array_funcs,
        f"""WITH w AS (SELECT doc_id, {WORDS_SQL} AS words FROM documents),
            u AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w),
            d AS (SELECT doc_id, word, min(i) AS i FROM u GROUP BY doc_id, word),
            g AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS distinct_words FROM d GROUP BY doc_id)
            SELECT doc_id, array_to_string(list_reverse(words), ' ') AS reversed, distinct_words,
                   array_to_string(flatten(list_transform(words, lambda x: string_split(x, chr(10)))), '|') AS flat
            FROM w JOIN g USING (doc_id)""",
    ),
    "array_duplicates": (
        array_duplicates,
        f"""WITH u AS (SELECT doc_id, unnest({WORDS_SQL}) AS word FROM documents),
            r AS (SELECT doc_id, word FROM u GROUP BY doc_id, word HAVING count(*) > 1),
            g AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY word) AS repeated FROM r GROUP BY doc_id)
            SELECT doc_id, coalesce(n, 0) AS n, coalesce(repeated, '') AS repeated FROM documents LEFT JOIN g USING (doc_id)""",
    ),
    "array_chunk": (
        array_chunk,
        f"""WITH u AS (SELECT doc_id, unnest({WORDS_SQL}) AS word, generate_subscripts({WORDS_SQL}, 1) - 1 AS i FROM documents)
            SELECT doc_id, i // 7 AS pos, string_agg(word, ' ' ORDER BY i) AS run FROM u GROUP BY doc_id, i // 7""",
    ),
}
