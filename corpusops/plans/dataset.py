"""Labelled-example generation over the derived code corpus."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusops.operators import lateral
from corpusops.operators import mutation as M
from corpusops.plans.inputs import CONTENT_SQL, PARTS_CTE, RAW_SQL, TEMPLATES, raw_sources, sources, sql_text
from corpusops.schemas import EXAMPLE
from corpusops.session import durable, scratch_path
from corpusops.sources.examples import read_jsonl, write_jsonl

# expected mutants per template: kind -> replacements, one per site in depth-first order
_GUARD = "    if qty < {s}:\n        raise ValueError('low')\n"
_LOOP_IF = "        if x > {s}:\n            return x\n"
_LOGIC = "a >= {s} and b < {m} or a == b"
_REPLACED = {
    0: {
        "flip_comparison": [("qty < {s}", "qty <= {s}")],
        "remove_guard": [(_GUARD, "")],
        "swap_arithmetic": [("/ 100 + {s}", "/ 100 - {s}"), ("qty * rate", "qty // rate")],
        "silent_wrong_default": [(_GUARD, "    return None\n")],
        "wrong_constant_scale": [(" / 100", "")],
        "off_by_one": [("qty < {s}", "qty < {s1}"), ("/ 100", "/ 101"), ("+ {s}", "+ {s1}")],
    },
    1: {
        "flip_comparison": [("a >= {s}", "a > {s}"), ("b < {m}", "b <= {m}"), ("a == b", "a != b")],
        "swap_boolop": [(_LOGIC, "(a >= {s} and b < {m}) and a == b"), (_LOGIC, "(a >= {s} or b < {m}) or a == b")],
        "off_by_one": [("a >= {s}", "a >= {s1}"), ("b < {m}", "b < {m1}")],
    },
    2: {
        "flip_comparison": [("x > {s}", "x >= {s}")],
        "remove_guard": [(_LOOP_IF, "")],
        "off_by_one": [("x > {s}", "x > {s1}"), ("return -1", "return -2")],
    },
    3: {
        "swap_arithmetic": [("n * {s}", "n // {s}")],
        "wrong_constant_scale": [("n * {s}", "n"), ("n / 100", "n")],
        "off_by_one": [("n * {s}", "n * {s1}"), ("n / 100", "n / 101")],
    },
}


def _mutant_selects() -> list[str]:
    selects = []
    for template, kinds in _REPLACED.items():
        for kind, changes in kinds.items():
            for site, (old, new) in enumerate(changes):
                text = TEMPLATES[template].replace(old, new)
                parses = not (template == 2 and kind == "remove_guard")
                selects.append(
                    f"SELECT {sql_text(text)} AS code, k AS source_id, '{kind}' AS mutation, "
                    f"{M.MUTATION_TYPES.index(kind)} AS type_order, {site} AS site, {str(parses).lower()} AS parses "
                    f"FROM parts WHERE k % 6 = {template}"
                )
    return selects


MUTANTS_CTE = PARTS_CTE + ",\nmutants AS (\n" + "\nUNION ALL ".join(_mutant_selects()) + ")"
EXAMPLES_CTE = (
    MUTANTS_CTE
    + f""",
firsts AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_id, code ORDER BY type_order, site) AS rn FROM mutants) WHERE rn = 1),
examples AS (
  SELECT {CONTENT_SQL} AS code, 0 AS label, k AS source_id, 'none' AS mutation FROM parts WHERE k % 6 <> 5
  UNION ALL SELECT code, 1 AS label, source_id, mutation FROM firsts)"""
)

_PLAIN = ("source_id", "mutation", "site", "code")


def _examples(spark, sf_dir):
    return M.examples(sources(spark, sf_dir))


def normalize_code(spark, sf_dir):
    return M.normalize(raw_sources(spark, sf_dir))


def normalize_changed_count(spark, sf_dir):
    return M.changed_count(M.normalize(raw_sources(spark, sf_dir)))


def mutants_all(spark, sf_dir):
    return M.all_mutants(sources(spark, sf_dir)).select(*_PLAIN, "parses")


def mutants_lateral(spark, sf_dir):
    """The same mutants by a table function in SQL."""
    lateral.register(spark)
    rows = spark.sql("SELECT m.* FROM {held} s, LATERAL code_mutants(s.source_id, s.code) m", held=sources(spark, sf_dir))
    return rows.select(*_PLAIN, "parses")


def mutants_unparsable(spark, sf_dir):
    return M.all_mutants(sources(spark, sf_dir)).where(~F.col("parses")).select(*_PLAIN)


def mutants_delete_statement(spark, sf_dir):
    return M.delete_statement(sources(spark, sf_dir)).select("source_id", "mutation", "code")


def mutation_site_counts(spark, sf_dir):
    return M.site_counts(sources(spark, sf_dir))


def mutants_nth_site(spark, sf_dir):
    return M.nth_site(M.all_mutants(sources(spark, sf_dir)), 1).select(*_PLAIN)


def mutants_first_site(spark, sf_dir):
    return M.first_site_of(sources(spark, sf_dir)).select(*_PLAIN)


def mutants_sampled(spark, sf_dir):
    """At most six per source, of all sites."""
    drawn = M.sample_mutants(M.all_mutants(sources(spark, sf_dir)), first_sites_only=False)
    return drawn.select(*_PLAIN, "place")


def mutants_sampled_first_sites(spark, sf_dir):
    """At most six per source, of each kind's first site."""
    return M.sample_mutants(M.all_mutants(sources(spark, sf_dir))).select(*_PLAIN, "place")


def mutants_dedup(spark, sf_dir):
    return M.dedup_mutants(M.all_mutants(sources(spark, sf_dir))).select(*_PLAIN)


def examples_all(spark, sf_dir):
    return _examples(spark, sf_dir)


def examples_roundtrip(spark, sf_dir):
    path = write_jsonl(_examples(spark, sf_dir), scratch_path(spark, "examples"))
    return read_jsonl(spark, path)


def examples_shuffled(spark, sf_dir):
    placed = M.shuffle_positions(durable(_examples(spark, sf_dir)))
    return placed.select("pos", *EXAMPLE.fieldNames())


def example_label_counts(spark, sf_dir):
    return M.label_counts(_examples(spark, sf_dir))


def example_type_counts(spark, sf_dir):
    return M.type_counts(_examples(spark, sf_dir))


_SITE_VALUES = ", ".join(
    f"({t}, '{kind}', {len(_REPLACED.get(t, {}).get(kind, []))})" for t in range(5) for kind in M.MUTATION_TYPES
)


def _sampled_sql(where: str) -> str:
    return f"""WITH {EXAMPLES_CTE}, d AS (
      SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY md5(concat('42:', source_id, ':', mutation, ':', site)), mutation, site) AS place
      FROM firsts WHERE {where})
    SELECT source_id, mutation, site, code, CAST(place AS INTEGER) AS place FROM d WHERE place <= 6"""


QUERIES = {
    "normalize_code": (
        normalize_code,
        f"""WITH {PARTS_CTE} SELECT k AS source_id, CASE WHEN k % 6 <> 5 THEN {CONTENT_SQL} END AS code,
            CASE WHEN k % 6 <> 5 THEN {RAW_SQL} <> {CONTENT_SQL} END AS changed FROM parts""",
    ),
    "normalize_changed_count": (
        normalize_changed_count,
        f"""WITH {PARTS_CTE} SELECT count(*) FILTER (k % 6 <> 5 AND {RAW_SQL} <> {CONTENT_SQL}) AS changed,
            count(*) FILTER (k % 6 <> 5) AS sources FROM parts""",
    ),
    "mutants_all": (mutants_all, f"WITH {MUTANTS_CTE} SELECT source_id, mutation, site, code, parses FROM mutants"),
    "mutants_lateral": (mutants_lateral, f"WITH {MUTANTS_CTE} SELECT source_id, mutation, site, code, parses FROM mutants"),
    "mutants_unparsable": (
        mutants_unparsable,
        f"WITH {MUTANTS_CTE} SELECT source_id, mutation, site, code FROM mutants WHERE NOT parses",
    ),
    "mutants_delete_statement": (
        mutants_delete_statement,
        f"""WITH {PARTS_CTE} SELECT k AS source_id, 'delete_statement' AS mutation,
            {sql_text("def part_{k}(a, b):" + chr(10) + "    return " + _LOGIC)} AS code FROM parts WHERE k % 6 = 1""",
    ),
    "mutation_site_counts": (
        mutation_site_counts,
        f"""WITH {PARTS_CTE}, sites(template, mutation, sites) AS (VALUES {_SITE_VALUES})
            SELECT k AS source_id, mutation, sites FROM parts JOIN sites ON template = k % 6""",
    ),
    "mutants_nth_site": (
        mutants_nth_site,
        f"WITH {MUTANTS_CTE} SELECT source_id, mutation, site, code FROM mutants WHERE site = 1",
    ),
    "mutants_first_site": (
        mutants_first_site,
        f"""WITH {MUTANTS_CTE}, d AS (
              SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY md5(concat('42:', source_id, ':', mutation))) AS rn
              FROM mutants WHERE site = 0)
            SELECT source_id, mutation, site, code FROM d WHERE rn = 1""",
    ),
    "mutants_sampled": (mutants_sampled, _sampled_sql("true")),
    "mutants_sampled_first_sites": (mutants_sampled_first_sites, _sampled_sql("site = 0")),
    "mutants_dedup": (mutants_dedup, f"WITH {EXAMPLES_CTE} SELECT source_id, mutation, site, code FROM firsts"),
    "examples_all": (examples_all, f"WITH {EXAMPLES_CTE} SELECT code, label, source_id, mutation FROM examples"),
    "examples_roundtrip": (examples_roundtrip, f"WITH {EXAMPLES_CTE} SELECT code, label, source_id, mutation FROM examples"),
    "examples_shuffled": (
        examples_shuffled,
        f"""WITH {EXAMPLES_CTE} SELECT row_number() OVER (ORDER BY md5(concat('42:', source_id, ':', label, ':', mutation, ':', md5(code)))) - 1 AS pos,
            code, label, source_id, mutation FROM examples""",
    ),
    "example_label_counts": (
        example_label_counts,
        f"""WITH {EXAMPLES_CTE} SELECT count(*) AS examples, count(*) FILTER (label = 0) AS clean,
            count(*) FILTER (label = 1) AS buggy FROM examples""",
    ),
    "example_type_counts": (
        example_type_counts,
        f"WITH {EXAMPLES_CTE} SELECT mutation, count(*) AS examples FROM examples GROUP BY mutation",
    ),
}
