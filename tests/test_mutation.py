import argparse
import ast
import inspect
import json.decoder
import statistics
import textwrap

import pytest
from pyspark.sql import functions as F

from corpusops.operators import mutation as M
from corpusops.plans.inputs import TEMPLATES
from corpusops.schemas import EXAMPLE

BANK = [t.format(k=17, s=17, m=8) for _, t in sorted(TEMPLATES.items())] + [
    "def chain(a, b, c):\n    return a < b <= c != 3",
    "def sign(x=-1, flag=True):\n    return [x, 0.5, flag][1:]",
    "def member(x, y):\n    return x in y or x is None or not y",
    "def nested(a):\n    if a > 1:\n        if a > 2:\n            raise KeyError\n    elif a == 5:\n        pass\n    else:\n        a = 2 * 3\n    return a",
    "def scaled(x):\n    return 2 * x + x / 3 + 4 * 5 + x % 2 + x ** 2",
    "class K:\n\n    def f(self):\n        total = 1\n        total += 2\n        print(total)\n        return total",
    "def lone(x):\n    x.run()",
    "f'{a + 1}'",
    "match x:\n    case 1:\n        y = 2",
]


def bank(spark, codes=BANK):
    return spark.createDataFrame(list(enumerate(codes)), "source_id long, code string").repartition(4)


def mutants(spark, codes=BANK):
    return M.all_mutants(bank(spark, codes)).orderBy("source_id", "type_order", "site").collect()


def of(rows, source_id, kind):
    return [r.code for r in rows if r.source_id == source_id and r.mutation == kind]


def test_template_mutants(spark):
    rows = mutants(spark)
    assert of(rows, 0, "swap_arithmetic")[1].endswith("return qty // rate / 100 + 17")
    assert of(rows, 0, "silent_wrong_default") == ["def part_17(qty, rate):\n    return None\n    return qty * rate / 100 + 17"]
    assert of(rows, 0, "wrong_constant_scale")[0].endswith("return qty * rate + 17")
    assert [c.split("return ")[1] for c in of(rows, 1, "swap_boolop")] == [
        "(a >= 17 and b < 8) and a == b",
        "(a >= 17 or b < 8) or a == b",
    ]
    removed = [r for r in rows if r.source_id == 2 and r.mutation == "remove_guard"]
    assert [r.parses for r in removed] == [False] and "for x in items:\n    return -1" in removed[0].code
    assert of(rows, 2, "off_by_one")[1].endswith("return -2")
    assert not [r for r in rows if r.source_id in (4, 5)]


def test_edge_semantics(spark):
    rows = mutants(spark)
    # a chain flips as one site; membership and identity are not comparisons to flip
    assert of(rows, 6, "flip_comparison") == ["def chain(a, b, c):\n    return a <= b < c == 3"]
    assert of(rows, 8, "flip_comparison") == []
    # defaults, subscripts and literals under a minus count; bools and floats do not
    assert [c.split("\n")[0][9:] for c in of(rows, 7, "off_by_one")][0] == "x=-2, flag=True):"
    assert len(of(rows, 7, "off_by_one")) == 2
    # an if without a raise is no site of the silent default, but one for removal
    assert len(of(rows, 9, "silent_wrong_default")) == 2
    assert len(of(rows, 9, "remove_guard")) == 3
    assert of(rows, 9, "remove_guard")[0] == "def nested(a):\n    return a"
    # the right constant wins; modulo and power are no sites
    assert [c.split("return ")[1] for c in of(rows, 10, "wrong_constant_scale")] == [
        "x + x / 3 + 4 * 5 + x % 2 + x ** 2",
        "2 * x + x + 4 * 5 + x % 2 + x ** 2",
        "2 * x + x / 3 + 4 + x % 2 + x ** 2",
    ]
    assert of(rows, 13, "off_by_one") == ["f'{a + 2}'"]
    assert len(of(rows, 14, "off_by_one")) == 2


def independent_count(tree, kind):
    """Sites counted over all nodes, in no particular order."""
    test = {
        "flip_comparison": lambda n: isinstance(n, ast.Compare) and any(isinstance(o, ast.Lt | ast.LtE | ast.Gt | ast.GtE | ast.Eq | ast.NotEq) for o in n.ops),
        "remove_guard": lambda n: isinstance(n, ast.If),
        "swap_arithmetic": lambda n: isinstance(n, ast.BinOp) and isinstance(n.op, ast.Add | ast.Sub | ast.Mult | ast.FloorDiv),
        "swap_boolop": lambda n: isinstance(n, ast.BoolOp),
        "silent_wrong_default": lambda n: isinstance(n, ast.If) and any(isinstance(i, ast.Raise) for i in ast.walk(n)),
        "wrong_constant_scale": lambda n: isinstance(n, ast.BinOp) and isinstance(n.op, ast.Div | ast.Mult) and ast.Constant in (type(n.left), type(n.right)),
        "off_by_one": lambda n: isinstance(n, ast.Constant) and type(n.value) is int,
    }[kind]
    return sum(map(test, ast.walk(tree)))


def test_site_counts_include_zeros_and_agree_with_mutants(spark):
    counts = {(r.source_id, r.mutation): r.sites for r in M.site_counts(bank(spark)).collect()}
    parsable = [i for i, c in enumerate(BANK) if i != 5]
    assert len(counts) == len(parsable) * len(M.MUTATION_TYPES)
    made = {}
    for r in mutants(spark):
        made[r.source_id, r.mutation] = made.get((r.source_id, r.mutation), 0) + 1
    for (source, kind), n in counts.items():
        assert n == independent_count(ast.parse(BANK[source]), kind)
        assert made.get((source, kind), 0) == n


def test_every_mutant_differs_and_the_flag_tells_what_parses(spark):
    for r in mutants(spark):
        assert r.code != ast.unparse(ast.parse(BANK[r.source_id]))
        try:
            ast.parse(r.code)
            parses = True
        except SyntaxError:
            parses = False
        assert r.parses == parses


@pytest.mark.parametrize("code", [*BANK, *map(inspect.getsource, (argparse, textwrap, json.decoder, statistics))])
def test_writing_changed_lines_equals_writing_the_whole_tree(code):
    base = M._normal_form(code)
    if base is None:
        return
    tree, lines = ast.parse(base), base.split("\n")
    sites = [site for found in M._sites(tree).values() for site in found]
    for statement, edit in sites[:: max(1, len(sites) // 150)]:
        assert M._mutated(tree, lines, statement, edit) == M._written_with(tree, edit)
    assert ast.unparse(tree) == base


AWKWARD = [
    "if a:\n    def f():\n        pass",
    "if a > 1:\n    x = 1\ndef g():\n    return 2",
    "def f(a):\n    if a:\n        pass\n    'text'\n    return 1",
    "def f(a):\n    if a:\n        x = 1\n    else:\n        if a > 2:\n            raise KeyError\n        y = 2\n        if a > 3:\n            raise KeyError",
    "try:\n    x = 1\nexcept E[1]:\n    if x:\n        raise\nfinally:\n    if x == 2:\n        pass",
    "@deco(1)\ndef f(a=1, *, b=2):\n    while a < 1 and b > 2:\n        a += 1\n    else:\n        a = 3\n    with open(1) as x, open(2):\n        pass",
    "for i in range(1):\n    if i:\n        continue\n    elif i > 1 or i < 2:\n        i = 4\n    elif i:\n        pass",
    "async def f():\n    async for i in g(1):\n        async with h(2):\n            await k(3)",
    "class A(b[1]):\n    x: int = 2\n    y = lambda z=3: z * 4\n    s = f\"\"\"a\n{x + 5}\"\"\"",
    "match a:\n    case 1 if a > 2:\n        if a:\n            b = 1\n        c = 2",
]


@pytest.mark.parametrize("code", AWKWARD)
def test_changed_lines_in_awkward_places(code):
    base = M._normal_form(code)
    tree, lines = ast.parse(base), base.split("\n")
    sites = [site for found in M._sites(tree).values() for site in found]
    assert sites
    for statement, edit in sites:
        assert M._mutated(tree, lines, statement, edit) == M._written_with(tree, edit)


def test_equal_mutants_of_a_source_keep_the_first_kind(spark):
    # both kinds turn this into the same text
    code = "def f(a):\n    if a:\n        raise ValueError\n    return None"
    twice = "def g(a):\n    return a * 1 + a * 1"
    rows = M.dedup_mutants(M.all_mutants(bank(spark, [code, twice]))).collect()
    keys = [(r.source_id, r.code) for r in rows]
    assert len(keys) == len(set(keys))
    everything = M.all_mutants(bank(spark, [code, twice])).collect()
    for r in rows:
        same = [(e.type_order, e.site) for e in everything if (e.source_id, e.code) == (r.source_id, r.code)]
        assert (r.type_order, r.site) == min(same)


def test_no_dedup_across_sources(spark):
    rows = M.examples(bank(spark, ["def f(a):\n    return a + 1"] * 3))
    assert rows.groupBy("code").count().where("count <> 3").count() == 0


def test_examples_hold_each_clean_source_once(spark):
    rows = M.examples(bank(spark))
    assert rows.schema.fieldNames() == EXAMPLE.fieldNames()
    clean = rows.where("label = 0").collect()
    assert sorted(r.source_id for r in clean) == [i for i in range(len(BANK)) if i != 5]
    assert {r.mutation for r in clean} == {"none"}
    counts = M.label_counts(rows).first()
    assert counts.clean + counts.buggy == counts.examples == rows.count()
    per_kind = [(r.examples, r.mutation) for r in M.type_counts(rows).collect()]
    assert per_kind == sorted(per_kind) and sum(n for n, _ in per_kind) == counts.examples


def test_order_and_choices_do_not_depend_on_partitioning(spark):
    def outcome(partitions):
        spread = bank(spark).repartition(partitions)
        pool = M.all_mutants(spread)
        drawn = M.sample_mutants(pool, limit=2, first_sites_only=False)
        return (
            sorted((r.source_id, r.mutation) for r in M.first_site_mutant(pool).collect()),
            sorted((r.source_id, r.place, r.mutation, r.site) for r in drawn.collect()),
            sorted((r.pos, r.source_id, r.mutation, r.code) for r in M.shuffle_positions(M.examples(spread)).collect()),
        )

    assert outcome(1) == outcome(8)


def test_shuffle_positions_are_the_sorted_order(spark):
    rows = M.examples(bank(spark))
    placed = [(r.source_id, r.mutation, r.code) for r in M.shuffle_positions(rows).orderBy("pos").collect()]
    assert placed == [(r.source_id, r.mutation, r.code) for r in M.shuffled(rows).collect()]
    assert placed != sorted(placed)


def test_sampling_limits_and_kinds(spark):
    pool = M.all_mutants(bank(spark))
    drawn = M.sample_mutants(pool, limit=3, first_sites_only=False).collect()
    per_source = {}
    for r in drawn:
        per_source.setdefault(r.source_id, set()).add(r.code)
    assert all(len(codes) <= 3 for codes in per_source.values())
    available = {r.source_id: r.n for r in pool.where("first_in_source").groupBy("source_id").agg(F.count("*").alias("n")).collect()}
    assert {s: len(c) for s, c in per_source.items()} == {s: min(3, n) for s, n in available.items()}
    assert all(r.site == 0 for r in M.sample_mutants(pool).collect())
    one = M.first_site_mutant(pool).collect()
    assert sorted(r.source_id for r in one) == sorted(available) and all(r.site == 0 for r in one)


def test_nth_site_is_absent_beyond_the_last(spark):
    pool = M.all_mutants(bank(spark))
    assert {r.site for r in M.nth_site(pool, 1).collect()} == {1}
    assert M.nth_site(pool, 99).count() == 0


def test_deleting_a_statement_never_empties_a_function(spark):
    rows = {r.source_id: r.code for r in M.delete_statement(bank(spark)).collect()}
    assert "lone" not in str(rows) and 0 not in rows
    before = ast.parse(BANK[11]).body[0].body[0].body
    after = ast.parse(rows[11]).body[0].body[0].body
    assert len(after) == len(before) - 1 and isinstance(after[-1], ast.Return)
    assert rows == {r.source_id: r.code for r in M.delete_statement(bank(spark).repartition(1)).collect()}


def test_normal_form(spark):
    codes = ['x = "a"  # note', "x = 'a'", "def f(:"]
    rows = {r.source_id: (r.code, r.changed) for r in M.normalize(bank(spark, codes)).collect()}
    assert rows == {0: ("x = 'a'", True), 1: ("x = 'a'", False), 2: (None, None)}
    assert M.changed_count(M.normalize(bank(spark, codes))).first().asDict() == {"changed": 1, "sources": 2}
    column = bank(spark, codes).select("source_id", M.normal_form(F.col("code")).alias("code")).collect()
    assert {r.source_id: r.code for r in column} == {0: "x = 'a'", 1: "x = 'a'", 2: "def f(:"}
