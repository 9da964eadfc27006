"""Labelled defects by syntax-tree edits: every site of every kind, in one pass per source.

A defect is one attribute of one tree node set to another value. Each edit is applied in place,
its statement is written out, and the attribute is put back, so a source is parsed once and never
copied, however many sites it has. Python only enumerates; counting, choosing, sampling,
labelling and ordering are relational.
"""

from __future__ import annotations

import ast
import copy
import hashlib
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from corpusops.operators.arrow_rows import flat_map
from corpusops.operators.ranking import hash_rank
from corpusops.schemas import EXAMPLE, MUTANT, NORMALIZED, SITE_COUNT

# The kinds in labelling order, the operator pairs they exchange, the clean label.
MUTATION_TYPES = (
    "flip_comparison",
    "remove_guard",
    "swap_arithmetic",
    "swap_boolop",
    "silent_wrong_default",
    "wrong_constant_scale",
    "off_by_one",
)
COMPARISON_PAIRS = ((ast.Lt, ast.LtE), (ast.Gt, ast.GtE), (ast.Eq, ast.NotEq))
ARITHMETIC_PAIRS = ((ast.Add, ast.Sub), (ast.Mult, ast.FloorDiv))
CLEAN = "none"
SEED = 42
MAX_MUTANTS = 6

_FLIPPED = {a: b for x, y in COMPARISON_PAIRS for a, b in ((x, y), (y, x))}
_SWAPPED = {a: b for x, y in ARITHMETIC_PAIRS for a, b in ((x, y), (y, x))}
_UNPARSABLE = (SyntaxError, ValueError, RecursionError, MemoryError)


def _preorder(root: ast.AST) -> Iterator[tuple]:
    """(node, its statement, parent, field, place in a list field) depth first, fields in declared order."""
    stack = [(root, None, None, "", None)]
    while stack:
        here = stack.pop()
        yield here
        node, statement, slots = here[0], here[1], []
        for field, value in ast.iter_fields(node):
            children = enumerate(value) if isinstance(value, list) else [(None, value)]
            slots += [
                (child, child if isinstance(child, ast.stmt) else statement, node, field, place)
                for place, child in children
                if isinstance(child, ast.AST)
            ]
        stack.extend(reversed(slots))


def _in_place_of(parent: ast.AST, field: str, place: int | None, *nodes: ast.AST) -> tuple:
    """The edit that puts ``nodes`` where a child is now."""
    if place is None:
        return parent, field, nodes[0]
    siblings = getattr(parent, field)
    return parent, field, [*siblings[:place], *nodes, *siblings[place + 1 :]]


def _edits(node: ast.AST, *slot) -> Iterator[tuple]:
    """(kind, (owner, attribute, new value)) for each defect this node is a site of."""
    match node:
        case ast.Compare(ops=ops) if not _FLIPPED.keys().isdisjoint(map(type, ops)):
            yield "flip_comparison", (node, "ops", [_FLIPPED.get(type(op), type(op))() for op in ops])
        case ast.If():
            yield "remove_guard", _in_place_of(*slot)
            if any(isinstance(inner, ast.Raise) for inner in ast.walk(node)):
                yield "silent_wrong_default", _in_place_of(*slot, ast.Return(ast.Constant(None)))
        case ast.BinOp(left=left, op=op, right=right):
            if type(op) in _SWAPPED:
                yield "swap_arithmetic", (node, "op", _SWAPPED[type(op)]())
            if isinstance(op, ast.Mult | ast.Div):
                if isinstance(right, ast.Constant):
                    yield "wrong_constant_scale", _in_place_of(*slot, left)
                elif isinstance(left, ast.Constant):
                    yield "wrong_constant_scale", _in_place_of(*slot, right)
        case ast.BoolOp(op=op):
            yield "swap_boolop", (node, "op", ast.And() if isinstance(op, ast.Or) else ast.Or())
        case ast.Constant(value=value) if type(value) is int:
            yield "off_by_one", _in_place_of(*slot, ast.Constant(value + 1))


def _sites(tree: ast.AST) -> dict[str, list[tuple]]:
    """(statement, edit) by kind; a site's number is its place in depth-first order."""
    sites = {kind: [] for kind in MUTATION_TYPES}
    for node, statement, *slot in _preorder(tree):
        for kind, edit in _edits(node, *slot):
            sites[kind].append((statement, edit))
    return sites


@contextmanager
def _applied(owner: ast.AST, attribute: str, value) -> Iterator[None]:
    before = getattr(owner, attribute)
    setattr(owner, attribute, value)
    try:
        yield
    finally:
        setattr(owner, attribute, before)


def _written_with(tree: ast.AST, edit: tuple) -> str | None:
    with _applied(*edit):
        try:
            return ast.unparse(tree)
        except _UNPARSABLE:
            return None


def _header(statement: ast.stmt) -> str:
    """First line of a compound statement."""
    short = copy.copy(statement)
    for field in ("orelse", "finalbody", "handlers"):
        if hasattr(short, field):
            setattr(short, field, [])
    short.body = [ast.Pass()]
    return ast.unparse(short).partition("\n")[0]


def _changed_lines(lines: list[str], statement: ast.stmt, edit: tuple) -> tuple | None:
    """(first, end, new lines) of an edit in text written from the tree, None where that is not certain.

    Every statement has lines of its own there, and its text does not depend on its neighbours,
    but for an ``elif``, a docstring, and blank lines at the top.
    """
    owner, attribute, value = edit
    first = statement.lineno - 1
    indent, old = lines[first][: statement.col_offset], lines[first][statement.col_offset :]
    if attribute in ("body", "orelse", "finalbody") and isinstance(value, list):
        at = getattr(owner, attribute).index(statement)
        if attribute != "body" or not value:
            return None
        if len(value) == len(getattr(owner, attribute)):
            return first, statement.end_lineno, [indent + ast.unparse(value[at])]
        if at == 0 and (isinstance(owner, ast.Module) or isinstance(value[0], ast.Expr)):
            return None
        return first, statement.end_lineno, []
    if isinstance(statement, ast.Match):
        return None
    if not hasattr(statement, "body"):
        with _applied(*edit):
            return first, statement.end_lineno, [indent + ast.unparse(statement)]
    before = _header(statement)
    with _applied(*edit):
        after = _header(statement)
    keyword = "el" if old == "el" + before else ""
    # an edit the header does not show lies in a handler, a case or a decorator
    return (first, first + 1, [indent + keyword + after]) if old == keyword + before != keyword + after else None


def _mutated(tree: ast.AST, lines: list[str], statement: ast.stmt | None, edit: tuple) -> str | None:
    """Text of the edited tree: its changed lines alone are written anew where possible.

    A source of n lines has some n sites; writing all of it for each would take n * n steps.
    """
    try:
        span = statement and _changed_lines(lines, statement, edit)
    except _UNPARSABLE:
        span = None
    if not span:
        return _written_with(tree, edit)
    first, end, new = span
    return "\n".join(lines[:first] + new + lines[end:])


def _parses(code: str) -> bool:
    try:
        ast.parse(code)
    except _UNPARSABLE:
        return False
    return True


def _normal_form(code: str) -> str | None:
    try:
        return ast.unparse(ast.parse(code))
    except _UNPARSABLE:
        return None


def _labelled(source_id: int, raw: str) -> Iterator[tuple]:
    """The clean example, then each mutant that differs from it; nothing for an unparsable source."""
    base = _normal_form(raw)
    if base is None:
        return
    yield base, 0, source_id, CLEAN, -1, -1, True, True
    tree, lines, seen = ast.parse(base), base.split("\n"), set()
    for order, (kind, edits) in enumerate(_sites(tree).items()):
        for site, (statement, edit) in enumerate(edits):
            code = _mutated(tree, lines, statement, edit)
            if code and code != base:
                # only an emptied statement list can leave text that does not parse
                parses = edit[2] != [] or _parses(code)
                # a digest, as the texts of a long source do not fit in memory together
                digest = hashlib.blake2b(code.encode("utf-8", "surrogatepass"), digest_size=16).digest()
                yield code, 1, source_id, kind, order, site, parses, digest not in seen
                seen.add(digest)


def expand(sources: DataFrame) -> DataFrame:
    """Clean and mutated rows of each (source_id, code), before any choice among them.

    ``first_in_source`` marks the first row of each mutant text within its source. All mutants of
    a source leave one input row, so this costs no shuffle.
    """
    return flat_map(sources.select("source_id", "code"), _labelled, MUTANT)


def all_mutants(sources: DataFrame) -> DataFrame:
    return expand(sources).where(F.col("label") == 1)


def dedup_mutants(mutants: DataFrame) -> DataFrame:
    """One row per mutant text and source; the first kind in labelling order names it."""
    return mutants.where("first_in_source")


def examples(sources: DataFrame) -> DataFrame:
    """Labelled examples: each clean source and its distinct mutants."""
    return expand(sources).where("first_in_source").select(*EXAMPLE.fieldNames())


def nth_site(mutants: DataFrame, n: int) -> DataFrame:
    """The mutant of each kind's n-th site (0-based); no row where a source has no such site."""
    return mutants.where(F.col("site") == n)


def site_counts(sources: DataFrame) -> DataFrame:
    """Sites per source and kind, zeros included."""

    def count(source_id: int, raw: str) -> Iterator[tuple]:
        base = _normal_form(raw)
        if base is not None:
            for kind, edits in _sites(ast.parse(base)).items():
                yield source_id, kind, len(edits)

    return flat_map(sources.select("source_id", "code"), count, SITE_COUNT)


def _draw(seed: int, *parts: Column | str) -> Column:
    """Reproducible random order: rows sort by a hash of the seed and their key."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(p).cast("string") if isinstance(p, str) else p for p in parts]))


def first_site_mutant(mutants: DataFrame, seed: int = SEED) -> DataFrame:
    """One mutant per source: the first site of a kind drawn at random among those that apply."""
    drawn = mutants.where(F.col("site") == 0).withColumn("draw", _draw(seed, "source_id", "mutation"))
    kept = [c for c in mutants.columns if c != "source_id"]
    least = drawn.groupBy("source_id").agg(F.min_by(F.struct(*kept), "draw").alias("row"))
    return least.select("source_id", "row.*").select(*mutants.columns)


def first_site_of(sources: DataFrame, seed: int = SEED) -> DataFrame:
    """What ``first_site_mutant`` gives for all mutants of (source_id, code), chosen where they are made.

    A source's kinds are tried in the order of their draws, so only the chosen mutant is ever built; no shuffle.
    """

    def chosen(source_id: int, raw: str) -> Iterator[tuple]:
        base = _normal_form(raw)
        if base is None:
            return
        tree, lines = ast.parse(base), base.split("\n")
        kinds = [(order, kind, edits[0]) for order, (kind, edits) in enumerate(_sites(tree).items()) if edits]
        for order, kind, (statement, edit) in sorted(kinds, key=lambda k: hashlib.md5(f"{seed}:{source_id}:{k[1]}".encode()).hexdigest()):
            code = _mutated(tree, lines, statement, edit)
            if code and code != base:
                yield code, 1, source_id, kind, order, 0, edit[2] != [] or _parses(code), True
                return

    return flat_map(sources.select("source_id", "code"), chosen, MUTANT)


def sample_mutants(mutants: DataFrame, limit: int = MAX_MUTANTS, seed: int = SEED, first_sites_only: bool = True) -> DataFrame:
    """At most ``limit`` distinct mutants per source, drawn by hash.

    The ranking keeps ``limit`` rows per source in each task before the shuffle, so a source
    with very many sites does not fill one task.
    """
    pool = mutants.where(F.col("site") == 0) if first_sites_only else mutants
    pool = pool.where("first_in_source").withColumn("draw", _draw(seed, "source_id", "mutation", "site"))
    order = W.partitionBy("source_id").orderBy("draw", "mutation", "site")
    return pool.withColumn("place", F.row_number().over(order)).where(F.col("place") <= limit).drop("draw")


def delete_statement(sources: DataFrame, seed: int = SEED) -> DataFrame:
    """Drop one assignment or expression statement of a function; off the default list of kinds.

    The first function in depth-first order that keeps a statement afterwards is the one edited.
    """

    def drop_one(source_id: int, raw: str) -> Iterator[tuple]:
        base = _normal_form(raw)
        tree = ast.parse(base or "")
        for node, *_ in _preorder(tree):
            if isinstance(node, ast.FunctionDef) and len(node.body) > 1:
                choices = [i for i, s in enumerate(node.body) if isinstance(s, ast.Assign | ast.AugAssign | ast.Expr)]
                if choices:
                    ticket = int(hashlib.md5(f"{seed}:{source_id}".encode()).hexdigest(), 16)
                    at = choices[ticket % len(choices)]
                    code = _written_with(tree, (node, "body", node.body[:at] + node.body[at + 1 :]))
                    yield code, 1, source_id, "delete_statement"
                    return

    return flat_map(sources.select("source_id", "code"), drop_one, EXAMPLE)


def normalize(sources: DataFrame) -> DataFrame:
    """Canonical text of each source, null where it does not parse, and whether it changed."""

    def one(source_id: int, raw: str) -> Iterator[tuple]:
        base = _normal_form(raw)
        yield source_id, base, None if base is None else base != raw

    return flat_map(sources.select("source_id", "code"), one, NORMALIZED)


def normal_form(code: Column) -> Column:
    """Canonical text as a column; text that does not parse stays as it is."""

    def rewrite(batch: pd.Series) -> pd.Series:
        return batch.map(lambda text: text if text is None else _normal_form(text) or text)

    return F.pandas_udf(rewrite, "string")(code)


def example_key(seed: int = SEED) -> Column:
    return _draw(seed, "source_id", "label", "mutation", F.md5("code"))


def shuffled(rows: DataFrame, seed: int = SEED) -> DataFrame:
    """Examples in a reproducible random order (a range-partitioned sort)."""
    return rows.withColumn("draw", example_key(seed)).orderBy("draw").drop("draw")


def shuffle_positions(rows: DataFrame, seed: int = SEED) -> DataFrame:
    """Each example's 0-based place in that order, without sorting the table in one task."""
    ranked = hash_rank(rows.withColumn("draw", example_key(seed)), "draw", out="place")
    return ranked.withColumn("pos", F.col("place") - 1).drop("draw", "place")


def label_counts(rows: DataFrame) -> DataFrame:
    return rows.agg(
        F.count("*").alias("examples"),
        F.count_if(F.col("label") == 0).alias("clean"),
        F.count_if(F.col("label") == 1).alias("buggy"),
    )


def type_counts(rows: DataFrame) -> DataFrame:
    """Examples per kind, fewest first."""
    return rows.groupBy("mutation").agg(F.count("*").alias("examples")).orderBy("examples", "mutation")


def changed_count(normalized: DataFrame) -> DataFrame:
    return normalized.agg(
        F.count_if("changed").alias("changed"),
        F.count("code").alias("sources"),
    )
