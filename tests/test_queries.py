import importlib.util
import pathlib

import pytest
from parity import compare

from corpusops.plans.catalog import QUERIES

DATA = pathlib.Path("/root/testdata/sf0.001")
needs_data = pytest.mark.skipif(not DATA.exists(), reason="test tables are not here")


def entry_module():
    path = pathlib.Path(__file__).parent.parent / "__spark_entry__.py"
    spec = importlib.util.spec_from_file_location("spark_entry", path)
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


def test_entry_module_lists_the_catalog():
    module = entry_module()
    # the optional operators add their own
    assert set(module.queries()) >= set(QUERIES)
    assert set(QUERIES) - set(module.oracle_sql()) == {
        "classifier_fit_predict",
        "cv_predictions",
        "code_classifier_report",
        "fresh_code_report",
    }


@needs_data
def test_flagship(spark):
    row = entry_module().entry(spark).first()
    assert row.total == 10 and row.top1_hits <= row.hits <= row.total


@needs_data
@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_its_sql_and_has_no_product_join(spark, name, capsys):
    query, sql = QUERIES[name]
    df = query(spark, str(DATA))
    df.explain("simple")
    plan = capsys.readouterr().out
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name in {"knn_topk", "mutants_sampled", "index_roundtrip_search"}:
        assert "WindowGroupLimit" in plan
    count, difference = compare(spark, name, lambda *_: df, sql, str(DATA))
    assert not difference
    assert count > 0
