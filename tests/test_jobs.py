import json

import pytest
from pyspark.sql import functions as F

from corpusops import jobs
from corpusops.operators import vectors as V
from corpusops.plans.inputs import TEMPLATES

MATH = '''"""Numbers."""


def total(values):
    """Add all values."""
    result = 0
    for v in values:
        result += v
    return result


def quotient(a, b):
    """Divide one value by another."""
    if b == 0:
        raise ZeroDivisionError('zero divisor')
    return a / b
'''
WORDS = '''class Words:
    def shout(self, text):
        """Upper case letters."""
        return text.upper() + '!'
'''


@pytest.fixture
def repo(tmp_path):
    (tmp_path / "repo/pkg").mkdir(parents=True)
    (tmp_path / "repo/math_tools.py").write_text(MATH)
    (tmp_path / "repo/pkg/__init__.py").write_text(WORDS)
    return str(tmp_path / "repo")


def test_index_search_and_evaluate(spark, repo, tmp_path):
    embedder, path = V.HashedEmbedder(128), str(tmp_path / "index")
    assert jobs.index_repository(spark, repo, embedder, path) == 5
    saved = V.HashedEmbedder.load(spark, embedder.save(spark, str(tmp_path / "embedder")))
    queries = spark.createDataFrame(
        [(1, "divide value by another zero divisor", "math_tools.py::quotient"), (2, "upper case letters text", "pkg/__init__.py::shout")],
        "query_id int, query string, expected_id string",
    )
    hits = jobs.search_index(V.load_index(spark, path), saved, queries, 3)
    assert hits.count() == 6
    log, summary = jobs.evaluate_models(jobs.chunk_repository(spark, repo), queries, {"wide": V.HashedEmbedder(128), "narrow": V.HashedEmbedder(2)})
    rows = {r.model: r for r in summary.collect()}
    assert rows["wide"].total == 2 and rows["wide"].top1_hits == 2 and rows["wide"].mrr == 1.0
    assert rows["narrow"].mrr <= 1.0 and log.count() == 4


def test_compare_chunking(spark, repo):
    files = spark.createDataFrame([("m.py", MATH), ("w.py", WORDS)], "path string, text string")
    rows = {r.file: r for r in jobs.compare_chunking(files, 100).collect()}
    assert rows["m.py"].fixed_chunks == -(-len(MATH) // 100)
    assert rows["m.py"].units == 2 and rows["m.py"].cut_units == 2


def sources(spark, n=48):
    rows = [(i, TEMPLATES[i % 4].format(k=i, s=1 + i % 50, m=i % 97)) for i in range(n)]
    return spark.createDataFrame(rows, "source_id long, code string")


def test_dataset_training_and_fresh_scoring(spark, tmp_path):
    examples = jobs.generate_dataset(sources(spark), str(tmp_path / "examples"))
    assert examples.where("label = 0").count() == 48
    model_path, metrics_path = str(tmp_path / "model"), str(tmp_path / "metrics")
    result = jobs.train_and_report(examples, model_path, metrics_path)
    metrics = result["metrics"].first()
    assert {r.split for r in result["balance"].collect()} == {"train", "test"}
    assert sum(r.total for r in result["by_mutation"].collect()) == metrics.n == result["predictions"].count()
    written = json.loads(spark.read.text(metrics_path).first().value)
    assert written["balanced_accuracy"] == pytest.approx(metrics.balanced_accuracy)
    assert written["majority_baseline_accuracy"] == pytest.approx(result["baseline"].first().majority_baseline_accuracy)
    fresh = sources(spark, 4).select(F.concat("code", F.lit("  # c")).alias("code"), F.lit(0).alias("label"), F.lit("x").alias("category"))
    scored, by_category = jobs.score_saved_model(model_path, fresh)
    assert scored.count() == by_category.first().total == 4


def test_cross_validation(spark, tmp_path):
    examples = jobs.generate_dataset(sources(spark, 24), str(tmp_path / "examples"))
    result = jobs.cross_validate(examples, 3, str(tmp_path / "predictions"))
    saved = spark.read.json(str(tmp_path / "predictions"))
    assert saved.count() == examples.count() and set(saved.columns) >= {"code", "label", "source_id", "mutation", "predicted", "correct"}
    assert saved.where("correct <> (predicted = label)").count() == 0
    summary = result["summary"].first()
    assert summary.folds == 3 and result["by_fold"].count() == 3
    assert 0 <= summary.pooled <= 1
    with pytest.raises(ValueError, match="mutation"):
        jobs.cross_validate(examples.drop("mutation"))


def test_rejects_come_with_the_chunks(spark, tmp_path):
    (tmp_path / "good.py").write_text("def f():\n    return 1\n")
    (tmp_path / "bad.py").write_text("def f(:\n")
    (tmp_path / "raw.py").write_bytes(b"\xff\xfe")
    chunks, rejects = jobs.audit_repository(spark, str(tmp_path))
    assert [r.name for r in chunks.collect()] == ["f"]
    assert {(r.file, r.reason) for r in rejects.collect()} == {("bad.py", "SyntaxError"), ("raw.py", "not utf-8")}


def test_the_best_candidate_is_fitted(spark):
    from corpusops.operators import classify

    rows = [(f"x = {'bad' if i % 2 else 'good'} + {i % 7}", i % 2, i // 4, "off_by_one" if i % 2 else "none") for i in range(80)]
    examples = spark.createDataFrame(rows, "code string, label int, source_id long, mutation string")
    candidates = {1: classify.weighted_logistic(0, 0.01), 2: classify.weighted_logistic(10, 0.01)}
    made = jobs.train_and_report(examples, candidates=candidates)
    scores = {r.epoch: r.eval_balanced_accuracy for r in made["history"].collect()}
    assert scores[2] == 1.0 > scores[1] and made["metrics"].first().accuracy == 1.0
