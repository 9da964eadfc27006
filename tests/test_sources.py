import os

import pytest
from pyspark.sql import functions as F

from corpusops.sources import guards, repo_files
from corpusops.sources.examples import read_jsonl, write_jsonl, write_metrics, write_predictions


def build_tree(root):
    files = {
        "a.py": b"x = 1\n",
        "pkg/__init__.py": b"",
        "pkg/_private/b.py": b"y = 2\r\nz = 3\r",
        "pkg/deep/er/c.py": "s = 'é'".encode(),
        "pkg/bad.py": b"\xff\xfe",
        "pkg/readme.txt": b"no",
        "pkg/UPPER.PY": b"no",
        "venv/lib/d.py": b"no",
        "pkg/__pycache__/e.py": b"no",
        ".git/f.py": b"no",
        "venv.py": b"kept = 1",
    }
    for name, data in files.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data)
    os.symlink(root / "gone.py", root / "broken.py")
    return {n for n, d in files.items() if d != b"no"} | {"broken.py"}


def test_scan_keeps_hidden_names_and_prunes_ignored_folders(spark, tmp_path):
    wanted = build_tree(tmp_path)
    rows = repo_files.scan_repo(spark, str(tmp_path)).collect()
    assert sorted(r.path for r in rows) == sorted(wanted)
    content = {r.path: r.content for r in rows}
    assert bytes(content["pkg/bad.py"]) == b"\xff\xfe"
    assert content["broken.py"] is None


def test_scan_with_own_ignore_list_replaces_the_default(spark, tmp_path):
    build_tree(tmp_path)
    paths = {r.path for r in repo_files.scan_repo(spark, str(tmp_path), ignore_dirs=["deep"]).select("path").collect()}
    assert "venv/lib/d.py" in paths and ".git/f.py" in paths
    assert "pkg/deep/er/c.py" not in paths


def test_scan_deals_a_flat_folder_over_readers_once(spark, tmp_path):
    for i in range(300):
        (tmp_path / f"f{i}.py").write_text("pass")
    rows = repo_files.scan_repo(spark, str(tmp_path))
    assert rows.rdd.getNumPartitions() > 1
    assert sorted(r.path for r in rows.select("path").collect()) == sorted(f"f{i}.py" for i in range(300))


def test_decode_routes_bad_bytes_and_normalizes_newlines(spark, tmp_path):
    build_tree(tmp_path)
    decoded = {r.path: r for r in repo_files.decode_files(repo_files.scan_repo(spark, str(tmp_path))).collect()}
    assert decoded["pkg/_private/b.py"].text == "y = 2\nz = 3\n"
    assert decoded["pkg/deep/er/c.py"].text == "s = 'é'"
    assert (decoded["pkg/bad.py"].text, decoded["pkg/bad.py"].reject) == (None, "not utf-8")
    assert decoded["broken.py"].reject == "unreadable"
    assert decoded["pkg/__init__.py"].text == ""


def test_table_rules_ignore_folders_not_file_names(spark):
    paths = ["/r/a.py", "/r/venv/a.py", "/r/venv.py", "/r/x/node_modules/y/z.py", "/r/b.txt", "/other/c.py"]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    kept = {r.path for r in repo_files.select_files(df, "/r").collect()}
    assert kept == {"a.py", "venv.py", "/other/c.py"}


@pytest.mark.parametrize("hot", [0, 3000])
def test_lookup_with_a_hot_path(spark, hot):
    files = spark.createDataFrame([(f"p{i}", f"text {i}") for i in range(50)], "path string, text string")
    asked = [(i, f"p{i % 80}") for i in range(800)] + [(800 + i, "p7") for i in range(hot)]
    found = repo_files.lookup_files(spark.createDataFrame(asked, "request_id long, path string"), files).collect()
    assert len(found) == len(asked)
    for row in found:
        number = int(row.path[1:])
        assert row.found == (number < 50)
        assert row.output == (f"text {number}" if number < 50 else f"Error: {row.path} not found in repo.")


def test_jsonl_round_trip_and_strictness(spark, tmp_path):
    rows = [("a\nb", 0, 1, "none"), ('q"uote', 1, 2, "off_by_one")]
    df = spark.createDataFrame(rows, "code string, label int, source_id long, mutation string")
    path = write_jsonl(df, str(tmp_path / "x"))
    assert sorted(map(tuple, read_jsonl(spark, path).collect())) == sorted(rows)
    good = '{"code":"a","label":0,"source_id":1,"mutation":"none"}'
    for name, bad in (("blank", f"{good}\n\n{good}\n"), ("broken", f"{good}\n{{oops\n")):
        (tmp_path / name).write_text(bad)
        with pytest.raises(Exception):
            read_jsonl(spark, str(tmp_path / name)).collect()


def test_prediction_and_metric_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, 3, "x", 0)], "code string, label int, source_id long, mutation string, predicted int")
    saved = spark.read.json(write_predictions(df, str(tmp_path / "p"))).first()
    assert (saved.predicted, saved.correct) == (0, False)
    metrics = spark.range(1).select(F.lit(3).alias("n"), F.lit(0.5).alias("accuracy"), F.lit("t").alias("name"))
    text = spark.read.text(write_metrics(metrics, str(tmp_path / "m"))).first().value
    assert text == '{"n":3.0,"accuracy":0.5}'


def test_guards(spark, tmp_path):
    df = spark.range(1)
    with pytest.raises(ValueError, match="mutation"):
        guards.require_columns(df, "id", "mutation")
    with pytest.raises(ValueError, match="nothing"):
        guards.require_rows(df.where("id > 5"), "nothing here")
    with pytest.raises(FileNotFoundError, match="build"):
        guards.require_path(spark, str(tmp_path / "none"), "build it first")
    assert guards.require_rows(guards.require_columns(df, "id"), "x") is df


def test_required_fields_of_json_lines(spark, tmp_path):
    (tmp_path / "few").write_text('{"code":"a","label":0,"source_id":1}\n')
    assert read_jsonl(spark, str(tmp_path / "few"), required=("code",)).count() == 1
    with pytest.raises(Exception, match="lacks mutation"):
        read_jsonl(spark, str(tmp_path / "few"), required=("code", "mutation")).collect()


def test_lookup_of_unreadable_and_repeated_paths(spark):
    files = spark.createDataFrame([("a", "x", None), ("a", "x", None), ("b", None, "not utf-8")], "path string, text string, reject string")
    asked = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "request_id long, path string")
    found = {r.request_id: (r.found, r.output) for r in repo_files.lookup_files(asked, files).collect()}
    assert found[1] == (True, "x") and found[2] == (True, "Error reading file: not utf-8") and not found[3][0] and len(found) == 3


def test_a_missing_root_fails(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        repo_files.scan_repo(spark, str(tmp_path / "none"))


def test_metrics_keep_named_keys(spark, tmp_path):
    metrics = spark.range(1).select(F.lit("en").alias("lang"), F.lit(3).alias("n"))
    assert spark.read.text(write_metrics(metrics, str(tmp_path / "m"), "lang")).first().value == '{"lang":"en","n":3.0}'
