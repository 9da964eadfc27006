"""Scans in two steps, versions of an index, table functions, and text that is fetched late."""

import os

import pytest
from pyspark.sql import functions as F

from corpusops.operators import chunking, lateral, mutation
from corpusops.operators import vectors as V
from corpusops.sources import repo_files


def test_one_deep_folder_fills_several_tasks(spark, tmp_path):
    deep = tmp_path.joinpath(*[f"d{i}" for i in range(12)])
    deep.mkdir(parents=True)
    for i in range(200):
        (deep / f"f{i}.py").write_text(f"x = {i}\n" * (i + 1))
    listed = repo_files.list_repo(spark, str(tmp_path)).collect()
    assert len(listed) == 200 and all(r["size"] == os.stat(tmp_path / r.path).st_size for r in listed)
    rows = repo_files.scan_repo(spark, str(tmp_path)).withColumn("task", F.spark_partition_id()).collect()
    assert {r.path: bytes(r.content) for r in rows} == {r.path: (tmp_path / r.path).read_bytes() for r in listed}
    assert len({r.task for r in rows}) > 4
    # by bytes, whatever the number of cores
    some = repo_files.read_listed(repo_files.list_repo(spark, str(tmp_path)), str(tmp_path), task_bytes=2000)
    assert some.rdd.getNumPartitions() == -(-sum(r["size"] for r in listed) // 2000) > 8
    assert repo_files.scan_repo(spark, str(tmp_path), suffix=".none").count() == 0


class FailingEmbedder:
    def embed(self, docs, text="text", out="embedding"):
        fail = F.when(F.length(text) > 0, F.raise_error(F.lit("no model")).cast("array<double>"))
        return docs.withColumn(out, fail)


def chunks_of(spark, n):
    rows = [(f"f::n{i}", "f", f"n{i}", "function", 1, 2, None, f"def n{i}(): pass") for i in range(n)]
    return spark.createDataFrame(rows, "id string, file string, name string, type string, start_line int, end_line int, docstring string, code string")


def test_a_failing_build_leaves_the_index_readable(spark, tmp_path):
    path = str(tmp_path / "index")
    embedder = V.HashedEmbedder(16)
    chunks = chunks_of(spark, 7)
    embedder.fit(chunks.withColumn("text", V.embed_text()))
    told = V.build_index_observed(chunks, embedder, path)
    assert told["rows"] == 7 and told["chars"] == V.load_index(spark, path).agg(F.sum(F.length("content"))).first()[0] and told["rows_per_second"] > 0
    with pytest.raises(Exception, match="no model"):
        V.build_index(chunks_of(spark, 9), FailingEmbedder(), path)
    assert V.load_index(spark, path).count() == 7
    # a reader at work keeps its version over the next build
    reader = V.load_index(spark, path)
    assert V.build_index(chunks_of(spark, 4), embedder, path) == 4
    assert reader.count() == 7 and V.load_index(spark, path).count() == 4
    assert V.build_index(chunks_of(spark, 5), embedder, path) == 5
    done = [v for v in os.listdir(f"{path}/{V.VERSIONS}") if os.path.exists(f"{path}/{V.VERSIONS}/{v}/_SUCCESS")]
    assert len(done) == 2 and V.load_index(spark, path).count() == 5


def test_a_build_reads_nothing_again(spark, tmp_path):
    chunks = chunks_of(spark, 20)
    embedder = V.HashedEmbedder(16).fit(chunks.withColumn("text", V.embed_text()))
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    watched = chunks.mapInArrow(counted, chunks.schema)
    assert V.build_index(watched, embedder, str(tmp_path / "index")) == 20
    # one row may be looked at to see that there are any
    assert 20 <= reads.value <= 40


SOURCES = [(1, "def f(a, b):\n    if a < b:\n        raise ValueError('x')\n    return a + b * 100"), (2, "def ("), (3, None), (4, "x = 1"), (5, "class A:\n    def m(self, n):\n        return n - 1 or n > 2")]


def test_table_functions_equal_the_operators(spark):
    lateral.register(spark)
    sources = spark.createDataFrame(SOURCES, "source_id long, code string")
    files = sources.select(F.concat(F.lit("p"), "source_id").alias("path"), F.col("code").alias("text"))
    found = spark.sql("SELECT u.* FROM {files} f, LATERAL chunk_units(f.path, f.text) u", files=files)
    wanted = chunking.chunk_code(files)
    assert sorted(map(str, found.collect())) == sorted(map(str, wanted.collect())) and found.columns == wanted.columns
    held = sources.where("code is not null")
    mutants = spark.sql("SELECT m.* FROM {held} s, LATERAL code_mutants(s.source_id, s.code) m", held=sources)
    assert sorted(map(str, mutants.collect())) == sorted(map(str, mutation.all_mutants(held).collect())) and mutants.count() > 5


def test_first_site_where_it_is_made(spark):
    sources = spark.createDataFrame([r for r in SOURCES if r[1]] + [(i, f"def f(a):\n    if a > {i}:\n        return a + {i}\n    return a") for i in range(10, 40)], "source_id long, code string")
    for seed in (42, 7):
        wanted = mutation.first_site_mutant(mutation.all_mutants(sources), seed)
        columns = ["source_id", "mutation", "type_order", "site", "code", "parses"]
        got = mutation.first_site_of(sources, seed)
        assert sorted(map(tuple, got.select(*columns).collect())) == sorted(map(tuple, wanted.select(*columns).collect()))
    assert "Exchange" not in mutation.first_site_of(sources)._jdf.queryExecution().executedPlan().toString()


def test_first_named_finds_places_without_text(spark):
    rows = [("b.py", 0, "f", "late"), ("a.py", 2, "f", "x" * 50), ("a.py", 1, "f", "first"), ("a.py", 0, None, "none"), ("b.py", 1, "g", "only"), ("a.py", 1, "f", "first")]
    chunks = spark.createDataFrame(rows, "file string, ordinal int, name string, code string")
    got = {r.name: (r.file, r.code, r.n_chars) for r in chunking.first_named(chunks).collect()}
    assert got == {"f": ("a.py", "first", 5), None: ("a.py", "none", 4), "g": ("b.py", "only", 4)}
    per_file = chunking.first_named(chunks, "file").collect()
    assert sorted((r.file, str(r.name), r.code) for r in per_file) == [("a.py", "None", "none"), ("a.py", "f", "first"), ("b.py", "f", "late"), ("b.py", "g", "only")]
    plan = chunking.first_named(chunks)._jdf.queryExecution().optimizedPlan().toString()
    least = [line for line in plan.split("\n") if "Aggregate" in line and "_first" in line]
    assert least and not any("code" in line for line in least)


def test_lookup_moves_only_what_is_asked_for(spark, monkeypatch):
    files = spark.createDataFrame([(f"p{i}", f"text {i}") for i in range(50)], "path string, text string")
    asked = spark.createDataFrame([(1, "p3"), (2, "p3"), (3, "none"), (4, None)], "request_id long, path string")
    for bound in (repo_files.ASKED_BYTES, 0):
        monkeypatch.setattr(repo_files, "ASKED_BYTES", bound)
        found = repo_files.lookup_files(asked, files)
        assert {r.request_id: r.output for r in found.where("found").collect()} == {1: "text 3", 2: "text 3"}
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        semi = [line for line in plan.split("\n") if "LeftSemi" in line]
        assert semi and all(("strategy=broadcast" in line) == (bound > 0) for line in semi)
