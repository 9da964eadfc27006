"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the local threads,
BENCH_QUERIES a comma list instead of the headline set. Every query's full result is produced
and dropped, once to warm up and then REPEATS times; the best run counts. ``rows_per_second`` and
``shuffle_mb`` are of that run: result rows by its seconds, and what its tasks wrote for a shuffle.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import Observation
from pyspark.sql import functions as F

from corpusops.plans.catalog import QUERIES
from corpusops.session import build_session

HEADLINE = (
    "chunk_fixed",
    "chunk_line_units",
    "chunk_code_units",
    "mutants_all",
    "mutants_sampled",
    "examples_shuffled",
    "mutation_site_counts",
    "knn_topk",
    "retrieval_model_compare",
    "search_hits",
    "lexical_topk",
    "group_holdout_split",
    "group_kfold_by_customer",
    "split_leakage_texts",
    "metrics_report",
    "metrics_by_category",
    "cv_fold_summary",
    "cv_predictions",
    "code_classifier_report",
    "fresh_code_report",
    "lexical_retrieval_eval",
    "file_lookup",
    "tokenize_truncate",
    "array_duplicates",
    "string_funcs",
    "arith_basic",
    "stats_summary",
    "split_leakage_near",
    "knn_topk_cells",
    "epoch_history",
    "interval_split_rate",
)
REPEATS = 2


def shuffled(spark) -> int:
    """Bytes all executors have written for shuffles so far."""
    held = spark.sparkContext._jsc.sc().statusStore().executorList(False)
    return sum(held.apply(i).totalShuffleWrite() for i in range(held.size()))


def run(query, spark, sf_dir: str) -> tuple[float, int, int]:
    """(seconds, rows, shuffled bytes)."""
    before, seen, began = shuffled(spark), Observation(), time.perf_counter()
    query(spark, sf_dir).observe(seen, F.count(F.lit(1)).alias("rows")).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began, seen.get["rows"], shuffled(spark) - before


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    wanted = os.environ.get("BENCH_QUERIES")
    names = wanted.split(",") if wanted else HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "5g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds, rates, moved = {}, {}, {}
    for name in names:
        run(QUERIES[name][0], spark, sf_dir)
        best, rows, written = min(run(QUERIES[name][0], spark, sf_dir) for _ in range(REPEATS))
        seconds[name], rates[name], moved[name] = round(best, 3), round(rows / best, 1), round(written / 1e6, 3)
    total = round(sum(seconds.values()), 3)
    told = {"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": sf_dir}
    print(json.dumps({**told, "rows_per_second": rates, "shuffle_mb": moved}))
    spark.stop()


if __name__ == "__main__":
    main()
