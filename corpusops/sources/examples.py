"""JSON-lines tables of labelled examples, predictions and metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusops.schemas import EXAMPLE


def read_jsonl(spark: SparkSession, path: str, schema=EXAMPLE, required: tuple[str, ...] = ()) -> DataFrame:
    """Every line must be one JSON record: a malformed or blank line, or one without a ``required`` field, fails the job.

    The built-in JSON scan drops blank lines silently, so lines are read as text.
    """
    line = F.col("value")
    parsed = F.from_json(line, schema, {"mode": "FAILFAST"})
    blank = F.raise_error(F.lit(f"blank line in {path}"))
    checked = F.when(F.trim(line) == "", blank)
    if required:
        names = F.array(*[F.lit(c) for c in required])
        absent = F.array_except(names, F.coalesce(F.json_object_keys(line), names))
        lacks = F.raise_error(F.concat(F.lit(f"record in {path} lacks "), F.array_join(absent, ", ")))
        checked = checked.when(F.size(absent) > 0, lacks)
    checked = checked.otherwise(line)
    return (
        spark.read.text(path)
        .select(checked.alias("value"))
        .select(parsed.alias("row"))
        .select("row.*")
    )


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)
    return path


def write_predictions(predictions: DataFrame, path: str) -> str:
    """Examples plus ``predicted`` and ``correct``."""
    return write_jsonl(with_correct(predictions), path)


def with_correct(predictions: DataFrame) -> DataFrame:
    return predictions.withColumn("correct", F.col("predicted") == F.col("label"))


def write_metrics(metrics: DataFrame, path: str, *keys: str) -> str:
    """Flat records, every value a double; ``keys`` name the columns that stay as they are."""
    values = [F.col(c) if c in keys else F.col(c).cast("double").alias(c) for c, t in metrics.dtypes if t != "string" or c in keys]
    return write_jsonl(metrics.select(*values), path)
