"""Checks at job boundaries: missing columns cost nothing, emptiness reads one row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing column(s) {missing}; found {df.columns}")
    return df


def require_rows(df: DataFrame, message: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(message)
    return df


def require_path(spark: SparkSession, path: str, message: str) -> str:
    """Fail early when a table folder is absent, whichever filesystem holds it."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    if not target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target):
        raise FileNotFoundError(message)
    return path
