"""Session settings, durable lineage cuts and input spreading."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
}


def build_session(app_name: str = "corpusops", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators are tuned for; cluster settings win where given."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster it would be
    visible to one machine, and lost with it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return tempfile.mkdtemp(prefix="corpusops-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/corpusops/{name}-{uuid.uuid4().hex}"


def durable(df: DataFrame, *partition_by: str) -> DataFrame:
    """Compute ``df`` once into the shared folder; the result survives lost executors.

    Reads that filter on a ``partition_by`` column open only its folders.
    """
    path = scratch_path(df.sparkSession, "cut")
    if not partition_by:
        df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_go(spark: SparkSession) -> Iterator[None]:
    """Within, what an action dealt out leaves the disks when it ends, not when the driver next collects its garbage.

    For steps that hand over by ``durable``: a frame that is collected twice is dealt out twice.
    """
    before = spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLES_GO) if before is None else spark.conf.set(SHUFFLES_GO, before)


def spread(df: DataFrame) -> DataFrame:
    """Give a small scan enough partitions for CPU-heavy row work; large scans pass through.

    Use on plain scans only: the partition count is read from the plan without running it.
    """
    wanted = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= wanted else df.repartition(wanted)
