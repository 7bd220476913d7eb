"""Session set-up and the few decisions that depend on the cluster."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings a run may rely on; all leave sizes to the adaptive planner and to the cluster.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Recording a call site per expression costs several driver round trips each.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Files and vectors travel to Python in batches bounded by bytes, not only by rows.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(32 * 1024 * 1024),
}


def get_session(app: str = "pagefold", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach: the cluster's checkpoint folder.

    A session without one cannot store anything.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    return folder


_staged: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new place in the shared folder that ``drop_staged`` deletes."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _staged.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, path: str) -> None:
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop_path, True)


@contextmanager
def staged(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """A staged table for the time of a block: long-running streams leave nothing behind."""
    spark = df.sparkSession
    table = stage_table(df, name)
    path = _staged[spark.sparkContext.applicationId].pop()
    try:
        yield table
    finally:
        _delete(spark, path)


def drop_staged(spark: SparkSession) -> int:
    """Delete the tables this application has staged, once nothing reads them any more."""
    paths = _staged.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        _delete(spark, path)
    return len(paths)


def spread(df: DataFrame) -> DataFrame:
    """Give a scan with fewer partitions than cores one partition per core.

    Text work is bound by CPU, and a small file is one task however many cores wait. A scan
    that already has enough partitions is returned as it is, so large inputs never shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores)
