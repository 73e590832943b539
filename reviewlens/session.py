"""Session helpers: the shared working folder and small settled tables."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

_settled: list[str] = []


def local_session(folder: str, cores: str = "8", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own.

    ``folder`` holds the settled tables.
    """
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("reviewlens")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", f"{folder}/reviewlens-{uuid.uuid4().hex}")
        .config("spark.sql.files.maxPartitionBytes", "1m")
        .config("spark.sql.files.openCostInBytes", "0")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Where nothing names one, a session on one machine keeps its tables in the warehouse; on a cluster that may
    be a folder of the driver's own, so it is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors reach")
    return (named or f"{spark.conf.get('spark.sql.warehouse.dir')}/reviewlens-work").rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; ``release`` removes it."""
    _settled.append(f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}")
    return _settled[-1]


def settle(df: DataFrame, label: str, by: str | None = None) -> DataFrame:
    """Write a derived table to the shared folder and read it back.

    This cuts the lineage in a place that survives lost executors, and it gives the
    optimizer the table's true size: joins broadcast it below
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffle it above. ``by`` names a column to
    keep in folder names, for readers that filter on it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    writer = df.write.partitionBy(by) if by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, since: int = 0, until: int | None = None) -> None:
    """Remove what has been settled, from the ``since``-th on (and before the ``until``-th), once nothing reads it any more."""
    for path in _settled[since:until]:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    del _settled[since:until]


def settled_count() -> int:
    """How many tables are settled now; the mark to give ``release`` at the end of a stage."""
    return len(_settled)
