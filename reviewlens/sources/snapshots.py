"""Processed reviews kept as one complete folder per run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

RUN = "run_ts"


def complete_runs(spark: SparkSession, path: str) -> list[str]:
    """Run names under ``path`` whose write has finished, oldest first.

    Only folder names are listed, so the cost does not grow with the data.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    runs = []
    for entry in fs.listStatus(root):
        name = entry.getPath().getName()
        done = hadoop.Path(entry.getPath(), "_SUCCESS")
        if name.startswith(f"{RUN}=") and fs.exists(done):
            runs.append(name.split("=", 1)[1])
    return sorted(runs)


def read_run(spark: SparkSession, path: str, run_ts: str, by: str | None = None) -> DataFrame:
    """One run; the column kept in folder names is read as text, whatever it looks like."""
    folder = f"{path}/{RUN}={run_ts}"
    stored = spark.read.parquet(folder)
    if by is None:
        return stored
    fields = [T.StructField(by, T.StringType()) if f.name == by else f for f in stored.schema]
    return spark.read.schema(T.StructType(fields)).parquet(folder)


def write_snapshot(df: DataFrame, path: str, run_ts: str, by: str = "predicted_category") -> None:
    """Add one run; rows are written where they are, without a shuffle."""
    df.write.mode("errorifexists").partitionBy(by).parquet(f"{path}/{RUN}={run_ts}")


def latest_snapshot(spark: SparkSession, path: str, by: str = "predicted_category") -> DataFrame:
    """The newest complete run; other runs are never opened."""
    runs = complete_runs(spark, path)
    if not runs:
        raise FileNotFoundError(f"no processed reviews under {path}")
    return read_run(spark, path, runs[-1], by)
