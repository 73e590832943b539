"""Corpus counts kept per run and added up: a new run counts its own reviews only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from reviewlens.operators.terms import corpus_counts, merge_counts
from reviewlens.sources.snapshots import RUN, complete_runs

COUNTS = "corpus_counts"


def add_counts(
    df: DataFrame, tokens: Column, root: str, run_ts: str, keys: Sequence[str] = (), stop_words: DataFrame | None = None
) -> None:
    """Count the reviews that a run adds. A run is counted once; writing it again is an error."""
    counts = corpus_counts(df, tokens, keys, stop_words)
    counts.write.mode("errorifexists").parquet(f"{root}/{COUNTS}/{RUN}={run_ts}")


def all_counts(spark: SparkSession, root: str, keys: Sequence[str] = (), up_to: str | None = None) -> DataFrame:
    """The counts over all complete runs, or those not after ``up_to``."""
    runs = [r for r in complete_runs(spark, f"{root}/{COUNTS}") if up_to is None or r <= up_to]
    if not runs:
        raise FileNotFoundError(f"no counts under {root}")
    parts = spark.read.parquet(*[f"{root}/{COUNTS}/{RUN}={run}" for run in runs])
    return merge_counts(parts, keys)
