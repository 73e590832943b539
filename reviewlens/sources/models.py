"""Fitted models on disk, listed in a registry table that is written last."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from reviewlens.sources import tables

SCHEMA = "category string, k int, path string"


def register_models(
    spark: SparkSession, kind: str, models: Sequence[tuple[str, int, Any]], root: str, run_ts: str
) -> DataFrame:
    """Save ``category, k, model`` entries; a run without its registry counts as absent."""
    rows = []
    for number, (category, k, model) in enumerate(models):
        path = f"{root}/{kind}/run_ts={run_ts}/{number}"
        model.write().save(path)
        rows.append((category, k, path))
    registry = spark.createDataFrame(rows, SCHEMA)
    tables.write_results({f"{kind}_registry": registry}, root, run_ts)
    return registry


def load_models(
    spark: SparkSession, kind: str, root: str, reader: Any, run_ts: str | None = None
) -> list[tuple[str, int, Any]]:
    """The models of the newest published run, or of the run at hand, read by ``reader``, the Spark ML class that was saved."""
    registry = tables.load_result(spark, root, f"{kind}_registry", run_ts=run_ts)
    if registry is None:
        raise FileNotFoundError(f"no {kind} under {root}")
    found = registry.orderBy("category", "k").collect()
    return [(r["category"], r["k"], reader.load(r["path"])) for r in found]
