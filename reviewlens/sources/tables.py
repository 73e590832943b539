"""Feature and result tables, kept by name under one root folder, and the list of each run's tables.

A table's run counts once its own write has finished. A run as a whole counts once it is published: one
file with the names and runs of all its tables, which appears under its final name at once. Readers
follow the newest published run, so a run that dies midway leaves the earlier one whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reviewlens.sources.snapshots import complete_runs, read_run

FEATURES, VOCABULARY = "text_features", "vocabulary"
RUNS = "_runs"


def write_results(
    tables: dict[str, DataFrame], root: str, run_ts: str, partition_by: dict[str, str] | None = None
) -> None:
    """Write each named table as one run."""
    for name, df in tables.items():
        writer = df.write.mode("errorifexists")
        if partition_by and name in partition_by:
            writer = writer.partitionBy(partition_by[name])
        writer.parquet(f"{root}/{name}/run_ts={run_ts}")


def _files(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _children(spark: SparkSession, path: str) -> list[str]:
    target, fs = _files(spark, path)
    return sorted(entry.getPath().getName() for entry in fs.listStatus(target)) if fs.exists(target) else []


def published_runs(spark: SparkSession, root: str) -> list[str]:
    """Names of the published runs, oldest first."""
    return [name.removesuffix(".json") for name in _children(spark, f"{root}/{RUNS}") if name.endswith(".json") and not name.startswith(("_", "."))]


def run_tables(spark: SparkSession, root: str, run_ts: str | None = None) -> dict[str, str]:
    """Table name to run of a published run, the newest by default; empty when none is published."""
    runs = published_runs(spark, root)
    if not runs or (run_ts is not None and run_ts not in runs):
        return {}
    listed = spark.read.schema("name string, run_ts string").json(f"{root}/{RUNS}/{run_ts or runs[-1]}.json")
    return {r["name"]: r["run_ts"] for r in listed.collect()}  # a row for each table


def publish_run(spark: SparkSession, root: str, run_ts: str, carry_over: bool = False) -> dict[str, str]:
    """Make a run's complete tables what readers see, all at once.

    ``carry_over`` keeps the tables of the run before that this one has not written again.
    """
    listed = run_tables(spark, root) if carry_over else {}
    for name in _children(spark, root):
        if not name.startswith(("_", ".")) and run_ts in complete_runs(spark, f"{root}/{name}"):
            listed[name] = run_ts
    if not listed:
        raise ValueError(f"run {run_ts} has no complete table under {root}")
    lines = "".join('{"name": "%s", "run_ts": "%s"}\n' % entry for entry in sorted(listed.items()))
    # Spark does not list names that begin with an underscore, nor does published_runs
    draft, fs = _files(spark, f"{root}/{RUNS}/_{run_ts}.draft")
    stream = fs.create(draft, True)
    stream.write(bytearray(lines.encode()))
    stream.close()
    if not fs.rename(draft, _files(spark, f"{root}/{RUNS}/{run_ts}.json")[0]):
        raise FileExistsError(f"run {run_ts} is published already")
    return listed


def run_of(spark: SparkSession, root: str, name: str, run_ts: str | None = None) -> str | None:
    """The run from which a table is read: ``run_ts`` itself where it is complete, else what the newest
    published run lists, else, where none was ever published, the newest complete one."""
    runs = complete_runs(spark, f"{root}/{name}")
    if run_ts in runs:
        return run_ts
    if published_runs(spark, root):
        return run_tables(spark, root).get(name)
    return runs[-1] if runs else None


def load_result(
    spark: SparkSession, root: str, name: str, by: str | None = None, run_ts: str | None = None
) -> DataFrame | None:
    """A table of the newest published run, or of the run at hand; None when it has none."""
    run = run_of(spark, root, name, run_ts)
    return read_run(spark, f"{root}/{name}", run, by) if run is not None else None


def load_results(
    spark: SparkSession, root: str, names: list[str], by: dict[str, str] | None = None, run_ts: str | None = None
) -> dict[str, DataFrame]:
    """All of ``names`` that exist; ``by`` names the columns they are partitioned by."""
    found = {name: load_result(spark, root, name, (by or {}).get(name), run_ts) for name in names}
    return {name: df for name, df in found.items() if df is not None}


def write_features(features: DataFrame, vocabulary: DataFrame, root: str, run_ts: str) -> None:
    """TF-IDF rows and their vocabulary, both partitioned by category."""
    by = {FEATURES: "category", VOCABULARY: "category"}
    write_results({FEATURES: features, VOCABULARY: vocabulary}, root, run_ts, by)


def load_features(
    spark: SparkSession, root: str, category: str | None = None, run_ts: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Feature and vocabulary tables, of one category if named (partition-pruned)."""
    out = []
    for name in (FEATURES, VOCABULARY):
        df = load_result(spark, root, name, by="category", run_ts=run_ts)
        if df is None:
            raise FileNotFoundError(f"no {name} under {root}")
        out.append(df if category is None else df.where(df["category"] == category))
    return out[0], out[1]
