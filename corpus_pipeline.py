"""The training-data pipeline: documents through the operators of ``reviewlens.llm``, stage by stage.

Every stage reads what its predecessor has written, and works on all of it. A null text, an empty
text and a null source are handled as the operators' modules say; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reviewlens.llm import decontaminate, mixing, quality_fm, sharding, simhash
from reviewlens.llm.columns import table
from reviewlens.session import release, scratch_path, settled_count


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is one half or more, by a model learnt on the labelled ones."""
    return quality_fm.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest doc_id."""
    return simhash.keep_one(docs, words=4, max_bits=4)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"), words=10)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target weight asks for."""
    return mixing.mixed(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard of 40, and their slot in it."""
    return sharding.sharded(docs, [1.0] * 40)


STAGES = [
    ("quality classifier", quality),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", benchmark_free),
    ("mixing", mixture),
    ("sharding", shards),
]

#: No SQL engine has the classifier, the fingerprints or the checksums; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each reads what its predecessor has written.

    Once a stage's output is written, its own tables and its input are released, so that the shared folder
    holds two outputs at most.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        mark = settled_count()
        path = scratch_path(spark, name.replace(" ", "-"))
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        release(spark, mark + 1)
        if before is not None:
            release(spark, before, before + 1)
            mark -= 1
        before = mark
    return docs
