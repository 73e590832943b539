"""Exact top-n per group and exact hash samples that keep hot groups off a single task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.session import settle

TRAIN_BELOW = "cccccccc"  # four fifths of the eight-digit hexadecimal range


def top_n_per_group(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    n: int,
    spread_by: Sequence[str],
    rank: str = "rank",
    salts: int | None = None,
) -> DataFrame:
    """The first ``n`` rows of each group, numbered from 1.

    Each group is first cut to ``n`` rows in every one of ``salts`` slices, so the task that
    ranks a group sees at most ``salts * n`` rows, however large the group is. Without a number there are
    as many slices as a shuffle has partitions, 32 at least.
    """
    salts = salts or max(32, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    sliced = df.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)))
    first = Window.partitionBy(*keys, "_salt").orderBy(*order)
    last = Window.partitionBy(*keys).orderBy(*order)
    return (
        sliced.withColumn(rank, F.row_number().over(first))
        .where(F.col(rank) <= n)
        .drop("_salt")
        .withColumn(rank, F.row_number().over(last))
        .where(F.col(rank) <= n)
    )


def first_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], columns: Sequence[str]
) -> DataFrame:
    """The best row of each group, as a partially aggregated minimum."""
    best = F.min(F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(order)], *columns))
    return (
        df.groupBy(*keys)
        .agg(best.alias("_best"))
        .select(*keys, *[F.col(f"_best.{c}").alias(c) for c in columns])
    )


def _order_hash() -> Column:
    return F.md5(F.col("Id").cast("string"))


def split_name() -> Column:
    """``train`` for about four fifths of the reviews, ``test`` for the rest, by ``Id`` alone."""
    return F.when(F.substring(_order_hash(), 1, 8) < TRAIN_BELOW, "train").otherwise("test")


def sample_reviews(df: DataFrame, n: int, keys: Sequence[str] = (), digits: int = 4) -> DataFrame:
    """Exactly ``n`` reviews per group (all of a smaller one), the same ones on every run.

    The sample is the ``n`` lowest hashes of ``Id``. A histogram over the leading hash digits
    finds the bucket that holds the n-th row, a second one over twice as many digits the bucket
    inside it; what is left to rank is a group's share of ``16^(2 * digits)``. The limits, one
    row per group, are settled while the result is built. The reviews themselves are then
    filtered against them and never move.
    """
    keys = list(keys)
    ids = df.select(*keys, "Id", _order_hash().alias("_h"))
    inside = ids.withColumn("_take", F.lit(n).cast("bigint"))
    for length in (digits, 2 * digits):
        prefix = F.substring("_h", 1, length).alias("_b")
        counts = inside.groupBy(*keys, "_take", prefix).agg(F.count("*").alias("_n"))
        upto = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_b"))
        cut = (
            counts.withColumn("_upto", upto)
            .where((F.col("_upto") >= F.col("_take")) & (F.col("_upto") - F.col("_n") < F.col("_take")))
            .select(*keys, "_b", (F.col("_take") - F.col("_upto") + F.col("_n")).alias("_take"))
        )
        cut = settle(cut, "sample-cut")
        inside = ids.withColumn("_b", F.substring("_h", 1, length)).join(cut, [*keys, "_b"]).drop("_b")
    in_bucket = Window.partitionBy(*keys).orderBy("_h", "Id")
    limits = (
        inside.withColumn("_rank", F.row_number().over(in_bucket))
        .where(F.col("_rank") == F.col("_take"))
        .select(*keys, F.struct(F.col("_h").alias("h"), F.col("Id").alias("i")).alias("_last"))
    )
    limits = settle(limits, "sample-limits")
    within = F.struct(_order_hash().alias("h"), F.col("Id").alias("i"))
    if not keys:
        return df.where(F.coalesce(within <= limits.select("_last").scalar(), F.lit(True)))
    kept = df.join(limits, keys, "left").where(F.col("_last").isNull() | (within <= F.col("_last")))
    return kept.drop("_last")
