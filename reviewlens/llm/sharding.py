"""Sharding by weighted rendezvous hashing of stable record keys.

Every shard draws a score for the key, ``-weight / ln(u)`` with u from a hash of key and shard;
the highest score wins. A shard's score depends on nothing but the key and the shard, so one more
shard takes rows only into itself, about its share of them, and moves no others.

Slots number a shard's rows from 0 without gaps. Rows go into ``ranges`` slices of each shard, by a
hash of id and checksum, and rows that share these into ``ranges`` parts, by a salt that is settled
with the rows, so that it stays the same. Rows are first counted in each part; prefix sums over a
shard's slices, and over the parts of a slice, give where each part starts, and rows are numbered
inside their part. One shuffle deals the rows out by part, however many are equal.

Cases: a null id is a key like any other; a null text has 16 bytes and the checksum of no bytes;
rows equal in id and text take neighbouring slots in any order, in many tasks; an empty table gives no rows.
``sharded`` keeps all columns and adds its own, with underscores if the name is taken.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.llm.columns import free_name
from reviewlens.session import settle

RANGES = 4096


def _score(id: str, shard: int, weight: float) -> Column:
    """A positive score and the shard, as a struct that orders by score."""
    u = (F.shiftrightunsigned(F.xxhash64(F.col(f"`{id}`"), F.lit(shard)), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    return F.struct((F.lit(-float(weight)) / F.ln(u)).alias("score"), F.lit(shard).alias("shard"))


def rendezvous(id: str, weights: Sequence[float]) -> Column:
    """The number of the shard that wins the key."""
    scores = [_score(id, shard, weight) for shard, weight in enumerate(weights)]
    return (F.greatest(*scores) if len(scores) > 1 else scores[0])["shard"]


def sharded(
    docs: DataFrame, weights: Sequence[float], grown: float = 1.0, ranges: int = RANGES,
    id: str = "doc_id", text: str = "text", keep: Sequence[str] | None = None,
) -> DataFrame:
    """``docs``, or its columns ``keep``, with ``size, text_crc32, law, shard, slot, grown_shard``.

    ``grown_shard`` is the shard with one more shard of weight ``grown``.
    """
    size, crc, law, shard = (free_name(docs, n) for n in ("size", "text_crc32", "law", "shard"))
    slot, more = (free_name(docs, n) for n in ("slot", "grown_shard"))
    part, start, h, salt = (free_name(docs, n) for n in ("llm_slice", "llm_start", "llm_hash", "llm_salt"))
    body = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
    placed = (
        docs.withColumn(size, F.octet_length(body).cast("bigint") + 16)
        .withColumn(crc, F.crc32(body))
        .withColumn(law, F.lit("key"))
        .withColumn(shard, rendezvous(id, weights))
        .withColumn(more, rendezvous(id, [*weights, grown]))
        .withColumn(h, F.xxhash64(F.lit(17), F.col(f"`{id}`"), F.col(crc)))
        .withColumn(part, F.pmod(F.col(h), F.lit(ranges)).cast("int"))
        .withColumn(salt, F.pmod(F.monotonically_increasing_id(), F.lit(ranges)).cast("int"))
    )
    columns = [c for c in docs.columns if c in keep] if keep is not None else docs.columns
    placed = settle(placed.select(*(F.col(f"`{c}`") for c in [*columns, size, crc, law, shard, more, h, part, salt])), "shard-rows")
    key = [shard, part, h, size, crc, salt]
    counts = settle(placed.groupBy(*key).agg(F.count("*").alias("n")), "shard-parts")
    slices = counts.groupBy(shard, part).agg(F.sum("n").alias("n"))
    earlier = Window.partitionBy(shard).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select(shard, part, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("begin"))
    before = Window.partitionBy(shard, part).orderBy(h, size, crc, salt).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn(start, F.coalesce(F.sum("n").over(before), F.lit(0))).join(settle(slices, "shard-slices"), [shard, part])
    starts = settle(starts.select(*key, (F.col(start) + F.col("begin")).alias(start)), "shard-starts")
    numbered = placed.join(starts, key).withColumn(slot, F.row_number().over(Window.partitionBy(*key).orderBy(salt)) - 1)
    return numbered.withColumn(slot, F.col(slot) + F.col(start)).select(
        *(F.col(f"`{c}`") for c in columns), size, crc, law, shard, slot, more
    )


def op4_sharding(spark, sf: str) -> DataFrame:
    """Every document's place among 40 shards of equal weight."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    return sharded(docs, [1.0] * 40, keep=["doc_id"])
