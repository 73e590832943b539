"""The bounded sample of labelled rows that the classifiers learn from.

A row of the sample is one text of one id with one label, however often the documents or the labels
repeat it. Rows are chosen by a hash of the id and the row's own columns, so that an id that many rows
share is no more and no less likely than its texts are many. The bound holds for each class after
labels and documents have met: the join moves ids and hashes only, and the texts of the chosen
rows alone are read again.

Cases: labels that are null or not 0 or 1, and null ids, are left out; a text with both labels counts
with each; without labelled rows the sample is empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.session import settle


def held_out(id: str = "doc_id") -> Column:
    """Whether a row is never learnt from: crc32 of the id's text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def sample(
    docs: DataFrame, labels: DataFrame, rows_per_class: int, columns: list[str], id: str = "doc_id", label: str = "quality"
) -> DataFrame:
    """``h, y, weight, c0, c1, ...``: at most ``rows_per_class`` rows of each class with the
    smallest hash, and their ``columns`` of ``docs``.

    ``weight`` gives the sample the class shares of all rows that may be learnt from.
    """
    values = [F.struct(F.col(f"`{c}`").isNull(), F.col(f"`{c}`")) for c in columns]
    key = F.col(f"`{id}`").cast("string").alias("key")
    row = [key, F.xxhash64(*values).alias("a"), F.xxhash64(F.lit(7), *values).alias("b")]
    known = labels.where(F.col(label).isin(0, 1) & ~held_out(id)).select(key, F.col(label).cast("double").alias("y"))
    met = settle(docs.select(*row).join(known.where("key IS NOT NULL").distinct(), "key").distinct(), "labelled-rows")
    met = met.withColumn("h", F.xxhash64("key", "a", "b"))
    total = met.groupBy("y").agg(F.count("*").alias("n"))
    parts = [met.where(F.col("y") == y).orderBy("h", "key", "a", "b").limit(rows_per_class) for y in (0.0, 1.0)]
    weight = F.greatest(F.lit(1.0), F.col("n") / rows_per_class).alias("weight")
    chosen = parts[0].union(parts[1]).join(F.broadcast(total), "y")  # a row for each class
    chosen = settle(chosen.select("key", "a", "b", "y", "h", weight), "labelled-sample")
    given = docs.select(*row, *(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)))
    found = given.join(F.broadcast(chosen), ["key", "a", "b"])  # 2 * rows_per_class rows at most
    first = [F.first(f"c{i}").alias(f"c{i}") for i in range(len(columns))]
    return found.groupBy("h", "key", "a", "b", "y", "weight").agg(*first).drop("key", "a", "b")
