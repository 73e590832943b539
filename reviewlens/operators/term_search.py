"""Many terms in many texts: one automaton per category, one scan per text.

Terms are literal and may overlap or lie inside one another. The listed terms go to all tasks in blocks of
whole categories of about ``BLOCK_BYTES``, measured first; a task builds the automaton of a category
when it meets its first review.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlens.functions.numbers import divide
from reviewlens.session import settle

BLOCK_BYTES = 16 << 20


class TermSets:
    """The listed terms of each category, and which of them a text holds."""

    def __init__(self, listed: dict[str, list[str]]):
        self.listed, self.machines = listed, {}

    def found(self, category: str | None, text: str | None) -> list[str]:
        if category not in self.listed or text is None:
            return []
        if category not in self.machines:
            machine = ahocorasick.Automaton()
            for term in self.listed[category]:
                if term:
                    machine.add_word(term, term)
            if len(machine):
                machine.make_automaton()
            self.machines[category] = machine
        machine = self.machines[category]
        return sorted({term for _, term in machine.iter(text)} if len(machine) else ())


def _blocks(terms: DataFrame, category: str) -> list[tuple[int, int, Broadcast]]:
    """(number, count, terms by category) of each block of categories."""
    listed = settle(terms.select(F.col(category).alias("category"), "term").where("category IS NOT NULL AND term IS NOT NULL").distinct(), "listed-terms")
    size = listed.agg(F.sum(F.octet_length("term") + F.octet_length("category"))).first()[0] or 0
    count = max(1, -(-size // BLOCK_BYTES))
    out = []
    for number in range(count):
        by_category: dict[str, list[str]] = {}
        for row in listed.where(F.pmod(F.xxhash64("category"), F.lit(count)) == number).toLocalIterator():
            by_category.setdefault(row["category"], []).append(row["term"])
        out.append((number, count, terms.sparkSession.sparkContext.broadcast(by_category)))
    return out


def _over_blocks(df: DataFrame, terms: DataFrame, category: str, scan: Callable[[DataFrame, Broadcast], DataFrame]) -> DataFrame:
    """``scan`` of each block with the reviews of its categories; every review is in one block."""
    parts = None
    for number, count, given in _blocks(terms, category):
        own = df if count == 1 else df.where(F.pmod(F.coalesce(F.xxhash64(F.col(category)), F.lit(0)), F.lit(count)) == number)
        part = scan(own, given)
        parts = part if parts is None else parts.unionByName(part)
    return parts


def find_terms(
    df: DataFrame, terms: DataFrame, category: str, keep: Sequence[str], text_col: str = "clean_text"
) -> DataFrame:
    """``*keep, found``: the terms of its category that each review's text holds, in order."""
    kept = df.select(*keep).schema
    schema = T.StructType([*kept, T.StructField("found", T.ArrayType(T.StringType()))])

    def scan(own: DataFrame, given: Broadcast) -> DataFrame:
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sets = TermSets(given.value)
            for batch in batches:
                *columns, categories, texts = batch.columns
                found = [sets.found(c, t) for c, t in zip(categories.to_pylist(), texts.to_pylist())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.list_(pa.string()))], names=schema.names)

        given_columns = [F.col(category).alias("_category"), F.col(text_col).alias("_text")]
        return own.select(*keep, *given_columns).mapInArrow(run, schema)

    return _over_blocks(df, terms, category, scan)


def _sums(df: DataFrame, given: Broadcast, category: str, found: str | None, text_col: str) -> DataFrame:
    """Per task and category: number, sum, mean, squares about it and range of the sentiment; and
    number and sum for each term that occurs. Reviews without text or sentiment are left out."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = TermSets(given.value)
        values: dict[str, list[float]] = {}
        present: dict[tuple[str, str], list[float]] = {}
        rows = []

        def close(name: str) -> None:
            x = np.array(values.pop(name))
            spread = ((x - x.mean()) ** 2).sum() if len(x) else 0.0
            low, high = (float(x.min()), float(x.max())) if len(x) else (None, None)
            rows.append((name, None, len(x), float(x.sum()), float(x.mean()) if len(x) else 0.0, float(spread), low, high))

        for batch in batches:
            for name, text, score in zip(*(c.to_pylist() for c in batch.columns)):
                if name not in sets.listed:
                    continue
                own = values.setdefault(name, [])
                if text is None or score is None:
                    continue
                own.append(score)
                for term in text if found else sets.found(name, text):
                    sums = present.setdefault((name, term), [0, 0.0])
                    sums[0] += 1
                    sums[1] += score
                if len(own) >= 1 << 16:
                    close(name)
        for name in list(values):
            close(name)
        rows += [(name, term, n, s, 0.0, 0.0, None, None) for (name, term), (n, s) in present.items()]
        columns = list(zip(*rows)) or [[]] * 8
        kinds = (pa.string(), pa.string(), pa.int64(), *[pa.float64()] * 5)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=NAMES)

    return df.select(F.col(category).alias("category"), found or text_col, F.col("sentiment_score").cast("double")).mapInArrow(run, SUMS)


SUMS = "category string, term string, n bigint, s double, mean double, spread double, low double, high double"
NAMES = [c.split()[0] for c in SUMS.split(", ")]


def term_correlation(df: DataFrame, terms: DataFrame, category: str, found: str | None = None, text_col: str = "clean_text") -> DataFrame:
    """``category, term, correlation`` of a term's presence with ``sentiment_score``, for the terms of
    every category with a review; NULL where either is constant. ``found`` names a column that
    ``find_terms`` has made; without it the texts are scanned here. What leaves a task is one
    row for each category and term that it has met."""
    summed = _over_blocks(df, terms, category, lambda own, given: _sums(own, given, category, found, text_col))
    merged = settle(
        summed.groupBy("category", "term").agg(
            F.sum("n").alias("n"), F.sum("s").alias("s"), F.min("low").alias("low"), F.max("high").alias("high"),
            F.sum(F.col("spread") + F.col("n") * F.col("mean") * F.col("mean")).alias("squares"),
        ),
        "term-sums",
    )
    whole = merged.where("term IS NULL").select("category", "n", "s", "squares", (F.col("low") < F.col("high")).alias("varies"))
    each = merged.where("term IS NOT NULL").select("category", "term", F.col("n").alias("with_term"), F.col("s").alias("with_sum"))
    listed = terms.select(F.col(category).alias("category"), "term").distinct().join(whole, "category")
    joined = listed.join(each, ["category", "term"], "left")
    n, hits = F.col("n").cast("double"), F.coalesce(F.col("with_term"), F.lit(0))
    hits = F.when(F.col("term") == "", F.col("n")).otherwise(hits)  # every text holds the empty term
    share, mean = divide(hits, n), divide(F.col("s"), n)
    variance = divide(F.col("squares"), n) - mean * mean
    covariance = divide(F.coalesce(F.col("with_sum"), F.lit(0.0)), n) - share * mean
    known = F.col("varies") & (hits > 0) & (hits < F.col("n")) & (variance > 0)
    value = F.when(known, divide(covariance, F.sqrt(share * (1 - share)) * F.sqrt(variance)))
    return joined.select("category", "term", value.alias("correlation"))
