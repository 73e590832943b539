"""Topic coherence (c_v) from window counts, exact and without listing windows.

After Roder, Both and Hinneburg, "Exploring the Space of Topic Coherence Measures", WSDM 2015.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlens.functions import text
from reviewlens.session import settle

WINDOW = 110
EPSILON = 1e-12


# Stands for all windows in place of a pair of terms.
EVERY = ""

HELD = 1 << 20  # words that a task reads before it counts their windows
MOST_BITS = 1 << 27  # of the windows that are counted together, one a term and window


def _last_start(words: Column, window: int) -> Column:
    """The last window start of a text; a short text is one window."""
    return F.greatest(F.lit(0), F.size(words) - window)


def _ranges(words: Column, window: int) -> Column:
    """Window starts that hold each word, as ``array<struct<term, start, end>>``."""

    def spans(w: Column) -> Column:
        last = _last_start(w, window)

        def one(word: Column, pos: Column) -> Column:
            start = F.greatest(F.lit(0), pos - (window - 1))
            return F.struct(
                word.alias("term"), start.alias("start"), F.least(pos, last).alias("end")
            )

        return F.transform(w, one)

    return text.bind(words, spans)


def _pairs_by_key(numbered: DataFrame, keys: Sequence[str]) -> dict[tuple, tuple]:
    """For each group: the number of each term, both sides of each pair as such numbers, in order of the first, and the pairs' own."""
    found: dict[tuple, list] = {}
    for row in numbered.select(*keys, "a", "b", "pair").collect():
        *key, a, b, pair = row
        if None not in (*key, a, b):
            found.setdefault(tuple(key), []).append((a, b, pair))
    out = {}
    for key, rows in found.items():
        index = {term: i for i, term in enumerate(sorted({t for a, b, _ in rows for t in (a, b)}))}
        sides = np.array(sorted((index[a], index[b], pair) for a, b, pair in rows), np.int64)
        out[key] = (index, *sides.T)
    return out


def _merged(word: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ranges of each word as disjoint ones with gaps between. Starts and ends of a word must not fall."""
    order = np.argsort(word, kind="stable")
    word, start, end = word[order], start[order], end[order]
    fresh = np.ones(len(word), bool)
    fresh[1:] = (word[1:] != word[:-1]) | (start[1:] > end[:-1] + 1)
    return word[fresh], start[fresh], end[np.roll(fresh, -1)]


def _window_bits(word: np.ndarray, start: np.ndarray, end: np.ndarray, n_words: int, n_windows: int) -> np.ndarray:
    """A row of 64-bit blocks for each word, with a bit for each window of its disjoint ranges.

    The first bit of a range and the one after it are marked, and each bit becomes the parity of the marks up to it.
    """
    blocks = n_windows // 64 + 1
    bits = np.zeros((n_words, blocks), np.uint64)
    marks = np.concatenate([start, end + 1])
    at = np.concatenate([word, word]) * blocks + (marks >> 6)
    np.bitwise_xor.at(bits.reshape(-1), at, np.uint64(1) << (marks & 63).astype(np.uint64))
    rows = max(1, (1 << 15) // blocks)
    for i in range(0, n_words, rows):
        part = bits[i : i + rows]
        for shift in (1, 2, 4, 8, 16, 32):
            part ^= part << np.uint64(shift)
        odd = np.bitwise_xor.accumulate(part >> np.uint64(63), axis=1)
        part[:, 1:] ^= np.uint64(0) - odd[:, :-1]
    return bits


def _shared_windows(codes: Sequence[np.ndarray], n_words: int, a: np.ndarray, b: np.ndarray, window: int) -> np.ndarray:
    """For each pair, in order of ``a``: the windows of the texts that hold both words.

    A text is the numbers of its words, -1 for those of no pair. The windows of all texts stand one after another, and a
    word's windows are the bits of a row, so that two rows share as many windows as bits.
    """
    sizes = np.array([len(c) for c in codes])
    last = np.maximum(0, sizes - window)
    base = np.cumsum(last + 1) - (last + 1)
    flat = np.concatenate(codes)
    hit = np.flatnonzero(flat >= 0)
    of = np.repeat(np.arange(len(sizes)), sizes)[hit]
    pos = hit - (np.cumsum(sizes) - sizes)[of]
    start, end = base[of] + np.maximum(0, pos - (window - 1)), base[of] + np.minimum(pos, last[of])
    word, start, end = _merged(flat[hit].astype(np.int64), start, end)
    both = np.zeros(len(a), np.int64)
    first = np.flatnonzero(np.diff(a, prepend=-1))
    n_windows, most = int((last + 1).sum()), max(64, MOST_BITS // n_words)
    for low in range(0, n_windows, most):
        n = min(most, n_windows - low)
        near = (start < low + n) & (end >= low)
        bits = _window_bits(word[near], np.maximum(start[near] - low, 0), np.minimum(end[near] - low, n - 1), n_words, n)
        for i, j in zip(first, [*first[1:], len(a)]):
            both[i:j] += np.bitwise_count(bits[b[i:j]] & bits[a[i]]).sum(axis=1, dtype=np.int64)
    return both


def _window_counter(keys: Sequence[str], sent, window: int) -> Callable:
    """For ``mapInArrow`` over ``*keys, text``: ``*keys, pair, n_both`` of whole tasks. All windows of a key have no pair, pairs have no key."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed, windows = sent.value, {}
        counts = {key: np.zeros(len(of[-1]), np.int64) for key, of in listed.items()}
        seen = {key: np.zeros(len(of[0]), bool) for key, of in listed.items()}
        held: dict[tuple, list] = {}
        room, types = 0, [pa.null()] * len(keys)

        def count() -> None:
            for key, codes in held.items():
                index, a, b, _ = listed[key]
                counts[key] += _shared_windows(codes, len(index), a, b, window)
                for own in codes:
                    seen[key][own[own >= 0]] = True
            held.clear()

        for batch in batches:
            types = [c.type for c in batch.columns[:-1]]
            found = zip(*(c.to_pylist() for c in batch.columns[:-1])) if keys else repeat(())
            for key, value in zip(found, batch.column(len(keys)).to_pylist()):
                words = value.decode("utf-8", "replace").split() if value else []
                windows[key] = windows.get(key, 0) + max(0, len(words) - window) + 1
                if key in listed:
                    held.setdefault(key, []).append(np.fromiter(map(listed[key][0].get, words, repeat(-1)), np.int32, len(words)))
                    room += len(words) + 1
            if room >= HELD:
                count()
                room = 0
        count()
        names = [*keys, "pair", "n_both"]
        if windows:
            columns = [pa.array(c, t) for c, t in zip(zip(*windows), types)]
            yield pa.RecordBatch.from_arrays([*columns, pa.nulls(len(windows), pa.int64()), pa.array(list(windows.values()), pa.int64())], names=names)
        for key, (_, a, b, pair) in listed.items():
            met = seen[key][a] | seen[key][b]
            if met.any():
                none = [pa.nulls(int(met.sum()), t) for t in types]
                yield pa.RecordBatch.from_arrays([*none, pa.array(pair[met]), pa.array(counts[key][met])], names=names)

    return run


def _counts_by_ranges(df: DataFrame, numbered: DataFrame, keys: Sequence[str], text_col: str, window: int) -> DataFrame:
    """``pair, n_both`` of rows that share ids, by joins: the windows of all rows of an id lie over each other, and its
    words' ranges are merged. Two words share ``|A| + |B| - |A or B|`` windows."""
    number = F.monotonically_increasing_id()
    either = F.explode(F.array_distinct(F.array("a", "b"))).alias("term")
    listed = settle(
        numbered.select(*keys, either).distinct().withColumn("word", number), "pair-terms"
    )
    tokens = df.select("Id", *keys, F.inline(_ranges(text.words(F.col(text_col)), window)))
    ranges = (
        tokens.join(listed, [*keys, "term"]).select("Id", "word", "start", "end").repartition("Id")
    )
    in_order = Window.partitionBy("Id", "word").orderBy("start", "end")
    fresh = F.col("start") > F.coalesce(F.lag("end").over(in_order), F.lit(-1))
    merged = (
        ranges.withColumn("_new", F.when(fresh, 1).otherwise(0))
        .withColumn("_run", F.sum("_new").over(in_order))
        .groupBy("Id", "word", "_run")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
    )
    sides = (
        numbered.select(*keys, either, "pair", (F.col("a") == F.col("b")).alias("same"))
        .join(listed, [*keys, "term"])
        .select("word", "pair", "same")
    )
    sides = settle(sides, "pair-sides")
    before = Window.partitionBy("Id", "pair").orderBy("start", "end")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    reach = F.coalesce(F.max("end").over(before), F.lit(-1))
    added = F.greatest(F.lit(0), F.col("end") - F.greatest(reach, F.col("start") - 1))
    covered = merged.join(sides, "word").withColumn("_added", added)
    own = F.col("end") - F.col("start") + 1
    both = F.when(F.col("same"), own).otherwise(own - F.col("_added"))
    return covered.groupBy("pair").agg(F.sum(both.cast("bigint")).alias("n_both"))


def pair_counts(
    df: DataFrame,
    pairs: DataFrame,
    keys: Sequence[str] = (),
    text_col: str = "clean_text",
    window: int = WINDOW,
) -> DataFrame:
    """``*keys, a, b, n_both``: windows that hold both terms of each of ``pairs``.

    The windows around one occurrence are a range of start positions, so a term covers a few
    merged ranges per review, kept as a row of bits; two terms share the bits of both rows. Texts
    are read once and stay where they are; a task gives a sum for each pair. The pairs have the
    topics' size; the driver sends them out. A pair of a term with itself counts the term; the
    pair of ``EVERY`` is the sum of all windows. Rows that share an id in a group count as one
    text with their windows over each other; only those rows move, by ``Id``.
    """
    spark = df.sparkSession
    numbered = settle(pairs.withColumn("pair", F.monotonically_increasing_id()), "term-pairs")
    sent = spark.sparkContext.broadcast(_pairs_by_key(numbered, keys))
    own = ["Id", *keys]
    shared = df.groupBy(*own).count().where("count > 1").select(*(F.col(name).alias(f"_{i}") for i, name in enumerate(own)))
    shared = settle(shared, "shared-ids")
    same = [F.col(name).eqNullSafe(F.col(f"_{i}")) for i, name in enumerate(own)]
    texts = df.select(*own, F.col(text_col))
    repeated = texts.join(shared, same, "left_semi")
    single = texts.join(shared, same, "left_anti").select(*keys, F.col(text_col).cast("binary"))
    sums = T.StructType([*df.select(*keys).schema, T.StructField("pair", T.LongType()), T.StructField("n_both", T.LongType())])
    windows = (_last_start(text.words(F.col(text_col)), window).cast("bigint") + 1).alias("n_both")
    counts = (
        single.mapInArrow(_window_counter(list(keys), sent, window), sums)
        .unionByName(repeated.select(*keys, F.lit(None).cast("bigint").alias("pair"), windows))
        .unionByName(_counts_by_ranges(repeated, numbered, keys, text_col, window), allowMissingColumns=True)
    )
    named = numbered.select("pair", "a", "b", *(F.col(k).alias(f"_{i}") for i, k in enumerate(keys)))
    of = [F.coalesce(f"_{i}", k).alias(k) for i, k in enumerate(keys)]
    sides = [F.coalesce(side, F.lit(EVERY)).alias(side) for side in ("a", "b")]
    summed = counts.groupBy(*keys, "pair").agg(F.sum("n_both").alias("n_both"))
    return summed.join(named, "pair", "left").select(*of, *sides, "n_both")


def coherence(
    df: DataFrame,
    topics: DataFrame,
    keys: Sequence[str] = (),
    model_keys: Sequence[str] = (),
    text_col: str = "clean_text",
    window: int = WINDOW,
) -> DataFrame:
    """``*keys, *model_keys, topic, coherence`` of topics given as ``..., topic, rnk, term`` rows.

    ``keys`` tie topics to their group of reviews; ``model_keys`` tell several models of one
    group apart. Every distinct pair of terms is counted once per group, whichever topics hold
    it, so one pass over the texts scores all models. The pairs and their counts are tables of
    the topics' size and are settled; the rest is arithmetic on them.
    """
    keys, model = list(keys), [*keys, *model_keys, "topic"]
    terms = topics.select(*model, "rnk", "term")
    left = terms.select(*model, F.col("rnk").alias("rank_a"), F.col("term").alias("term_a"))
    right = terms.select(*model, F.col("rnk").alias("rank_b"), F.col("term").alias("term_b"))
    grid = left.join(right, model).withColumns(
        {"a": F.least("term_a", "term_b"), "b": F.greatest("term_a", "term_b")}
    )
    pairs = grid.select(*keys, "a", "b").distinct()
    counts = settle(pair_counts(df, pairs, keys, text_col, window), "pair-counts")
    single = counts.where(F.col("a") == F.col("b"))
    totals = single.where(F.col("a") == EVERY).select(*keys, F.col("n_both").alias("n_windows"))

    def alone(side: str) -> DataFrame:
        return single.select(*keys, F.col("a").alias(f"term_{side}"), F.col("n_both").alias(f"n_{side}"))

    joined = (
        grid.join(counts, [*keys, "a", "b"], "left")
        .join(alone("a"), [*keys, "term_a"], "left")
        .join(alone("b"), [*keys, "term_b"], "left")
    )
    joined = joined.join(totals, keys) if keys else joined.withColumn("n_windows", totals.scalar())
    n = F.col("n_windows").cast("double")
    p_both = F.coalesce(F.col("n_both"), F.lit(0)) / n + EPSILON
    ratio = F.ln(p_both / ((F.col("n_a") / n) * (F.col("n_b") / n))) / -F.ln(p_both)
    npmi = F.when(F.col("n_a").isNull() | F.col("n_b").isNull(), F.lit(0.0)).otherwise(ratio)
    vectors = joined.select(*model, "rank_a", "rank_b", npmi.alias("v"))
    sums = vectors.groupBy(*model, "rank_b").agg(F.sum("v").alias("s"))
    dots = (
        vectors.join(sums, [*model, "rank_b"])
        .groupBy(*model, "rank_a")
        .agg(
            F.sum(F.col("v") * F.col("s")).alias("vs"),
            F.sum(F.col("v") * F.col("v")).alias("vv"),
            F.sum(F.col("s") * F.col("s")).alias("ss"),
        )
    )
    cosine = F.coalesce(
        F.try_divide(F.col("vs"), F.sqrt("vv") * F.sqrt("ss")), F.lit(0.0)
    )
    return dots.groupBy(*model).agg(F.avg(cosine).alias("coherence"))
