"""SimHash near-duplicates, found by multi-index hashing.

A fingerprint has 64 bits: bit i is 1 if more than half of a text's shingle hashes have it.
Fingerprints within ``max_bits`` are linked, and the components of links are the groups.

Multi-index hashing cuts the fingerprint into segments and gives each a radius. If two
fingerprints exceed the radius in every segment, they differ by at least the sum of (radius + 1);
the plan makes that sum ``max_bits + 1``, so every link shows in some segment: one side's segment
lies in the Hamming ball around the other's. The balls are enumerated as join keys, the table is
joined by them, and each match is verified on all 64 bits.

Cases: a null or wordless text has fingerprint 0 and is linked like any other; equal
fingerprints, and so equal texts, are one node however often they occur; a null ``doc_id`` is
never a group's smallest unless all are null; an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

from itertools import combinations, repeat
from math import comb

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.columns import LOWER, free_name, map_texts, row_digest
from reviewlens.llm.components import components
from reviewlens.session import settle


def fingerprint(text: str | None, words: int, seed: int = 42) -> int:
    """The fingerprint as a signed 64-bit integer."""
    tokens = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not tokens:
        return 0
    line, shingles = b" ".join(tokens), max(1, len(tokens) - words + 1)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:shingles]
    spans = map(slice, starts.tolist(), ends[-shingles:].tolist())
    hashes = np.fromiter(
        map(xxhash.xxh64_intdigest, map(line.__getitem__, spans), repeat(seed)), np.uint64, shingles
    )
    ones = np.zeros(64, np.int64)
    for at in range(0, shingles, 1 << 16):
        bits = np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > shingles, bitorder="little").view(np.int64)[0])


def with_fingerprint(docs: DataFrame, keep: list[str], text: str, words: int, name: str) -> DataFrame:
    """The columns ``keep`` of every row and its fingerprint under ``name``."""

    def make():
        return lambda texts: [[fingerprint(t, words) for t in texts]]

    return map_texts(docs, keep, [text], f"`{name}` bigint", make)


def segment_plan(max_bits: int, segments: int) -> list[tuple[int, int, int]]:
    """(first bit, width, radius) of each segment; the radii plus one add up to ``max_bits + 1``."""
    if not 2 <= segments <= max_bits + 1:
        raise ValueError("two to max_bits + 1 segments")
    widths = [64 // segments + (i < 64 % segments) for i in range(segments)]
    spare = max_bits + 1 - segments
    radii = [spare // segments + (i < spare % segments) for i in range(segments)]
    return [(sum(widths[:i]), widths[i], radii[i]) for i in range(segments)]


def expected_rows(n: int, plan: list[tuple[int, int, int]]) -> float:
    """Keys that ``n`` random fingerprints are joined by, and strangers they then meet."""
    ball = [sum(comb(width, k) for k in range(radius + 1)) for _, width, radius in plan]
    return sum(n * (1 + (b + 1) / 2) + n * n * b / 2 ** (width + 1) for b, (_, width, _) in zip(ball, plan))


def best_segments(n: int, max_bits: int) -> int:
    """The number of segments with the fewest rows: more keys or more strangers, whichever grows less."""
    return min(range(2, max_bits + 2), key=lambda s: expected_rows(n, segment_plan(max_bits, s)))


def _segment(plan: tuple[int, int, int]) -> Column:
    first, width, _ = plan
    return F.shiftrightunsigned("fp", first).bitwiseAND(F.lit((1 << width) - 1))


def _keys(plan: list[tuple[int, int, int]], ball: bool) -> Column:
    """Join keys of a fingerprint: its segments, or all members of the balls around them.

    A pair whose segments differ needs one direction only: the first bit that a ball member
    flips must be 0 here, and is 1 on the other side.
    """
    keys = []
    for number, (first, width, radius) in enumerate(plan):
        own, sizes = _segment((first, width, radius)), range(1, radius + 1 if ball else 1)
        masks = [sum(1 << b for b in bits) for size in sizes for bits in combinations(range(width), size)]
        # the lowest bit of a mask is its first; the mask 0 has none, and is the segment itself
        free = F.filter(F.array(*map(F.lit, [0, *masks])), lambda m: own.bitwiseAND(m.bitwiseAND(-m)) == 0)
        tag = F.lit(number << 40)
        keys.append(F.transform(free, lambda m: F.struct(own.bitwiseXOR(m).bitwiseOR(tag).alias("key"), (m == 0).alias("same"))))
    return F.flatten(F.array(*keys))


def near_fingerprints(fingerprints: DataFrame, max_bits: int, segments: int | None = None) -> DataFrame:
    """Links ``a, b`` between the distinct values ``fp`` at most ``max_bits`` apart.

    A link may come more than once, from several segments. The links are the same for any number
    of segments; without one, that of the fewest rows for the counted fingerprints is taken.
    """
    plan = segment_plan(max_bits, segments or best_segments(fingerprints.count(), max_bits))
    table = fingerprints.select(F.col("fp").alias("b"), F.explode(_keys(plan, False)).alias("k"))
    balls = fingerprints.select(F.col("fp").alias("a"), F.explode(_keys(plan, True)).alias("k"))
    found = balls.select("a", "k.key", "k.same").join(table.select("b", "k.key"), "key")
    once = ~F.col("same") | (F.col("a") < F.col("b"))
    return found.where(once & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)).select("a", "b")


def groups(docs: DataFrame, words: int, max_bits: int, segments: int | None = None, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``<id>, fp, root, component_id`` per row; rows of a group share ``root`` and ``component_id``.

    ``root`` is the group's smallest fingerprint, ``component_id`` its smallest id. The
    fingerprint work is one pass without a shuffle; everything after it moves distinct
    fingerprints, 64 bits each, but for the last join, which moves ids. ``segments`` trades
    rows for candidates: fewer segments enumerate larger balls and meet fewer strangers; it follows
    the number of fingerprints unless given.
    """
    rows = settle(with_fingerprint(docs, [id], text, words, "fp"), "fingerprints")
    nodes = settle(rows.groupBy("fp").agg(F.min(id).alias("least")), "fingerprint-nodes")
    links = near_fingerprints(nodes.select("fp"), max_bits, segments)
    linked = components(links, "a", "b", "fingerprint-links")
    rooted = nodes.join(linked.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of = rooted.select("fp", "root").join(smallest, "root")
    return rows.join(of, "fp").select(id, "fp", "root", "component_id")


def keep_one(docs: DataFrame, words: int, max_bits: int, segments: int | None = None, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group: its smallest id, nulls last; a tie goes to the
    smallest fingerprint and row hash, and rows equal in every column count as one."""
    own, row = docs.columns, [free_name(docs, "llm_row_a"), free_name(docs, "llm_row_b")]
    tagged = docs.withColumns(dict(zip(row, row_digest(docs))))
    prints = with_fingerprint(tagged, [id, *row], text, words, "llm_fp")
    narrow = [F.col(f"`{id}`").alias("id"), F.col("llm_fp").alias("fp"), *(F.col(c).alias(n) for c, n in zip(row, "ab"))]
    narrow = settle(prints.select(*narrow), "simhash-rows")
    order = F.struct(F.col("id").isNull().alias("none"), "id", "fp", "a", "b")
    nodes = settle(narrow.groupBy("fp").agg(F.min(order).alias("first")), "simhash-nodes")
    linked = components(near_fingerprints(nodes.select("fp"), max_bits, segments), "a", "b", "simhash-links")
    first = (
        nodes.join(linked.withColumnRenamed("node", "fp"), "fp", "left")
        .groupBy(F.coalesce("root", "fp").alias("root"))
        .agg(F.min("first").alias("first"))
        .select(*(F.col(f"first.{n}").alias(c) for c, n in zip(row, "ab")))
    )
    # the join finds the rows where the aggregation has put them: the texts move once
    return tagged.dropDuplicates(row).join(first, row, "left_semi").select(*(F.col(f"`{c}`") for c in own))


def op1_simhash(spark, sf: str) -> DataFrame:
    """Every document's fingerprint and group, at the contract's 4 words and 4 bits."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return groups(docs, words=4, max_bits=4).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
