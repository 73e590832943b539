"""Boosted regression trees from binned features: one job a level, on one byte a feature.

Bin edges come from a mergeable quantile sketch over all training rows, in one aggregation. The rows are
then kept as bytes, one for each feature's bin, beside the target. For each level of a tree, one job
sums count and residual per node, feature and bin; these histograms, whose size the data does not
change, decide the splits. Residuals are rounded to ``UNIT`` and summed as integers, so that the
trees are the same whatever the partitions.

A row's margin is what the trees since the last settling add to the stored one; every ``SETTLE`` trees
the margins are stored anew, so that a job's work a row does not grow with the number of trees.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.operators.attribution import Node
from reviewlens.operators.ranking import split_name
from reviewlens.session import settle

BINS = 64
ACCURACY = 10_000  # of the sketch: ranks are within 1 / ACCURACY
SETTLE = 10
UNIT = 2.0**-30


@dataclass
class BinnedTree:
    """Nodes of a full binary tree by number, children at ``2 i + 1`` and ``2 i + 2``: the feature and the last
    bin that goes left, or feature -1 and a value. ``counts`` are the training rows of each node."""

    feature: np.ndarray
    bin: np.ndarray
    value: np.ndarray
    counts: np.ndarray

    def leaf_of(self, bins: np.ndarray, levels: int) -> np.ndarray:
        """The node that each row of bins reaches after so many levels."""
        node = np.zeros(len(bins), np.int64)
        for _ in range(levels):
            feature = self.feature[node]
            inner = np.flatnonzero(feature >= 0)
            right = bins[inner, feature[inner]] > self.bin[node[inner]]
            node[inner] = 2 * node[inner] + 1 + right
        return node


@dataclass
class BinnedModel:
    """``names`` of the features, ``edges`` of their bins, the ``start`` value and the trees."""

    names: list[str]
    edges: list[np.ndarray]
    depth: int
    rate: float
    start: float = 0.0
    trees: list[BinnedTree] = field(default_factory=list)

    def bins(self, columns: Sequence[np.ndarray]) -> np.ndarray:
        """A value at an edge belongs to the bin that ends there; a missing one counts as 0."""
        return np.stack([np.searchsorted(e, np.nan_to_num(c), side="left") for e, c in zip(self.edges, columns)], axis=1).astype(np.uint8)

    def predict(self, bins: np.ndarray) -> np.ndarray:
        out = np.full(len(bins), self.start)
        for tree in self.trees:
            out += self.rate * tree.value[tree.leaf_of(bins, self.depth)]
        return out

    def nodes(self) -> list[Node]:
        """The trees as ``attribution`` reads them, the start value as one of a single leaf."""

        def node(tree: BinnedTree, i: int) -> Node:
            if tree.feature[i] < 0:
                return Node(self.rate * float(tree.value[i]))
            feature, left, right = int(tree.feature[i]), 2 * i + 1, 2 * i + 2
            shares = [float(tree.counts[k] / tree.counts[i]) for k in (left, right)]
            return Node(0.0, feature, float(self.edges[feature][tree.bin[i]]), node(tree, left), node(tree, right), *shares)

        return [Node(self.start), *(node(tree, 0) for tree in self.trees)]


def bin_edges(df: DataFrame, names: Sequence[str], bins: int = BINS) -> list[np.ndarray]:
    """The different values at the inner quantiles of each feature, from one sketch a feature."""
    shares = [i / bins for i in range(1, bins)]
    sketches = [F.percentile_approx(F.coalesce(F.col(n).cast("double"), F.lit(0.0)), shares, ACCURACY).alias(n) for n in names]
    row = df.agg(*sketches).first()
    return [np.unique(np.array(row[n] or [], dtype=float)) for n in names]


def best_split(counts: np.ndarray, sums: np.ndarray) -> tuple[int, int, float]:
    """Feature, last bin that goes left, and what the split takes off the squared error, from one node's
    histograms (features by bins); feature -1 without a split that helps. Ties go to the first."""
    n, s = np.cumsum(counts, axis=1), np.cumsum(sums, axis=1)
    whole, total = n[:, -1:], s[:, -1:]
    left, right = n[:, :-1], whole - n[:, :-1]
    valid = (left > 0) & (right > 0)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = s[:, :-1] ** 2 / left + (total - s[:, :-1]) ** 2 / right - total**2 / whole
    gain = np.where(valid, gain, -np.inf)
    at = int(np.argmax(gain))
    feature, last = divmod(at, gain.shape[1])
    found = float(gain[feature, last])
    return (feature, last, found) if found > 1e-12 else (-1, 0, 0.0)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of bytes as a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, width)


def _histograms(rows: DataFrame, trees: list[BinnedTree], tree: BinnedTree, level: int, model: BinnedModel) -> tuple[np.ndarray, np.ndarray]:
    """Counts and residual sums per node of the level, feature and bin."""
    width, first = len(model.names), 2**level - 1
    sent = rows.sparkSession.sparkContext.broadcast((trees, tree))
    depth, rate, slots = model.depth, model.rate, 2**level * width * BINS

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        older, growing = sent.value
        n, s = np.zeros(slots, np.int64), np.zeros(slots, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            bins = _matrix(batch.column("bins"), width)
            left = np.asarray(batch.column("y")) - np.asarray(batch.column("margin"))
            for t in older:
                left = left - rate * t.value[t.leaf_of(bins, depth)]
            units = np.rint(left / UNIT)
            node = growing.leaf_of(bins, level) - first
            here = np.flatnonzero(node >= 0)  # others have ended in a leaf above
            base = node[here] * width * BINS
            for feature in range(width):
                slot = base + feature * BINS + bins[here, feature]
                n += np.bincount(slot, minlength=slots)
                s += np.bincount(slot, units[here], slots).astype(np.int64)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_pydict({"slot": some, "n": n[some], "s": s[some]})

    summed = rows.mapInArrow(run, "slot bigint, n bigint, s bigint").groupBy("slot").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    table = summed.toArrow()
    slot, n, s = (np.asarray(table.column(c).combine_chunks()) for c in ("slot", "n", "s"))
    counts, sums = np.zeros(slots, np.int64), np.zeros(slots)
    counts[slot], sums[slot] = n, s * UNIT
    return counts.reshape(-1, width, BINS), sums.reshape(-1, width, BINS)


def _grow(rows: DataFrame, trees: list[BinnedTree], model: BinnedModel) -> BinnedTree:
    """One tree on the residuals, level by level."""
    size = 2 ** (model.depth + 1) - 1
    tree = BinnedTree(np.full(size, -1), np.zeros(size, np.int64), np.zeros(size), np.zeros(size, np.int64))
    for level in range(model.depth):
        counts, sums = _histograms(rows, trees, tree, level, model)
        first = 2**level - 1
        for i in range(2**level):
            n, s, node = counts[i, 0].sum(), sums[i, 0].sum(), first + i
            if not n:
                continue
            tree.counts[node], tree.value[node] = n, s / n
            feature, last, _ = best_split(counts[i], sums[i])
            if feature < 0:
                continue
            tree.feature[node], tree.bin[node] = feature, last
            lower = slice(0, last + 1)
            for child, part in ((2 * node + 1, lower), (2 * node + 2, slice(last + 1, None))):
                own = counts[i, feature, part].sum()
                tree.counts[child], tree.value[child] = own, sums[i, feature, part].sum() / own
        if (tree.feature[first : 2 * first + 1] < 0).all():
            break
    return tree


def fit_binned(
    scaled: DataFrame, names: Sequence[str], target: str = "helpfulness_ratio", n_trees: int = 100, depth: int = 5, rate: float = 0.1
) -> BinnedModel:
    """Boosted trees on the training part of ``scaled``, which holds ``Id``, the features and the target."""
    train = scaled.where(split_name() == "train").where(F.col(target).isNotNull())
    model = BinnedModel(list(names), bin_edges(train, names), depth, rate)
    model.start = train.agg(F.avg(target)).first()[0] or 0.0
    parts = int(scaled.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # few bytes, much work
    features = [F.coalesce(F.col(n).cast("double"), F.lit(0.0)).alias(n) for n in names]
    given = train.select(*features, F.col(target).cast("double").alias("y"))

    def to_bytes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = model.bins([np.asarray(c) for c in batch.columns[:-1]])
            made = pa.array([row.tobytes() for row in bins], pa.binary())
            margin = pa.array(np.full(batch.num_rows, model.start))
            yield pa.RecordBatch.from_arrays([made, batch.column("y"), margin], names=["bins", "y", "margin"])

    rows = settle(given.mapInArrow(to_bytes, "bins binary, y double, margin double").repartition(parts), "binned-rows")
    fresh: list[BinnedTree] = []
    for number in range(n_trees):
        tree = _grow(rows, fresh, model)
        model.trees.append(tree)
        fresh.append(tree)
        if len(fresh) == SETTLE and number + 1 < n_trees:
            rows, fresh = settle(_moved(rows, fresh, model), "binned-rows"), []
    return model


def _moved(rows: DataFrame, trees: list[BinnedTree], model: BinnedModel) -> DataFrame:
    """The rows with the margins that the trees add to."""
    sent = rows.sparkSession.sparkContext.broadcast(list(trees))
    width, depth, rate = len(model.names), model.depth, model.rate

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins, margin = _matrix(batch.column("bins"), width), np.array(batch.column("margin"))
            for t in sent.value:
                margin = margin + rate * t.value[t.leaf_of(bins, depth)]
            yield pa.RecordBatch.from_arrays([batch.column("bins"), batch.column("y"), pa.array(margin)], names=batch.schema.names)

    return rows.mapInArrow(run, rows.schema)


def predict_binned(model: BinnedModel, scaled: DataFrame, keep: Sequence[str] = ("Id",)) -> DataFrame:
    """``*keep, prediction`` of every row."""
    sent = scaled.sparkSession.sparkContext.broadcast(model)
    features = [F.coalesce(F.col(n).cast("double"), F.lit(0.0)).alias(f"_f{i}") for i, n in enumerate(model.names)]
    kept = scaled.select(*keep)
    n = len(features)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = sent.value.predict(sent.value.bins([np.asarray(c) for c in batch.columns[-n:]]))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-n], pa.array(values)], names=[*keep, "prediction"])

    return scaled.select(*keep, *features).mapInArrow(run, kept.schema.add("prediction", "double"))
