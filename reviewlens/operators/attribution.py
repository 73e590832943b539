"""Shapley values of boosted trees, exact for the trees' own cover weights.

For one leaf, let ``o`` say which features on its path let a review through, and ``r`` be the
share of training weight that passes each of them. A feature's value is the average, over all
orders of adding features, of what adding it changes in ``leaf * prod(o or r)``. As the number of
features that come first is uniform, this average is an integral over a share ``t`` of features
that are known:

    leaf * (o_j - r_j) * integral over t of  prod over i <> j of  (1 - t) r_i + t o_i

The product has a degree below the number of features on the path, so a Gauss rule of half as many points
gives the integral exactly. One walk over a tree extends the products by one factor an edge, for all
reviews of a batch at once, and on its way back sums them over the leaves below each edge. The work is
linear in the nodes and in the points, for trees of any depth.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlens.operators.helpfulness import HelpfulnessModel
from reviewlens.session import scratch_path

ROWS = 2048  # reviews that walk a tree together, so that their products stay in the caches


@dataclass
class Node:
    """A leaf with its weighted ``value``, or a split with the training share of each side."""

    value: float = 0.0
    feature: int = -1
    threshold: float = 0.0
    left: Node | None = None
    right: Node | None = None
    left_share: float = 1.0
    right_share: float = 1.0

    def mean(self) -> float:
        """The output averaged over the training weight."""
        if self.left is None:
            return self.value
        return self.left_share * self.left.mean() + self.right_share * self.right.mean()

    def most_features(self, above: frozenset[int] = frozenset()) -> int:
        """The largest number of different features on a path."""
        if self.left is None:
            return len(above)
        own = above | {self.feature}
        return max(self.left.most_features(own), self.right.most_features(own))


def tree_of(nodes: dict[int, dict], weight: float, node_id: int = 0) -> Node:
    """A tree from its rows ``left, right, feature, threshold, count, prediction`` by node number."""
    own = nodes[node_id]
    if own["left"] < 0:
        return Node(weight * own["prediction"])
    left, right = (tree_of(nodes, weight, own[side]) for side in ("left", "right"))
    shares = [nodes[own[side]]["count"] / own["count"] for side in ("left", "right")]
    return Node(0.0, own["feature"], own["threshold"], left, right, *shares)


def model_trees(spark: SparkSession, model: HelpfulnessModel) -> list[Node]:
    """All trees of the model, from the node tables of its saved form.

    The nodes are model parameters: at most ``trees * 2^(depth + 1)`` of them.
    """
    path = scratch_path(spark, "helpfulness-trees")
    model.trees.write().save(path)
    rows = (
        spark.read.parquet(f"{path}/data")
        .select(
            "treeID",
            F.col("nodeData.id").alias("id"),
            F.col("nodeData.prediction").alias("prediction"),
            F.col("nodeData.rawCount").alias("count"),
            F.col("nodeData.leftChild").alias("left"),
            F.col("nodeData.rightChild").alias("right"),
            F.col("nodeData.split.featureIndex").alias("feature"),
            F.get("nodeData.split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
        )
        .collect()
    )
    trees: dict[int, dict[int, dict]] = {}
    for r in rows:
        trees.setdefault(r["treeID"], {})[r["id"]] = r.asDict()
    return [tree_of(trees[number], weight) for number, weight in enumerate(model.trees.treeWeights)]


def gauss_rule(points: int) -> tuple[np.ndarray, np.ndarray]:
    """Points and weights on the unit interval, as columns, exact below degree ``2 * points``."""
    x, w = np.polynomial.legendre.leggauss(max(1, points))
    return (x[:, None] + 1) / 2, w[:, None] / 2


class _Walk:
    """One tree and the columns of some reviews; adds to ``out``, a row for each feature."""

    def __init__(self, x: np.ndarray, out: np.ndarray, points: int):
        self.x, self.out = x, out
        self.t, self.weights = gauss_rule(points)

    def under(self, node: Node, product: np.ndarray, path: dict[int, tuple]) -> np.ndarray:
        """The sum over the leaves below of leaf and product, after adding what their edges give."""
        if node.left is None:
            return node.value * product
        column, earlier, total = self.x[node.feature], path.get(node.feature), None
        below_threshold = column <= node.threshold
        if node.left.left is None and node.right.left is None:
            return self.over_leaves(node, below_threshold, product, earlier)
        for child, here, share in ((node.left, below_threshold, node.left_share), (node.right, ~below_threshold, node.right_share)):
            passes, grown = here, product
            if earlier:
                passes, share, grown = here & earlier[0], share * earlier[1], product / earlier[2]
            factor = (1 - self.t) * share + self.t * passes
            below = self.under(child, grown * factor, {**path, node.feature: (passes, share, factor)})
            self.out[node.feature] += (passes - share) * self.mean(below / factor)
            if earlier:  # the earlier edge of this feature has no part in the leaves of this one
                self.out[node.feature] -= (earlier[0] - earlier[1]) * self.mean(below / earlier[2])
            total = below if total is None else total + below
        return total

    def over_leaves(self, node: Node, below_threshold: np.ndarray, product: np.ndarray, earlier: tuple | None) -> np.ndarray:
        """``under`` for a split of two leaves, half of all edges: both edges at once, their own factors never divided out."""
        seen, known, grown = (earlier[0], earlier[1], product / earlier[2]) if earlier else (1.0, 1.0, product)
        known_mean = known * (node.left_share * node.left.value + node.right_share * node.right.value)
        own = np.where(below_threshold, node.left.value, node.right.value) * seen
        total = grown * ((1 - self.t) * known_mean + self.t * own)
        self.out[node.feature] += (own - known_mean) * self.mean(grown)
        if earlier:
            self.out[node.feature] -= (earlier[0] - earlier[1]) * self.mean(total / earlier[2])
        return total

    def mean(self, values: np.ndarray) -> np.ndarray:
        """Over the rule's points."""
        return np.einsum("p,pn->n", self.weights[:, 0], values)


def attribute(trees: list[Node], x: np.ndarray) -> np.ndarray:
    """Shapley values of the rows of ``x``."""
    out = np.zeros(x.shape, dtype=float)
    points = [math.ceil(tree.most_features() / 2) for tree in trees]
    for first in range(0, len(x), ROWS):
        columns = np.ascontiguousarray(x[first : first + ROWS].T, dtype=float)
        values = np.zeros_like(columns)
        for tree, n in zip(trees, points):
            walk = _Walk(columns, values, n)
            walk.under(tree, np.ones((len(walk.t), columns.shape[1])), {})
        out[first : first + ROWS] = values.T
    return out


def shap_values(model: HelpfulnessModel, scaled: DataFrame) -> DataFrame:
    """``Id, phi, base``: one value per feature of the same scaled rows the model was fitted on."""
    spark = scaled.sparkSession
    trees = model_trees(spark, model)
    shared = spark.sparkContext.broadcast(trees)
    names = model.names

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            phi = attribute(shared.value, batch[names].to_numpy(dtype=float))
            yield pd.DataFrame({"Id": batch["Id"], "phi": list(phi)})

    id_type = scaled.schema["Id"].dataType
    schema = T.StructType(
        [T.StructField("Id", id_type), T.StructField("phi", T.ArrayType(T.DoubleType()))]
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))  # few bytes, much work
    filled = scaled.select("Id", *[F.coalesce(F.col(n), F.lit(0.0)).alias(n) for n in names]).repartition(parts)
    return filled.mapInPandas(run, schema).withColumn("base", F.lit(sum(tree.mean() for tree in trees)))


def mean_attribution(values: DataFrame, names: list[str]) -> DataFrame:
    """``feature, importance``: mean absolute value per feature, the largest first."""
    means = values.agg(*[F.avg(F.abs(F.get("phi", F.lit(i)))).alias(n) for i, n in enumerate(names)])
    pairs: list[Column] = [
        F.struct(F.lit(n).alias("feature"), F.col(n).alias("importance")) for n in names
    ]
    return means.select(F.inline(F.array(*pairs))).orderBy(F.desc("importance"), "feature")


def gain_importance(model: HelpfulnessModel, spark: SparkSession) -> DataFrame:
    """``feature, importance`` from the splits alone: no pass over the reviews."""
    gains = model.trees.featureImportances.toArray()
    rows = [(n, float(g)) for n, g in zip(model.names, gains)]
    table = spark.createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature")
