"""Trees from histograms against plain numpy, and against the trees of Spark ML."""

import numpy as np
import pandas as pd
import pytest

from reviewlens.operators import attribution, helpfulness
from reviewlens.operators import binned_trees as bt
from reviewlens.operators.metrics import regression_metrics
from reviewlens.operators.ranking import split_name
from reviewlens.session import settle

NAMES = ["rating", "hour", "noise"]


def table(spark, n=400, seed=1):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({"rating": rng.integers(-2, 3, n).astype(float), "hour": rng.normal(size=n), "noise": rng.normal(size=n)})
    pdf["helpfulness_ratio"] = 0.2 * pdf.rating + 0.3 * (pdf.hour > 0.4) + 0.1 * np.sin(3 * pdf.hour) + 0.01 * rng.normal(size=n)
    pdf["Id"] = range(n)
    return settle(spark.createDataFrame(pdf), "trees-input")


def test_best_split_by_trying_all():
    rng = np.random.default_rng(2)
    for _ in range(50):
        bins, left = rng.integers(0, 6, (30, 3)), rng.normal(size=30)
        counts, sums = (np.stack([np.bincount(bins[:, f], w, 8) for f in range(3)]) for w in (None, left))
        errors = {}
        for f in range(3):
            for last in range(7):
                low = bins[:, f] <= last
                if low.any() and not low.all():
                    errors[f, last] = sum(((left[m] - left[m].mean()) ** 2).sum() for m in (low, ~low))
        feature, last, gain = bt.best_split(counts, sums)
        best = min(errors.values())
        assert errors[feature, last] == pytest.approx(best)
        assert gain == pytest.approx(((left - left.mean()) ** 2).sum() - best)
    assert bt.best_split(np.array([[5, 0]]), np.array([[1.0, 0.0]])) == (-1, 0, 0.0)


def plain_tree(bins, left, depth, node=0, out=None):
    """The same tree, row by row."""
    out = {} if out is None else out
    width = bins.shape[1]
    counts, sums = (np.stack([np.bincount(bins[:, f], w, bt.BINS) for f in range(width)]) for w in (None, left))
    feature, last, _ = bt.best_split(counts, sums) if depth else (-1, 0, 0)
    out[node] = (feature, last, left.mean(), len(left))
    if feature >= 0:
        low = bins[:, feature] <= last
        plain_tree(bins[low], left[low], depth - 1, 2 * node + 1, out)
        plain_tree(bins[~low], left[~low], depth - 1, 2 * node + 2, out)
    return out


def test_trees_by_plain_numpy(spark):
    df = table(spark)
    model = bt.fit_binned(df, NAMES, n_trees=3, depth=3, rate=0.5)
    train = df.where(split_name() == "train").toPandas()
    bins = model.bins([train[n].to_numpy() for n in NAMES])
    margin = np.full(len(train), train.helpfulness_ratio.mean())
    assert model.start == pytest.approx(margin[0])
    for tree in model.trees:
        expected = plain_tree(bins, (train.helpfulness_ratio - margin).to_numpy(), 3)
        for node, (feature, last, value, n) in expected.items():
            assert (tree.feature[node], tree.counts[node]) == (feature, n)
            assert tree.value[node] == pytest.approx(value, abs=1e-6) and (feature < 0 or tree.bin[node] == last)
        margin = margin + 0.5 * tree.value[tree.leaf_of(bins, 3)]


def test_edges_are_quantiles(spark):
    df = table(spark, 2000)
    edges = bt.bin_edges(df, NAMES)
    x = df.toPandas()
    assert edges[0].tolist() == [-2, -1, 0, 1, 2] and len(edges[1]) == bt.BINS - 1
    ranks = np.searchsorted(np.sort(x.hour.to_numpy()), edges[1]) / len(x)
    assert np.abs(ranks - np.arange(1, bt.BINS) / bt.BINS).max() < 0.002


def test_same_on_every_run_and_partitioning(spark, monkeypatch):
    monkeypatch.setattr(bt, "SETTLE", 2)
    df = table(spark, 200)
    one, many = (bt.fit_binned(x, NAMES, n_trees=5, depth=2) for x in (df.coalesce(1), df.repartition(6)))
    for a, b in zip(one.trees, many.trees):
        assert np.array_equal(a.value, b.value) and np.array_equal(a.feature, b.feature) and np.array_equal(a.bin, b.bin)


def test_as_good_as_spark_ml_and_attributed(spark):
    df = table(spark, 1500)
    model = bt.fit_binned(df, NAMES, n_trees=30, depth=3, rate=0.2)
    predicted = bt.predict_binned(model, df, ["Id", "helpfulness_ratio"]).where(split_name() == "test")
    own = regression_metrics(predicted, "helpfulness_ratio").first()["r2"]
    vectors = helpfulness.assemble(df.withColumnsRenamed({"noise": "word_count"}))
    theirs = helpfulness.fit_helpfulness(vectors, ["rating", "hour", "word_count"], n_trees=30, depth=3)
    test = helpfulness.predict_helpfulness(theirs, vectors).where("split = 'test'")
    assert own > 0.95 and own > regression_metrics(test, "helpfulness_ratio").first()["r2"] - 0.01
    x = df.limit(50).toPandas()
    phi = attribution.attribute(model.nodes(), x[NAMES].to_numpy())
    base = sum(n.mean() for n in model.nodes())
    told = model.predict(model.bins([x[n].to_numpy() for n in NAMES]))
    assert phi.sum(axis=1) + base == pytest.approx(told)


def test_nothing_to_learn(spark):
    df = table(spark).withColumn("helpfulness_ratio", split_name().isNotNull().cast("double"))
    model = bt.fit_binned(df, NAMES, n_trees=2, depth=2)
    assert model.start == 1.0 and all((t.feature < 0).all() and not t.value.any() for t in model.trees)
    none = bt.fit_binned(df.limit(0), NAMES, n_trees=1, depth=2)
    assert bt.predict_binned(none, df).count() == 400
