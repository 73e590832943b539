"""Topic models by mini-batches against plain numpy, on small tables."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewlens.operators import online_topics as ot
from reviewlens.operators import topics
from reviewlens.session import settle

SUBJECTS = [["tea", "cup", "kettle", "leaf"], ["dog", "leash", "bowl", "puppy"], ["book", "page", "cover", "print"]]


def made(spark, n=90, batches=3, categories=("a", "b")):
    """Reviews of one subject each, as sparse vectors; some repeated, some of one word."""
    names = sorted(w for s in SUBJECTS for w in s)
    rng, rows = np.random.default_rng(4), []
    for i in range(n):
        subject = SUBJECTS[i % 3]
        picked = sorted({names.index(subject[int(x)]) for x in rng.integers(0, 4, 1 + i % 5)})
        weights = [float(x) for x in rng.uniform(0.2, 1.0, len(picked))]
        rows.append((categories[i % len(categories)], i, picked, weights, i % batches))
    df = spark.createDataFrame(rows, "category string, Id long, terms array<int>, weights array<double>, batch int")
    return rows, df, {c: names for c in categories}


def psi(x, h=1e-5):
    return (math.lgamma(x + h) - math.lgamma(x - h)) / (2 * h)


@pytest.mark.parametrize("x", [0.01, 0.2, 1.0, 3.7, 50.0, 1e6])
def test_special_functions(x):
    assert ot.log_gamma(np.array([x]))[0] == pytest.approx(math.lgamma(x), rel=1e-10, abs=1e-10)
    if 0.1 < x < 1e5:
        assert ot.digamma(np.array([x]))[0] == pytest.approx(psi(x), rel=1e-5, abs=1e-5)
    assert ot.digamma(np.array([x + 1]))[0] == pytest.approx(ot.digamma(np.array([x]))[0] + 1 / x, rel=1e-10)


def plain_shares(terms, weights, beta, prior):
    """One review, word by word."""
    gamma = np.ones(beta.shape[0])
    for _ in range(100):
        theta = np.exp(ot.expected_log(gamma[None])[0])
        new = np.full(len(gamma), prior)
        for w, n in zip(terms, weights):
            phi = theta * beta[:, w]
            new += n * phi / (phi.sum() + 1e-100)
        moved = np.abs(new - gamma).mean()
        gamma = new
        if moved < 1e-3:
            break
    return gamma


def plain_fit(rows, category, k, n_terms, passes, batches, start):
    lam, step, own = start.copy(), 0, [r for r in rows if r[0] == category]
    for _ in range(passes):
        for b in range(batches):
            batch = [r for r in own if r[4] == b]
            if not batch:
                continue
            beta, stats = np.exp(ot.expected_log(lam)), np.zeros((k, n_terms))
            for _, _, terms, weights, _ in batch:
                theta = np.exp(ot.expected_log(plain_shares(terms, weights, beta, 1 / k)[None])[0])
                for w, n in zip(terms, weights):
                    phi = theta * beta[:, w]
                    stats[:, w] += n * phi / phi.sum()
            step += 1
            rate = (50 + step) ** -0.7
            lam = (1 - rate) * lam + rate * (1 / k + stats * len(own) / len(batch))
    return lam


@pytest.mark.parametrize("block", [1, 1 << 13, 1 << 30])
def test_shares_do_not_depend_on_neighbours(monkeypatch, block):
    """Reviews of one to many terms, each as it is alone and as it is word by word, however many go together."""
    monkeypatch.setattr(ot, "BLOCK_BYTES", block)
    rng = np.random.default_rng(6)
    sizes = np.array([1, 2, 15, 16, 17, 63, 64, 65, 200, *rng.integers(1, 90, 60)])
    terms = np.concatenate([np.sort(rng.choice(200, n, replace=False)) for n in sizes]).astype(np.int32)
    counts, offsets = rng.uniform(0.05, 2.0, len(terms)), np.concatenate([[0], np.cumsum(sizes)])
    beta = np.exp(ot.expected_log(rng.gamma(0.3, 2.0, (5, 200)) + 0.01)).T.copy()
    whole = ot.review_shares(offsets, terms, counts, beta, 0.2)
    for i, (a, b) in enumerate(zip(offsets, offsets[1:])):
        alone = ot.review_shares(np.array([0, b - a]), terms[a:b], counts[a:b], beta, 0.2)
        assert np.array_equal(alone[0], whole[i])
        assert whole[i] == pytest.approx(plain_shares(terms[a:b], counts[a:b], beta.T, 0.2), rel=1e-9)


def test_reviews_of_one_width_settle_together(monkeypatch):
    """A round of a chunk is a few products, whatever its reviews: one width, one call."""
    calls, settle_shares = [], ot._settle_shares
    monkeypatch.setattr(ot, "_settle_shares", lambda beta, *rest: calls.append(beta.shape) or settle_shares(beta, *rest))
    offsets = np.arange(0, 501 * 10, 10)
    terms, counts = np.tile(np.arange(10, dtype=np.int32), 500), np.full(5000, 0.3)
    ot.review_shares(offsets, terms, counts, np.full((10, 3), 0.1), 1 / 3)
    assert calls == [(500, 3, ot.LEAST_WIDTH)]


def test_equals_plain_numpy(spark):
    rows, df, names = made(spark)
    models = ot.fit_models(df, names, (2, 3), passes=3)
    assert [(m.category, m.k) for m in models] == [("a", 2), ("a", 3), ("b", 2), ("b", 3)]
    for m in models:
        expected = plain_fit(rows, m.category, m.k, len(m.terms), 3, 3, ot.start_weights(m, 42))
        assert np.allclose(m.weights, expected, atol=1e-4)
        assert [done for done, _ in m.trace] == [3]
    shares = {(r.category, r.k, r.Id): r.topics for r in ot.shares(df, models).collect()}
    assert len(shares) == 180
    for m in models:
        beta = np.exp(ot.expected_log(m.weights))
        for c, i, terms, weights, _ in rows:
            if c == m.category:
                gamma = plain_shares(terms, weights, beta, 1 / m.k)
                assert shares[c, m.k, i] == pytest.approx(gamma / gamma.sum(), abs=1e-9)


def test_perplexity_by_its_definition(spark):
    rows, df, names = made(spark, 30, 1, ("a",))
    (m,) = ot.fit_models(df, names, (3,), passes=1)
    logb, prior, bound, words = ot.expected_log(m.weights), 1 / 3, 0.0, 0.0
    for _, _, terms, weights, _ in rows:
        gamma = plain_shares(terms, weights, np.exp(logb), prior)
        logt = ot.expected_log(gamma[None])[0]
        bound += sum(n * math.log(sum(math.exp(logt[j] + logb[j, w]) for j in range(3))) for w, n in zip(terms, weights))
        bound += sum((prior - g) * x + math.lgamma(g) - math.lgamma(prior) for g, x in zip(gamma, logt)) + math.lgamma(1) - math.lgamma(gamma.sum())
        words += sum(weights)
    for row, logs in zip(m.weights, logb):
        bound += sum((prior - w) * x + math.lgamma(w) - math.lgamma(prior) for w, x in zip(row, logs))
        bound += math.lgamma(12 * prior) - math.lgamma(row.sum())
    assert m.trace == [(1, pytest.approx(-bound / words, abs=1e-4))]


def test_same_on_every_run_and_partitioning(spark):
    _, df, names = made(spark)
    one = ot.fit_models(df.coalesce(1), names, (3,), passes=2)
    many = ot.fit_models(df.repartition(7), names, (3,), passes=2)
    assert all(np.array_equal(a.weights, b.weights) and a.trace == b.trace for a, b in zip(one, many))


def test_trace_falls_and_topics_are_the_subjects(spark):
    _, df, names = made(spark, 300, 4, ("a",))
    one, three = ot.fit_models(settle(df, "vectors", by="batch"), names, (1, 3), passes=20)
    values = [v for _, v in three.trace]
    assert [done for done, _ in three.trace] == [5, 10, 15, 20]
    assert all(a > b for a, b in zip(values, values[1:])) and values[-1] < one.trace[-1][1]
    ranked = topics.topic_terms(spark, [three], 4).collect()
    found = [{r.term for r in ranked if r.topic == t} for t in range(3)]
    assert sorted(map(sorted, found)) == sorted(map(sorted, SUBJECTS))


def test_models_in_groups_and_read_back(spark, monkeypatch):
    _, df, names = made(spark)
    whole = ot.fit_models(df, names, (2, 3), passes=1)
    monkeypatch.setattr(ot, "GROUP_BYTES", 300)
    parts = ot.fit_models(df, names, (2, 3), passes=1)
    assert all(np.array_equal(a.weights, b.weights) for a, b in zip(whole, parts))
    back = topics.read_models(topics.model_table(spark, whole))
    assert all(a.terms == b.terms and np.array_equal(a.weights, b.weights) for a, b in zip(whole, back))


def test_every_review_is_in_one_batch(spark):
    texts = [(i, "c", " ".join(SUBJECTS[i % 3][: 1 + i % 4])) for i in range(200)] + [(900, "c", "unknown words"), (901, "c", "")]
    df = spark.createDataFrame(texts, "Id long, category string, clean_text string")
    from reviewlens.functions import text
    from reviewlens.operators import terms

    vocab = terms.fit_vocabulary(df.where("Id < 200"), text.terms(F.col("clean_text")), 100, ["category"])
    vectors = topics.topic_vectors(df, vocab, "category", batch=30)
    rows = vectors.collect()
    assert sorted(r.Id for r in rows) == list(range(200)) and {r.batch for r in rows} == set(range(7))
    assert all(sum(w * w for w in r.weights) == pytest.approx(1) and r.terms == sorted(r.terms) for r in rows)


def test_tasks_have_as_many_chunks(spark, monkeypatch):
    """A step waits for its slowest task, so the chunks of a batch are dealt out evenly."""
    rows, df, _ = made(spark, 400, 2)
    monkeypatch.setattr(ot, "CHUNK", 7)
    sizes = {(c, b): sum(r[0] == c and r[4] == b for r in rows) for c in "ab" for b in range(2)}
    many = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}  # files of few chunks
    before = {name: spark.conf.get(name) for name in many}
    try:
        for name, value in many.items():
            spark.conf.set(name, value)
        dealt = [[len(part) for part in kept.glom().collect()] for kept in ot.chunked(df, sizes).values()]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    for held in dealt:
        assert len(held) == spark.sparkContext.defaultParallelism and max(held) - min(held) <= 1 and sum(held) > 20


def test_steps_read_kept_chunks(spark, monkeypatch):
    rows, df, names = made(spark)
    whole = ot.fit_models(df, names, (2,), passes=2)
    monkeypatch.setattr(ot, "CHUNK", 10)
    chunks = ot.chunked(df, {(c, b): sum(r[0] == c and r[4] == b for r in rows) for c in "ab" for b in range(3)})
    assert sorted(chunks) == [0, 1, 2]
    for batch, kept in chunks.items():
        found = kept.collect()
        told = sorted((c, t[a:b].tolist(), w[a:b].tolist()) for c, o, t, w in found for a, b in zip(o, o[1:]))
        assert told == sorted((r[0], r[2], r[3]) for r in rows if r[4] == batch) and len(found) > 2
    plans = []
    monkeypatch.setattr(type(df), "mapInArrow", lambda *a, **k: plans.append(a) or pytest.fail("a plan a step"))
    cut = ot.fit_models(df, names, (2,), passes=2)
    assert not plans and all(np.array_equal(a.weights, b.weights) and a.trace == b.trace for a, b in zip(whole, cut))
