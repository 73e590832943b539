"""Operators against brute force, and properties that hold for any input."""

import hashlib
import itertools
import math
import time
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reviewlens.functions import text
from reviewlens.operators import attribution, categories, coherence, helpfulness, ranking, terms
from reviewlens.operators.lexicon import add_sentiment, lexicon_sentiment
from reviewlens.operators.sentiment_model import evaluate_sentiment, fit_sentiment, score_sentiment, score_with, text_tokens
from reviewlens.session import settle

FEW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
WORD = st.sampled_from(["tea", "cup", "good", "bad", "not", "very", "kettle", "of", "the"])
TEXTS = st.lists(st.lists(WORD, max_size=12).map(" ".join), min_size=1, max_size=8)


def frame(spark, texts, **more):
    rows = [(i, t, *[v[i] for v in more.values()]) for i, t in enumerate(texts)]
    extra = "".join(f", {k} string" for k in more)
    return spark.createDataFrame(rows, f"Id long, clean_text string{extra}")


@FEW
@given(texts=TEXTS)
def test_term_counts_are_counts(spark, texts):
    bag = terms.bag_of_words(frame(spark, texts), text.words(F.col("clean_text")))
    got = {(r["Id"], r["term"]): r["tf"] for r in bag.collect()}
    assert got == {(i, w): n for i, t in enumerate(texts) for w, n in Counter(t.split()).items()}


@FEW
@given(texts=TEXTS)
def test_tfidf_rows_have_length_one(spark, texts):
    df, tokens = frame(spark, texts), text.terms(F.col("clean_text"))
    vocab = terms.fit_vocabulary(df, tokens, 5)
    rows = terms.tfidf(terms.bag_of_words(df, tokens), vocab).collect()
    lengths = Counter()
    for r in rows:
        lengths[r["Id"]] += r["weight"] ** 2
    assert all(v == pytest.approx(1) for v in lengths.values())
    kept = sorted(Counter(w for t in texts for w in t.split()).items(), key=lambda p: (-p[1], p[0]))[:5]
    assert sorted(r["term"] for r in vocab.collect()) == sorted(w for w, _ in kept)


def test_sparse_vectors_equal_the_long_table(spark):
    df = frame(spark, ["good tea good cup", "bad tea", "", "kettle of the cup"])
    tokens = text.terms(F.col("clean_text"))
    vocab = terms.fit_vocabulary(df, tokens, 6)
    long = {
        (r["Id"], r["term_idx"]): r["weight"]
        for r in terms.tfidf(terms.bag_of_words(df, tokens), vocab).collect()
    }
    vectors = terms.tfidf_vectors(df, tokens, vocab).select("Id", "features").collect()
    flat = {(r["Id"], int(i)): v for r in vectors for i, v in zip(r["features"].indices, r["features"].values)}
    assert flat == pytest.approx(long)


def _polarity(words, lexicon, modifiers):
    found = []
    for i, w in enumerate(words):
        if w not in lexicon:
            continue
        before = [modifiers.get(words[j]) if j >= 0 else None for j in (i - 1, i - 2)]
        p = lexicon[w][0]
        if before[0] and before[0][0] == "intensifier":
            p *= before[0][1]
        negators = [m[1] for m in before if m and m[0] == "negator"]
        found.append((p * negators[0] if negators else p, lexicon[w][1]))
    if not found:
        return 0.0, 0.0
    mean = sum(p for p, _ in found) / len(found)
    return max(-1.0, min(1.0, mean)), sum(s for _, s in found) / len(found)


@FEW
@given(texts=TEXTS)
def test_lexicon_scores(spark, texts):
    lexicon = {"good": (0.7, 0.6), "bad": (-0.9, 0.7), "very": (0.2, 0.3)}
    modifiers = {"not": ("negator", -0.5), "very": ("intensifier", 1.9)}
    got = lexicon_sentiment(
        frame(spark, texts),
        spark.createDataFrame([(w, *v) for w, v in lexicon.items()], "word string, polarity double, subjectivity double"),
        spark.createDataFrame([(w, *v) for w, v in modifiers.items()], "word string, kind string, factor double"),
    ).collect()
    expected = {i: _polarity(t.split(), lexicon, modifiers) for i, t in enumerate(texts)}
    assert {r["Id"]: (r["sentiment_score"], r["subjectivity_score"]) for r in got} == {
        i: pytest.approx(v) for i, v in expected.items()
    }
    assert all(-1 <= r["sentiment_score"] <= 1 for r in got)


def test_sentiment_does_not_depend_on_partitions(spark):
    df = frame(spark, [f"good tea {'not ' * (i % 3)}bad cup" for i in range(40)])
    lexicon = spark.createDataFrame([("good", 0.7, 0.6), ("bad", -0.9, 0.7)], "word string, polarity double, subjectivity double")
    modifiers = spark.createDataFrame([("not", "negator", -0.5)], "word string, kind string, factor double")
    one = add_sentiment(df.coalesce(1), lexicon, modifiers).orderBy("Id").collect()
    assert one == add_sentiment(df.repartition(7), lexicon, modifiers).orderBy("Id").collect()


@pytest.mark.parametrize("n", [1, 7, 60])
def test_sample_is_the_lowest_hashes(spark, n):
    df = spark.range(200).select(
        F.col("id").alias("Id"), F.when(F.col("id") % 10 < 7, "hot").otherwise("cold").alias("g")
    )
    order = sorted(range(200), key=lambda i: (hashlib.md5(str(i).encode()).hexdigest(), i))
    assert {r["Id"] for r in ranking.sample_reviews(df, n, digits=1).collect()} == set(order[:n])
    got = {(r["g"], r["Id"]) for r in ranking.sample_reviews(df, n, ["g"], digits=1).collect()}
    expected = set()
    for g, test in (("hot", lambda i: i % 10 < 7), ("cold", lambda i: i % 10 >= 7)):
        expected |= {(g, i) for i in [i for i in order if test(i)][:n]}
    assert got == expected


def test_top_n_of_a_hot_group(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "cold").otherwise("hot").alias("g"),
        F.col("id").cast("string").alias("term"),
        (F.col("id") * 7919 % 997).alias("v"),
    )
    got = ranking.top_n_per_group(df, ["g"], [F.desc("v"), F.asc("term")], 25, ["term"], salts=4).toPandas()
    whole = df.toPandas().sort_values(["g", "v", "term"], ascending=[True, False, True])
    expected = whole.groupby("g").head(25)
    assert sorted(zip(got.g, got.term)) == sorted(zip(expected.g, expected.term))
    assert sorted(got["rank"]) == sorted(list(range(1, 26)) * 2)


def _windows(words, size):
    return [set(words[s : s + size]) for s in range(max(len(words) - size, 0) + 1)]


@FEW
@given(
    texts=st.lists(st.lists(WORD, max_size=25).map(" ".join), min_size=1, max_size=6),
    size=st.sampled_from([2, 5, 9]),
)
def test_window_counts_by_listing_windows(spark, texts, size):
    words = ["tea", "cup", "good", "not", "absent"]
    pairs = [tuple(sorted(p)) for p in itertools.combinations_with_replacement(words, 2)]
    table = settle(spark.createDataFrame(pairs, "a string, b string"), "pairs")
    counts = coherence.pair_counts(frame(spark, texts), table, window=size).collect()
    got = {(r["a"], r["b"]): r["n_both"] for r in counts if r["n_both"]}
    held = [w for t in texts for w in _windows(t.split(), size)]
    expected = {p: n for p in pairs if (n := sum(p[0] in w and p[1] in w for w in held))}
    assert got == expected | {("", ""): len(held)}


@pytest.mark.parametrize("most_bits", [1 << 27, 1])
def test_shared_windows_by_listing_windows(monkeypatch, most_bits):
    """The counts of texts of one group, also where their windows are counted in many blocks."""
    monkeypatch.setattr(coherence, "MOST_BITS", most_bits)
    rng = np.random.default_rng(8)
    texts = [rng.integers(-1, 6, n).astype(np.int32) for n in [0, 1, 3, 4, 5, 64, 65, 700, *rng.integers(0, 90, 40)]]
    a, b = np.array([(a, b) for a in range(6) for b in range(a, 6)]).T
    windows = [set(t[s : s + 4].tolist()) for t in texts for s in range(max(len(t) - 4, 0) + 1)]
    expected = [sum(x in w and y in w for w in windows) for x, y in zip(a, b)]
    assert coherence._shared_windows(texts, 6, a, b, 4).tolist() == expected
    assert coherence._shared_windows([t[t < 0] for t in texts], 6, a, b, 4).tolist() == [0] * len(a)


def test_rows_of_one_id_lie_over_each_other(spark):
    """Such rows count as one text, in a group at a time; all others stay where they are and give the same sums."""
    words, rng = ["tea", "cup", "good", "not"], np.random.default_rng(5)
    texts = [" ".join(rng.choice([*words, "other"], n)) for n in (3, 9, 2, 14, 0, 8, 5, 7)] + [None]
    rows = list(zip([1, 1, 2, 3, 3, 4, 1, None, None], "xxxxxxyxx", texts))
    df = settle(spark.createDataFrame(rows, "Id bigint, g string, clean_text string"), "texts")
    pairs = [(g, *sorted(p)) for g in "xyz" for p in itertools.combinations_with_replacement(words, 2)]
    table = settle(spark.createDataFrame(pairs, "g string, a string, b string"), "pairs")
    got = {(r["g"], r["a"], r["b"]): r["n_both"] for r in coherence.pair_counts(df, table, ["g"], window=4).collect()}
    covered, totals, present = {}, {}, {}
    for i, g, t in rows:
        held = _windows((t or "").split(), 4)
        totals[g] = totals.get(g, 0) + len(held)
        present.setdefault(g, set()).update((t or "").split())
        for n, w in enumerate(held):
            covered.setdefault((g, i, n), set()).update(w)
    expected = {(g, "", ""): n for g, n in totals.items()}
    for g, a, b in pairs:
        if {a, b} & present.get(g, set()):
            expected[g, a, b] = sum(k[0] == g and a in w and b in w for k, w in covered.items())
    assert got == expected


def test_coherence_by_its_definition(spark):
    texts = ["tea cup tea good kettle " * 3, "bad not very bad not", "tea cup", "good bad kettle of the"]
    rows = [(0, 1, "tea"), (0, 2, "cup"), (0, 3, "good"), (1, 1, "bad"), (1, 2, "not"), (1, 3, "zzz")]
    given_terms = spark.createDataFrame(rows, "topic int, rnk int, term string")
    got = {r["topic"]: r["coherence"] for r in coherence.coherence(frame(spark, texts), given_terms, window=4).collect()}
    held = [w for t in texts for w in _windows(t.split(), 4)]

    def p(*ws):
        return sum(all(w in h for w in ws) for h in held) / len(held)

    def npmi(a, b):
        if not p(a) or not p(b):
            return 0.0
        both = p(a, b) + 1e-12
        return math.log(both / (p(a) * p(b))) / -math.log(both)

    for topic in (0, 1):
        words = [t for k, _, t in rows if k == topic]
        m = np.array([[npmi(a, b) for b in words] for a in words])
        s = m.sum(axis=0)
        cos = [(v @ s) / (np.linalg.norm(v) * np.linalg.norm(s)) if v.any() else 0.0 for v in m]
        assert got[topic] == pytest.approx(np.mean(cos), abs=1e-9)


def test_classifier_by_hand(spark):
    training = spark.createDataFrame(
        [("1", "tea", "green tea cup"), ("2", "tea", "black tea"), ("3", "pot", "steel kettle pot"), ("4", "pot", "kettle pot cup")],
        "Id string, label string, text string",
    )
    model = categories.fit_categories(training)
    priors, table = model.log_priors, model.parameters().toPandas()
    assert priors == pytest.approx([math.log(0.5)] * 2)
    sums = np.exp(table.log_likelihood).groupby(table.label).sum()
    assert sums.tolist() == pytest.approx([1.0, 1.0])
    df = spark.createDataFrame([(1, "tea tea"), (2, "kettle"), (3, "nothing known"), (4, "")], "Id long, Text string")
    got = {r["Id"]: r for r in categories.classify(df, model, F.col("Text")).collect()}
    assert [got[i]["predicted_category"] for i in (1, 2, 3, 4)] == ["tea", "pot", "pot", "pot"]
    assert got[3]["category_confidence"] == got[4]["category_confidence"] == pytest.approx(0.5)
    logits = {
        label: priors[i] + table[(table.label == label) & (table.term == "kettle")].log_likelihood.iloc[0]
        for i, label in enumerate(model.labels)
    }
    top = math.exp(logits["pot"]) / sum(math.exp(v) for v in logits.values())
    assert got[2]["category_confidence"] == pytest.approx(top)


def test_training_texts_follow_the_template(spark):
    keywords = spark.createDataFrame(
        [(c, w) for c in ("Pet Supplies", "Tea") for w in ("a1", "b2", "c3", "d4", "e5", "e5")],
        "category string, keyword string",
    )
    texts = categories.synthetic_training(keywords, categories.negative_keywords(spark), 6, 2).toPandas()
    assert texts.Id.is_unique
    assert Counter(texts.label) == {"Pet Supplies": 6, "Tea": 6, "Other": 12}
    tea = texts[texts.label == "Tea"].text
    assert tea.str.fullmatch(r"This is a tea review about \w\d( and \w\d){2,4}\. The \w\d quality is good\. ").all()
    assert texts[texts.label == "Pet Supplies"].text.str.contains("My pet loves this").all()
    assert texts[texts.label == "Other"].text.str.fullmatch(r"This [\w ]+ is not related to pets\. ").all()


def _tree_value(nodes, x, known, node=0):
    n = nodes[node]
    if n["left"] < 0:
        return n["prediction"]
    if n["feature"] in known:
        return _tree_value(nodes, x, known, n["left"] if x[n["feature"]] <= n["threshold"] else n["right"])
    share = nodes[n["left"]]["count"] / n["count"]
    return share * _tree_value(nodes, x, known, n["left"]) + (1 - share) * _tree_value(nodes, x, known, n["right"])


def _by_all_subsets(nodes, row, n):
    """The Shapley values of a row from the tree's value under every subset of known features."""
    value = {s: _tree_value(nodes, row, set(s)) for size in range(n + 1) for s in itertools.combinations(range(n), size)}
    out = []
    for j in range(n):
        total = 0.0
        for s in value:
            if j not in s:
                weight = math.factorial(len(s)) * math.factorial(n - len(s) - 1) / math.factorial(n)
                total += weight * (value[tuple(sorted((*s, j)))] - value[s])
        out.append(total)
    return out


def test_attribution_by_all_subsets():
    rng = np.random.default_rng(3)

    def leaf(i, count):
        return {"id": i, "left": -1, "right": -1, "count": count, "prediction": float(rng.normal())}

    def split(i, left, right, feature, threshold, count):
        return {"id": i, "left": left, "right": right, "feature": feature, "threshold": threshold, "count": count}

    nodes = {n["id"]: n for n in [
        split(0, 1, 2, 0, 0.0, 100), split(1, 3, 4, 1, 0.5, 40), split(2, 5, 6, 0, 1.0, 60),
        leaf(3, 10), leaf(4, 30), split(5, 7, 8, 2, -0.5, 45), leaf(6, 15), leaf(7, 5), leaf(8, 40),
    ]}
    tree = attribution.tree_of(nodes, 1.0)
    x = rng.normal(size=(40, 4))
    phi = attribution.attribute([tree], x)
    assert tree.mean() == pytest.approx(_tree_value(nodes, x[0], set()))
    for row, got in zip(x, phi):
        assert got == pytest.approx(_by_all_subsets(nodes, row, 4), abs=1e-12)


def _random_tree(rng, depth, n_features):
    """Node rows of a full tree: random features, which repeat on its paths, and uneven shares."""
    nodes, todo = {}, [(0, depth, 2.0**20)]
    while todo:
        i, left_levels, count = todo.pop()
        if not left_levels:
            nodes[i] = {"left": -1, "right": -1, "count": count, "prediction": float(rng.normal())}
            continue
        share = rng.uniform(0.001, 0.999)
        nodes[i] = {"left": 2 * i + 1, "right": 2 * i + 2, "feature": int(rng.integers(n_features)), "threshold": float(rng.normal()), "count": count}
        todo += [(2 * i + 1, left_levels - 1, count * share), (2 * i + 2, left_levels - 1, count * (1 - share))]
    return nodes


@pytest.mark.parametrize("depth,n_features", [(0, 3), (1, 1), (4, 2), (6, 7), (10, 6)])
def test_attribution_of_deep_trees_by_all_subsets(monkeypatch, depth, n_features):
    monkeypatch.setattr(attribution, "ROWS", 3)
    rng = np.random.default_rng(depth)
    forest = [_random_tree(rng, depth, n_features) for _ in range(2)]
    trees = [attribution.tree_of(nodes, weight) for nodes, weight in zip(forest, (1.0, 0.1))]
    x = rng.normal(size=(7, n_features))
    phi = attribution.attribute(trees, x)
    for row, got in zip(x, phi):
        expected = sum(w * np.array(_by_all_subsets(nodes, row, n_features)) for nodes, w in zip(forest, (1.0, 0.1)))
        assert got == pytest.approx(expected, abs=1e-10)
        whole = sum(w * _tree_value(nodes, row, set(range(n_features))) for nodes, w in zip(forest, (1.0, 0.1)))
        assert sum(got) + sum(t.mean() for t in trees) == pytest.approx(whole)


def test_attribution_of_a_hundred_deep_trees():
    """Depth 10: the work is linear in the nodes, where tables would hold 10 * 2^10 numbers a leaf."""
    rng = np.random.default_rng(8)
    trees = [attribution.tree_of(_random_tree(rng, 10, 9), 0.1) for _ in range(100)]
    x = rng.normal(size=(64, 9))
    phi, start = attribution.attribute(trees, x), time.time()
    assert attribution.attribute(trees[:10], x).shape == phi.shape and time.time() - start < 20


def test_attributions_add_up_to_the_prediction(spark):
    rng = np.random.default_rng(5)
    n = 300
    pdf = pd.DataFrame({name: rng.normal(size=n) for name in helpfulness.FEATURES})
    pdf["helpfulness_ratio"] = np.clip(0.5 + 0.3 * pdf.rating - 0.2 * (pdf.hour > 0), 0, 1)
    pdf["Id"] = range(n)
    scaled = settle(spark.createDataFrame(pdf), "scaled")
    vectors = helpfulness.assemble(scaled)
    model = helpfulness.fit_helpfulness(vectors, helpfulness.FEATURES, n_trees=6, depth=3)
    predicted = helpfulness.predict_helpfulness(model, vectors).select("Id", "prediction")
    values = attribution.shap_values(model, scaled)
    for r in values.join(predicted, "Id").collect():
        assert sum(r["phi"]) + r["base"] == pytest.approx(r["prediction"], abs=1e-9)
    ranked = attribution.mean_attribution(values, helpfulness.FEATURES).collect()
    assert {r["feature"] for r in ranked[:2]} == {"rating", "hour"}


def test_sentiment_model_learns(spark):
    words = {1: "awful broken waste", 3: "average plain usual", 5: "lovely perfect great"}
    rows = [(i, f"{words[s]} item {i % 7}", s) for i in range(300) for s in [(1, 3, 5)[i % 3]]]
    df = spark.createDataFrame(rows, "Id long, Text string, Score int")
    scored = score_sentiment(fit_sentiment(df, sample=200, n_features=1 << 10), df, ["Score"])
    assert evaluate_sentiment(scored)["accuracy"] > 0.9
    means = {r["Score"]: r["m"] for r in scored.groupBy("Score").agg(F.avg("sentiment_score").alias("m")).collect()}
    assert means[1] < means[3] < means[5] and -1 <= means[1] and means[5] <= 1


class LongText:
    """A scorer of one's own, that counts how often it is opened."""

    def __init__(self, opened):
        self.opened = opened

    def open(self):
        self.opened.add(1)

        def score(batch):
            n = np.array([len(t or "") for t in batch.column("text").to_pylist()])
            return np.stack([n < 5, (n >= 5) & (n < 9), n >= 9], axis=1)

        return score


def test_a_scorer_of_ones_own(spark):
    rows = [(i, "x" * (i % 12), 1 + i % 5) for i in range(50)] + [(60, None, None)]
    df = spark.createDataFrame(rows, "Id long, Text string, Score int").repartition(3)
    opened = spark.sparkContext.accumulator(0)
    scored = score_with(LongText(opened), df, {"text": F.col("Text")}, ["Score"], probabilities=True)
    got = {r["Id"]: r for r in scored.collect()}
    assert opened.value == 3  # once in each task
    for i, t, score in rows:
        kind = 0 if len(t or "") < 5 else 1 if len(t) < 9 else 2
        assert (got[i]["prediction"], got[i]["sentiment_score"], got[i]["Score"]) == (kind, kind - 1, score)
        assert got[i]["probabilities"] == [float(k == kind) for k in range(3)]
        assert got[i]["sentiment_label"] == (None if score is None else 0 if score <= 2 else 1 if score == 3 else 2)


class TwoClasses:
    def open(self):
        return lambda batch: np.ones((batch.num_rows, 2))


def test_a_scorer_must_give_three_classes(spark):
    df = spark.createDataFrame([(1, "a", 2)], "Id long, Text string, Score int")
    with pytest.raises(Exception, match="three probabilities"):
        score_with(TwoClasses(), df, {"text": F.col("Text")}).collect()


def test_numpy_scorer_equals_the_fitted_model(spark):
    words = {1: "awful broken waste", 3: "average plain usual", 5: "lovely perfect great"}
    rows = [(i, f"{words[s]} item {i % 7} thing{i % 11}", s) for i in range(200) for s in [(1, 3, 5)[i % 3]]] + [(900, "", 1), (901, None, 5), (902, "unseen", 3)]
    df = spark.createDataFrame(rows, "Id long, Text string, Score int")
    model = fit_sentiment(df, sample=150)
    expected = {r["Id"]: r for r in score_sentiment(model, df, probabilities=True).collect()}
    for r in score_with(model.scorer(), df, {"terms": text_tokens()}, probabilities=True).collect():
        assert r["probabilities"] == pytest.approx(list(expected[r["Id"]]["probabilities"]), abs=1e-12)
        assert r["prediction"] == expected[r["Id"]]["prediction"] and r["split"] == expected[r["Id"]]["split"]
