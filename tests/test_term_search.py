"""Terms found by automaton against plain substring search, and their correlations against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewlens.operators import impact, lexicon, term_search
from reviewlens.session import settle

# overlapping, nested, repeated and absent terms; a term as long as a text; characters beyond ASCII
TERMS = {"a": ["he", "she", "hers", "his", "s", "ushers ushers", "zzz", "é", ""], "b": ["aa", "aaa", "ab a", "b"], "c": ["never met"]}
TEXTS = ["ushers", "she sells his", "", "aaaa", "ab ab a", "ushers ushers", "héros é", None, "b", "he"]


def table(spark, n=200):
    rng = np.random.default_rng(2)
    scores = [None if i % 17 == 0 else float(x) for i, x in enumerate(rng.normal(0, 0.4, n))]
    rows = [(i, "ab"[i % 2] if i % 13 else None, TEXTS[(i * 7 + i // 10) % len(TEXTS)], scores[i]) for i in range(n)]
    return rows, spark.createDataFrame(rows, "Id long, category string, clean_text string, sentiment_score double")


def listed(spark):
    return spark.createDataFrame([(c, t) for c, ts in TERMS.items() for t in ts + ts[:1]], "category string, term string")


@pytest.mark.parametrize("block", [1 << 20, 8])
def test_found_terms_are_substrings(spark, monkeypatch, block):
    monkeypatch.setattr(term_search, "BLOCK_BYTES", block)
    rows, df = table(spark)
    got = {r.Id: r.found for r in term_search.find_terms(df, listed(spark), "category", ["Id"]).collect()}
    assert got == {i: sorted(t for t in TERMS.get(c, ()) if t and t in (text or "")) for i, c, text, _ in rows}


@pytest.mark.parametrize("block", [1 << 20, 8])
def test_correlations_by_numpy(spark, monkeypatch, block):
    monkeypatch.setattr(term_search, "BLOCK_BYTES", block)
    rows, df = table(spark)
    expected = {}
    for c in "ab":
        own = [(text, s) for _, k, text, s in rows if k == c and text is not None and s is not None]
        s = np.array([x for _, x in own])
        for term in TERMS[c]:
            p = np.array([term in text for text, _ in own], float)
            expected[c, term] = None if p.std() == 0 else pytest.approx(np.corrcoef(p, s)[0, 1])
    scanned = impact.term_sentiment(df.repartition(5), listed(spark), "category")
    marked = term_search.find_terms(df, listed(spark), "category", ["Id", "category", "sentiment_score", "clean_text"])
    marked = marked.withColumn("found", F.when(F.col("clean_text").isNotNull(), F.col("found")))
    for found in (scanned, impact.term_sentiment(marked, listed(spark), "category", "found")):
        assert {(r.category, r.term): r.correlation for r in found.collect()} == expected


def test_constant_sentiment_has_no_correlation(spark):
    df = spark.createDataFrame([(i, "a", TEXTS[i % 3], 0.1) for i in range(50)], "Id long, category string, clean_text string, sentiment_score double")
    assert {r.correlation for r in impact.term_sentiment(df, listed(spark), "category").collect()} == {None}


def test_no_row_for_each_review_and_term(spark):
    _, df = table(spark)
    plan = impact.term_sentiment(settle(df, "reviews"), listed(spark), "category")._jdf.queryExecution().toString()
    assert "Generate" not in plan and "contains" not in plan.lower()


def test_lexicon_reads_reviews_once(spark):
    df = settle(spark.createDataFrame([(1, "good"), (2, ""), (3, "not good bad"), (4, "of"), (5, None)], "Id long, clean_text string"), "reviews")
    words = spark.createDataFrame([("good", 0.5, 0.5), ("bad", -1.0, 1.0), ("of", 0.0, 0.0)], "word string, polarity double, subjectivity double")
    modifiers = spark.createDataFrame([("not", "negator", -0.5)], "word string, kind string, factor double")
    scored = lexicon.lexicon_sentiment(df, words, modifiers)
    assert scored._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") <= 1
    got = {r.Id: (r.sentiment_score, r.subjectivity_score) for r in scored.collect()}
    assert got == {1: (0.5, 0.5), 2: (0.0, 0.0), 3: (pytest.approx((-0.25 + 0.5) / 2), 0.75), 4: (0.0, 0.0), 5: (0.0, 0.0)}
