"""The six stages, each reading tables the earlier ones wrote.

Every stage takes ``root`` (a folder all executors reach) and ``run_ts`` (a sortable run name)
and returns what it wrote by name.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlens.functions import text
from reviewlens.operators import (
    attribution,
    categories,
    charts,
    helpfulness,
    impact,
    lexicon,
    metrics,
    prepare,
    sentiment_model,
    terms,
    topics,
)
from reviewlens.schema import require_key
from reviewlens.session import release, settle, settled_count
from reviewlens.sources import models as model_files
from reviewlens.sources import reviews, snapshots, tables

PROCESSED = "processed_reviews"
CATEGORY = "predicted_category"


@dataclass
class Parameters:
    """Small user tables: keywords and negatives as ``category, keyword``; lexicon as ``word,
    polarity, subjectivity``; modifiers as ``word, kind, factor``; stop words as ``word``."""

    keywords: DataFrame
    negatives: DataFrame
    lexicon: DataFrame
    modifiers: DataFrame
    stop_words: DataFrame


def english_stop_words(spark: SparkSession) -> DataFrame:
    """Spark ML's English list, as the terms its entries are cut into."""
    words = StopWordsRemover.loadDefaultStopWords("english")
    listed = spark.createDataFrame([(w,) for w in words], "word string")
    return listed.select(F.explode(text.terms(F.col("word"))).alias("word")).distinct()


def _write(found: dict[str, DataFrame], root: str, run_ts: str, **by: str) -> dict[str, DataFrame]:
    """Write tables and return them as read back."""
    tables.write_results(found, root, run_ts, by)
    spark = next(iter(found.values())).sparkSession
    return {name: tables.load_result(spark, root, name, by.get(name), run_ts) for name in found}


def load_processed(spark: SparkSession, root: str, run_ts: str | None = None) -> DataFrame:
    """The processed reviews of the run at hand, else of the newest published one."""
    run = tables.run_of(spark, root, PROCESSED, run_ts)
    if run is None:
        raise FileNotFoundError(f"no processed reviews under {root}/{PROCESSED}")
    return snapshots.read_run(spark, f"{root}/{PROCESSED}", run, CATEGORY)


def process_reviews(
    raw: DataFrame,
    params: Parameters,
    root: str,
    run_ts: str,
    threshold: float | None = None,
    negatives_per_sample: int = 50,
) -> dict[str, DataFrame]:
    """Clean, score, classify and write the reviews, then their TF-IDF tables.

    The raw reviews are written once, typed, and read from there; each must have an ``Id`` of
    its own. Sentiment and category come out as one narrow row per review, both partitioned by
    ``Id``; the reviews themselves are shuffled once, to join them.
    """
    spark, mark = raw.sparkSession, settled_count()
    raw = settle(raw, "raw-reviews")
    require_key(raw, "Id")
    prepared = prepare.prepare_reviews(prepare.epoch_time(raw))
    training = categories.synthetic_training(
        params.keywords, params.negatives, negatives_per_sample=negatives_per_sample
    )
    model = categories.fit_categories(training, stop_words=params.stop_words)
    classified = categories.classify(prepared, model, prepare.combined_text())
    if threshold is not None:
        classified = categories.apply_threshold(classified, threshold)
    sentiment = lexicon.lexicon_sentiment(prepared, params.lexicon, params.modifiers)
    whole = prepared.join(classified.join(sentiment, "Id"), "Id")
    snapshots.write_snapshot(whole, f"{root}/{PROCESSED}", run_ts, CATEGORY)

    done = load_processed(spark, root, run_ts).withColumnRenamed(CATEGORY, "category")
    tokens = text.terms(F.col("clean_text"))
    vocab = terms.fit_vocabulary(done, tokens, 1000, ["category"], params.stop_words)
    bag = terms.bag_of_words(done, tokens, ["category"], params.stop_words)
    tables.write_features(terms.tfidf(bag, vocab, ["category"]), vocab, root, run_ts)
    found = {
        "category_distribution": categories.category_distribution(done, "category"),
        "quality_report": prepare.quality_report(done),
    }
    found = _write(found, root, run_ts)
    release(spark, mark)
    return found


def model_topics(
    spark: SparkSession,
    root: str,
    run_ts: str,
    counts: Sequence[int] = topics.TOPIC_COUNTS,
    passes: int = topics.PASSES,
    sample: int | None = None,
) -> dict[str, DataFrame]:
    """Fit every topic count per category, keep the most coherent model of each.

    Coherence reads all reviews unless ``sample`` bounds them per category.
    """
    mark = settled_count()
    reviews_by = load_processed(spark, root, run_ts).withColumnRenamed(CATEGORY, "category")
    _, vocab = tables.load_features(spark, root, run_ts=run_ts)
    vectors = topics.topic_vectors(reviews_by, vocab, "category", ["sentiment_score"])
    models = topics.fit_all_topics(vectors, vocab, counts, "category", passes)
    scores = settle(topics.coherence_sweep(reviews_by, models, "category", sample=sample), "scores")
    best = {r["category"]: r["k"] for r in topics.best_k(scores).collect()}
    chosen = [m for m in models if best.get(m.category) == m.k and m.weights is not None]
    if not chosen:
        raise ValueError("no category has a vocabulary to model")
    shares = topics.document_topics(chosen, vectors, ["sentiment_score"])
    fit = [(m.category, m.k, done, value) for m in chosen for done, value in m.trace]
    ranked = topics.top_terms(topics.topic_terms(spark, chosen), ["category", "k"])
    merged = topics.merged_terms(ranked, ["category", "k"]).select("category", "rnk", "term")
    found = _write(
        {
            "topic_distributions": shares,
            "top_terms": merged,
            "coherence_scores": scores,
            "topic_perplexity": spark.createDataFrame(
                fit, "category string, k int, passes int, log_perplexity double"
            ),
            "topic_models": topics.model_table(spark, chosen),
        },
        root,
        run_ts,
        topic_distributions="category",
        top_terms="category",
        topic_models="category",
    )
    weighed = topics.long_topics(found["topic_distributions"], ["sentiment_score"])
    found |= _write({"topic_sentiment": topics.topic_sentiment(weighed)}, root, run_ts)
    release(spark, mark)
    return found


def analyse_sentiment(
    spark: SparkSession, root: str, run_ts: str, sample: int | None = sentiment_model.SAMPLE
) -> dict[str, DataFrame]:
    """Learn sentiment from ratings, score all reviews, and write its trends."""
    mark = settled_count()
    df = load_processed(spark, root, run_ts).select("Id", "Text", "Score", "Time", "ProductId")
    model = sentiment_model.fit_sentiment(df, sample)
    scored = settle(
        sentiment_model.score_sentiment(model, df, ["Score", "Time", "ProductId"]), "sentiment"
    )
    model_files.register_models(spark, "sentiment_models", [("", 3, model.whole())], root, run_ts)
    quality = sentiment_model.evaluate_sentiment(scored)
    found = {
        "temporal_trends": metrics.month_trend(scored),
        "product_sentiment": metrics.product_sentiment(scored),
        "sentiment_metrics": spark.createDataFrame(
            sorted(quality.items()), "metric string, value double"
        ),
    }
    found = _write(found, root, run_ts)
    release(spark, mark)
    return found


def predict_helpfulness(
    spark: SparkSession, root: str, run_ts: str, n_trees: int = 100
) -> dict[str, DataFrame]:
    """Fit the helpfulness model; write its metrics, attributions and product table."""
    mark = settled_count()
    df = load_processed(spark, root, run_ts)
    features = helpfulness.feature_table(df)
    names = helpfulness.feature_names(features)
    scaled = settle(helpfulness.scale_features(features), "scaled")
    vectors = helpfulness.assemble(scaled)
    model = helpfulness.fit_helpfulness(vectors, names, n_trees)
    model_files.register_models(
        spark, "helpfulness_models", [("", n_trees, model.trees)], root, run_ts
    )
    predicted = helpfulness.predict_helpfulness(model, vectors).where("split = 'test'")
    values = attribution.shap_values(model, scaled)
    found = {
        "model_metrics": metrics.regression_metrics(predicted, "helpfulness_ratio"),
        "feature_importance": attribution.mean_attribution(values, names),
        "product_helpfulness": metrics.product_helpfulness(df),
    }
    found = _write(found, root, run_ts)
    release(spark, mark)
    return found


def analyse_impact(spark: SparkSession, root: str, run_ts: str) -> dict[str, DataFrame]:
    """Effect sizes, category tables, advice, and term correlations where topics exist."""
    df = load_processed(spark, root, run_ts)
    found = impact.impact_tables(df)
    listed = tables.load_result(spark, root, "top_terms", by="category", run_ts=run_ts)
    if listed is not None:
        found["term_sentiment"] = impact.term_sentiment(df, listed).orderBy(
            "category", "correlation", "term"
        )
    return _write(found, root, run_ts)


def chart_tables(
    spark: SparkSession, root: str, run_ts: str, stop_words: DataFrame | None = None
) -> dict[str, DataFrame]:
    """The table under every chart whose inputs exist."""
    df = load_processed(spark, root, run_ts)
    earlier = tables.load_results(
        spark,
        root,
        [
            "topic_distributions", "coherence_scores", "feature_importance", "product_sentiment",
            "temporal_trends", "product_helpfulness",
        ],
        {"topic_distributions": "category"},
        run_ts,
    )
    found = {
        "chart_ratings": charts.rating_histogram(df),
        "chart_words": terms.word_frequencies(df, stop_words=stop_words),
    }
    if "sentiment_score" in df.columns:
        found["chart_sentiment_months"] = charts.sentiment_pivot(df)
        found["chart_timeline"] = charts.daily_timeline(df)
    if "helpfulness_ratio" in df.columns:
        found["chart_length_helpfulness"] = charts.length_helpfulness_bins(df)
    if "coherence_scores" in earlier:
        found["chart_coherence"] = charts.coherence_chart(earlier["coherence_scores"])
    if "topic_distributions" in earlier:
        weighed = topics.long_topics(earlier["topic_distributions"], ["sentiment_score"])
        found["chart_topics"] = topics.topic_prevalence(weighed, ["category"])
    if "feature_importance" in earlier:
        found["chart_features"] = charts.top_rows(
            earlier["feature_importance"], "importance", "feature"
        )
    if "product_sentiment" in earlier:
        found["chart_sentiment_box"] = charts.sentiment_boxplot(earlier["product_sentiment"])
    if "temporal_trends" in earlier:
        found["chart_trends"] = earlier["temporal_trends"].orderBy("month")
    if "product_helpfulness" in earlier:
        found["chart_products"] = earlier["product_helpfulness"]
    mark = settled_count()
    found = _write(found, root, run_ts)
    release(spark, mark)
    return found


def run_all(
    spark: SparkSession, path: str, params: Parameters, root: str, run_ts: str, fmt: str = "csv"
) -> dict[str, DataFrame]:
    """All stages over the reviews at ``path``, published as one run when the last has ended."""
    found = process_reviews(reviews.read_reviews(spark, path, fmt), params, root, run_ts)
    found |= model_topics(spark, root, run_ts)
    found |= analyse_sentiment(spark, root, run_ts)
    found |= predict_helpfulness(spark, root, run_ts)
    found |= analyse_impact(spark, root, run_ts)
    found |= chart_tables(spark, root, run_ts, params.stop_words)
    tables.publish_run(spark, root, run_ts)
    return found
