"""The Spark side of every registered query: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from querybook import fixtures as fx
from reviewlens.functions import dates, text
from reviewlens.operators import (
    attribution,
    binned_trees,
    categories,
    charts,
    coherence,
    helpfulness,
    impact,
    lexicon,
    metrics,
    prepare,
    ranking,
    sentiment_model,
    term_search,
    terms,
    topics,
)
from reviewlens.schema import FEATURES, RAW_REVIEWS
from reviewlens.session import scratch_path, settle
from reviewlens.sources import reviews as review_files
from reviewlens.sources import counts, snapshots, tables
from reviewlens.streaming import reviews as stream

CAT = "category"


def r6(df: DataFrame, *names: str) -> DataFrame:
    """Doubles at six digits, as the SQL twins give them."""
    doubles = names or [n for n, t in df.dtypes if t == "double"]
    return df.withColumns({n: F.round(n, 6) for n in doubles})


def pick(df: DataFrame, *columns: str | Column) -> DataFrame:
    return r6(df.select(*columns))


# -- stage 1 -----------------------------------------------------------------


def helpfulness_ratio(spark: SparkSession, sf: str) -> DataFrame:
    df = fx.reviews(spark, sf).withColumn("helpfulness_ratio", prepare.helpfulness_ratio())
    return pick(df, "Id", "helpfulness_ratio")


def clean_text(spark: SparkSession, sf: str) -> DataFrame:
    df = prepare.clean_columns(prepare.fill_text(fx.reviews(spark, sf)))
    return df.select("Id", "clean_text", "clean_summary")


def text_features(spark: SparkSession, sf: str) -> DataFrame:
    df = prepare.text_features(prepare.fill_text(fx.reviews(spark, sf)))
    return df.select("Id", "text_length", "summary_length", "word_count")


def epoch_time(spark: SparkSession, sf: str) -> DataFrame:
    seconds = F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', Time)")
    raw = fx.reviews(spark, sf).select("Id", seconds.alias("Time"))
    return prepare.epoch_time(raw).select(
        "Id",
        F.col("Time").alias("time"),
        dates.month_start(F.col("Time")).alias("month"),
        F.hour("Time").alias("hour"),
        dates.day_of_week(F.col("Time")).alias("day_of_week"),
    )


def score_bucket(spark: SparkSession, sf: str) -> DataFrame:
    df = fx.reviews(spark, sf).withColumn("sentiment_label", prepare.score_label())
    return df.groupBy("Score", "sentiment_label").agg(F.count("*").alias("n_reviews"))


def category_slug(spark: SparkSession, sf: str) -> DataFrame:
    named = F.concat_ws(" & ", CAT, "ProductId")
    slugs = fx.reviews(spark, sf).select(named.alias("category")).distinct()
    return slugs.select("category", prepare.category_slug(F.col("category")).alias("slug"))


def combined_text(spark: SparkSession, sf: str) -> DataFrame:
    df = prepare.fill_text(fx.reviews(spark, sf))
    return df.select("Id", prepare.combined_text().alias("combined_text"))


def quality_report(spark: SparkSession, sf: str) -> DataFrame:
    return prepare.quality_report(fx.reviews(spark, sf))


# -- grouped metrics ---------------------------------------------------------


def category_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return categories.category_distribution(fx.reviews(spark, sf), CAT)


def category_performance(spark: SparkSession, sf: str) -> DataFrame:
    return impact.category_performance(fx.scored(spark, sf, CAT, "helpfulness_ratio", "Score"), CAT)


def category_metrics(spark: SparkSession, sf: str) -> DataFrame:
    df = fx.scored(spark, sf, CAT, "helpfulness_ratio", "Score")
    return r6(impact.category_metrics(df, CAT))


def category_month(spark: SparkSession, sf: str) -> DataFrame:
    df = fx.scored(spark, sf, CAT, "helpfulness_ratio", "Score", "Time")
    return impact.category_month(df, CAT)


def month_trend(spark: SparkSession, sf: str) -> DataFrame:
    return r6(metrics.month_trend(fx.scored(spark, sf, "Score", "Time")))


def product_sentiment(spark: SparkSession, sf: str) -> DataFrame:
    return r6(metrics.product_sentiment(fx.scored(spark, sf, "Score", "ProductId")))


def product_helpfulness(spark: SparkSession, sf: str) -> DataFrame:
    return r6(metrics.product_helpfulness(fx.prepared(spark, sf), more_than=40))


def daily_timeline(spark: SparkSession, sf: str) -> DataFrame:
    return r6(charts.daily_timeline(fx.scored(spark, sf, "Score", "Time")))


def length_effect(spark: SparkSession, sf: str) -> DataFrame:
    return r6(impact.length_effect(fx.prepared(spark, sf)))


def sentiment_effect(spark: SparkSession, sf: str) -> DataFrame:
    return r6(impact.sentiment_effect(fx.scored(spark, sf, CAT, "Score"), category=CAT))


def recommendations(spark: SparkSession, sf: str) -> DataFrame:
    df = fx.scored(spark, sf, CAT, "helpfulness_ratio", "Score")
    advice = impact.recommendations(
        impact.category_metrics(df, CAT), impact.length_effect(fx.prepared(spark, sf))
    )
    return advice.withColumn("improvement_areas", F.array_join("improvement_areas", ","))


def _frequent_terms(spark: SparkSession, sf: str, n: int) -> DataFrame:
    stats = terms.term_stats(fx.review_terms(spark, sf, CAT), [CAT])
    return terms.vocabulary(stats, n, [CAT])


def term_sentiment_corr(spark: SparkSession, sf: str) -> DataFrame:
    words = settle(_frequent_terms(spark, sf, 20).select(CAT, "term"), "terms")
    marked = term_search.find_terms(fx.prepared(spark, sf), words, CAT, ["Id", CAT, "clean_text"])
    lexica = fx.parameter(spark, "lexicon"), fx.parameter(spark, "modifiers")
    scored = lexicon.lexicon_sentiment(marked, *lexica, keep=[CAT, "found"])
    return r6(impact.term_sentiment(scored, words, CAT, "found")).orderBy(CAT, "correlation", "term")


# -- charts ------------------------------------------------------------------


def rating_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return charts.rating_histogram(fx.reviews(spark, sf))


def sentiment_pivot(spark: SparkSession, sf: str) -> DataFrame:
    """The pivot of all years that occur, as one row for each month and year."""
    pivot = charts.sentiment_pivot(settle(fx.scored(spark, sf, "Time"), "scored"))
    rows = pivot.unpivot("month", [c for c in pivot.columns if c != "month"], "year", "sentiment_mean")
    return r6(rows.where("sentiment_mean IS NOT NULL").withColumn("year", F.substring("year", 2, 9).cast("int")))


def length_helpfulness_bins(spark: SparkSession, sf: str) -> DataFrame:
    return charts.length_helpfulness_bins(fx.prepared(spark, sf))


def word_frequencies(spark: SparkSession, sf: str) -> DataFrame:
    df = prepare.fill_text(fx.reviews(spark, sf))
    return terms.word_frequencies(df, stop_words=fx.parameter(spark, "stop_words"))


def sentiment_boxplot(spark: SparkSession, sf: str) -> DataFrame:
    products = metrics.product_sentiment(fx.scored(spark, sf, "Score", "ProductId"))
    return r6(charts.sentiment_boxplot(products))


# -- terms -------------------------------------------------------------------


def term_stats(spark: SparkSession, sf: str) -> DataFrame:
    return _frequent_terms(spark, sf, 1000)


def merged_counts(spark: SparkSession, sf: str) -> DataFrame:
    """The weights of every category's vocabulary, from counts of two runs over disjoint reviews."""
    df, tokens, root = fx.prepared(spark, sf), text.terms(F.col("clean_text")), scratch_path(spark, "counts")
    for part in (0, 1):
        own = df.where(F.col("Id") % 2 == part)
        counts.add_counts(own, tokens, root, f"2026010{part + 1}_000000", [CAT], fx.parameter(spark, "stop_words"))
    vocab = terms.counted_vocabulary(counts.all_counts(spark, root, [CAT]), 1000, [CAT])
    return r6(vocab.select(CAT, "term", "term_idx", "df", "cf", "n_docs", "idf"))


def tfidf(spark: SparkSession, sf: str) -> DataFrame:
    df, tokens = fx.prepared(spark, sf), text.terms(F.col("clean_text"))
    stop = fx.parameter(spark, "stop_words")
    vocab = terms.fit_vocabulary(df, tokens, 1000, [CAT], stop)
    return r6(terms.tfidf(terms.bag_of_words(df, tokens, [CAT], stop), vocab, [CAT]))


def stopword_filter(spark: SparkSession, sf: str) -> DataFrame:
    return fx.review_terms(spark, sf).select("Id", "term", "tf")


def bag_of_words(spark: SparkSession, sf: str) -> DataFrame:
    words = text.words(F.col("clean_text"))
    return terms.bag_of_words(fx.prepared(spark, sf), words, [CAT])


def tf_vectors(spark: SparkSession, sf: str) -> DataFrame:
    df, tokens = fx.prepared(spark, sf), text.terms(F.col("clean_text"))
    vocab = terms.vocabulary(terms.term_stats(terms.bag_of_words(df, tokens)), 1000)
    names = [r["term"] for r in vocab.orderBy("term_idx").collect()]
    found = vector_to_array("counts")
    vectors = terms.count_vectors(df.select("Id", "clean_text"), tokens, names)
    return vectors.select(
        "Id",
        F.size(F.filter(found, lambda x: x > 0)).cast("bigint").alias("n_terms"),
        F.aggregate(found, F.lit(0.0), lambda a, x: a + x).cast("bigint").alias("n_tokens"),
    )


# -- categories --------------------------------------------------------------


def _keywords(spark: SparkSession, sf: str) -> DataFrame:
    """Category keywords out of the texts: the 40 most frequent terms of each language."""
    stats = terms.term_stats(fx.review_terms(spark, sf, "lang"), ["lang"])
    return settle(
        terms.vocabulary(stats, 40, ["lang"]).select(
            F.col("lang").alias("category"), F.col("term").alias("keyword")
        ),
        "keywords",
    )


def _negatives(spark: SparkSession, sf: str) -> DataFrame:
    """Negative keywords of one language: the words of the summaries."""
    words = fx.reviews(spark, sf).select(F.explode(text.words(F.lower("Summary"))).alias("keyword"))
    return words.distinct().select(F.lit("en").alias("category"), "keyword")


def _training(spark: SparkSession, sf: str) -> DataFrame:
    return categories.synthetic_training(
        _keywords(spark, sf), _negatives(spark, sf), 200, 50, extra_sentence="es"
    )


def _category_model(spark: SparkSession, sf: str) -> categories.CategoryModel:
    return categories.fit_categories(
        _training(spark, sf), 5000, fx.parameter(spark, "stop_words")
    )


def _classified(spark: SparkSession, sf: str, keep: Sequence[str] = ()) -> DataFrame:
    df = prepare.fill_text(fx.reviews(spark, sf))
    return categories.classify(df, _category_model(spark, sf), prepare.combined_text(), keep)


def synthetic_training(spark: SparkSession, sf: str) -> DataFrame:
    return _training(spark, sf)


def nb_model(spark: SparkSession, sf: str) -> DataFrame:
    return r6(_category_model(spark, sf).parameters())


def nb_predict(spark: SparkSession, sf: str) -> DataFrame:
    return r6(_classified(spark, sf, ["lang"]))


def confidence_threshold(spark: SparkSession, sf: str) -> DataFrame:
    scored = settle(_classified(spark, sf), "classified")
    low = categories.low_confidence_count(scored, 0.9)
    kept = categories.apply_threshold(scored, 0.9)
    n_low = F.lit(low.first()["n_low_confidence"])
    return categories.category_distribution(kept).withColumn("n_low_confidence", n_low)


# -- sentiment ---------------------------------------------------------------


def lexicon_sentiment(spark: SparkSession, sf: str) -> DataFrame:
    return r6(fx.scored(spark, sf))


def _rated(spark: SparkSession, sf: str) -> DataFrame:
    """Reviews with ratings that the text tells: one for each language."""
    rating = F.when(F.col("lang") == "de", 1).when(F.col("lang") == "fr", 3).otherwise(5)
    return settle(fx.reviews(spark, sf).select("Id", "Text", rating.alias("Score")), "rated-reviews")


def _sentiment(spark: SparkSession, sf: str) -> DataFrame:
    df = _rated(spark, sf)
    model = sentiment_model.fit_sentiment(df)
    return sentiment_model.score_sentiment(model, df, probabilities=True)


def sentiment_classifier(spark: SparkSession, sf: str) -> DataFrame:
    """Every review's class and part, and whether its score is one: p2 - p0 of a distribution."""
    scored = _sentiment(spark, sf)
    p, score = F.col("probabilities"), F.col("sentiment_score")
    total = F.aggregate(p, F.lit(0.0), lambda a, x: a + x)
    best = p[F.col("prediction").cast("int")] == F.array_max(p)
    sound = (F.abs(total - 1) < 1e-9) & score.between(-1, 1) & (F.abs(score - p[2] + p[0]) < 1e-12) & best
    return scored.select("Id", "sentiment_label", "split", sound.alias("score_is_sound"))


def sentiment_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Held-out quality: the part's size, whether the reported accuracy is its share of hits, and whether
    accuracy and F1 are above what naming the largest class gives, by half of what that leaves."""
    scored = settle(_sentiment(spark, sf), "sentiment-scored")
    told = sentiment_model.evaluate_sentiment(scored)
    test = scored.where("split = 'test' AND sentiment_label IS NOT NULL")
    hits = F.avg((F.col("prediction") == F.col("sentiment_label")).cast("double"))
    largest = test.groupBy("sentiment_label").count().agg(F.max("count") / F.sum("count")).first()[0]
    return test.agg(
        F.count("*").alias("n_test"),
        (F.abs(hits - told["accuracy"]) < 1e-9).alias("accuracy_is_hits"),
        F.lit(min(told["accuracy"], told["f1"]) > (1 + largest) / 2).alias("beats_largest_class"),
    )


def own_scorer(spark: SparkSession, sf: str) -> DataFrame:
    """Per review, whether a numpy scorer sent to the tasks gives what the fitted model gives."""
    df = _rated(spark, sf)
    model = sentiment_model.fit_sentiment(df)
    told = sentiment_model.score_sentiment(model, df).select("Id", "sentiment_label", "prediction", "sentiment_score")
    tokens = {"terms": sentiment_model.text_tokens()}
    own = sentiment_model.score_with(model.scorer(), df, tokens).select(
        "Id", F.col("prediction").alias("own"), F.col("sentiment_score").alias("own_score")
    )
    same = (F.abs(F.col("own_score") - F.col("sentiment_score")) < 1e-9) & (F.col("own") == F.col("prediction"))
    return told.join(own, "Id").select("Id", "sentiment_label", same.alias("is_same"))


# -- helpfulness -------------------------------------------------------------


def _features(spark: SparkSession, sf: str) -> DataFrame:
    df = fx.scored(spark, sf, "text_length", "word_count", "Score", "Time", "helpfulness_ratio")
    return helpfulness.feature_table(df, ratings=fx.reviews(spark, sf))


def feature_table(spark: SparkSession, sf: str) -> DataFrame:
    return r6(_features(spark, sf))


def scaled_features(spark: SparkSession, sf: str) -> DataFrame:
    return r6(helpfulness.scale_features(settle(_features(spark, sf), "features")))


def train_test_split(spark: SparkSession, sf: str) -> DataFrame:
    return fx.reviews(spark, sf).select("Id", ranking.split_name().alias("split"))


def regression_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Each product's mean training ratio as the prediction for its test reviews."""
    df = fx.prepared(spark, sf).select(
        "ProductId", "helpfulness_ratio", ranking.split_name().alias("split")
    )
    known = df.where("split = 'train'").groupBy("ProductId").agg(
        F.avg("helpfulness_ratio").alias("prediction")
    )
    known = settle(known, "product-means")
    test = df.where("split = 'test'").join(known, "ProductId")
    return r6(metrics.regression_metrics(test, "helpfulness_ratio"))


def _planted(features: DataFrame) -> DataFrame:
    """The features with a target that they tell: most by the rating, less by the hour."""
    return features.withColumn("helpfulness_ratio", 0.16 * F.col("rating") + 0.4 * F.col("hour") / 24)


#: The helpfulness model of a session's tables, by application and folder: three queries ask for the same fit.
_MODELS: dict[tuple[str, str], helpfulness.HelpfulnessModel] = {}


def _fitted(spark: SparkSession, sf: str) -> tuple[helpfulness.HelpfulnessModel, DataFrame]:
    scaled = settle(
        helpfulness.scale_features(settle(_planted(_features(spark, sf)), "features")), "scaled"
    )
    key = (spark.sparkContext.applicationId, sf)
    if key not in _MODELS:
        _MODELS[key] = helpfulness.fit_helpfulness(helpfulness.assemble(scaled), FEATURES)
    return _MODELS[key], scaled


def helpfulness_model(spark: SparkSession, sf: str) -> DataFrame:
    """The test part's size, whether the metrics are those of its rows, and whether the model tells
    nine tenths of the variance there."""
    model, scaled = _fitted(spark, sf)
    predicted = helpfulness.predict_helpfulness(model, helpfulness.assemble(scaled))
    test = settle(predicted.where("split = 'test'").select("helpfulness_ratio", "prediction"), "predicted")
    told = metrics.regression_metrics(test, "helpfulness_ratio").first()
    error = F.col("helpfulness_ratio") - F.col("prediction")
    same = (F.abs(F.sum(error * error) / F.count("*") - told["mse"]) < 1e-9) & (
        F.abs(F.lit(told["rmse"] ** 2 - told["mse"])) < 1e-9
    )
    return test.agg(F.count("*").alias("n_test"), same.alias("mse_is_of_rows"), F.lit(told["r2"] > 0.9).alias("fits"))


def binned_model(spark: SparkSession, sf: str) -> DataFrame:
    """Trees from histograms of binned features: the test part's size, whether they tell nine tenths of the
    variance there, as much as Spark ML's trees but for a hundredth, and which feature is split first."""
    trees, scaled = _fitted(spark, sf)
    model = binned_trees.fit_binned(scaled, FEATURES, n_trees=30, depth=4, rate=0.2)
    own = binned_trees.predict_binned(model, scaled, ["Id", "helpfulness_ratio"]).where(ranking.split_name() == "test")
    theirs = helpfulness.predict_helpfulness(trees, helpfulness.assemble(scaled)).where("split = 'test'")
    r2 = [metrics.regression_metrics(df, "helpfulness_ratio").first()["r2"] for df in (own, theirs)]
    return own.agg(
        F.count("*").alias("n_test"), F.lit(r2[0] > 0.9).alias("fits"), F.lit(r2[0] > r2[1] - 0.01).alias("as_good"),
        F.lit(FEATURES[model.trees[0].feature[0]]).alias("first_split"),
    )


def shap_importance(spark: SparkSession, sf: str) -> DataFrame:
    """Per review, whether its attributions and the base add up to the prediction of 100 trees, and
    whether the rating's has the sign that its planted part has."""
    model, scaled = _fitted(spark, sf)
    values = attribution.shap_values(model, scaled)
    predicted = helpfulness.predict_helpfulness(model, helpfulness.assemble(scaled))
    total = F.aggregate("phi", F.col("base"), lambda a, x: a + x)
    told = values.join(predicted.select("Id", "prediction", "rating"), "Id")
    of_rating = F.get("phi", F.lit(FEATURES.index("rating")))  # scaled ratings are above 0 or below
    return told.select(
        "Id",
        (F.abs(total - F.col("prediction")) < 1e-6).alias("adds_up"),
        (of_rating * F.col("rating") > 0).alias("follows_rating"),
    )


def feature_ranking(spark: SparkSession, sf: str) -> DataFrame:
    """The features in order of importance: whether each is above zero and none above the one before, and
    the places of the two that the target was planted with."""
    model, scaled = _fitted(spark, sf)
    ranked = attribution.mean_attribution(attribution.shap_values(model, scaled), FEATURES)
    top = settle(charts.top_rows(ranked, "importance", "feature"), "ranking")
    order = Window.orderBy(F.desc("importance"), "feature")  # ten rows at most
    before = F.lag("importance").over(order)
    sound = (F.col("importance") >= 0) & F.coalesce(before >= F.col("importance"), F.lit(True))
    planted = F.when(F.col("feature").isin("rating", "hour"), F.row_number().over(order))
    return top.select("feature", sound.alias("in_order"), planted.alias("planted_place"))


# -- samples -----------------------------------------------------------------


def sample_reviews(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.sample_reviews(fx.reviews(spark, sf), 500).select("Id", "Summary", CAT)


def coherence_sample(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.sample_reviews(fx.reviews(spark, sf), 100, [CAT]).select(CAT, "Id")


# -- topics ------------------------------------------------------------------


def _document_topics(spark: SparkSession, sf: str, keep: Sequence[str] = ()) -> DataFrame:
    """Made-up shares of three topics for every review."""
    ids = fx.reviews(spark, sf).select("Id", *keep)
    share = F.transform(
        F.sequence(F.lit(0), F.lit(2)),
        lambda t: (F.lit(1) + (F.col("Id") * (t + 3)) % 7).cast("double"),
    )

    def scale(w: Column) -> Column:
        total = F.aggregate(w, F.lit(0.0), lambda a, x: a + x)
        return F.transform(w, lambda x: x / total)

    return ids.select("Id", *keep, F.posexplode(text.bind(share, scale)).alias("topic", "weight"))


def topic_sentiment(spark: SparkSession, sf: str) -> DataFrame:
    joined = _document_topics(spark, sf).join(fx.scored(spark, sf, CAT), "Id")
    return r6(topics.topic_sentiment(joined, [CAT]))


def topic_prevalence(spark: SparkSession, sf: str) -> DataFrame:
    joined = _document_topics(spark, sf).join(fx.scored(spark, sf), "Id")
    return r6(topics.topic_prevalence(joined))


def _ranked_terms(spark: SparkSession, sf: str) -> DataFrame:
    """Top terms per category with the language as topic and the corpus count as weight."""
    stats = terms.term_stats(fx.review_terms(spark, sf, CAT, "lang"), [CAT, "lang"])
    weights = stats.select(CAT, F.col("lang").alias("topic"), "term", F.col("cf").alias("weight"))
    kept = ranking.top_n_per_group(
        weights, [CAT, "topic"], [F.desc("weight"), F.asc("term")], 10, ["term"]
    )
    return topics.top_terms(kept, [CAT])


def top_terms(spark: SparkSession, sf: str) -> DataFrame:
    return topics.merged_terms(_ranked_terms(spark, sf), [CAT])


def top_terms_load(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_path(spark, "results")
    merged = topics.merged_terms(_ranked_terms(spark, sf), [CAT])
    tables.write_results({"top_terms": merged}, root, "20260101_000000", {"top_terms": CAT})
    return tables.load_result(spark, root, "top_terms", by=CAT).select(CAT, "rnk", "term")


def coherence_given(spark: SparkSession, sf: str) -> DataFrame:
    given = fx.parameter(spark, "given_terms")
    return r6(coherence.coherence(fx.prepared(spark, sf), given))


def _k_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Models of 1 to 4 topics, each the first topics of the given list, for every category."""
    given = fx.parameter(spark, "given_terms")
    cats = settle(fx.reviews(spark, sf).select(CAT).distinct(), "categories")
    nested = given.withColumn("k", F.explode(F.sequence(F.col("topic") + 1, F.lit(4))))
    listed = cats.withColumn("k", F.explode(F.array(*[F.lit(k) for k in range(1, 5)])))
    scores = coherence.coherence(
        fx.prepared(spark, sf), listed.join(nested, "k"), [CAT], ["k"]
    )
    return topics.model_coherence(scores, [CAT, "k"])


def best_k(spark: SparkSession, sf: str) -> DataFrame:
    rounded = _k_scores(spark, sf).withColumn("coherence", F.round("coherence", 6))
    return topics.best_k(rounded, [CAT])


def coherence_by_k(spark: SparkSession, sf: str) -> DataFrame:
    rounded = _k_scores(spark, sf).withColumn("coherence", F.round("coherence", 6))
    return r6(charts.coherence_chart(rounded))


def _topic_input(spark: SparkSession, sf: str, keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Reviews, the counts of their terms and the vocabulary of every category."""
    df = settle(fx.prepared(spark, sf).select("Id", CAT, "clean_text", *keep), "topic-reviews", CAT)
    counted = terms.kept_counts(df, text.terms(F.col("clean_text")), [CAT, *keep], CAT)
    return df, counted, terms.fit_vocabulary(counted, terms.COUNTS, 1000, [CAT], fx.parameter(spark, "stop_words"))


def _topic_models(spark: SparkSession, sf: str, sizes: Sequence[int], keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame, DataFrame, list]:
    """Reviews, vocabulary, vectors and fitted models of every category."""
    df, counted, vocab = _topic_input(spark, sf, keep)
    vectors = topics.topic_vectors(counted, vocab, CAT, keep, tokens=terms.COUNTS)
    return df, vocab, vectors, topics.fit_all_topics(vectors, vocab, sizes, CAT)


def lda_topics(spark: SparkSession, sf: str) -> DataFrame:
    """The ranked terms of every category's five topics, without the terms that the fit chose: whether they
    are in the vocabulary with falling weights, and whether the perplexity fell all through the fit."""
    _, vocab, _, models = _topic_models(spark, sf, (5,))
    ranked = topics.topic_terms(spark, models)
    traces = {m.category: [value for _, value in m.trace] for m in models}
    falls = {c: len(t) == 4 and all(math.isfinite(x) for x in t) and all(a > b for a, b in zip(t, t[1:])) for c, t in traces.items()}
    learned = spark.createDataFrame(list(falls.items()), "category string, learned boolean")
    known = ranked.join(vocab.select(CAT, "term", F.lit(True).alias("known")), [CAT, "term"], "left")
    heavier = F.lag("weight").over(Window.partitionBy(CAT, "topic").orderBy("rnk"))
    in_order = F.coalesce(heavier >= F.col("weight"), F.lit(True))
    sound = F.coalesce("known", F.lit(False)) & in_order
    return known.join(learned, CAT).select(CAT, "k", "topic", "rnk", sound.alias("is_sound"), "learned")


def document_topics(spark: SparkSession, sf: str) -> DataFrame:
    """Per review with a vocabulary term: how many topic shares it has, whether they are shares, and whether
    the topics of its category tell languages apart: by the largest language of each review's
    first topic more reviews are right than by the largest language of all."""
    _, _, vectors, models = _topic_models(spark, sf, (5,), ["lang"])
    shares = settle(topics.document_topics(models, vectors, ["lang"]), "shares")
    first = F.array_position("topics", F.array_max("topics")).alias("first")
    met = settle(shares.groupBy(CAT, "lang", first).agg(F.count("*").alias("n")), "languages")
    by_topic = met.groupBy(CAT, "first").agg(F.max("n").alias("n")).groupBy(CAT).agg(F.sum("n").alias("right"))
    by_all = met.groupBy(CAT, "lang").agg(F.sum("n").alias("n")).groupBy(CAT).agg(F.max("n").alias("largest"))
    told = by_topic.join(by_all, CAT).select(CAT, (F.col("right") > F.col("largest")).alias("tells_languages"))
    total = F.aggregate("topics", F.lit(0.0), lambda a, x: a + x)
    sound = (F.abs(total - 1) < 1e-6) & (F.array_min("topics") >= 0)
    rows = shares.select(CAT, "Id", F.size("topics").cast("bigint").alias("n_topics"), sound.alias("sums_to_one"))
    return rows.join(settle(told, "told"), CAT)


def coherence_sweep(spark: SparkSession, sf: str) -> DataFrame:
    """Every model of the sweep: whether its coherence is a cosine mean, whether one of its category is
    kept, and whether the kept ones are on average more coherent than their terms dealt over their topics."""
    df, _, _, models = _topic_models(spark, sf, topics.TOPIC_COUNTS)
    scores = settle(topics.coherence_sweep(df, models, CAT, compare_dealt=True), "sweep-scores")
    kept = topics.best_k(scores).join(scores.select("category", "k", "dealt_coherence"), ["category", "k"])
    above = kept.agg(F.avg(F.col("coherence") - F.col("dealt_coherence"))).first()[0]
    kept = kept.select("category", F.lit(True).alias("one_kept"), F.lit(above is not None and above > 0).alias("groups_terms"))
    joined = scores.join(kept, "category")
    return joined.select("category", "k", F.col("coherence").between(-1, 1).alias("in_range"), "one_kept", "groups_terms")


# -- sources -----------------------------------------------------------------


def read_reviews_csv(spark: SparkSession, sf: str) -> DataFrame:
    seconds = F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', Time)")
    path = scratch_path(spark, "reviews-csv")
    review_files.write_reviews_csv(fx.reviews(spark, sf).withColumn("Time", seconds), path)
    return prepare.fill_text(review_files.read_reviews(spark, path))


def result_tables(spark: SparkSession, sf: str) -> DataFrame:
    """All impact tables written and published, loaded with a name that no stage has written, and counted;
    a later run that stopped after one table is not read."""
    df = settle(fx.scored(spark, sf, CAT, "helpfulness_ratio", "Score", "Time", "text_length"), "scored")
    made, root = impact.impact_tables(df, CAT), scratch_path(spark, "impact")
    tables.write_results(made, root, "20260101_000000")
    tables.publish_run(spark, root, "20260101_000000")
    tables.write_results({"category_metrics": made["category_metrics"].limit(0)}, root, "20260102_000000")
    found = tables.load_results(spark, root, [*made, "never_written"])
    parts = [t.agg(F.lit(name).alias("name"), F.count("*").alias("n_rows")) for name, t in found.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def streamed_reviews(spark: SparkSession, sf: str) -> DataFrame:
    """The reviews' row-local columns, made by a stream over files that come in two goes."""
    seconds = F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', Time)")
    raw = fx.reviews(spark, sf).withColumn("Time", seconds).select(*RAW_REVIEWS.names)
    root = scratch_path(spark, "stream")
    for part in (0, 1):
        raw.where(F.col("Id") % 2 == part).write.mode("append").parquet(f"{root}/in")
        stream.prepare_stream(spark, f"{root}/in", f"{root}/out", f"{root}/checkpoint").awaitTermination()
    done = spark.read.parquet(f"{root}/out")
    names = ["Id", "helpfulness_ratio", "clean_text", "text_length", "summary_length", "word_count", "combined_text", "sentiment_label"]
    return r6(done.select(*names, dates.month_start(F.col("Time")).alias("month")), "helpfulness_ratio")


def pruned_scan(spark: SparkSession, sf: str) -> DataFrame:
    df = review_files.pruned_scan(fx.reviews(spark, sf))
    return df.withColumn("Score", F.col("Score").cast("int"))


def latest_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_path(spark, "snapshots")
    df = fx.prepared(spark, sf).select("Id", CAT, "helpfulness_ratio", "text_length")
    snapshots.write_snapshot(df.withColumn("text_length", F.lit(-1)), root, "20260101_000000", CAT)
    snapshots.write_snapshot(df, root, "20260102_000000", CAT)
    return pick(
        snapshots.latest_snapshot(spark, root, CAT), "Id", CAT, "helpfulness_ratio", "text_length"
    )


def feature_tables_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    stop = fx.parameter(spark, "stop_words")
    df = terms.kept_counts(fx.prepared(spark, sf), text.terms(F.col("clean_text")), [CAT], by=CAT)
    vocab = terms.fit_vocabulary(df, terms.COUNTS, 1000, [CAT], stop)
    root = scratch_path(spark, "features")
    bag = terms.bag_of_words(df, terms.COUNTS, [CAT], stop)
    tables.write_features(terms.tfidf(bag, vocab, [CAT]), vocab, root, "20260101_000000")
    features, names = tables.load_features(spark, root)
    return features.join(names.select(CAT, "term", "df"), [CAT, "term"]).groupBy(CAT).agg(
        F.count("*").alias("n_rows"),
        F.countDistinct("term_idx").alias("n_terms"),
        F.round(F.sum(F.col("weight") * F.col("weight"))).cast("bigint").alias("n_reviews"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        helpfulness_ratio, clean_text, text_features, epoch_time, score_bucket, category_slug,
        combined_text, quality_report, category_distribution, category_performance,
        category_metrics, category_month, month_trend, product_sentiment, product_helpfulness,
        daily_timeline, length_effect, sentiment_effect, recommendations, term_sentiment_corr,
        rating_histogram, sentiment_pivot, length_helpfulness_bins, word_frequencies,
        sentiment_boxplot, term_stats, merged_counts, tfidf, stopword_filter, bag_of_words, tf_vectors,
        synthetic_training, nb_model, nb_predict, confidence_threshold, lexicon_sentiment,
        sentiment_classifier, sentiment_quality, own_scorer, feature_table, scaled_features, train_test_split,
        regression_metrics, helpfulness_model, binned_model, shap_importance, feature_ranking, sample_reviews, coherence_sample,
        topic_sentiment, topic_prevalence, top_terms, top_terms_load, best_k, coherence_by_k, lda_topics,
        document_topics, coherence_sweep, read_reviews_csv, result_tables, streamed_reviews, pruned_scan, latest_snapshot,
        feature_tables_roundtrip,
    )
}
QUERIES["coherence"] = coherence_given
