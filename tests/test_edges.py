"""Hand-made rows at the edges of every rule."""

import datetime

import pytest
from pyspark.sql import functions as F

from reviewlens.functions import dates, text
from reviewlens.operators import categories, charts, helpfulness, impact, metrics, prepare, ranking, topics


def values(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]


def test_ratio_without_votes_and_above_one(spark):
    df = spark.createDataFrame(
        [(0, 0, 5, "a"), (3, 2, 9, None), (1, 4, 1, "b")],
        "HelpfulnessNumerator int, HelpfulnessDenominator int, Score int, Text string",
    )
    ratios = values(df.withColumn("r", prepare.helpfulness_ratio()), "r")
    assert ratios == [(0.0,), (1.5,), (0.25,)]
    report = prepare.quality_report(df).first().asDict()
    assert report == {
        "n_reviews": 3, "with_votes": 2, "ratio_above_one": 1, "score_out_of_range": 1, "empty_text": 1,
    }


def test_missing_and_blank_texts(spark):
    df = spark.createDataFrame([(1, None, "s"), (2, "   ", None)], "Id long, Text string, Summary string")
    got = prepare.text_features(prepare.fill_text(df))
    assert values(got, "Text", "Summary", "text_length", "summary_length", "word_count") == [
        ("", "s", 0, 1, 0), ("   ", "", 3, 0, 0),
    ]


def test_clean_keeps_letters_digits_underscore(spark):
    samples = ["Été_1, ok!", "a b-c", "x́y", "«Ω» 10²", "tab\tnl\nend.", "a\x1cb c"]
    import re

    df = spark.createDataFrame([(s,) for s in samples], "t string")
    got = values(df.select(text.clean(F.col("t")).alias("c"), text.words(F.col("t")).alias("w")), "c", "w")
    assert got == [(re.sub(r"[^\w\s]", "", s.lower()), s.split()) for s in samples]


def test_epoch_is_a_thursday(spark):
    df = spark.createDataFrame([(0,), (951782399,)], "Time long")
    got = df.select(dates.from_epoch(F.col("Time")).alias("t")).select(
        "t", F.hour("t").alias("h"), dates.day_of_week(F.col("t")).alias("d"),
        dates.month_start(F.col("t")).alias("m"),
    )
    assert values(got, "t", "h", "d", "m") == [
        (datetime.datetime(1970, 1, 1), 0, 3, datetime.date(1970, 1, 1)),
        (datetime.datetime(2000, 2, 28, 23, 59, 59), 23, 0, datetime.date(2000, 2, 1)),
    ]


def test_score_classes(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (4,), (None,)], "Score int")
    assert values(df.withColumn("l", prepare.score_label()), "l") == [(0,), (0,), (1,), (2,), (None,)]


def test_one_review_has_no_deviation(spark):
    df = spark.createDataFrame(
        [("a", 0.5, 0.1, 4)],
        "predicted_category string, helpfulness_ratio double, sentiment_score double, Score int",
    )
    row = impact.category_performance(df).first()
    assert (row["helpfulness_mean"], row["helpfulness_std"], row["score_count"]) == (0.5, None, 1)


def test_constant_presence_has_no_correlation(spark):
    df = spark.createDataFrame(
        [("a", "good tea", 0.1), ("a", "good cup", 0.7)],
        "predicted_category string, clean_text string, sentiment_score double",
    )
    words = spark.createDataFrame([("a", "good"), ("a", "tea"), ("a", "none")], "category string, term string")
    got = dict(values(impact.term_sentiment(df, words), "term", "correlation"))
    assert got["good"] is None and got["none"] is None
    assert got["tea"] == pytest.approx(-1.0)


def test_bands_include_their_edges(spark):
    df = spark.createDataFrame(
        [(1999, 0.0), (2000, 1.0), (5000, 1.0), (5001, 0.0)], "text_length int, helpfulness_ratio double"
    )
    row = impact.length_effect(df).first()
    assert (row["mean_improvement"], row["effect_size"]) == (1.0, 0.0)
    scores = spark.createDataFrame(
        [("a", 0.2, 5), ("a", 0.4, 5), ("a", 0.1999, 1), ("b", 0.5, 3)],
        "predicted_category string, sentiment_score double, Score int",
    )
    assert values(impact.sentiment_effect(scores), "category", "mean_improvement") == [("a", 4.0)]


def test_improvement_areas_hold_all_that_apply(spark):
    df = spark.createDataFrame(
        [("a", -0.5, 0.2, 3.0, 4), ("b", 0.5, 0.9, 4.5, 2)],
        "category string, avg_sentiment double, avg_helpfulness double, avg_rating double, review_count long",
    )
    effect = spark.createDataFrame([(0.1234, 1.0)], "mean_improvement double, effect_size double")
    got = {r["category"]: r for r in impact.recommendations(df, effect).collect()}
    assert got["a"]["improvement_areas"] == ["helpfulness", "sentiment"]
    assert got["b"]["improvement_areas"] == []
    assert (got["a"]["expected_improvement"], got["b"]["avg_helpfulness"]) == ("12.34%", "90.00%")


def test_equal_probabilities_take_the_first_class(spark):
    df = spark.createDataFrame([([0.5, 0.5],), ([0.2, 0.8],)], "p array<double>")
    got = df.select(categories.best_class(F.col("p"), ["Books", "Art"]).alias("c"))
    assert values(got, "c") == [("Art",), ("Art",)]


def test_equal_coherence_takes_the_smaller_model(spark):
    df = spark.createDataFrame(
        [("a", 10, 0.5), ("a", 5, 0.5), ("a", 15, 0.4), ("b", 5, 0.1), ("b", 10, 0.2)],
        "category string, k int, coherence double",
    )
    assert sorted(values(topics.best_k(df), "category", "k")) == [("a", 5), ("b", 10)]


def test_threshold_is_exclusive(spark):
    df = spark.createDataFrame([("a", 0.5), ("b", 0.49)], "predicted_category string, category_confidence double")
    assert values(categories.apply_threshold(df, 0.5), "predicted_category") == [("a",), ("Uncategorized",)]
    assert categories.low_confidence_count(df, 0.5).first()[0] == 1


def test_merged_terms_keep_first_places(spark):
    rows = [("c", 0, 1, "x"), ("c", 0, 2, "y"), ("c", 1, 1, "y"), ("c", 1, 2, "z"), ("c", 2, 1, "x")]
    df = spark.createDataFrame(rows, "category string, topic int, rnk int, term string")
    got = topics.merged_terms(df, ["category"]).orderBy("rnk")
    assert values(got, "rnk", "term") == [(1, "x"), (2, "y"), (3, "z")]


def test_slug_and_guard(spark):
    df = spark.createDataFrame([("Food & Beverages",)], "c string")
    assert df.select(prepare.category_slug(F.col("c"))).first()[0] == "food_beverages"
    with pytest.raises(ValueError, match="missing columns"):
        helpfulness.feature_table(df)


def test_product_limits(spark):
    rows = [("a", 5, 0.1, 0.5)] * 10 + [("b", 4, 0.2, 0.5)] * 9
    df = spark.createDataFrame(
        rows, "ProductId string, Score int, sentiment_score double, helpfulness_ratio double"
    )
    assert values(metrics.product_sentiment(df), "ProductId") == [("a",)]
    assert values(metrics.product_helpfulness(df, 9), "ProductId", "review_count") == [("a", 10)]


def test_boxplot_quartiles(spark):
    rows = [("p%d" % i, 4.0, float(i) / 10) for i in range(5)]
    df = spark.createDataFrame(rows, "ProductId string, score_mean double, sentiment_mean double")
    row = charts.sentiment_boxplot(df).first()
    assert [row[c] for c in ("lowest", "q1", "median", "q3", "highest")] == pytest.approx([0, 0.1, 0.2, 0.3, 0.4])


def test_split_and_sample_of_a_small_table(spark):
    df = spark.range(50).withColumnRenamed("id", "Id")
    assert ranking.sample_reviews(df, 100).count() == 50
    parts = {r[0]: r[1] for r in df.groupBy(ranking.split_name()).count().collect()}
    assert set(parts) == {"train", "test"} and parts["train"] > parts["test"]
