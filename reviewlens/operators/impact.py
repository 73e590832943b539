"""Business impact: effect sizes, category and month tables, term correlations, advice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.functions import dates
from reviewlens.functions.numbers import effect_columns, three_digits
from reviewlens.operators.term_search import term_correlation

# The bands whose effect is measured.
LENGTH_BAND = (2000, 5000)
SENTIMENT_BAND = (0.2, 0.4)


def category_performance(df: DataFrame, category: str = "predicted_category") -> DataFrame:
    """Per category: ratio and sentiment with deviations, ratings, to three digits."""
    return df.groupBy(F.col(category).alias("category")).agg(
        three_digits(F.avg("helpfulness_ratio")).alias("helpfulness_mean"),
        three_digits(F.stddev_samp("helpfulness_ratio")).alias("helpfulness_std"),
        three_digits(F.avg("sentiment_score")).alias("sentiment_mean"),
        three_digits(F.stddev_samp("sentiment_score")).alias("sentiment_std"),
        three_digits(F.avg("Score")).alias("score_mean"),
        F.count("Score").alias("score_count"),
    )


def category_month(df: DataFrame, category: str = "predicted_category") -> DataFrame:
    """Per category and month, to three digits."""
    month = dates.month_start(F.col("Time")).alias("month")
    return df.groupBy(F.col(category).alias("category"), month).agg(
        three_digits(F.avg("helpfulness_ratio")).alias("helpfulness_mean"),
        three_digits(F.avg("sentiment_score")).alias("sentiment_mean"),
        three_digits(F.avg("Score")).alias("score_mean"),
        F.count("Score").alias("score_count"),
    )


def category_metrics(df: DataFrame, category: str = "predicted_category") -> DataFrame:
    """Per category: unrounded means and the number of reviews."""
    return df.groupBy(F.col(category).alias("category")).agg(
        F.avg("sentiment_score").alias("avg_sentiment"),
        F.avg("helpfulness_ratio").alias("avg_helpfulness"),
        F.avg("Score").alias("avg_rating"),
        F.count("*").alias("review_count"),
    )


def length_effect(df: DataFrame, band: tuple[int, int] = LENGTH_BAND) -> DataFrame:
    """How reviews of a favoured length differ in helpfulness from all others; one row."""
    inside = F.col("text_length").between(*band)
    return df.agg(*effect_columns(F.col("helpfulness_ratio"), inside))


def sentiment_effect(
    df: DataFrame,
    band: tuple[float, float] = SENTIMENT_BAND,
    category: str = "predicted_category",
) -> DataFrame:
    """Per category with a review in the band: how those reviews differ in rating."""
    inside = F.col("sentiment_score").between(*band)
    return (
        df.groupBy(F.col(category).alias("category"))
        .agg(F.count_if(inside).alias("_n"), *effect_columns(F.col("Score"), inside))
        .where(F.col("_n") > 0)
        .drop("_n")
    )


def term_sentiment(
    df: DataFrame, terms: DataFrame, category: str = "predicted_category", found: str | None = None
) -> DataFrame:
    """``category, term, correlation``: presence of a term, as substring, against sentiment.

    ``terms`` holds ``category, term``. Each text is scanned once for all terms of its category, where it
    is; ``found`` names a column of ``find_terms`` that holds what an earlier scan has found.
    """
    listed = terms.select(F.col("category").alias(category), "term")
    return term_correlation(df, listed, category, found)


def recommendations(
    metrics: DataFrame, effect: DataFrame, band: tuple[int, int] = LENGTH_BAND
) -> DataFrame:
    """Advice per category from ``category_metrics`` and the one row of ``length_effect``."""
    gain = effect.select("mean_improvement").scalar()

    def percent(c: Column) -> Column:
        return F.format_string("%.2f%%", c * 100)

    areas = F.array_compact(
        F.array(
            F.when(F.col("avg_helpfulness") < 0.5, "helpfulness"),
            F.when(F.col("avg_sentiment") < 0, "sentiment"),
        )
    )
    return metrics.select(
        "category",
        F.lit(f"{band[0]}-{band[1]} characters").alias("target_length"),
        percent(gain).alias("expected_improvement"),
        F.format_string("%.2f", "avg_sentiment").alias("avg_sentiment"),
        percent(F.col("avg_helpfulness")).alias("avg_helpfulness"),
        F.format_string("%.1f", "avg_rating").alias("avg_rating"),
        F.col("review_count").alias("review_volume"),
        areas.alias("improvement_areas"),
    )


def impact_tables(df: DataFrame, category: str = "predicted_category") -> dict[str, DataFrame]:
    """All impact tables of one scored review table, keyed by name."""
    metrics, effect = category_metrics(df, category), length_effect(df)
    return {
        "category_performance": category_performance(df, category),
        "category_month": category_month(df, category),
        "category_metrics": metrics,
        "length_effect": effect,
        "sentiment_effect": sentiment_effect(df, category=category),
        "recommendations": recommendations(metrics, effect),
    }
