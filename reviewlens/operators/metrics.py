"""Grouped metrics of scored reviews: one aggregation each, partial before the shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.functions import dates
from reviewlens.functions.numbers import divide


def month_trend(df: DataFrame) -> DataFrame:
    """Per month: mean and deviation of sentiment, mean and number of ratings."""
    return df.groupBy(dates.month_start(F.col("Time")).alias("month")).agg(
        F.avg("sentiment_score").alias("sentiment_mean"),
        F.stddev_samp("sentiment_score").alias("sentiment_std"),
        F.avg("Score").alias("score_mean"),
        F.count("Score").alias("score_count"),
    )


def product_sentiment(df: DataFrame, min_reviews: int = 10) -> DataFrame:
    """Per product with at least ``min_reviews`` ratings: the same four columns."""
    return (
        df.groupBy("ProductId")
        .agg(
            F.avg("sentiment_score").alias("sentiment_mean"),
            F.stddev_samp("sentiment_score").alias("sentiment_std"),
            F.avg("Score").alias("score_mean"),
            F.count("Score").alias("score_count"),
        )
        .where(F.col("score_count") >= min_reviews)
    )


def product_helpfulness(df: DataFrame, more_than: int = 50) -> DataFrame:
    """Per product with more than ``more_than`` reviews: helpfulness, size, rating."""
    return (
        df.groupBy("ProductId")
        .agg(
            F.avg("helpfulness_ratio").alias("avg_helpfulness"),
            F.count("*").alias("review_count"),
            F.avg("Score").alias("avg_rating"),
        )
        .where(F.col("review_count") > more_than)
    )


def regression_metrics(df: DataFrame, y: str = "y", prediction: str = "prediction") -> DataFrame:
    """``mse, rmse, r2`` of a column of predictions; ``r2`` is NULL for a constant target."""
    error = F.col(y) - F.col(prediction)
    mse = F.avg(error * error)
    return df.agg(mse.alias("mse"), F.var_pop(y).alias("_var")).select(
        "mse",
        F.sqrt("mse").alias("rmse"),
        (F.lit(1.0) - divide(F.col("mse"), F.col("_var"))).alias("r2"),
    )
