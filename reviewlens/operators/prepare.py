"""Stage 1: raw reviews to cleaned reviews, row by row, without a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.functions import dates, text


def fill_text(df: DataFrame) -> DataFrame:
    """Missing texts become empty ones."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in ("Text", "Summary")})


def epoch_time(df: DataFrame) -> DataFrame:
    return df.withColumn("Time", dates.from_epoch(F.col("Time")))


def helpfulness_ratio() -> Column:
    """Share of helpful votes; 0 without votes. May exceed 1 where the input does."""
    votes = F.col("HelpfulnessDenominator")
    ratio = F.try_divide(F.col("HelpfulnessNumerator").cast("double"), votes.cast("double"))
    return F.when(votes > 0, ratio).otherwise(F.lit(0.0))


def clean_columns(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "clean_text": text.clean(F.col("Text")),
            "clean_summary": text.clean(F.col("Summary")),
        }
    )


def text_features(df: DataFrame) -> DataFrame:
    """Lengths in characters and the number of blank-separated words."""
    return df.withColumns(
        {
            "text_length": F.length("Text"),
            "summary_length": F.length("Summary"),
            "word_count": F.size(text.words(F.col("Text"))),
        }
    )


def combined_text() -> Column:
    """The text the category model reads."""
    return F.concat_ws(" ", F.col("Summary"), F.col("Text"))


def score_label() -> Column:
    """Rating as class: up to 2 is 0, up to 3 is 1, above is 2."""
    score = F.col("Score")
    return (
        F.when(score <= 2, 0).when(score <= 3, 1).when(score > 3, 2).cast("int")
    )


def category_slug(category: Column) -> Column:
    """Display form of a category; never a join key."""
    return F.replace(F.lower(category), F.lit(" & "), F.lit("_"))


def prepare_reviews(df: DataFrame) -> DataFrame:
    """All row-local columns of stage 1 over reviews whose ``Time`` is already a timestamp."""
    filled = fill_text(df).withColumn("helpfulness_ratio", helpfulness_ratio())
    return text_features(clean_columns(filled))


def quality_report(df: DataFrame) -> DataFrame:
    """Counts of rows that break an expectation; the values themselves are kept."""
    num, den = F.col("HelpfulnessNumerator"), F.col("HelpfulnessDenominator")
    return df.agg(
        F.count("*").alias("n_reviews"),
        F.count_if(den > 0).alias("with_votes"),
        F.count_if((den > 0) & (num > den)).alias("ratio_above_one"),
        F.count_if(~F.col("Score").between(1, 5)).alias("score_out_of_range"),
        F.count_if(F.coalesce(F.length("Text"), F.lit(0)) == 0).alias("empty_text"),
    )
