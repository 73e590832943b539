"""Lexicon sentiment: polarity and subjectivity of a text from a word list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.functions import text


def _neighbours(words: Column) -> Column:
    """Each word with the two before it, and whether it is the first."""

    def around(w: Column) -> Column:
        def one(x: Column, i: Column) -> Column:
            return F.struct(
                x.alias("word"), F.get(w, i - 1).alias("prev1"), F.get(w, i - 2).alias("prev2"), (i == 0).alias("first")
            )

        return F.transform(w, one)

    return text.bind(words, around)


def lexicon_sentiment(
    df: DataFrame,
    lexicon: DataFrame,
    modifiers: DataFrame,
    text_col: str = "clean_text",
    keep: Sequence[str] = (),
) -> DataFrame:
    """``Id, *keep, sentiment_score, subjectivity_score`` for every review.

    A hit counts its polarity, times the factor of an intensifier just before it, times the
    factor of a negator one or two words before it (the nearer one). The score is the mean
    over hits, held within [-1, 1]; a review without a hit scores 0. Subjectivity is the plain
    mean. Words meet the lexicon where they are; what is summed is hits, and each review's first
    word, or an empty row, whether it is a hit or not, so that no review is lost, none is
    read twice, and no word is common to all. ``keep`` carries narrow columns through, which saves joining them back.
    """
    pieces = df.select(
        "Id", *keep, F.inline_outer(_neighbours(text.words(F.col(text_col))))
    )
    entries = lexicon.select("word", "polarity", "subjectivity")

    def side(n: int) -> DataFrame:
        return modifiers.select(
            F.col("word").alias(f"prev{n}"),
            F.col("kind").alias(f"kind{n}"),
            F.col("factor").alias(f"factor{n}"),
        )

    hits = (
        pieces.join(entries, "word", "left")
        .where(F.col("polarity").isNotNull() | F.col("subjectivity").isNotNull() | F.coalesce("first", F.lit(True)))
        .join(side(1), "prev1", "left")
        .join(side(2).where(F.col("kind2") == "negator"), "prev2", "left")
    )
    intensity = F.when(F.col("kind1") == "intensifier", F.col("factor1")).otherwise(F.lit(1.0))
    negation = (
        F.when(F.col("kind1") == "negator", F.col("factor1"))
        .when(F.col("kind2") == "negator", F.col("factor2"))
        .otherwise(F.lit(1.0))
    )
    mean = F.coalesce(F.avg(F.col("polarity") * intensity * negation), F.lit(0.0))
    return hits.groupBy("Id", *keep).agg(
        F.greatest(F.lit(-1.0), F.least(F.lit(1.0), mean)).alias("sentiment_score"),
        F.coalesce(F.avg("subjectivity"), F.lit(0.0)).alias("subjectivity_score"),
    )


def add_sentiment(df: DataFrame, lexicon: DataFrame, modifiers: DataFrame) -> DataFrame:
    """Reviews with their two scores, joined back on ``Id``."""
    return df.join(lexicon_sentiment(df, lexicon, modifiers), "Id")
