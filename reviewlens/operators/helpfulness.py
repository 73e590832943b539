"""Helpfulness model: features, scaling, boosted trees, attribution."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from reviewlens.functions import dates
from reviewlens.functions.numbers import divide
from reviewlens.operators.ranking import split_name
from reviewlens.schema import FEATURES, require


def feature_table(
    df: DataFrame,
    keep: Sequence[str] = (),
    train_mean_only: bool = False,
    ratings: DataFrame | None = None,
) -> DataFrame:
    """``Id, *keep``, the feature columns and the target ``helpfulness_ratio``.

    The mean rating is one scalar over all reviews, or over the training part only; where
    ``df`` is costly to derive, ``ratings`` names a plainer source of ``Id`` and ``Score``.
    Sentiment features are left out when the input has no sentiment.
    """
    require(df, "Id", "text_length", "word_count", "Score", "Time", "helpfulness_ratio")
    base = df if ratings is None else ratings
    base = base.where(split_name() == "train") if train_mean_only else base
    mean_score = base.agg(F.avg("Score")).scalar()
    columns: dict[str, Column] = {
        "text_length": F.col("text_length"),
        "word_count": F.col("word_count"),
        "avg_word_length": divide(F.col("text_length"), F.col("word_count")),
        "rating": F.col("Score"),
    }
    if "sentiment_score" in df.columns:
        columns["sentiment_score"] = F.col("sentiment_score")
        columns["sentiment_magnitude"] = F.abs("sentiment_score")
    columns["rating_deviation"] = F.abs(F.col("Score") - mean_score)
    columns["hour"] = F.hour("Time")
    columns["day_of_week"] = dates.day_of_week(F.col("Time"))
    return df.select(
        "Id", *keep, *[c.alias(n) for n, c in columns.items()], "helpfulness_ratio"
    )


def feature_names(df: DataFrame) -> list[str]:
    return [n for n in FEATURES if n in df.columns]


def scale_features(features: DataFrame) -> DataFrame:
    """Features minus the training mean, over the training population deviation.

    A constant feature becomes NULL, as does a missing value; ``assemble`` reads both as the
    mean.
    """
    names = feature_names(features)
    moments = F.struct(
        *[F.avg(n).alias(f"{n}_mean") for n in names],
        *[F.stddev_pop(n).alias(f"{n}_std") for n in names],
    )
    fitted = features.where(split_name() == "train").agg(moments).scalar()
    return features.withColumns(
        {
            n: divide(F.col(n) - fitted.getField(f"{n}_mean"), fitted.getField(f"{n}_std"))
            for n in names
        }
    )


def assemble(scaled: DataFrame, out: str = "features") -> DataFrame:
    """One vector per review; a missing feature counts as the training mean, which is 0."""
    names = feature_names(scaled)
    filled = scaled.withColumns({f"_{n}": F.coalesce(F.col(n), F.lit(0.0)) for n in names})
    assembler = VectorAssembler(inputCols=[f"_{n}" for n in names], outputCol=out)
    return assembler.transform(filled).drop(*[f"_{n}" for n in names])


@dataclass
class HelpfulnessModel:
    """Fitted trees with the names of their inputs."""

    trees: GBTRegressionModel
    names: list[str]


def fit_helpfulness(
    vectors: DataFrame, names: Sequence[str], n_trees: int = 100, depth: int = 5, seed: int = 42
) -> HelpfulnessModel:
    """Boosted regression trees on the training part of ``assemble``'s output."""
    train = vectors.where(split_name() == "train").select("features", "helpfulness_ratio")
    train = train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        learner = GBTRegressor(
            labelCol="helpfulness_ratio",
            maxIter=n_trees,
            stepSize=0.1,
            maxDepth=depth,
            seed=seed,
            checkpointInterval=10,
        )
        return HelpfulnessModel(learner.fit(train), list(names))
    finally:
        train.unpersist()


def predict_helpfulness(model: HelpfulnessModel, vectors: DataFrame) -> DataFrame:
    """Input plus ``prediction`` and the part of the split each review is in."""
    return model.trees.transform(vectors).withColumn("split", split_name())
