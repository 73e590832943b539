"""Three-class sentiment model learnt from ratings, and its score per review."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.storagelevel import StorageLevel

from reviewlens.functions import text
from reviewlens.operators.prepare import score_label
from reviewlens.operators.ranking import sample_reviews, split_name
from reviewlens.operators.terms import fit_vocabulary

# Fixed value: reviews sampled for training.
SAMPLE = 50_000


def labelled(df: DataFrame) -> DataFrame:
    """Reviews with their rating class and part of the split."""
    return df.withColumn("sentiment_label", score_label()).withColumn("split", split_name())


def score_from_probabilities(p: Column) -> Column:
    """Probability of the positive class minus that of the negative one."""
    return F.get(p, F.lit(2)) - F.get(p, F.lit(0))


@dataclass
class SentimentModel:
    """TF-IDF over a fitted vocabulary, followed by a multinomial logistic regression."""

    features: PipelineModel
    classifier: LogisticRegressionModel

    def whole(self) -> PipelineModel:
        """All steps as one model, for saving."""
        return PipelineModel([*self.features.stages, self.classifier])

    @staticmethod
    def of(whole: PipelineModel) -> SentimentModel:
        """The model from its saved form."""
        return SentimentModel(PipelineModel(whole.stages[:-1]), whole.stages[-1])

    def scorer(self) -> NumpyScorer:
        """The same model without Spark, as an example of a scorer of one's own."""
        counts, weigh, _ = self.features.stages
        columns = {term: i for i, term in enumerate(counts.vocabulary)}
        coefficients = self.classifier.coefficientMatrix.toArray()
        return NumpyScorer(columns, weigh.getScalingVec().toArray(), coefficients, self.classifier.interceptVector.toArray())


def _tokens(df: DataFrame) -> DataFrame:
    return df.withColumn("_tokens", text_tokens())


def text_tokens() -> Column:
    """The terms of a review's text, as the model reads them."""
    return text.terms(F.coalesce(F.col("Text"), F.lit("")))


def fit_sentiment(
    df: DataFrame, sample: int | None = SAMPLE, n_features: int = 20_000, max_iter: int = 20
) -> SentimentModel:
    """Train on the training part of up to ``sample`` reviews; None takes all.

    The features are the ``n_features`` most frequent terms of that part, one column each.
    """
    chosen = df if sample is None else sample_reviews(df, sample)
    train = labelled(chosen).where((F.col("split") == "train") & F.col("sentiment_label").isNotNull())
    vocab = fit_vocabulary(train.select("Id", "Text"), text_tokens(), n_features)
    rows = vocab.select("term", "idf").orderBy("term_idx").collect()  # n_features rows at most
    if not rows:
        raise ValueError("no term to learn from")
    counts = CountVectorizerModel.from_vocabulary([r["term"] for r in rows], inputCol="_tokens", outputCol="_tf")
    weigh = ElementwiseProduct(scalingVec=Vectors.dense([r["idf"] for r in rows]), inputCol="_tf", outputCol="_tfidf")
    scale = Normalizer(p=2.0, inputCol="_tfidf", outputCol="features")
    features = PipelineModel([counts, weigh, scale])
    vectors = features.transform(_tokens(train)).select("features", "sentiment_label").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        learner = LogisticRegression(
            labelCol="sentiment_label", family="multinomial", maxIter=max_iter, regParam=0.01
        )
        return SentimentModel(features, learner.fit(vectors))
    finally:
        vectors.unpersist()


def score_sentiment(
    model: SentimentModel, df: DataFrame, keep: Sequence[str] = (), probabilities: bool = False
) -> DataFrame:
    """``Id, *keep, sentiment_label, split, prediction, sentiment_score``, row by row; and the
    array ``probabilities`` of the three classes if asked for."""
    scored = model.classifier.transform(model.features.transform(_tokens(labelled(df))))
    shares = vector_to_array("probability")
    score = score_from_probabilities(shares).alias("sentiment_score")
    more = [shares.alias("probabilities")] if probabilities else []
    return scored.select("Id", *keep, "sentiment_label", "split", F.col("prediction"), score, *more)


class Scorer(Protocol):
    """A model of the user's own. It is sent out once and opened once in each task."""

    def open(self) -> Callable[[pa.RecordBatch], np.ndarray]:
        """A function from a batch of inputs to the probabilities of the three classes, a row each."""


@dataclass
class NumpyScorer:
    """Logistic regression over TF-IDF, from an input column of terms."""

    columns: dict[str, int]
    idf: np.ndarray
    coefficients: np.ndarray
    intercepts: np.ndarray

    def open(self) -> Callable[[pa.RecordBatch], np.ndarray]:
        def score(batch: pa.RecordBatch) -> np.ndarray:
            margins = np.tile(self.intercepts, (batch.num_rows, 1))
            for row, terms in enumerate(batch.column(0).to_pylist()):
                counted = Counter(c for c in map(self.columns.get, terms) if c is not None)
                if counted:
                    at = np.fromiter(counted, np.int64, len(counted))
                    weights = np.fromiter(counted.values(), float, len(counted)) * self.idf[at]
                    margins[row] += self.coefficients[:, at] @ (weights / np.sqrt(weights @ weights))
            shares = np.exp(margins - margins.max(axis=1, keepdims=True))
            return shares / shares.sum(axis=1, keepdims=True)

        return score


def score_with(
    scorer: Scorer, df: DataFrame, inputs: dict[str, Column], keep: Sequence[str] = (), probabilities: bool = False
) -> DataFrame:
    """What ``score_sentiment`` gives, by a scorer of the user's own.

    ``inputs`` are the columns it is given, by name, in Arrow batches. The prediction is the class of
    the largest probability, the smaller one on a tie.
    """
    sent = df.sparkSession.sparkContext.broadcast(scorer)
    rows = labelled(df).select("Id", *keep, "sentiment_label", "split", *[c.alias(f"_in_{n}") for n, c in inputs.items()])
    names, n = list(inputs), len(inputs)
    schema = T.StructType([*rows.schema.fields[:-n], T.StructField("prediction", T.DoubleType()), T.StructField("probabilities", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = sent.value.open()
        for batch in batches:
            given = pa.RecordBatch.from_arrays(batch.columns[-n:], names=names)
            shares = np.asarray(score(given), dtype=float)
            if shares.shape != (batch.num_rows, 3):
                raise ValueError(f"a scorer gives three probabilities a review, not {shares.shape} for {batch.num_rows}")
            offsets = pa.array(np.arange(batch.num_rows + 1) * 3, pa.int32())
            best = pa.array(shares.argmax(axis=1).astype(float)) if batch.num_rows else pa.array([], pa.float64())
            out = [*batch.columns[:-n], best, pa.ListArray.from_arrays(offsets, shares.ravel())]
            yield pa.RecordBatch.from_arrays(out, names=schema.names)

    scored = rows.mapInArrow(run, schema)
    score = score_from_probabilities(F.col("probabilities")).alias("sentiment_score")
    more = ["probabilities"] if probabilities else []
    return scored.select("Id", *keep, "sentiment_label", "split", "prediction", score, *more)


def evaluate_sentiment(scored: DataFrame) -> dict[str, float]:
    """Accuracy and F1 on the held-out part."""
    test = scored.where((F.col("split") == "test") & F.col("sentiment_label").isNotNull())
    test = test.withColumn("label", F.col("sentiment_label").cast("double"))
    judge = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction")
    return {m: judge.evaluate(test, {judge.metricName: m}) for m in ("accuracy", "f1")}
