"""Topic models per category: fitting, top terms, choice of size, sentiment per topic."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewlens.functions import text
from reviewlens.functions.numbers import divide
from reviewlens.operators import online_topics
from reviewlens.operators.coherence import coherence
from reviewlens.operators.online_topics import BATCH, MOST_BATCHES, PASSES, OnlineModel
from reviewlens.operators.ranking import first_per_group, sample_reviews
from reviewlens.operators.terms import bag_of_words, tfidf
from reviewlens.session import settle

# Fixed value: sizes tried.
TOPIC_COUNTS = (5, 10, 15)


def topic_vectors(
    df: DataFrame, vocab: DataFrame, column: str = "predicted_category", keep: Sequence[str] = (), batch: int = BATCH,
    tokens: str | None = None,
) -> DataFrame:
    """``category, Id, *keep, terms, weights, batch``: the TF-IDF row of every review, settled by batch.

    Reviews without any vocabulary term say nothing about topics and are left out. A pass has as
    many batches as the largest category has times ``batch`` reviews, ``MOST_BATCHES`` at most.
    ``tokens`` names the column where ``terms.kept_counts`` has the reviews' counts; without it, texts are counted.
    """
    spark, counts = df.sparkSession, tokens or text.terms(F.col("clean_text"))
    rows = tfidf(bag_of_words(df, counts, [column, *keep]), vocab, [column], keep)
    entry = F.sort_array(F.collect_list(F.struct("term_idx", "weight"))).alias("entries")
    # few bytes, much work: as many parts as tasks may run, whatever they weigh
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    grouped = settle(rows.groupBy(F.col(column).alias("category"), "Id", *keep).agg(entry), "topic-rows")
    largest = grouped.groupBy("category").count().agg(F.max("count")).first()[0] or 0
    batches = min(MOST_BATCHES, max(1, -(-largest // batch)))
    vectors = grouped.select(
        "category", "Id", *keep, F.col("entries.term_idx").cast("array<int>").alias("terms"), F.col("entries.weight").alias("weights"),
        F.pmod(F.xxhash64("Id"), F.lit(batches)).cast("int").alias("batch"),
    )
    return settle(vectors.repartition(parts, "Id"), "topic-vectors", by="batch")


def fit_all_topics(
    vectors: DataFrame,
    vocab: DataFrame,
    counts: Sequence[int] = TOPIC_COUNTS,
    column: str = "predicted_category",
    passes: int = PASSES,
) -> list[OnlineModel]:
    """A model of every category of the vocabulary and number of topics, all in the same jobs.

    A category without a review to learn from has models without weights.
    """
    names: dict[str, list[str]] = {}
    for row in vocab.select(F.col(column).alias("category"), "term").orderBy(column, "term_idx").collect():
        names.setdefault(row["category"], []).append(row["term"])
    return online_topics.fit_models(vectors, names, counts, passes)


def model_table(spark: SparkSession, models: Sequence[OnlineModel]) -> DataFrame:
    """``category, k, topic, term_idx, term, weight`` of models, to be kept and read by ``read_models``."""
    rows = [
        (m.category, m.k, topic, column, term, float(weight))
        for m in models if m.weights is not None
        for topic, weights in enumerate(m.weights)
        for column, (term, weight) in enumerate(zip(m.terms, weights))
    ]
    return spark.createDataFrame(rows, "category string, k int, topic int, term_idx int, term string, weight double")


def read_models(table: DataFrame) -> list[OnlineModel]:
    """The models of ``model_table``."""
    found: dict[tuple[str, int], list] = {}
    for row in table.orderBy("category", "k", "topic", "term_idx").collect():
        found.setdefault((row["category"], row["k"]), []).append(row)
    out = []
    for (category, k), rows in found.items():
        terms = [r["term"] for r in rows if r["topic"] == 0]
        weights = np.array([r["weight"] for r in rows]).reshape(k, len(terms))
        out.append(OnlineModel(category, k, terms, weights))
    return out


def document_topics(models: Sequence[OnlineModel], vectors: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``category, Id, *keep, topics``: topic shares of every review as an array, by one model a category."""
    return online_topics.shares(vectors, models, keep).drop("k")


def long_topics(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``category, Id, *keep, topic, weight`` from arrays of shares."""
    return df.select("category", "Id", *keep, F.posexplode("topics").alias("topic", "weight"))


def topic_terms(spark: SparkSession, models: Sequence[OnlineModel], n: int = 10) -> DataFrame:
    """``category, k, topic, rnk, term, weight``: the ``n`` heaviest terms of every topic."""
    rows = []
    for m in models:
        for topic, weights in enumerate(m.weights if m.weights is not None else ()):
            weights = weights / weights.sum()
            heaviest = np.argsort(-weights, kind="stable")[:n].tolist()
            rows += [(m.category, m.k, topic, rank, m.terms[i], float(weights[i])) for rank, i in enumerate(heaviest, 1)]
    return spark.createDataFrame(
        rows, "category string, k int, topic int, rnk int, term string, weight double"
    )


def top_terms(weights: DataFrame, keys: Sequence[str], n: int = 10) -> DataFrame:
    """``*keys, topic, rnk, term``: heaviest terms per topic, ties by name.

    ``weights`` holds ``*keys, topic, term, weight`` over a bounded vocabulary.
    """
    heaviest = Window.partitionBy(*keys, "topic").orderBy(F.desc("weight"), "term")
    ranked = weights.withColumn("rnk", F.row_number().over(heaviest)).where(F.col("rnk") <= n)
    return ranked.select(*keys, "topic", "rnk", "term")


def merged_terms(ranked: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``*keys, rnk, term``: the topics' terms in order, each at its first place only."""
    first = ranked.groupBy(*keys, "term").agg(F.min(F.struct("topic", "rnk")).alias("place"))
    in_order = Window.partitionBy(*keys).orderBy("place", "term")
    return first.select(*keys, F.row_number().over(in_order).alias("rnk"), "term")


def topic_sentiment(df: DataFrame, keys: Sequence[str] = ("category",)) -> DataFrame:
    """Mean sentiment per topic, weighted by topic share."""
    weighted = F.sum(F.col("sentiment_score") * F.col("weight"))
    return df.groupBy(*keys, "topic").agg(divide(weighted, F.sum("weight")).alias("avg_sentiment"))


def topic_prevalence(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Mean share of each topic and mean of sentiment times share."""
    return df.groupBy(*keys, "topic").agg(
        F.avg("weight").alias("prevalence"),
        F.avg(F.col("sentiment_score") * F.col("weight")).alias("avg_sentiment"),
    )


def model_coherence(topic_scores: DataFrame, keys: Sequence[str] = ("category", "k")) -> DataFrame:
    """Mean over a model's topics."""
    return topic_scores.groupBy(*keys).agg(F.avg("coherence").alias("coherence"))


def best_k(scores: DataFrame, keys: Sequence[str] = ("category",)) -> DataFrame:
    """The topic count of highest coherence per category, the smallest on a tie."""
    order: list[Column] = [-F.col("coherence"), F.col("k")]
    return first_per_group(scores, keys, order, ["k", "coherence"])


def dealt_terms(ranked: DataFrame) -> DataFrame:
    """The terms of ``topic_terms`` dealt over the other topics of their model: as many of each rank, without what groups them."""
    topic = F.pmod(F.col("topic") + F.col("rnk"), F.col("k")).cast("int")
    return ranked.withColumn("topic", topic)


def coherence_sweep(
    df: DataFrame,
    models: Sequence[OnlineModel],
    column: str = "predicted_category",
    n_terms: int = 20,
    sample: int | None = None,
    compare_dealt: bool = False,
) -> DataFrame:
    """``category, k, coherence`` of fitted models, scored in one pass over the texts.

    A model without weights scores 0. All reviews are read, or an exact sample of ``sample`` per category.
    ``compare_dealt`` adds ``dealt_coherence``, of the same terms dealt over the topics.
    """
    ranked = topic_terms(df.sparkSession, models, n_terms)
    reviews = df.select(F.col(column).alias("category"), "Id", "clean_text")
    if sample is not None:
        reviews = sample_reviews(reviews, sample, ["category"])
    listed = ranked.withColumn("dealt", F.lit(False))
    if compare_dealt:
        listed = listed.unionByName(dealt_terms(ranked).withColumn("dealt", F.lit(True)))
    found = model_coherence(coherence(reviews, listed, ["category"], ["k", "dealt"]), ["category", "k", "dealt"])
    columns = {"coherence": False, "dealt_coherence": True} if compare_dealt else {"coherence": False}
    scores = found.groupBy("category", "k").agg(*[F.max(F.when(F.col("dealt") == d, F.col("coherence"))).alias(n) for n, d in columns.items()])
    failed = [(m.category, m.k, *[0.0] * len(columns)) for m in models if m.weights is None]
    if not failed:
        return scores
    schema = "category string, k int" + "".join(f", {name} double" for name in columns)
    return scores.unionByName(df.sparkSession.createDataFrame(failed, schema))
