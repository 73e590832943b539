"""Bags of words, vocabularies and TF-IDF weights as long tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.functions import text
from reviewlens.operators.ranking import top_n_per_group
from reviewlens.session import settle


COUNTS = "term_counts"


def kept_counts(df: DataFrame, tokens: Column, keys: Sequence[str] = (), by: str | None = None) -> DataFrame:
    """``*keys, Id, term_counts``: a row for each review with the counts of its terms, settled once.

    Counting is most of the work of a bag of words, so a table whose bag is read more than once, for its
    vocabulary and again for its weights, is counted here and its bags are made from ``COUNTS``.
    """
    return settle(df.select(*keys, "Id", text.term_counts(tokens).alias(COUNTS)), "term-counts", by)


def bag_of_words(
    df: DataFrame, tokens: Column | str, keys: Sequence[str] = (), stop_words: DataFrame | None = None
) -> DataFrame:
    """``*keys, Id, term, tf``: term counts of each review, made inside its row.

    ``tokens`` are a review's tokens, or the name of the column where ``kept_counts`` has their counts.
    """
    counts = F.col(tokens) if isinstance(tokens, str) else text.term_counts(tokens)
    bag = df.select(*keys, "Id", F.inline(counts))
    return bag if stop_words is None else without_stop_words(bag, stop_words)


def without_stop_words(bag: DataFrame, stop_words: DataFrame) -> DataFrame:
    return bag.join(stop_words.select(F.col("word").alias("term")), "term", "left_anti")


def term_stats(bag: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``*keys, term, df, cf``: number of reviews and of occurrences."""
    return bag.groupBy(*keys, "term").agg(
        F.count("*").alias("df"), F.sum("tf").cast("bigint").alias("cf")
    )


def vocabulary(stats: DataFrame, max_features: int, keys: Sequence[str] = ()) -> DataFrame:
    """The ``max_features`` most frequent terms per group, numbered alphabetically from 0."""
    group = list(keys)
    kept = top_n_per_group(
        stats.withColumn("_all", F.lit(0)),
        ["_all", *group],
        [F.desc("cf"), F.asc("term")],
        max_features,
        spread_by=["term"],
    )
    by_name = Window.partitionBy("_all", *group).orderBy("term")
    return kept.withColumn("term_idx", F.row_number().over(by_name) - 1).select(
        *group, "term", "term_idx", "df", "cf"
    )


def smooth_idf(n_docs: Column, df: Column) -> Column:
    return F.ln((F.lit(1.0) + n_docs) / (F.lit(1.0) + df)) + F.lit(1.0)


def fit_vocabulary(
    df: DataFrame,
    tokens: Column | str,
    max_features: int = 1000,
    keys: Sequence[str] = (),
    stop_words: DataFrame | None = None,
) -> DataFrame:
    """``*keys, term, term_idx, df, cf, n_docs, idf``, settled once for all its uses."""
    group = list(keys)
    stats = term_stats(bag_of_words(df, tokens, group, stop_words), group)
    sizes = df.groupBy(*group).agg(F.count("*").alias("n_docs")) if group else df.agg(F.count("*").alias("n_docs"))
    return _weighed(stats, sizes, max_features, group)


def _weighed(stats: DataFrame, sizes: DataFrame, max_features: int, group: list[str]) -> DataFrame:
    """The vocabulary of term counts, with the number of reviews ``n_docs`` of each group and the IDF."""
    kept = vocabulary(stats, max_features, group)
    joined = kept.join(sizes, group) if group else kept.withColumn("n_docs", sizes.scalar())
    return settle(
        joined.select(
            *group, "term", "term_idx", "df", "cf", "n_docs",
            smooth_idf(F.col("n_docs"), F.col("df")).alias("idf"),
        ),
        "vocabulary",
    )


def corpus_counts(
    df: DataFrame, tokens: Column, keys: Sequence[str] = (), stop_words: DataFrame | None = None
) -> DataFrame:
    """``*keys, term, df, cf``: what ``term_stats`` counts, and under the NULL term how many reviews there are.

    Counts of disjoint reviews add up (``merge_counts``), so texts that have been counted are never read again.
    """
    group = list(keys)
    stats = term_stats(bag_of_words(df, tokens, group, stop_words), group).select(*group, "term", "df", "cf")
    none, zero = F.lit(None).cast("string").alias("term"), F.lit(0).cast("bigint").alias("cf")
    sizes = df.groupBy(*group).agg(F.count("*").alias("df")) if group else df.agg(F.count("*").alias("df"))
    return stats.unionByName(sizes.select(*group, none, "df", zero))


def merge_counts(counts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The counts of all reviews from those of their parts, one under another."""
    sums = [F.sum(c).cast("bigint").alias(c) for c in ("df", "cf")]
    return counts.groupBy(*keys, "term").agg(*sums)


def counted_vocabulary(counts: DataFrame, max_features: int = 1000, keys: Sequence[str] = ()) -> DataFrame:
    """``fit_vocabulary`` from merged counts, without the texts."""
    group = list(keys)
    sizes = counts.where("term IS NULL").select(*group, F.col("df").alias("n_docs"))
    return _weighed(counts.where("term IS NOT NULL"), sizes, max_features, group)


def tfidf(
    bag: DataFrame, vocab: DataFrame, keys: Sequence[str] = (), keep: Sequence[str] = ()
) -> DataFrame:
    """``*keys, *keep, Id, term, term_idx, weight``: ``tf * idf`` scaled to length 1 per review.

    ``keys`` pair a review with its group's vocabulary; ``keep`` is only carried. Rows meet the vocabulary before anything moves; the one shuffle is by ``Id``, which is
    unique per review and so cannot be skewed.
    """
    raw = bag.join(vocab.select(*keys, "term", "term_idx", "idf"), [*keys, "term"]).withColumn(
        "_w", F.col("tf") * F.col("idf")
    )
    length = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy("Id")))
    return raw.withColumn("weight", F.col("_w") / length).select(
        *keys, *keep, "Id", "term", "term_idx", "weight"
    )


def count_vectors(
    df: DataFrame, tokens: Column, terms: Sequence[str], out: str = "counts"
) -> DataFrame:
    """Sparse term counts over a given vocabulary, one vector per review."""
    if not terms:
        raise ValueError("the vocabulary is empty")
    model = CountVectorizerModel.from_vocabulary(list(terms), inputCol="_tokens", outputCol=out)
    return model.transform(df.withColumn("_tokens", tokens)).drop("_tokens")


def tfidf_vectors(df: DataFrame, tokens: Column, vocab: DataFrame, out: str = "features") -> DataFrame:
    """The weights of ``tfidf`` as one sparse vector per review, for model fitting.

    ``vocab`` is the vocabulary of one group, at most ``max_features`` rows, and becomes
    the parameters of three row-local transformers.
    """
    rows = vocab.select("term", "idf").orderBy("term_idx").collect()
    counted = count_vectors(df, tokens, [r["term"] for r in rows], out="_counts")
    weigh = ElementwiseProduct(
        scalingVec=Vectors.dense([r["idf"] for r in rows]), inputCol="_counts", outputCol="_raw"
    )
    scale = Normalizer(p=2.0, inputCol="_raw", outputCol=out)
    return scale.transform(weigh.transform(counted)).drop("_counts", "_raw")


def word_frequencies(
    df: DataFrame, text_col: str = "Text", stop_words: DataFrame | None = None, n: int = 200
) -> DataFrame:
    """The ``n`` most frequent words over all reviews: ``term, cf``."""
    stats = term_stats(bag_of_words(df, text.terms(F.col(text_col)), (), stop_words))
    return stats.select("term", "cf").orderBy(F.desc("cf"), "term").limit(n)
