"""Product categories: training texts from keyword lists, Naive Bayes, prediction."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewlens.functions import text
from reviewlens.operators.terms import bag_of_words, fit_vocabulary, tfidf
from reviewlens.session import settle

# Labels, and the category whose training texts are extended.
OTHER = "Other"
UNCATEGORIZED = "Uncategorized"
PETS = "Pet Supplies"

# The sentences of the training texts.
ABOUT, QUALITY, LOVED = "This is a {} review about {}. ", "The {} quality is good. ", "My pet loves this {}. "
UNRELATED = "This {} is not related to pets. "

# Words that speak against a category.
NEGATIVE_KEYWORDS = {
    "Pet Supplies": [
        "human food", "snack food", "candy", "chocolate", "beverage",
        "drink", "coffee", "tea", "juice", "soda", "cooking",
        "baking", "ingredient", "spice", "herb", "oil", "sauce",
    ]
}


def negative_keywords(spark: SparkSession) -> DataFrame:
    """The default ``category, keyword`` table of negative words."""
    rows = [(c, w) for c, ws in NEGATIVE_KEYWORDS.items() for w in ws]
    return spark.createDataFrame(rows, "category string, keyword string")


def _filled(sentence: str, *parts: Column) -> Column:
    """``sentence`` with a part in place of each ``{}``."""
    texts = [F.lit(t) for t in sentence.split("{}")]
    return F.concat(texts[0], *[c for pair in zip(parts, texts[1:]) for c in pair])


def _draw(*parts: Column) -> Column:
    return F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))


def synthetic_training(
    keywords: DataFrame,
    negatives: DataFrame,
    n: int = 200,
    negatives_per_sample: int = 50,
    extra_sentence: str = PETS,
) -> DataFrame:
    """``Id, label, text``: labelled texts made from keywords.

    Sample ``i`` of a category takes the ``3 + i % 3`` keywords of lowest hash, so the texts
    are the same on every run. A category with negative keywords adds, per sample,
    ``negatives_per_sample`` texts labelled ``Other``; at the defaults these are five sixths
    of a ten-category corpus, which sets the class priors.
    """
    draws = (
        keywords.select("category", "keyword")
        .distinct()
        .withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
        .withColumn("h", _draw(F.col("category"), F.col("i"), F.col("keyword")))
    )
    by_hash = Window.partitionBy("category", "i").orderBy("h", "keyword")
    picked = draws.withColumn("r", F.row_number().over(by_hash)).where(
        F.col("r") <= 3 + F.col("i") % 3
    )
    chosen = picked.groupBy("category", "i").agg(
        F.sort_array(F.collect_list(F.struct("r", "keyword"))).alias("picks")
    )
    names = F.transform(F.col("picks"), lambda p: p["keyword"])
    count = F.size(names).cast("bigint")

    def pick(salt: int) -> Column:
        return F.get(names, ((F.col("i") * 7 + salt) % count).cast("int"))

    body = F.concat(_filled(ABOUT, F.lower("category"), F.array_join(names, " and ")), _filled(QUALITY, pick(1)))
    pets = _filled(LOVED, pick(2))
    positive = chosen.select(
        F.concat_ws("|", "category", "i").alias("Id"),
        F.col("category").alias("label"),
        F.when(F.col("category") == extra_sentence, F.concat(body, pets)).otherwise(body).alias("text"),
    )
    slots = (
        negatives.select("category", "keyword")
        .distinct()
        .join(keywords.select("category").distinct(), "category", "left_semi")
        .withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
        .withColumn("j", F.explode(F.sequence(F.lit(1), F.lit(negatives_per_sample))))
    )
    lowest = F.min(F.struct(_draw(F.col("category"), F.col("i"), F.col("j"), F.col("keyword")), "keyword"))
    negative = (
        slots.groupBy("category", "i", "j")
        .agg(lowest.alias("low"))
        .select(
            F.concat_ws("|", "category", "i", "j").alias("Id"),
            F.lit(OTHER).alias("label"),
            _filled(UNRELATED, F.col("low.keyword")).alias("text"),
        )
    )
    return positive.unionByName(negative)


@dataclass
class CategoryModel:
    """A fitted classifier: classes with their log priors, and one settled row per term.

    ``table`` holds ``term, idf`` and the array ``ll`` of log likelihoods in class order; it
    has at most ``max_features`` rows.
    """

    labels: list[str]
    log_priors: list[float]
    table: DataFrame

    def parameters(self) -> DataFrame:
        """``label, term, log_prior, log_likelihood`` rows."""
        rows = [
            F.struct(
                F.lit(label).alias("label"),
                F.lit(prior).alias("log_prior"),
                F.get("ll", F.lit(i)).alias("log_likelihood"),
            )
            for i, (label, prior) in enumerate(zip(self.labels, self.log_priors))
        ]
        return self.table.select("term", F.inline(F.array(*rows)))


def fit_categories(
    training: DataFrame, max_features: int = 5000, stop_words: DataFrame | None = None
) -> CategoryModel:
    """Multinomial Naive Bayes with add-one smoothing on the TF-IDF weights of ``Id, label, text``."""
    training = settle(training.select("Id", "label", "text"), "training")
    tokens = text.terms(F.col("text"))
    vocab = fit_vocabulary(training, tokens, max_features, (), stop_words)
    weights = settle(
        tfidf(bag_of_words(training, tokens, ["label"]), vocab, keep=["label"]), "training-weights"
    )
    sizes = training.groupBy("label").agg(F.count("*").alias("n"))
    totals = weights.groupBy("label").agg(F.sum("weight").alias("total"))
    classes = sizes.join(totals, "label", "left").orderBy("label").collect()
    n_terms = vocab.count()
    n_docs = sum(c["n"] for c in classes)
    sums = weights.groupBy("term").agg(
        *[
            F.coalesce(F.sum(F.when(F.col("label") == c["label"], F.col("weight"))), F.lit(0.0)).alias(f"s{i}")
            for i, c in enumerate(classes)
        ]
    )
    likelihoods = [
        F.ln((F.col(f"s{i}") + 1.0) / ((c["total"] or 0.0) + n_terms)) for i, c in enumerate(classes)
    ]
    table = vocab.join(sums, "term").select("term", "idf", F.array(*likelihoods).alias("ll"))
    return CategoryModel(
        labels=[c["label"] for c in classes],
        log_priors=[math.log(c["n"] / n_docs) for c in classes],
        table=settle(table, "category-model"),
    )


def classify(
    df: DataFrame, model: CategoryModel, source: Column, keep: Sequence[str] = ()
) -> DataFrame:
    """``Id, *keep, predicted_category, category_confidence`` for every review.

    Term counts are made inside the row and meet the model's terms without moving; the sums
    per class collapse to one row per review before the only shuffle. What is summed is known terms, and
    each review's first term, or an empty row, known or not, so that a text without a known term
    gets the class priors. Equal probabilities go to the first class by name.
    """
    counted = df.select("Id", *keep, F.posexplode_outer(text.term_counts(text.terms(source))).alias("_at", "_term"))
    bag = counted.select("Id", *keep, "_at", F.col("_term.term").alias("term"), F.col("_term.tf").alias("tf"))
    n = len(model.labels)
    known = bag.join(model.table, "term", "left").where(F.col("idf").isNotNull() | (F.coalesce("_at", F.lit(0)) == 0))
    weight = F.col("tf") * F.col("idf")
    sums = known.groupBy("Id", *keep).agg(
        F.sqrt(F.sum(weight * weight)).alias("_length"),
        *[F.sum(weight * F.get("ll", F.lit(i))).alias(f"_s{i}") for i in range(n)],
    )
    logits = F.array(
        *[
            F.lit(p) + F.coalesce(F.try_divide(F.col(f"_s{i}"), F.col("_length")), F.lit(0.0))
            for i, p in enumerate(model.log_priors)
        ]
    )
    return sums.withColumn("_p", softmax(logits)).select(
        "Id",
        *keep,
        best_class(F.col("_p"), model.labels).alias("predicted_category"),
        F.array_max("_p").alias("category_confidence"),
    )


def softmax(logits: Column) -> Column:
    """Probabilities from an array of logits, shifted by the largest before ``exp``."""

    def shares(l: Column) -> Column:
        exps = F.transform(l, lambda x: F.exp(x - F.array_max(l)))
        total = F.aggregate(exps, F.lit(0.0), lambda a, x: a + x)
        return F.transform(exps, lambda e: e / total)

    return text.bind(logits, shares)


def best_class(probabilities: Column, labels: Sequence[str]) -> Column:
    """Label of the largest probability at 12 digits, the first by name on a tie."""
    names = F.array(*[F.lit(name) for name in labels])
    pairs = F.zip_with(
        probabilities, names, lambda p, name: F.struct((-F.round(p, 12)).alias("p"), name.alias("label"))
    )
    return F.array_min(pairs)["label"]


def apply_threshold(df: DataFrame, threshold: float) -> DataFrame:
    """Categories below ``threshold`` become ``Uncategorized``."""
    low = F.col("category_confidence") < threshold
    return df.withColumn(
        "predicted_category", F.when(low, UNCATEGORIZED).otherwise(F.col("predicted_category"))
    )


def low_confidence_count(df: DataFrame, threshold: float) -> DataFrame:
    return df.agg(F.count_if(F.col("category_confidence") < threshold).alias("n_low_confidence"))


def category_distribution(df: DataFrame, category: str = "predicted_category") -> DataFrame:
    """Reviews per category, the largest first."""
    return (
        df.groupBy(F.col(category).alias("category"))
        .agg(F.count("*").alias("n_reviews"))
        .orderBy(F.desc("n_reviews"), "category")
    )
