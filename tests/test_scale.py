"""Plans and guards that matter when tables grow."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewlens.functions import text
from reviewlens.operators import attribution, charts, coherence, helpfulness, lexicon, ranking, terms, topics
from reviewlens.schema import require_key
from reviewlens.session import release, scratch_path, settle, settled_count, shared_dir


def exchanges(df):
    """What the plan shuffles by, without adaptive execution."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = df._jdf.queryExecution().sparkPlan().toString() + df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    return set(re.findall(r"hashpartitioning\(([^)]*)", plan))


def test_coherence_moves_ranges_by_review_only(spark):
    texts = [(i, f"c{i % 3}", " ".join(f"w{(i * j) % 60}" for j in range(40))) for i in range(60)]
    df = spark.createDataFrame(texts, "Id bigint, category string, clean_text string")
    pairs = [(f"c{c}", f"w{a}", f"w{b}") for c in range(3) for a in range(60) for b in range(a, 60, 7)]
    counted = coherence.pair_counts(df, spark.createDataFrame(pairs, "category string, a string, b string"), ["category"])
    keys = exchanges(counted)
    assert not any(k.startswith("word#") for k in keys), keys
    assert any(k.startswith("Id#") for k in keys)


def test_samples_move_no_reviews(spark, folder):
    spark.range(5000).select(F.col("id").alias("Id"), (F.col("id") % 3).alias("g")).write.parquet(f"{folder}/ids")
    df = spark.read.parquet(f"{folder}/ids")
    for keys in ([], ["g"]):
        assert not any("Id#" in k or "_h#" in k for k in exchanges(ranking.sample_reviews(df, 100, keys)))


def test_no_word_is_common_to_all_reviews(spark):
    df = spark.createDataFrame([(1, "a b"), (2, ""), (3, "c")], "Id bigint, t string")
    words = df.select("Id", F.inline(lexicon._neighbours(F.array_remove(F.split("t", " "), ""))))
    assert sorted(r.word for r in words.collect()) == ["a", "b", "c"]


def test_key_must_be_present_and_unique(spark):
    require_key(spark.createDataFrame([(1,), (2,)], "Id bigint"), "Id")
    for rows in ([(1,), (1,)], [(1,), (None,)]):
        with pytest.raises(ValueError, match="Id must be unique"):
            require_key(spark.createDataFrame(rows, "Id bigint"), "Id")


def test_boxplot_equals_numpy(spark):
    random = np.random.default_rng(3)
    values = [(float(random.integers(1, 4)), float(x)) for x in random.normal(0, 0.3, 500)] + [(2.0, 0.25)] * 50 + [(5.0, 0.1)]
    df = spark.createDataFrame(values, "score_mean double, sentiment_mean double")
    for r in charts.sentiment_boxplot(df, cells=16).collect():
        own = [v for s, v in values if s == r.rating]
        assert r.n_products == len(own)
        assert [r.lowest, r.q1, r.median, r.q3, r.highest] == pytest.approx(np.quantile(own, [0, 0.25, 0.5, 0.75, 1]))


def test_category_without_reviews_scores_zero(spark):
    rows = [(i, "c", f"tea cup kettle w{i % 5}") for i in range(20)]
    df = spark.createDataFrame(rows, "Id bigint, predicted_category string, clean_text string")
    vocab = terms.fit_vocabulary(df, text.terms(F.col("clean_text")), 10, ["predicted_category"])
    vocab = vocab.union(vocab.limit(3).withColumn("predicted_category", F.lit("none")))
    models = topics.fit_all_topics(topics.topic_vectors(df, vocab), vocab, (2, 3), passes=2)
    scores = {(r.category, r.k): r.coherence for r in topics.coherence_sweep(df, models).collect()}
    assert scores["none", 2] == scores["none", 3] == 0.0 and set(scores) == {(c, k) for c in ("c", "none") for k in (2, 3)}


def test_shared_folder_is_named_on_a_cluster():
    class Session:
        def __init__(self, master, named=None):
            self.sparkContext, self.conf = self, self
            self.master, self.names = master, {"spark.checkpoint.dir": named, "spark.sql.warehouse.dir": "/warehouse"}

        def get(self, name, default=None):
            return self.names[name] or default

        def getCheckpointDir(self):
            return None

    for master in ("local-cluster[2,1,1024]", "yarn", "spark://host:7077"):
        assert shared_dir(Session(master, "s3a://b/work/")) == "s3a://b/work"
        with pytest.raises(ValueError, match="checkpoint"):
            shared_dir(Session(master))
    assert shared_dir(Session("local[4]")) == shared_dir(Session("local")) == "/warehouse/reviewlens-work"


def test_settled_tables_are_released(spark):
    mark = settled_count()
    settle(spark.range(3).toDF("x"), "some")
    path = scratch_path(spark, "other")
    spark.range(2).write.parquet(path)
    release(spark, mark)
    assert settled_count() == mark
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_attribution_uses_every_task(spark, monkeypatch):
    leaves = attribution.Node(2.0), attribution.Node(-1.0)
    tree = attribution.Node(0.0, 0, 0.5, *leaves, 0.25, 0.75)
    monkeypatch.setattr(attribution, "model_trees", lambda *_: [tree])
    scaled = spark.createDataFrame([(i, float(i % 2)) for i in range(200)], "Id bigint, rating double").coalesce(1)
    values = attribution.shap_values(helpfulness.HelpfulnessModel(None, ["rating"]), scaled)
    rows = values.withColumn("part", F.spark_partition_id()).collect()
    assert len({r.part for r in rows}) == int(spark.conf.get("spark.sql.shuffle.partitions")) > 1
    assert sorted((r.Id, r.phi[0] + r.base) for r in rows) == [(i, pytest.approx(-1.0 if i % 2 else 2.0)) for i in range(200)]


def test_feature_tables_count_terms_once(spark, monkeypatch):
    """The texts are counted into one settled table, from which both vocabulary and weights are made."""
    rows = [(1, "c", "b a b x1"), (1, "c", "b cc cc"), (2, None, "a b"), (None, "d", "zz zz"), (3, "d", ""), (4, "d", None)]
    df = spark.createDataFrame(rows, "Id bigint, category string, t string")
    tokens = F.split("t", " ")
    mark = settled_count()
    kept = terms.kept_counts(df, tokens, ["category"], by="category")
    for stop in (None, spark.createDataFrame([("b",)], "word string")):
        made = [sorted(map(str, terms.bag_of_words(d, t, ["category"], stop).select("category", "Id", "term", "tf").collect())) for d, t in ((df, tokens), (kept, terms.COUNTS))]
        assert made[0] == made[1] and made[0]
        fitted = [sorted(map(str, terms.fit_vocabulary(d, t, 3, ["category"], stop).collect())) for d, t in ((df, tokens), (kept, terms.COUNTS))]
        assert fitted[0] == fitted[1] and fitted[0]

    from querybook import queries

    counted, count = [], text.term_counts
    monkeypatch.setattr(text, "term_counts", lambda t: counted.append(t) or count(t))
    monkeypatch.setattr(queries.fx, "prepared", lambda spark, sf: df.withColumnRenamed("t", "clean_text"))
    made = {r.category: (r.n_rows, r.n_terms) for r in queries.feature_tables_roundtrip(spark, "").collect()}
    assert made == {"c": (2, 2), "d": (1, 1)} and len(counted) == 1
    release(spark, mark)
