"""All stages in a row on a small review file."""

from pyspark.ml import PipelineModel
from pyspark.ml.regression import GBTRegressionModel

from reviewlens.operators import topics
from reviewlens.operators.attribution import gain_importance
from reviewlens.operators.helpfulness import HelpfulnessModel
from reviewlens.operators.sentiment_model import SentimentModel, score_sentiment
from reviewlens.plans import stages
from reviewlens.schema import FEATURES, RAW_REVIEWS
from reviewlens.sources import models, reviews, tables

SUBJECTS = {
    "Tea & Coffee": ["tea", "coffee", "kettle", "mug", "brew", "leaf"],
    "Pet Supplies": ["dog", "leash", "collar", "bowl", "puppy", "kennel"],
}
MOODS = {1: "bad awful", 2: "bad", 3: "plain", 4: "good", 5: "very good great"}


def make_reviews(n=240):
    rows = []
    for i in range(n):
        words = list(SUBJECTS.values())[i % 2]
        score = i * 7 % 5 + 1
        picked = " ".join(words[(i // 2 + j) % 6] for j in range(4))
        text = f"The {picked} was {MOODS[score]}, {'really ' * (i % 4)}{words[i % 6]}.\nBought {i % 9}."
        rows.append((i, f"p{i % 4}", i % 3, i % 4, score, 86400 * 11 * i, words[0], text))
    return rows


def test_run_all(spark, folder):
    reviews.write_reviews_csv(spark.createDataFrame(make_reviews(), RAW_REVIEWS), f"{folder}/csv")
    params = stages.Parameters(
        keywords=spark.createDataFrame(
            [(c, w) for c, ws in SUBJECTS.items() for w in ws], "category string, keyword string"
        ),
        negatives=spark.createDataFrame([("Pet Supplies", "sauce")], "category string, keyword string"),
        lexicon=spark.createDataFrame(
            [("good", 0.7, 0.6), ("bad", -0.7, 0.6), ("great", 0.8, 0.7), ("awful", -1.0, 1.0)],
            "word string, polarity double, subjectivity double",
        ),
        modifiers=spark.createDataFrame([("very", "intensifier", 1.3)], "word string, kind string, factor double"),
        stop_words=stages.english_stop_words(spark),
    )
    root, raw = f"{folder}/out", reviews.read_reviews(spark, f"{folder}/csv")
    found = stages.process_reviews(raw, params, root, "r1", negatives_per_sample=1)
    found |= stages.model_topics(spark, root, "r1", counts=(2, 3), passes=3)
    found |= stages.analyse_sentiment(spark, root, "r1")
    found |= stages.predict_helpfulness(spark, root, "r1", n_trees=4)
    found |= stages.analyse_impact(spark, root, "r1")
    found |= stages.chart_tables(spark, root, "r1", params.stop_words)

    assert tables.published_runs(spark, root) == []
    listed = tables.publish_run(spark, root, "r1")
    assert set(found) <= set(listed) and set(listed.values()) == {"r1"}

    done = stages.load_processed(spark, root)
    assert done.count() == 240
    assert {r["category"]: r["n_reviews"] for r in found["category_distribution"].collect()} == {
        "Tea & Coffee": 120, "Pet Supplies": 120,
    }
    shares = found["topic_distributions"].collect()
    assert len(shares) == 240 and all(abs(sum(r["topics"]) - 1) < 1e-6 for r in shares)
    assert found["coherence_scores"].count() == 4
    quality = {r["metric"]: r["value"] for r in found["sentiment_metrics"].collect()}
    assert quality["accuracy"] > 0.6
    assert found["feature_importance"].count() == 9
    assert found["recommendations"].count() == 2
    correlated = found["term_sentiment"].collect()
    assert {r["category"] for r in correlated} == set(SUBJECTS)
    assert found["chart_features"].count() == 9 and found["chart_coherence"].count() == 2
    assert found["chart_topics"].count() > 0 and found["chart_sentiment_box"].count() > 0
    assert {"chart_ratings", "chart_words", "chart_timeline", "chart_sentiment_months"} <= set(found)

    kept = topics.read_models(tables.load_result(spark, root, "topic_models", by="category"))
    assert [m.category for m in kept] == sorted(SUBJECTS) and all(len(m.weights) == m.k for m in kept)
    assert found["topic_perplexity"].count() == len(kept) == 2
    ((_, _, whole),) = models.load_models(spark, "sentiment_models", root, PipelineModel)
    again = score_sentiment(SentimentModel.of(whole), done.select("Id", "Text", "Score"))
    assert again.count() == 240
    ((_, _, trees),) = models.load_models(spark, "helpfulness_models", root, GBTRegressionModel)
    assert gain_importance(HelpfulnessModel(trees, FEATURES), spark).count() == 9


def test_a_run_that_dies_midway_leaves_the_earlier_one_whole(spark, folder, monkeypatch):
    """The second run fails in its fourth stage: every table is still read from the first."""
    root, steps = f"{folder}/out", ["process_reviews", "model_topics", "analyse_sentiment", "predict_helpfulness", "analyse_impact", "chart_tables"]

    def stage(name, value, fails):
        def run(first, *args, **more):
            run_ts = next(a for a in reversed(args) if a in ("r1", "r2"))
            if fails:
                raise RuntimeError("lost")
            df = spark.createDataFrame([(1, value)], "Id long, value string")
            return stages._write({name: df}, root, run_ts)

        return run

    params = stages.Parameters(*[None] * 5)
    spark.createDataFrame(make_reviews(2), RAW_REVIEWS).write.parquet(f"{folder}/in")
    for run_ts, dies in (("r1", None), ("r2", "predict_helpfulness")):
        for name in steps:
            monkeypatch.setattr(stages, name, stage(name, run_ts, name == dies))
        try:
            stages.run_all(spark, f"{folder}/in", params, root, run_ts, "parquet")
        except RuntimeError:
            assert dies
    assert tables.published_runs(spark, root) == ["r1"]
    found = tables.load_results(spark, root, steps)
    assert {n: [r.value for r in df.collect()] for n, df in found.items()} == {n: ["r1"] for n in steps}
    # the run at hand sees its own tables first; published with the rest carried over, it is read by all
    assert tables.load_result(spark, root, "model_topics", run_ts="r2").first().value == "r2"
    assert tables.load_result(spark, root, "chart_tables", run_ts="r2").first().value == "r1"
    assert tables.publish_run(spark, root, "r2", carry_over=True)["chart_tables"] == "r1"
    found = tables.load_results(spark, root, steps)
    assert [found[n].first().value for n in steps] == ["r2"] * 3 + ["r1"] * 3
    assert tables.run_tables(spark, root, "r1") == {n: "r1" for n in steps}
