"""Readers and writers."""

import pytest
from pyspark.sql import functions as F

from reviewlens.operators.prepare import fill_text
from reviewlens.schema import RAW_REVIEWS
from reviewlens.sources import reviews, snapshots, tables

ROWS = [
    (1, "p1", 1, 2, 5, 1_000_000_000, "quoted \"word\", comma", "two\nlines, and \"\"quotes\"\""),
    (2, "p2", 0, 0, 1, 0, "", "  kept blanks  "),
    (3, "p1", 3, 2, 3, 5, None, None),
]


def test_csv_round_trip(spark, folder):
    df = spark.createDataFrame(ROWS, RAW_REVIEWS)
    reviews.write_reviews_csv(df, f"{folder}/csv")
    back = fill_text(reviews.read_reviews(spark, f"{folder}/csv"))
    assert sorted(back.collect()) == sorted(fill_text(df).collect())


def test_csv_columns_are_picked_by_name(spark, folder):
    df = spark.createDataFrame(ROWS, RAW_REVIEWS).withColumn("ProfileName", F.lit("x"))
    reviews.write_reviews_csv(df.select(*sorted(df.columns, reverse=True)), f"{folder}/csv")
    back = reviews.read_reviews(spark, f"{folder}/csv")
    assert back.schema.names == RAW_REVIEWS.names
    assert {r["Id"]: r["Score"] for r in back.collect()} == {1: 5, 2: 1, 3: 3}


def test_malformed_and_missing_columns_fail(spark, folder):
    df = spark.createDataFrame(ROWS, RAW_REVIEWS)
    bad = df.withColumn("Score", F.lit("five"))
    bad.write.option("header", True).csv(f"{folder}/bad")
    with pytest.raises(Exception, match="column Score holds"):
        reviews.read_reviews(spark, f"{folder}/bad").collect()
    df.drop("Id").write.parquet(f"{folder}/short")
    with pytest.raises(ValueError, match="Id"):
        reviews.read_reviews(spark, f"{folder}/short", "parquet")


def test_files_with_another_header_fail(spark, folder):
    df = spark.createDataFrame(ROWS, RAW_REVIEWS)
    for part, columns in (("a", df.columns), ("b", df.columns[::-1])):
        reviews.write_reviews_csv(df.select(*columns).coalesce(1), f"{folder}/csv/{part}")
    with pytest.raises(Exception, match="(?i)header"):
        reviews.read_reviews(spark, f"{folder}/csv/*").collect()


def test_newest_complete_run_is_read(spark, folder):
    df = spark.createDataFrame([(1, "007"), (2, "Food & Beverages")], "Id long, predicted_category string")
    with pytest.raises(FileNotFoundError):
        snapshots.latest_snapshot(spark, folder)
    snapshots.write_snapshot(df, folder, "a")
    snapshots.write_snapshot(df.withColumn("Id", F.col("Id") + 10), folder, "b")
    snapshots.write_snapshot(df, folder, "c")
    (__import__("pathlib").Path(folder) / "run_ts=c" / "_SUCCESS").rename(f"{folder}/unfinished")
    got = snapshots.latest_snapshot(spark, folder)
    assert sorted(tuple(r) for r in got.select("Id", "predicted_category").collect()) == [
        (11, "007"), (12, "Food & Beverages"),
    ]


def test_absent_results_are_left_out(spark, folder):
    df = spark.createDataFrame([("a", 1)], "category string, n int")
    tables.write_results({"one": df}, folder, "r1")
    found = tables.load_results(spark, folder, ["one", "two"])
    assert list(found) == ["one"] and found["one"].count() == 1
    assert tables.load_result(spark, folder, "two") is None


def test_features_of_one_category(spark, folder):
    rows = spark.createDataFrame([("a", 1, "x", 0.5), ("b", 2, "y", 1.0)], "category string, Id long, term string, weight double")
    tables.write_features(rows, rows.select("category", "term"), folder, "r1")
    features, vocab = tables.load_features(spark, folder, "b")
    assert [r["Id"] for r in features.collect()] == [2] and vocab.count() == 1
    with pytest.raises(FileNotFoundError):
        tables.load_features(spark, f"{folder}/none")


def test_pruned_scan_reads_four_columns(spark, folder):
    spark.createDataFrame(ROWS, RAW_REVIEWS).write.parquet(f"{folder}/p")
    df = reviews.pruned_scan(reviews.read_reviews(spark, f"{folder}/p", "parquet"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Helpfulness" not in plan and "Summary" not in plan
    assert dict(df.dtypes)["Score"] == "tinyint"
