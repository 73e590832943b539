"""Corpus counts of parts against those of the whole."""

import pytest
from pyspark.sql import functions as F

from reviewlens.functions import text
from reviewlens.operators import terms
from reviewlens.sources import counts

WORDS = "tea cup kettle of the pot leaf brew mug green black".split()


@pytest.mark.parametrize("keys", [[], ["category"]])
def test_two_runs_merged_equal_one_run_over_both(spark, folder, keys):
    rows = [(i, "ab"[i * i % 3 % 2], " ".join(WORDS[(i * j) % len(WORDS)] for j in range(1 + i % 9))) for i in range(80)] + [(900, "a", "")]
    df = spark.createDataFrame(rows, "Id long, category string, clean_text string")
    stop = spark.createDataFrame([("of",), ("the",)], "word string")
    tokens = text.terms(F.col("clean_text"))
    whole = terms.fit_vocabulary(df, tokens, 5, keys, stop)
    for run, part in (("r1", "Id < 30"), ("r2", "Id >= 30")):
        counts.add_counts(df.where(part), tokens, folder, run, keys, stop)
    merged = terms.counted_vocabulary(counts.all_counts(spark, folder, keys), 5, keys)
    assert merged.columns == whole.columns
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, whole.collect()))
    first = terms.counted_vocabulary(counts.all_counts(spark, folder, keys, up_to="r1"), 5, keys)
    only = terms.fit_vocabulary(df.where("Id < 30"), tokens, 5, keys, stop)
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, only.collect()))


def test_a_run_is_counted_once(spark, folder):
    df = spark.createDataFrame([(1, "tea cup")], "Id long, clean_text string")
    counts.add_counts(df, text.terms(F.col("clean_text")), folder, "r1")
    with pytest.raises(Exception, match="(?i)exist"):
        counts.add_counts(df, text.terms(F.col("clean_text")), folder, "r1")
    with pytest.raises(FileNotFoundError):
        counts.all_counts(spark, f"{folder}/none")
