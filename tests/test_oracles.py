"""Every registered query against its SQL twin, at the smallest scale; means near ties also at the next."""

import pytest

import __spark_entry__ as entry
from querybook.compare import connect, differences
from querybook.oracles import SQL
from querybook.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, con, name):
    assert differences(spark, con, SMALL, name) == []


def test_every_query_has_sql_and_is_registered():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() == 6


@pytest.mark.parametrize(
    "name", ["category_performance", "tfidf", "nb_predict", "coherence", "coherence_sample"]
)
def test_equals_sql_without_broadcasts(spark, con, name):
    """Small tables that outgrow a broadcast are shuffled, with the same result."""
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        assert differences(spark, con, SMALL, name) == []
    finally:
        spark.conf.set(limit, before)


@pytest.mark.parametrize("partitions", ["1", "4", "8"])
def test_rounded_means_do_not_depend_on_partitions(spark, partitions):
    """Many groups have means on an exact tie at this scale."""
    larger, before = SMALL.replace("0.001", "0.01"), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert differences(spark, connect(larger), larger, "category_month") == []
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
