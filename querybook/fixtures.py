"""The review table and the small parameter tables, for Spark and for SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlens.functions import text
from reviewlens.operators import terms
from reviewlens.operators.lexicon import lexicon_sentiment
from reviewlens.operators.prepare import clean_columns, fill_text, helpfulness_ratio, text_features

PARAMETERS = {
    "lexicon": """SELECT * FROM (VALUES
  ('the',0.2E0,0.3E0),('of',-0.1E0,0.2E0),('and',0.3E0,0.5E0),('to',0.5E0,0.6E0),('in',-0.3E0,0.4E0),('is',0.8E0,0.9E0),
  ('for',0.4E0,0.5E0),('with',0.6E0,0.7E0),('was',-0.6E0,0.8E0),('this',0.7E0,0.4E0),
  ('de',-0.2E0,0.3E0),('la',0.4E0,0.4E0),('que',0.9E0,0.8E0),('le',0.1E0,0.1E0),
  ('der',-0.5E0,0.6E0),('die',0.2E0,0.2E0),('und',0.3E0,0.3E0),('el',-0.4E0,0.5E0)
) AS v(word, polarity, subjectivity)""",
    "modifiers": """SELECT * FROM (VALUES
  ('that','negator',-0.5E0),('des','negator',-0.5E0),('by','intensifier',1.3E0),('en','intensifier',0.7E0)
) AS v(word, kind, factor)""",
    "stop_words": """SELECT * FROM (VALUES
  ('the'),('of'),('and'),('de'),('la'),('der'),('die'),('is'),('it'),('to')) AS v(word)""",
    "given_terms": """SELECT * FROM (VALUES
  (0,1,'the'),(0,2,'of'),(0,3,'and'),(0,4,'to'),(0,5,'in'),
  (1,1,'de'),(1,2,'la'),(1,3,'que'),(1,4,'le'),(1,5,'et'),
  (2,1,'der'),(2,2,'die'),(2,3,'und'),(2,4,'von'),(2,5,'den'),
  (3,1,'the'),(3,2,'de'),(3,3,'der'),(3,4,'que'),(3,5,'qqqq')
) AS v(topic, rnk, term)""",
}


def parameter(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(PARAMETERS[name])


SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf}/{name}.parquet")


def reviews(spark: SparkSession, sf: str) -> DataFrame:
    """One review per document. The narrow tables are joined first, so texts move once."""
    score = F.expr(
        "CASE event_type WHEN 'error' THEN 1 WHEN 'view' THEN 2 WHEN 'signup' THEN 3 "
        "WHEN 'click' THEN 4 ELSE 5 END"
    )
    time = F.expr("o_orderdate + (ts - CAST(CAST(ts AS DATE) AS TIMESTAMP_NTZ))")
    whole = F.floor("value").cast("bigint")
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value", "ts")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    part = table(spark, sf, "part").select("p_partkey", "p_type", "p_name")
    facts = events.join(orders, F.col("event_id") == F.col("o_orderkey")).join(
        part, F.col("event_id") == F.col("p_partkey")
    )
    documents = table(spark, sf, "documents").select("doc_id", "source", "lang", "text")
    votes = (whole * (F.col("doc_id") % 7) % (whole % 9 + 1)).cast("int")
    # both sides grow with the data, so this is a shuffle join at every size
    return documents.join(facts.hint("merge"), F.col("doc_id") == F.col("event_id")).select(
        F.col("doc_id").alias("Id"),
        F.col("source").alias("ProductId"),
        F.col("user_id").alias("UserId"),
        F.col("p_type").alias("category"),
        "lang",
        votes.alias("HelpfulnessNumerator"),
        (whole % 9).cast("int").alias("HelpfulnessDenominator"),
        score.alias("Score"),
        time.alias("Time"),
        F.col("p_name").alias("Summary"),
        F.col("text").alias("Text"),
    )


def prepared(spark: SparkSession, sf: str) -> DataFrame:
    """Reviews with every row-local column; unused ones are pruned from each plan."""
    ratio = fill_text(reviews(spark, sf)).withColumn("helpfulness_ratio", helpfulness_ratio())
    return text_features(clean_columns(ratio))


def scored(spark: SparkSession, sf: str, *keep: str) -> DataFrame:
    """``Id, *keep`` and the two lexicon scores."""
    return lexicon_sentiment(
        prepared(spark, sf), parameter(spark, "lexicon"), parameter(spark, "modifiers"), keep=keep
    )


def review_terms(spark: SparkSession, sf: str, *keys: str) -> DataFrame:
    """Bag of words of the cleaned texts, without stop words."""
    return terms.bag_of_words(
        prepared(spark, sf), text.terms(F.col("clean_text")), keys, parameter(spark, "stop_words")
    )


REVIEWS_SQL = """SELECT d.doc_id AS Id, d.source AS ProductId, e.user_id AS UserId, p.p_type AS category, d.lang AS lang,
  CAST(CAST(floor(e.value) AS BIGINT) * (d.doc_id % 7)
       % (CAST(floor(e.value) AS BIGINT) % 9 + 1) AS INT) AS HelpfulnessNumerator,
  CAST(CAST(floor(e.value) AS BIGINT) % 9 AS INT) AS HelpfulnessDenominator,
  CASE e.event_type WHEN 'error' THEN 1 WHEN 'view' THEN 2 WHEN 'signup' THEN 3
                    WHEN 'click' THEN 4 ELSE 5 END AS Score,
  o.o_orderdate + (e.ts - CAST(CAST(e.ts AS DATE) AS TIMESTAMP)) AS Time,
  p.p_name AS Summary, d.text AS Text
FROM documents d
JOIN events e ON e.event_id = d.doc_id
JOIN orders o ON o.o_orderkey = d.doc_id
JOIN part   p ON p.p_partkey  = d.doc_id"""
