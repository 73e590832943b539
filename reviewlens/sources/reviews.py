"""Raw reviews from CSV or Parquet."""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlens.schema import RAW_REVIEWS, require
from reviewlens.sources.csv_records import records

CSV_DIALECT = {"header": True, "quote": '"', "escape": '"'}


def _typed(name: str, dtype) -> Column:
    """Cast that fails on a malformed value instead of turning it into NULL."""
    raw, value = F.col(name), F.col(name).try_cast(dtype)
    bad = raw.isNotNull() & value.isNull()
    message = F.concat(F.lit(f"column {name} holds "), raw.cast("string"))
    return F.when(bad, F.raise_error(message).cast(dtype)).otherwise(value).alias(name)


def _csv_table(spark: SparkSession, path: str) -> DataFrame:
    """All columns of quoted CSV files as texts, by the names in their common header."""
    headers, found = records(spark, path)
    told = {tuple(next(csv.reader([r["record"]]))) for r in headers.limit(100).collect()}
    if len(told) > 1:
        raise ValueError(f"the files under {path} have different headers: {sorted(told)[:2]}")
    names = [*told.pop()] if told else []
    if not names:
        return spark.createDataFrame([], "none string")
    fields = ", ".join(f"c{i} string" for i in range(len(names)))
    dialect = {"quote": '"', "escape": '"', "multiLine": "true"}
    parsed = found.select(F.from_csv("record", fields, dialect).alias("row")).select("row.*")
    return parsed.toDF(*[name or f"_c{i}" for i, name in enumerate(names)])


def read_reviews(
    spark: SparkSession, path: str, fmt: str = "csv", multi_line: bool = True
) -> DataFrame:
    """Reviews with the fixed column set, picked by name from a wider file.

    All CSV files under ``path`` must have the same header; one that differs is an error.

    With ``multi_line``, texts may hold line breaks, and a file is still read in many tasks (see
    ``csv_records``), at the price of three passes over its lines. Without it, one pass does.
    """
    if fmt == "csv" and multi_line:
        table = _csv_table(spark, path)
    elif fmt == "csv":
        reader = spark.read.options(**CSV_DIALECT)
        texts = T.StructType([T.StructField(n, T.StringType()) for n in reader.csv(path).columns])
        table = reader.schema(texts).option("enforceSchema", False).csv(path)
    else:
        table = spark.read.format(fmt).load(path)
    require(table, *RAW_REVIEWS.fieldNames())
    return table.select(*[_typed(f.name, f.dataType) for f in RAW_REVIEWS.fields])


def write_reviews_csv(df: DataFrame, path: str) -> None:
    """Reviews as CSV files that ``read_reviews`` reads back unchanged."""
    (
        df.write.options(**CSV_DIALECT)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def pruned_scan(df: DataFrame) -> DataFrame:
    """The four columns the sentiment stage needs, the score as a byte."""
    return df.select("Text", F.col("Score").cast("tinyint").alias("Score"), "Time", "ProductId")
