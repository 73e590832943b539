"""Column sets of the review tables."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

RAW_REVIEWS = T.StructType(
    [
        T.StructField("Id", T.LongType()),
        T.StructField("ProductId", T.StringType()),
        T.StructField("HelpfulnessNumerator", T.IntegerType()),
        T.StructField("HelpfulnessDenominator", T.IntegerType()),
        T.StructField("Score", T.IntegerType()),
        T.StructField("Time", T.LongType()),
        T.StructField("Summary", T.StringType()),
        T.StructField("Text", T.StringType()),
    ]
)

# Columns that stage 1 adds to a raw review.
PREPARED_COLUMNS = [
    "helpfulness_ratio",
    "clean_text",
    "clean_summary",
    "text_length",
    "summary_length",
    "word_count",
]

FEATURES = [
    "text_length",
    "word_count",
    "avg_word_length",
    "rating",
    "sentiment_score",
    "sentiment_magnitude",
    "rating_deviation",
    "hour",
    "day_of_week",
]


def require(df, *names: str) -> None:
    """Fail early, with the missing names, when a table lacks columns."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; the table has {df.columns}")


def require_key(df, name: str) -> None:
    """Fail early when a key column holds NULLs or repeats."""
    rows, known, distinct = df.agg(F.count("*"), F.count(name), F.count_distinct(name)).first()
    if known < rows or distinct < known:
        raise ValueError(f"{name} must be unique: {rows - known} NULLs, {known - distinct} repeats in {rows} rows")
