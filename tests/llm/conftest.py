import pytest
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    """Makes a table of documents from texts, or from (id, text, source) rows, with clashing extra columns."""

    def make(rows):
        rows = [r if isinstance(r, tuple) else (i, r, f"s{i % 2}") for i, r in enumerate(rows)]
        df = spark.createDataFrame([(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows], DOCS)
        clash = ["size", "shard", "fp", "score", "t1", "key", "hit", "id", "raw", "llm_row", "bucket"]
        return df.withColumns({c: F.lit("x") for c in clash})

    return make


#: Nulls, empty and blank texts, ties and repeats, one long text, and passages that several share.
PASSAGE = " ".join(f"shared{i}" for i in range(60))
ODD = [
    (1, None, "a"),
    (2, "", "a"),
    (3, " \t\n\x0b", None),
    (4, "one", "b"),
    (5, "One two\nthree\n\nfour five", "b"),
    (5, "One two\nthree\n\nfour five", "b"),
    (None, "no id here\nat all", "a"),
    (None, None, None),
    (6, f"before {PASSAGE} after\nline\nline", "c"),
    (7, f"other words {PASSAGE}", "c"),
    (8, "é" * 300 + " x\x00y", "c"),
    (9, "a" * 900, "a"),
    (10, "ab" * 700, None),
    (11, "\n".join(f"word{i % 700} and {i * i % 97}" for i in range(30000)), "b"),
    (12, "ONE", "b"),
    (-3, "one", "b"),
]
