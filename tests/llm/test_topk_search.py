import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewlens.llm import topk_search
from tests.llm.conftest import SMALL

VECTORS = "vec_id bigint, embedding array<float>, row string, q string, score string, v string"


def brute(rows, k, scale=1024):
    """(query, rank, id, score) by Python's whole numbers, one row against all others."""
    whole = [
        (i, None if v is None or any(x is None or not math.isfinite(x) for x in v) else [math.floor(scale * float(np.float32(x))) for x in v])
        for i, v in rows
    ]
    out = []
    for at, (i, q) in enumerate(whole):
        if q is None or i is None or i % 100:
            continue
        scored = [(-sum(a * b for a, b in zip(q, v)), j is None, j) for n, (j, v) in enumerate(whole) if v is not None and n != at]
        scored = sorted(scored, key=lambda x: (max(-(2**63) + 1, min(2**63, x[0])), x[1], x[2] or 0))[:k]
        out += [(i, rank, j, max(-(2**63), min(2**63 - 1, -s))) for rank, (s, _, j) in enumerate(scored, 1)]
    return sorted(out, key=repr)


def made(spark, rows, **more):
    df = spark.createDataFrame([(i, v, "x", "x", "x", "x") for i, v in rows], VECTORS)
    found = topk_search.top_k(df, F.col("vec_id") % 100 == 0, **more)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(map(tuple, found.collect()), key=repr)


ODD = [
    (0, [0.5, -0.25, 0.0]), (100, [0.5, -0.25, 0.0]), (100, [0.5, -0.25, 0.0]), (200, []), (300, None), (400, [float("nan"), 1.0]),
    (500, [float("inf")]), (600, [1.0, None]), (None, [0.5, -0.25, 0.0]), (None, [9.0]), (7, [1.0]), (8, [0.0, 0.0, 0.0, 2.0]), (700, [0.0, 0.0, 1.5, -2.0]),
    (9, [-1.0, 1e-9, -1e-9]), (-100, [3.0, 3.0]),
]


@pytest.mark.parametrize("k", [1, 3, 50])
def test_odd_rows(spark, k):
    assert made(spark, ODD, k=k) == brute(ODD, k)


def test_many_ties_and_repeats_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "SCORES", 256)
    random.seed(5)
    rows = [(random.randrange(400) * 25, [random.choice((0.0, 0.0, 1 / 1024, -1 / 512)) for _ in range(random.randrange(6))]) for _ in range(400)]
    rows += [(1000, [0.25, 0.5])] * 200
    assert made(spark, rows, k=10, block_bytes=400) == brute(rows, 10)


def test_scores_beyond_64_bits_are_held(spark):
    rows = [(0, [2.0**45, 2.0**45, 1.0]), (1, [2.0**45, 2.0**45, 1.0]), (2, [-(2.0**50), 0.0, 1.0]), (3, [1.0, 1.0, 1.0])]
    assert made(spark, rows, k=5) == brute(rows, 5)


def test_query_by_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    assert sorted(map(tuple, topk_search.op11_topk_search(spark, SMALL).collect()), key=repr) == brute(rows, 10)


def test_empty(spark):
    assert made(spark, []) == [] and made(spark, [(1, [1.0])]) == [] and made(spark, [(100, [1.0])]) == []


def test_postings_hold_every_weight():
    lists = topk_search.postings(np.array([0, 2, 2, 5]), np.array([4, 0, 7, 0, 9]))
    assert {t: (r.tolist(), w.tolist()) for t, (r, w) in lists.items()} == {0: ([0, 2], [4, 7]), 2: ([2], [9])}
