import itertools
import math

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from reviewlens.llm import components, simhash
from tests.llm.conftest import ODD, SMALL


def brute_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\x0b", " ").replace("\x0c", " ")
             .replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(rows):
    """(id, fingerprint, smallest id of the group) per row."""
    prints = [brute_fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        if bin(prints[i] ^ prints[j]).count("1") <= 4:
            old, new = group[j], group[i]
            group = [new if g == old else g for g in group]
    least = {}
    for (i, _), g in zip(rows, group):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    return [(i, f"{p:016x}", least.get(g)) for (i, _), p, g in zip(rows, prints, group)]


def test_query_by_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = [tuple(r) for r in simhash.op1_simhash(spark, SMALL).collect()]
    assert sorted(got) == sorted(brute_groups(rows))


def test_odd_rows(documents):
    df = simhash.groups(documents(ODD), 4, 4)
    got = [(r.doc_id, f"{r.fp & (1 << 64) - 1:016x}", r.component_id) for r in df.collect()]
    expected = brute_groups([(i, t) for i, t, _ in ODD])
    assert sorted(got, key=repr) == sorted(expected, key=repr)


@pytest.mark.parametrize("segments", [2, 3, 4, 5])
def test_links_by_all_pairs(spark, segments):
    random, most = np.random.default_rng(segments), 4
    base = random.integers(0, 1 << 62, 40)
    near = [int(b) ^ sum(1 << int(x) for x in random.choice(64, k, replace=False)) for b in base for k in range(6)]
    prints = sorted({n - (1 << 64) if n >> 63 else n for n in near})
    df = spark.createDataFrame([(p,) for p in prints], "fp bigint")
    found = {frozenset(r) for r in simhash.near_fingerprints(df, most, segments).collect()}
    pairs = itertools.combinations(prints, 2)
    assert found == {frozenset(p) for p in pairs if bin((p[0] ^ p[1]) & (1 << 64) - 1).count("1") <= most}


def test_segments_follow_the_number_of_fingerprints(spark):
    chosen = [simhash.best_segments(10**k, 4) for k in range(4, 12)]
    assert chosen == sorted(chosen, reverse=True) and chosen[-1] == 2
    for k in (6, 8, 10):
        rows = min(simhash.expected_rows(10**k, simhash.segment_plan(4, s)) for s in (2, 3, 4, 5)) / 10**k
        assert rows < 1000
    random = np.random.default_rng(7)
    df = spark.createDataFrame([(int(x),) for x in random.integers(-(1 << 62), 1 << 62, 3000)], "fp bigint")
    for segments in (2, 3):
        plan = simhash.segment_plan(4, segments)
        keys = sum(df.select(F.size(simhash._keys(plan, ball)).alias("n")).agg(F.sum("n")).first()[0] for ball in (False, True))
        told = simhash.expected_rows(3000, plan) - sum(3000**2 * sum(math.comb(w, i) for i in range(r + 1)) / 2 ** (w + 1) for _, w, r in plan)
        assert abs(keys - told) < 0.02 * told


def test_components_of_a_path_a_star_and_a_loop(spark):
    path = [(i, i + 1) for i in range(40, 0, -1)]
    star = [(100, i) for i in range(101, 140)] + [(139, 99)]
    df = spark.createDataFrame([*path, *star, (7, 7), (3, 2), (2, 3)], "a bigint, b bigint")
    got = {r.node: r.root for r in components.components(df, "a", "b", "test").collect()}
    assert got == {i: 1 for i in range(1, 42)} | {i: 99 for i in range(99, 140)}


def test_keep_one(documents):
    df = documents(ODD)
    kept = simhash.keep_one(df, 4, 4)
    assert kept.columns == df.columns
    groups = {g for _, _, g in brute_groups([(i, t) for i, t, _ in ODD])}
    # one row a group; the row without an id and with a text of its own is a group, too
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(g for g in groups if g is not None)
    assert ids.count(None) == 1


def test_empty(documents):
    df = documents(ODD).limit(0)
    assert simhash.groups(df, 4, 4).count() == 0 and simhash.keep_one(df, 4, 4).count() == 0
