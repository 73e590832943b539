import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from querybook.compare import connect
from reviewlens.llm import mixing, sharding
from reviewlens.session import settle
from tests.llm.conftest import ODD, SMALL

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute_targets(sizes, weights=(5, 2, 1), limit=3):
    """Water filling one source at a time, in fractions."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = Fraction(sum(sizes.values())), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > limit * sizes[s]}
        if not full:
            return out | {s: level * weight[s] for s in open_}
        for s in full:
            out[s] = Fraction(limit * sizes[s])
            left -= out[s]
        open_ -= full
    return out


def check(rows, docs):
    sizes, taken = defaultdict(int), defaultdict(int)
    source = {}
    for i, t, s in docs:
        sizes[s] += len(WORD.findall(t or ""))
        source.setdefault((i, len(WORD.findall(t or ""))), s)
    targets = brute_targets(sizes)
    for r in rows:
        s = source[r.doc_id, r["size"]]
        assert r.source_size == sizes[s] and r.target == pytest.approx(float(targets[s]))
        assert 0 <= r.taken <= 3 * r["size"]
        taken[s] += r.taken
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= 2, s


def test_mix_of_odd_rows(documents):
    rows = mixing.mix(documents(ODD)).collect()
    assert len(rows) == len(ODD)
    check(rows, ODD)


def test_mix_with_scarce_and_tied_sources(documents):
    docs = [(i, "w " * (i % 7), f"s{i * i % 5}") for i in range(300)] + [(900 + i, "only few", "a") for i in range(3)]
    docs += [(500, "tie tie tie", "b")] * 4
    df = documents(docs)
    rows = mixing.mix(df).collect()
    check(rows, docs)
    again = mixing.mix(df.repartition(5)).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_mixed_gives_the_words_that_are_taken(documents):
    docs = [(i, f"w{i}  " * (1 + i % 9) + "\nend", f"s{i % 4}") for i in range(120)] + [(900, " few words here", "a"), (901, None, "b"), (902, "", "b")]
    df = documents(docs)
    out = mixing.mixed(df)
    assert out.columns == df.columns
    got, whole = defaultdict(int), {i: t for i, t, _ in docs}
    for r in out.collect():
        got[r.doc_id] += len(WORD.findall(r.text or ""))
        assert r.text is None and whole[r.doc_id] is None or whole[r.doc_id].startswith(r.text)
        assert r.n_chars == (None if r.text is None else len(r.text))
    taken = {r.doc_id: r.taken for r in mixing.mix(df).collect()}
    assert dict(got) == {i: n for i, n in taken.items() if n} | {i: 0 for i in got if not got[i]}


@pytest.mark.parametrize("hot", [["one"] * 200, [f"text {i} of many " + "w " * (i % 5) for i in range(200)]])
def test_rows_of_one_id_stay_whole_but_one(documents, hot):
    """A third of the rows have no id: whole texts, one at the most cut, sums as aimed."""
    docs = [(None, t, "a") for t in hot] + [(1000 + i, "w " * (1 + i % 7), f"s{i % 3}") for i in range(400)]
    sizes, df, weights = Counter(), documents(docs), (1, 9, 9, 9)
    for _, t, s in docs:
        sizes[s] += len(WORD.findall(t))
    target = round(brute_targets(sizes, weights)["a"])
    epochs, left = divmod(target, sizes["a"])
    assert left  # the cut is inside the rows without id
    rows = [r for r in mixing.mix(df, weights).collect() if r.doc_id is None]
    assert len(rows) == 200 and sum(r.taken for r in rows) == target
    assert sum(r.taken % r["size"] > 0 for r in rows) <= 1
    out = [r.text for r in mixing.mixed(df, weights).collect() if r.doc_id is None]
    assert sum(len(WORD.findall(t)) for t in out) == target
    assert sum((Counter(out) - Counter({t: n * (epochs + 1) for t, n in Counter(hot).items()})).values()) <= 1


def test_mixed_keeps_rows_that_differ_in_other_columns(documents):
    df = documents([(None, "two words", "a")] * 90 + [(i, "w " * 30, "b") for i in range(50)])
    df = df.withColumn("more", F.create_map(F.lit("k"), F.monotonically_increasing_id()))
    df = settle(df, "with-maps")
    out = [r for r in mixing.mixed(df, (1, 30)).collect() if r.doc_id is None]
    target = round(brute_targets({"a": 180, "b": 1500}, (1, 30))["a"])
    assert 0 < target < 180 and sum(len(WORD.findall(r.text)) for r in out) == target
    assert len({r.more["k"] for r in out}) == len(out) == -(-target // 2)


def test_no_words_and_no_rows(documents):
    assert [r.taken for r in mixing.mix(documents(["", None, " "])).collect()] == [0, 0, 0]
    empty = documents(["x"]).limit(0)
    assert mixing.mix(empty).count() == 0 and mixing.mixed(empty).count() == 0


def test_mix_equals_sql(spark):
    expected = connect(SMALL).execute(mixing.SQL).fetchall()
    assert sorted(map(tuple, mixing.op7_mixing(spark, SMALL).collect())) == sorted(expected)


def test_mix_of_repeated_ids_equals_sql(spark, documents, folder):
    """400 rows with 60 ids, some null, some rows equal throughout."""
    docs = [(None if i % 7 == 0 else i % 60, "w " * (i % 5) + f"t{i % 90}", f"s{i % 4}") for i in range(400)]
    df = documents(docs)
    df.write.parquet(f"{folder}/documents.parquet")
    sql = mixing.SQL.replace("FROM documents", f"FROM '{folder}/documents.parquet/*.parquet'")
    got = sorted(map(tuple, mixing.op7_mixing(spark, folder).collect()), key=repr)
    assert got == sorted(connect(folder).execute(sql).fetchall(), key=repr)


def test_shards_of_odd_rows(documents):
    df = documents(ODD + [(i, f"text {i}", "a") for i in range(100, 400)])
    out = sharding.sharded(df, [1.0] * 40, ranges=8)
    assert out.columns[: len(df.columns)] == df.columns  # its own columns get underscores where names clash
    rows = out.collect()
    slots = defaultdict(list)
    for r in rows:
        raw = (r.text or "").encode()
        assert (r.size_, r.text_crc32, r.law) == (len(raw) + 16, zlib.crc32(raw), "key")
        assert r.grown_shard in (r.shard_, 40)
        slots[r.shard_].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(rows) == len(ODD) + 300
    assert len({r.shard_ for r in rows if r.doc_id == 5}) == 1  # the key decides


def test_growing_moves_few_rows_and_weights_count(spark):
    ids = spark.range(20000).select(F.col("id").alias("doc_id"))
    shard = ids.select(
        sharding.rendezvous("doc_id", [1.0] * 9).alias("a"), sharding.rendezvous("doc_id", [1.0] * 10).alias("b"),
        sharding.rendezvous("doc_id", [3.0, 1.0]).alias("c"),
    ).collect()
    moved = [r for r in shard if r.a != r.b]
    assert {r.b for r in moved} == {9} and abs(len(moved) - 2000) < 200
    assert abs(sum(r.c == 0 for r in shard) - 15000) < 300


def test_sharding_query_and_no_rows(spark, documents):
    rows = sharding.op4_sharding(spark, SMALL).collect()
    assert len(rows) == 200 and {r.law for r in rows} == {"key"}
    assert sharding.sharded(documents(["x"]).limit(0), [1.0] * 3).count() == 0




def test_equal_rows_are_numbered_in_many_tasks(spark, documents):
    docs = documents([(None, None, "a")] * 3000 + [(5, "again", "a")] * 50 + [(i, f"text {i}", "a") for i in range(10, 1000)])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = sharding.sharded(docs, [1.0] * 3).withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    slots, equal, tasks = defaultdict(list), defaultdict(list), defaultdict(int)
    for r in rows:
        slots[r.shard_].append(r.slot)
        equal[r.doc_id, r.text].append(r.slot)
        tasks[r.task] += r.doc_id is None
    assert len(rows) == 4040 and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(max(s) - min(s) == len(s) - 1 for s in equal.values())  # neighbours
    assert max(tasks.values()) < 1500
