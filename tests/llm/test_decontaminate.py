import re
from hashlib import sha256

import pytest

from reviewlens.llm import decontaminate
from tests.llm.conftest import ODD, PASSAGE, SMALL

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, n=10):
    windows = {}
    for item, text in items:
        w = words(text)
        for k in range(max(1, len(w) - n + 1)) if w else ():
            windows.setdefault(tuple(w[k : k + n]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for size in sizes:
            for k in range(len(w) - size + 1):
                if owners := windows.get(tuple(w[k : k + size])):
                    hit |= set(range(k, k + size))
                    found |= owners
        ids = ",".join(sorted(map(str, found)))
        out.append((doc, len(w), len(hit), len(found), sha256(ids.encode()).hexdigest(), bool(hit)))
    return out


def test_query_by_brute_force(spark):
    docs, items = ([tuple(r) for r in spark.read.parquet(f"{SMALL}/{t}.parquet").select(k, "text").collect()]
                   for t, k in (("documents", "doc_id"), ("benchmark", "item_id")))
    got = decontaminate.op6_decontaminate(spark, SMALL).drop("spans").collect()
    assert sorted(map(tuple, got)) == sorted(brute(docs, items))


ITEMS = [(1, PASSAGE), (2, "One, TWO three!"), (3, None), (4, " .. "), (5, "ONE"), (6, "one two three"), (10, "É é"),
         (7, " ".join(f"shared{i}" for i in range(5, 20))), (7, "word1 and"), (None, "at all")]


@pytest.mark.parametrize("block", [1 << 20, 100])
def test_odd_rows_in_one_block_and_in_many(spark, documents, block):
    df = documents(ODD + [(30, "Été: É-é; one,two  three", "a")])
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    rows = decontaminate.hits(df, items, ["doc_id", "text"], "found", block_bytes=block).collect()
    docs = [(i, t) for i, t, _ in ODD] + [(30, "Été: É-é; one,two  three")]
    expected = brute(docs, [i for i in ITEMS if i[0] is not None])
    got = [
        (r.doc_id, r.found.n_words, sum(b - a for a, b in r.found.runs), len(r.found["items"]),
         sha256(",".join(sorted(map(str, r.found["items"]))).encode()).hexdigest(), bool(r.found.runs))
        for r in rows
    ]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    for r in rows:
        pieces = [words(r.text[a:b]) for a, b in r.found.spans]
        runs = [words(r.text)[a:b] for a, b in r.found.runs]
        assert pieces == runs
        assert all(WORD.match(r.text[a].lower()) and WORD.match(r.text[b - 1].lower()) for a, b in r.found.spans)


@pytest.mark.parametrize("block", [1 << 20, 60])
def test_item_ids_that_are_texts(spark, documents, folder, block):
    df = documents(ODD)
    items = spark.createDataFrame([("b-1", PASSAGE), ("a", "one two three"), (None, "one"), ("10", "four five"), ("9", "four five")],
                                  "item_id string, text string")
    rows = decontaminate.hits(df, items, ["doc_id"], "h", block_bytes=block, unnamed=True).collect()
    assert {r.doc_id: r.h["items"] for r in rows if r.h["items"]} == {5: ["10", "9", "a"], 6: ["b-1"], 7: ["b-1"]}
    df.write.parquet(f"{folder}/documents.parquet")
    items.write.parquet(f"{folder}/benchmark.parquet")
    got = {r.doc_id: (r.n_items, r.items_sha256) for r in decontaminate.op6_decontaminate(spark, folder).collect() if r.n_items}
    assert got == {i: (len(x), sha256(",".join(x).encode()).hexdigest()) for i, x in {5: ["10", "9", "a"], 6: ["b-1"], 7: ["b-1"]}.items()}


def test_many_different_words_keep_their_letters():
    """One, two and three letters a word; no match begins inside a word."""
    for n in (3, 300, 7000):
        items = [(i, " ".join(f"w{10 * i + k}" for k in range(10))) for i in range(n)]
        machine = decontaminate.Windows(items, 10)
        assert machine.digits == {3: 1, 300: 2, 7000: 3}[n]
        for i in (0, n // 2, n - 1):
            assert machine.scan(f"x {items[i][1]} unknown {items[i][1]}") == (22, [[1, 11], [12, 22]], {i})
        assert machine.scan("w0 w1 unknown w2 w3")[1:] == ([], set())
    single = decontaminate.Windows([(i, f"w{i}") for i in range(70)], 10)
    assert [single.scan(f"w{i} w{j}")[2] for i in (0, 5, 69) for j in (64, 1)] == [{i, j} for i in (0, 5, 69) for j in (64, 1)]


def test_keep_clean(spark, documents):
    df, items = documents(ODD), spark.createDataFrame([(1, PASSAGE)], "item_id bigint, text string")
    kept = decontaminate.keep_clean(df, items)
    assert kept.columns == df.columns and kept.count() == len(ODD) - 2
    assert decontaminate.keep_clean(df, items.limit(0)).count() == len(ODD)
    assert decontaminate.keep_clean(df.limit(0), items).count() == 0


def test_items_without_an_id_are_hits(spark, documents, folder):
    """In the query and the stage, and in many blocks: hits as of any item, but no id in the list."""
    docs = [(1, "x " + PASSAGE), (2, "own words only"), (3, "and One, two THREE here"), (4, "five six")]
    df = documents([(i, t, "a") for i, t in docs])
    items = spark.createDataFrame([(None, PASSAGE), (None, "one two three"), (9, "one two three"), (8, "five six")],
                                  "item_id bigint, text string")
    df.write.parquet(f"{folder}/documents.parquet")
    items.write.parquet(f"{folder}/benchmark.parquet")
    expected = []
    for doc, n, hit, _, _, bad in brute(docs, [(-1, i.text) for i in items.collect()]):
        ids = {3: ["9"], 4: ["8"]}.get(doc, [])
        expected.append((doc, n, hit, len(ids), sha256(",".join(ids).encode()).hexdigest(), bad))
    got = decontaminate.op6_decontaminate(spark, str(folder)).drop("spans").collect()
    assert sorted(map(tuple, got)) == sorted(expected)
    assert [r.doc_id for r in decontaminate.keep_clean(df, items).collect()] == [2]
    blocks = decontaminate.hits(df, items, ["doc_id"], "h", block_bytes=100, unnamed=True).collect()
    assert sorted((r.doc_id, len(r.h.runs), r.h["items"]) for r in blocks) == [(1, 1, []), (2, 0, []), (3, 1, [9]), (4, 1, [8])]
