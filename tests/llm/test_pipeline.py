"""The stages against plain Python over their own inputs, and the pipeline over odd tables."""

import re
from collections import Counter, defaultdict

import __spark_entry__ as entry
import corpus_pipeline
from reviewlens.llm import mixing, quality_fm
from tests.llm.conftest import ODD, SMALL
from tests.llm.test_decontaminate import brute as brute_hits
from tests.llm.test_near_duplicates import brute_groups

WORD = re.compile("[^\x20\x09-\x0d]+")


def test_every_stage_does_its_work(spark, folder):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    inputs = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, inputs[-1], SMALL)
        if name != "sharding":
            assert out.columns == docs.columns
        out.write.parquet(f"{folder}/{name.replace(' ', '-')}")
        inputs.append(spark.read.parquet(f"{folder}/{name.replace(' ', '-')}"))
    rows = [[r.asDict() for r in df.collect()] for df in inputs]

    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    good = {r.doc_id for r in quality_fm.scored(docs, labels, ["doc_id"], "s").where("s >= 0.5").collect()}
    assert {r["doc_id"] for r in rows[1]} == good

    first = {g for _, _, g in brute_groups([(r["doc_id"], r["text"]) for r in rows[1]])}
    assert Counter(r["doc_id"] for r in rows[2]) == Counter(first)

    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    clean = {h[0] for h in brute_hits([(r["doc_id"], r["text"]) for r in rows[2]], items) if not h[5]}
    assert {r["doc_id"] for r in rows[3]} == clean

    taken = {r.doc_id: r.taken for r in mixing.mix(inputs[3]).collect()}
    words = defaultdict(int)
    for r in rows[4]:
        words[r["doc_id"]] += len(WORD.findall(r["text"]))
    assert dict(words) == {i: n for i, n in taken.items() if n}

    key = lambda r: (r["doc_id"], r["text"])
    assert Counter(map(key, rows[5])) == Counter(map(key, rows[4]))
    slots = defaultdict(list)
    for r in rows[5]:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())

    run = corpus_pipeline.run(spark, SMALL).collect()
    assert Counter((r.doc_id, r.text, r.shard, r.slot) for r in run) == Counter(
        (r["doc_id"], r["text"], r["shard"], r["slot"]) for r in rows[5]
    )


def test_odd_and_empty_documents(spark, documents):
    for docs in (documents(ODD), documents(ODD).limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SMALL)
            assert out.columns[: len(docs.columns)] == docs.columns, name
            assert out.count() <= 3 * max(1, docs.count())


def test_registered():
    names = set(entry.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
