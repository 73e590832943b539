import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from reviewlens.llm import labelled, quality_fm, quality_rules
from tests.llm.conftest import ODD, SMALL

WORD = re.compile("[^\x20\x09-\x0d]+")


def test_sum_of_squares_is_all_pairs():
    random = np.random.default_rng(1)
    w, v = random.normal(size=9), random.normal(size=(9, 3))
    number, value = np.array([0, 4, 7, 8]), random.normal(size=4)
    pairs = sum(v[i] @ v[j] * x * y for a, (i, x) in enumerate(zip(number, value)) for j, y in list(zip(number, value))[a + 1 :])
    got = quality_fm.margins(0.3, w, v, number, value, np.array([0]))[0][0]
    assert got == pytest.approx(0.3 + w[number] @ value + pairs)


def held_out_scores(spark, rows, score, sf="/root/testdata/sf0.01"):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    return [(labels[r.doc_id], r[score]) for r in rows if r.doc_id in labels and crc32(str(r.doc_id).encode()) % 3 == 1]


def area(pairs):
    good, bad = ([s for y, s in pairs if y == k] for k in (1, 0))
    return sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad))


def test_factorisation_machine_ranks_held_out_rows(spark):
    rows = quality_fm.op2_quality_fm(spark, "/root/testdata/sf0.01").collect()
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows) and len(rows) == 1000
    assert area(held_out_scores(spark, rows, "score")) > 0.95
    again = quality_fm.op2_quality_fm(spark, "/root/testdata/sf0.01").collect()
    assert {r.doc_id: r.score for r in again} == {r.doc_id: r.score for r in rows}


def brute_counts(text):
    words, lines = WORD.findall(text or ""), (text or "").split("\n")
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in lines if WORD.search(x)]
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_rules_by_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    rows = quality_rules.op10_quality_rules(spark, "/root/testdata/sf0.01").collect()
    assert {r.doc_id: tuple(r[c] for c in COUNTS) for r in rows} == {i: brute_counts(t) for i, t in texts.items()}
    assert all(r.kept == (not r.base_failed and r.probability >= 0.5) for r in rows)
    assert area(held_out_scores(spark, rows, "probability")) > 0.9


def test_repeated_words_renumbers_large_vocabularies():
    words = [f"w{i}".encode() for i in range(9000)]
    assert quality_rules.repeated_words(words + words[100:109]) == 18
    assert quality_rules.repeated_words([b"x"] * 7) == 7 and quality_rules.repeated_words([b"x"] * 5) == 0


def test_odd_rows_and_no_labels(spark, documents):
    df, labels = documents(ODD), spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    judged = quality_rules.judged(df, labels, ["doc_id", "text"]).collect()
    assert sorted((r.text or "", *(r[c] for c in COUNTS)) for r in judged) == sorted(
        (t or "", *brute_counts(t)) for _, t, _ in ODD
    )
    scored = quality_fm.scored(df, labels, ["doc_id"], "score").collect()
    assert [r.score for r in scored] == [0.5] * len(ODD)
    assert quality_fm.keep_good(df, labels).columns == df.columns


def test_odd_labels(spark, documents):
    df = documents(ODD + [(20 + i, f"good text number {i} of many fine words", "a") for i in range(30)])
    rows = [(20 + i, i % 2, 0) for i in range(30)] + [(5, None, 0), (6, 7, 0), (None, 1, 0), (21, 1, 1)]
    labels = spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")
    assert quality_fm.scored(df, labels, ["doc_id"], "score").count() == len(ODD) + 30
    assert quality_rules.judged(df, labels, ["doc_id"]).count() == len(ODD) + 30
    empty = df.limit(0)
    assert quality_fm.scored(empty, labels, ["doc_id"], "s").count() == 0
    assert quality_rules.judged(empty, labels, ["doc_id"]).count() == 0


def hot_label(spark, documents, same_text):
    """600 documents in two plain classes; one id with label 0 holds a third of all rows."""
    good, bad = "the river runs past the old town and its quiet market", "click $$$ win ### now !!! free *** cash"
    rows = [(i, f"{(bad, good)[i % 2]} {i} {'x' * (i % 7)}", "a") for i in range(1, 401)]
    rows += [(-8, f"{bad} again{'' if same_text else i}", "a") for i in range(200)]
    labels = [(i, i % 2, 0) for i in range(1, 401)] + [(-8, 0, 0)] * 50
    return documents(rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


@pytest.mark.parametrize("same_text", [True, False])
def test_one_labelled_id_on_a_third_of_the_rows(spark, documents, same_text):
    df, labels = hot_label(spark, documents, same_text)
    assert crc32(b"-8") % 3 != 1  # learnt from
    few = {"rows_per_class": 100}
    for rows, score in (
        (quality_fm.scored(df, labels, ["doc_id"], "p", quality_fm.Settings(**few)), "p"),
        (quality_rules.judged(df, labels, ["doc_id"], quality_rules.Settings(**few)), "probability"),
    ):
        pairs = [(r.doc_id % 2, r[score]) for r in rows.collect() if crc32(str(r.doc_id).encode()) % 3 == 1]
        assert area(pairs) > 0.95
    kept = {r.doc_id for r in quality_fm.keep_good(df, labels, quality_fm.Settings(**few)).collect()}
    assert kept >= {i for i in range(1, 401, 2)} and -8 not in kept


def test_sample_is_of_texts_and_bounded(spark, documents):
    df, labels = hot_label(spark, documents, True)
    labels = labels.union(spark.createDataFrame([(None, 1, 0), (1, 0, 0), (2, None, 0), (4, 5, 0)], labels.schema))
    learnt = labelled.sample(df, labels, 1000, ["text", "n_chars"]).collect()
    own = [i for i in range(1, 401) if crc32(str(i).encode()) % 3 != 1]
    assert Counter(r.y for r in learnt) == {1.0: sum(i % 2 for i in own), 0.0: sum(1 - i % 2 for i in own) + 1 + (1 in own)}
    assert all(r.weight == 1 for r in learnt) and sum(r.c0.endswith("again") for r in learnt) == 1
    bounded = labelled.sample(df, labels, 20, ["text"]).collect()
    assert Counter(r.y for r in bounded) == {0.0: 20, 1.0: 20}
    assert {r.y: round(20 * r.weight) for r in bounded} == Counter(r.y for r in learnt)


def brute_margin(text, settings, bias, weights):
    """The logistic score of a text, gram by gram, with Python's whole numbers."""
    words = text.encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))).split()
    crc = [crc32(w) for w in words]
    mask = (1 << settings.bits) - 1
    families = [[c & mask for c in crc]]
    families.append([((a * 0x9E3779B1 + b) * 0x85EBCA77 % (1 << 64) >> 15) & mask for a, b in zip(crc, crc[1:])])
    for n in settings.grams:
        codes = []
        for k in range(len(text) - n + 1):
            code = 0
            for letter in text[k : k + n]:
                code = (code * 0x01000193 + ord(letter)) % (1 << 32)
            codes.append((code * 0x9E3779B1 % (1 << 32)) >> (32 - settings.bits))
        families.append(codes)
    total = bias
    for number, found in enumerate(families):
        if found:
            total += sum(weights[(number << settings.bits) + b] for b in found) / len(found)
    return total


def test_probability_is_the_logistic_of_all_grams():
    settings, random = quality_rules.Settings(), np.random.default_rng(4)
    weights = random.normal(size=settings.width)
    for text in ("", "x", "Ein paar schöne Wörter, ein paar", "日本語 text and 𝔸 letter\n", " é "):
        raw = text.encode()
        got = quality_rules.margin(quality_rules.buckets(text, raw, raw.split(), settings), 0.3, weights)
        assert got == pytest.approx(brute_margin(text, settings, 0.3, weights))


def brute_fm(text, declared, w0, w, v, settings):
    number, value = quality_fm.features(text, declared, settings)
    total = w0 + sum(w[i] * x for i, x in zip(number, value))
    for a in range(len(number)):
        for b in range(a + 1, len(number)):
            total += float(v[number[a]] @ v[number[b]]) * value[a] * value[b]
    return 1 / (1 + np.exp(-total))


def test_scores_by_all_pairs(spark, documents):
    """The query's scores against the model's definition, pair by pair."""
    df, labels = hot_label(spark, documents, False)
    settings = quality_fm.Settings(rows_per_class=100)
    model = quality_fm.fit(df, labels, settings)
    got = {r.doc_id: r for r in quality_fm.scored(df, labels, ["doc_id", "text", "n_chars"], "p", settings).collect()}
    for r in (got[i] for i in range(1, 20)):
        assert r.p == pytest.approx(brute_fm(r.text, r.n_chars, *model, settings), abs=1e-6)


def test_calibration_follows_shares():
    z = np.array([-1.0] * 50 + [1.0] * 50)
    y = np.array([1.0] * 10 + [0.0] * 40 + [1.0] * 40 + [0.0] * 10)
    a, b = quality_rules.calibrate(z, y, np.ones(100))
    p = 1 / (1 + np.exp(-(a * np.array([-1, 1]) + b)))
    assert p == pytest.approx([0.2, 0.8], abs=0.02)


def test_small_query(spark):
    assert quality_fm.op2_quality_fm(spark, SMALL).count() == 200
