import random
from collections import Counter
from hashlib import md5, sha256

import numpy as np
import pytest

from querybook.compare import connect, differences
from reviewlens.llm import bwt, line_dedup, suffix_dedup
from tests.llm.conftest import ODD, SMALL


@pytest.mark.parametrize("block", [1, 2, 5, 1 << 16])
@pytest.mark.parametrize("seed", range(12))
def test_transform_and_common_prefixes_by_sorting(monkeypatch, seed, block):
    """Whatever the blocks that the files are read in."""
    monkeypatch.setattr(bwt, "BLOCK", block)
    r = random.Random(seed)
    strings = [bytes(r.choice(b"ab\x00") for _ in range(r.randint(1, 30))) for _ in range(r.randint(1, 12))]
    length = r.randint(1, 6)
    suffixes = sorted((tuple(x + 1 for x in s[k:]) + (0,), i, k) for i, s in enumerate(strings) for k in range(len(s) + 1))

    def common(a, b):
        n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y or x == 0), 0)
        return min(n, length)

    symbols, prefixes = bwt.transform(strings, length)
    assert symbols.tolist() == [strings[i][k - 1] if k else bwt.END for _, i, k in suffixes]
    assert prefixes.tolist() == [0] + [common(a[0], b[0]) for a, b in zip(suffixes, suffixes[1:])]
    count = Counter(s[k : k + length] for s in strings for k in range(len(s) - length + 1))
    expected = [[count[s[k : k + length]] > 1 for k in range(len(s) - length + 1)] for s in strings]
    assert [x.tolist() for x in bwt.repeated(strings, length)] == expected


def brute(rows, length=200):
    texts = [(t or "").encode() for _, t in rows]
    count = Counter(t[k : k + length] for t in texts for k in range(len(t) - length + 1))
    out = []
    for (i, _), t in zip(rows, texts):
        edges = np.zeros(len(t) + 1, int)
        for k in range(len(t) - length + 1):
            if count[t[k : k + length]] > 1:
                edges[k] += 1
                edges[k + length] -= 1
        gone = np.cumsum(edges)[:-1] > 0
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((i, len(t), int(gone.sum()), spans, sha256(kept).hexdigest()))
    return out


def digest(df):
    return [
        (r.doc_id, r.n_bytes, r.n_bytes - len(r.kept), len(r.spans), sha256(r.kept).hexdigest())
        for r in df.collect()
    ]


def test_suffix_query_by_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert sorted(map(tuple, suffix_dedup.op9_suffix_dedup(spark, SMALL).collect())) == sorted(brute(rows))


def planted(seed):
    """Texts that share passages of 150 to 400 bytes, with edits, periods and copies."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randint(1, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(60) for _ in range(4)]
    rows = []
    for i in range(40):
        parts = [text(r.randint(0, 30))]
        for _ in range(r.randint(0, 3)):
            p = r.choice(passages)
            a = r.randint(0, 120)
            parts += [p[a : a + r.randint(150, 330)], text(r.randint(0, 10))]
        rows.append((i, "".join(parts)))
    return rows + [(50, rows[3][1]), (51, rows[3][1][:-5] + "Z"), (52, "xy" * 350), (53, "q" * 205)]


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("crowd", [4000, 1])
def test_planted_passages_by_brute_force(spark, documents, monkeypatch, seed, crowd):
    """Also with every anchor of several pieces treated as crowded."""
    whole = suffix_dedup.repeated_spans
    monkeypatch.setattr(suffix_dedup, "repeated_spans", lambda texts, n: whole(texts, n, bucket=3, crowd=crowd))
    rows = planted(seed)
    got = digest(suffix_dedup.without_repeats(documents([(i, t, "a") for i, t in rows])))
    assert sorted(got) == sorted(brute(rows))


def test_suffix_odd_rows_in_small_slices(documents):
    rows = [(i, t) for i, t, _ in ODD]
    got = digest(suffix_dedup.without_repeats(documents(ODD)))
    assert sorted(got, key=repr) == sorted(brute(rows), key=repr)
    assert suffix_dedup.without_repeats(documents(ODD).limit(0)).count() == 0


def test_long_texts_are_cut_without_losing_a_start(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SLICE_BITS", 10)
    texts = [bytes(random.Random(1).choices(b"abc", k=5000)), b"x" * 300, b"short"]
    seen = Counter()
    for parts in suffix_dedup.slices(texts, 200):
        number, at, size, *_ = suffix_dedup.pieces(parts, 200, True)
        for n, a, s in zip(number.tolist(), at.tolist(), size.tolist()):
            seen.update((n, k) for k in range(a, a + s - 199))
    assert seen == Counter({(n, k): 1 for n, t in enumerate(texts) for k in range(len(t) - 199)})


def test_lines_equal_sql(spark, monkeypatch):
    import querybook.compare as compare

    monkeypatch.setitem(compare.QUERIES, "op3", line_dedup.op3_line_dedup)
    monkeypatch.setitem(compare.SQL, "op3", line_dedup.SQL)
    assert differences(spark, connect(SMALL), SMALL, "op3") == []


def test_lines_odd_rows(documents):
    rows = {(r.doc_id, r.text): r for r in line_dedup.without_repeats(documents(ODD)).collect()}
    assert line_dedup.without_repeats(documents(ODD)).count() == len(ODD)
    assert rows[2, ""].n_lines == 1 and rows[1, None].n_lines == 0
    assert (5, "One two\nthree\n\nfour five") in rows  # given twice, kept twice
    assert line_dedup.without_repeats(documents(ODD).limit(0)).count() == 0


def brute_chunks(text, lines=4):
    """The chunks of a text, line by line."""
    own = text.split("\n")
    h = [int(md5(x.encode()).hexdigest()[:8], 16) for x in own]
    out, first = [], 0
    for i in range(len(own)):
        ends = (h[i] + 3 * (h[i - 1] if i else 0) + 5 * (h[i - 2] if i > 1 else 0)) % lines == 0
        if (ends and i > first or i - first == 4 * lines - 1) and i != len(own) - 2 or i == len(own) - 1:
            out.append("\n".join(own[first : i + 1]))
            first = i + 1
    return out


def brute_lines(rows):
    seen, out = set(), []
    for i, text in sorted(rows):
        kept = []
        for chunk in brute_chunks(text):
            if "\n" in chunk and chunk.strip(" \t\n\r\x0b\x0c"):
                if chunk in seen:
                    continue
                seen.add(chunk)
            kept.append(chunk)
        out.append((i, "\n".join(kept)))
    return out


PERIODIC = [
    (1, "\n".join(["one line"] * 200)), (2, "\n".join(["one line"] * 200)), (3, "\n".join(["another"] * 95)),
    (4, "\n".join(f"of three {i % 3}" for i in range(120))), (5, "start\n" + "\n".join(f"of three {i % 3}" for i in range(120))),
    (6, "\n".join(f"long {i}" for i in range(700))), (7, "\n".join(f"long {i}" for i in range(300, 700))), (8, "one line"), (9, "one line"),
    (10, "\n" * 50), (11, "\n" * 50),
]


def test_lines_by_brute_force(spark, documents):
    for rows in (PERIODIC, [(i, t) for i, t, _ in ODD if i not in (None, 5) and t is not None]):
        got = line_dedup.without_repeats(documents([(i, t, "a") for i, t in rows])).collect()
        assert sorted((r.doc_id, r.text) for r in got) == sorted(brute_lines(rows))
    left = {i: len(t.split("\n")) for i, t in brute_lines(PERIODIC)}
    assert left[1] <= 40 and left[2] <= 10 and left[3] <= 40 and left[4] <= 60 and left[5] <= 70 and left[7] <= 20


def test_recall_on_exact_copies(spark):
    """Of the lines of later exact copies, of two lines or more, hardly any stay."""
    sf = "/root/testdata/sf0.1"
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    seen, copies = set(), set()
    for i, text in rows:
        if text in seen and "\n" in text:
            copies.add(i)
        seen.add(text)
    got = [r for r in line_dedup.op3_line_dedup(spark, sf).select("doc_id", "n_lines", "n_lines_removed").collect() if r.doc_id in copies]
    lines, gone = sum(r.n_lines for r in got), sum(r.n_lines_removed for r in got)
    print(f"{len(copies)} copies, {lines} lines, {lines - gone} stay, untouched {sum(r.n_lines_removed == 0 for r in got)}")
    assert len(copies) > 500 and lines - gone < 0.02 * lines


def test_shared_lines_go_from_the_later_text(documents):
    block = "\n".join(f"line {i} of the shared block" for i in range(60))
    rows = [(1, f"own first\n{block}\nown end", "a"), (2, f"quite\nother\nstart\n{block}", "a"), (3, "a\nb\nc", "a")]
    got = {r.doc_id: r for r in line_dedup.without_repeats(documents(rows)).collect()}
    assert got[1].text == rows[0][1] and got[3].text == "a\nb\nc"
    assert got[2].n_lines_removed > 45 and set(got[2].text.split("\n")) < set(rows[1][1].split("\n"))
    assert got[2].n_lines == 63 and len(got[2].text.split("\n")) == 63 - got[2].n_lines_removed
