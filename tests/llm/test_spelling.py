import random
import re
from collections import Counter
from itertools import product
from zlib import crc32

import pytest

from reviewlens.llm import spelling
from tests.llm.conftest import ODD, SMALL


def edits(a, b):
    """Edit distance by the textbook table."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def brute_words(rows, min_length=6, min_count=5):
    counts = Counter()
    for id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = crc32(f"{'' if id is None else id}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}


def brute(words):
    near = {w: [v for v in words if abs(len(v) - len(w)) <= 1 and edits(w, v) == 1] for w in words}
    forms = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best and words[best] >= 5 * n else None
    out = []
    for w, n in words.items():
        root = w
        while forms[root]:
            root = forms[root]
        out.append((w, forms[w], root, n, len(near[w]), words.get(forms[w])))
    return sorted(out, key=repr)


def corpus(seed, n_words=60):
    """Words with chains of variants, accents, repeated letters and anagrams, in Zipf-like numbers."""
    draw = random.Random(seed)
    words = ["".join(draw.choice("abcdeéÿ") for _ in range(draw.randrange(5, 9))) for _ in range(n_words)]
    words += [w[:i] + c + w[i + d :] for w in words[:30] for i, c, d in ((0, "z", 0), (2, "", 1), (3, "q", 1), (4, "éé", 1))]
    words += ["".join(draw.sample(w, len(w))) for w in words[:20]] + ["aaaaaa", "aaaaaaa", "aaaaaaaa"]
    rows = []
    for rank, word in enumerate(draw.sample(words, len(words))):
        rows += [(rank * 100 + i, f"{word} {word.upper()}.{word}1{word}") for i in range(1 + 300 // (rank + 1))]
    return rows + [(-1 - i, f"planted {'plantéd' if i % 6 == 0 else ''} {'plantéds' if i % 40 == 0 else ''}") for i in range(300)]


@pytest.mark.parametrize("members,searches", [(20_000, 4_000), (20, 15), (1, 2)])
def test_variants_by_all_pairs(spark, members, searches):
    rows = corpus(3) if members > 1 else corpus(3, 20)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = spelling.variants(df, spelling.Settings(members=members, searches=searches)).collect()
    expected = brute(brute_words(rows))
    assert sorted(map(tuple, got), key=repr) == expected
    assert any(w[1] and w[2] != w[1] for w in expected)  # a chain of two forms at least


def test_odd_rows(documents):
    more = [(30 + i, "Élégant elegant élégant×x ELEGANT", None) for i in range(6)] + [(None, "straße strasse straße", "a")] * 9
    rows = [(i, t) for i, t, _ in ODD + more]
    got = spelling.variants(documents(ODD + more)).collect()
    assert sorted(map(tuple, got), key=repr) == brute(brute_words(rows))
    assert spelling.variants(documents(ODD).limit(0)).count() == 0
    assert spelling.variants(documents([(1, None, "a"), (2, "", "a")])).count() == 0


def test_query_by_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = spelling.op13_spelling(spark, SMALL).collect()
    assert sorted(map(tuple, got), key=repr) == brute(brute_words(rows))


def test_one_edit_is_found_from_one_side():
    words = ["".join(w) for n in range(5) for w in product("aéq", repeat=n)]  # a and q share a group
    for a in words:
        for b in words:
            assert spelling.exceeds(a, b) + spelling.exceeds(b, a) == (edits(a, b) == 1)


@pytest.mark.parametrize("depth", [0, 5, spelling.GROUPS])
def test_search_finds_what_exceeds(monkeypatch, depth):
    monkeypatch.setattr(spelling, "LEAF", 2)
    draw = random.Random(depth)
    words = sorted({"".join(draw.choice("abqr") for _ in range(draw.randrange(3, 6))) for _ in range(300)})
    groups = {}
    for w in words:
        groups.setdefault(spelling.descend(w, "", 0, depth, spelling.OWN)[0][0], []).append((w, 1, spelling.frequencies(w)))
    tries = {path: spelling.build(some, depth) for path, some in groups.items()}
    for w in words:
        places = spelling.descend(w, "", 0, depth, spelling.NOTHING)
        assert len(places) == len(set(places))
        found = [o[0] for path, spent in places if path in tries for o in spelling.search(tries[path], w, depth, spent)]
        assert sorted(found) == [o for o in words if spelling.exceeds(w, o)]


def test_roots_of_a_long_chain(spark):
    chain = [(f"w{i:03}", f"w{i + 1:03}") for i in range(37)] + [("x", "w036"), ("y", "x")]
    found = spelling.roots(spark.createDataFrame(chain, "word string, form string"))
    assert {r.root for r in found.collect()} == {"w037"} and found.count() == 39
