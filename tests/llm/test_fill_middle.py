import hashlib
import re
from dataclasses import replace

import pytest
from hypothesis import given
from hypothesis import strategies as st

from reviewlens.llm import fill_middle
from tests.llm.conftest import ODD, SMALL

UNIT = re.compile("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+")
MORE = [(20 + i, f"word{i} <S> two  three\n" if i % 5 == 0 else f" a{i}\tb{i} ccc é{i} " * 9, "a") for i in range(60)]


def brute(id, text):
    """id, n, form, lengths of prefix and middle, output; by the contract's words."""
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"42:{'' if id is None else id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    pre, mid, suf = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return id, len(units), "plain", None, None, text
    if h[3] % 100 < 80:
        return id, len(units), "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return id, len(units), "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


@pytest.mark.parametrize("piece_bytes", [1, 7, 8192])
def test_odd_rows(documents, piece_bytes):
    rows = ODD + MORE if piece_bytes > 1 else [r for r in ODD + MORE if len(r[1] or "") < 2000]
    df, settings = documents(rows), replace(fill_middle.Settings(), piece_bytes=piece_bytes)
    ordered = fill_middle.in_order(fill_middle.pieces(df, settings))
    got = [tuple(r) for r in fill_middle.restored(fill_middle.sections(ordered)).collect()]
    told = [brute(i, t) for i, t, _ in rows]
    expected = [(*b[:5], sha(b[5]), sha(t)) for b, (_, t, _) in zip(told, rows)]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    texts = [tuple(r) for r in fill_middle.outputs(df, settings).collect()]
    assert sorted(texts, key=repr) == sorted(((b[0], b[2], b[5]) for b in told), key=repr)
    assert {b[2] for b in told} == {"plain", "psm", "spm"}


def test_query_by_brute_force(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    expected = {(*(b := brute(r.doc_id, r.text))[:5], sha(b[5]), sha(r.text)) for r in rows}
    assert set(map(tuple, fill_middle.op12_fill_middle(spark, SMALL).collect())) == expected


def test_ids_of_any_type_and_empty_tables(spark):
    df = spark.createDataFrame([("a", "one two three four"), (None, "x y z")], "k string, body string")
    got = fill_middle.outputs(df, id="k", text="body").collect()
    assert {(r.k, r.output) for r in got} == {(i, brute(i, t)[5]) for i, t in (("a", "one two three four"), (None, "x y z"))}
    empty = df.limit(0)
    assert fill_middle.outputs(empty, id="k", text="body").count() == 0
    ordered = fill_middle.in_order(fill_middle.pieces(empty, id="k", text="body"))
    assert fill_middle.restored(fill_middle.sections(ordered), "k").count() == 0


@given(st.text(alphabet="ab<>PSM é\n", max_size=40), st.integers(1, 9), st.integers(1, 9))
def test_any_cut_of_an_output_is_read_back(text, most, step):
    raw = text.encode()
    if any(m in raw for m in fill_middle.PLACE):
        return
    ends = fill_middle.unit_ends(raw)
    assert [raw[a:b].decode() for a, b in zip([0, *ends], ends)] == UNIT.findall(text)
    first, last = int(ends[len(ends) // 3]) if len(ends) else 0, len(raw)
    for form in fill_middle.MARKS:
        output = b"".join(fill_middle.output_pieces(raw, form, ends, first, last, most))
        reader, found = fill_middle.Sections(form), {0: b"", 1: b"", 2: b""}
        for at in range(0, len(output), step):
            for place, part in reader.feed(output[at : at + step]):
                found[place] += part
        for place, part in reader.feed(b"", ended=True):
            found[place] += part
        assert found == {0: raw[:first], 1: raw[first:last], 2: raw[last:]}
