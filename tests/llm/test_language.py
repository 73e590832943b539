import re
import time

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reviewlens.llm import language

PAGES = "page_id bigint, url string, html string"
LANGS = ("en", "fr")


def page(lang, text):
    return f'<html lang="{lang}"><head><title>x</title></head><body><script>var a="<p>";</script><p>{text}</p><!-- no --></body></html>'


def model():
    counts = np.full((2, language.BUCKETS), 0.5)
    for i, text in enumerate(("the cat and the hat that sat there", "le chat et les chapeaux que voila")):
        counts[i] += np.bincount(language.trigrams(text), minlength=language.BUCKETS)
    return np.log(counts / counts.sum(axis=1, keepdims=True))


ROWS = [
    (1, "http://a.example.com/x", page("en", "the cat sat there")), (2, "http://a.example.com/y", page("en", "that hat")),
    (3, "https://b.example.fr:80/", page("fr-FR", "le chat que voila")), (4, "http://u@b.example.fr/z", "les chapeaux"),
    (5, None, page("fr", "")), (6, "not an address", None), (7, "http://a.example.com/", ""), (None, "HTTP://A.example.com", page("EN", "x")),
    (1, "http://a.example.com/x", page("en", "the cat sat there")),
]


def brute(rows, table):
    """The fused posterior of each page by its definition."""
    ll = np.array([language.text_evidence(h, table) for _, _, h in rows])
    p = np.exp(ll) / np.exp(ll).sum(axis=1, keepdims=True)
    host = ["a.example.com", "a.example.com", "b.example.fr", "b.example.fr", None, None, "a.example.com", "a.example.com", "a.example.com"]
    said = ["en", "en", "fr", None, "fr", None, None, "en", "en"]
    base = (p.sum(axis=0) + 0.5) / (len(rows) + 0.5 * p.shape[1])
    out = []
    for i in range(len(rows)):
        score = ll[i].copy()
        prior = base
        for part in (lambda h: h and ".".join(h.split(".")[-2:]), lambda h: h):
            if host[i]:
                others = sum(p[j] for j in range(len(rows)) if j != i and part(host[j]) == part(host[i]))
                prior = (others + 4 * prior) / (others + 4 * prior).sum()
        score += np.log(prior)
        for values in (said, [h and h.split(".")[-1] for h in host]):
            if values[i]:
                same = sum(p[j] for j in range(len(rows)) if values[j] == values[i])
                score += np.log((same + 0.5) / (p.sum(axis=0) + 1))
        e = np.exp(score - score.max())
        out.append((rows[i][0], LANGS[int(np.argmax(score))], e.max() / e.sum(), said[i], host[i]))
    return out


def test_posterior_by_its_definition(spark):
    df = spark.createDataFrame([(*r, "x", "y") for r in ROWS], PAGES + ", host string, p string")
    got = language.fused(df, model(), LANGS).collect()
    expected = brute(ROWS, model())
    order = lambda r: (repr(r[0]), repr(r[-1]))
    for r, e in zip(sorted(((r.page_id, r.lang, r.probability, r.declared, r.host) for r in got), key=order), sorted(expected, key=order)):
        assert r[0] == e[0] and r[1] == e[1] and r[3:] == e[3:]
        assert r[2] == pytest.approx(e[2])


def test_model_counts_all_documents(spark):
    rows = [("the cat", "en"), ("the cat", "en"), (None, "en"), ("le chat", "fr"), ("xx", "de"), ("yy", None)]
    got = language.text_model(spark.createDataFrame(rows, "text string, lang string"), LANGS)
    counts = np.full((2, language.BUCKETS), 0.5)
    counts[0] += 2 * np.bincount(language.trigrams("the cat"), minlength=language.BUCKETS)
    counts[1] += np.bincount(language.trigrams("le chat"), minlength=language.BUCKETS)
    assert np.allclose(got, np.log(counts / counts.sum(axis=1, keepdims=True)))


def test_pages_by_the_language_in_their_path(spark):
    sf = "/root/testdata/sf0.01"
    rows = language.op5_language(spark, sf).collect()
    path = {r.page_id: r.url.split("/")[3] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    assert len(rows) == 250 and np.mean([r.lang == path[r.page_id] for r in rows]) > 0.97


_ALL = re.compile(r"<!--.*?-->|<(script|style|head)\b.*?</\1\s*>|<[^>]*>", re.I | re.S)


@given(st.lists(st.sampled_from(["<!--", "-->", "<script", "</script >", "<STYLE>", "</style>", "<head", "</head>", "<p>", "<", ">", " a", "b"]), max_size=25))
def test_visible_text_is_what_no_mark_hides(parts):
    page = "".join(parts)
    assert language.visible(page).split() == _ALL.sub(" ", page).split()


@pytest.mark.parametrize("mark", ["<script>", "<style ", "<head", "<!-- ", "<", "<html ", "<html lang ", "a<script>b</scrip"])
def test_long_pages_with_unclosed_marks(spark, mark):
    start = time.time()
    language.visible(mark * 300_000)
    df = spark.createDataFrame([(1, "http://a.b.co.uk/", "<html lang=fr>le chat" + mark * 200_000)], PAGES)
    (row,) = language.fused(df, model(), LANGS).collect()
    assert row.declared == "fr" and time.time() - start < 20


def test_domain_of_a_country(spark):
    hosts = ["a.b.co.uk", "b.co.uk", "co.uk", "x.example.com", "example.com", "localhost", "a.gov.au", "x.ab.de"]
    df = spark.createDataFrame([(h,) for h in hosts], "host string").select(language.domain_of(F.col("host")))
    assert [r[0] for r in df.collect()] == ["b.co.uk", "b.co.uk", "co.uk", "example.com", "example.com", "localhost", "a.gov.au", "ab.de"]


def test_hot_host(spark):
    """A third of the pages share a host, another third have no address."""
    rows = [(i, "http://hot.example.fr/" if i % 3 == 0 else None if i % 3 == 1 else f"http://h{i}.example.com/", page("", "le chat" if i % 2 else "the cat"))
            for i in range(300)]
    got = language.fused(spark.createDataFrame(rows, PAGES), model(), LANGS).collect()
    assert len(got) == 300 and np.mean([r.lang == ("fr" if r.page_id % 2 else "en") for r in got if r.page_id % 3]) == 1


def test_no_rows(spark):
    assert language.fused(spark.createDataFrame([], PAGES), model(), LANGS).count() == 0
