"""Language of web pages by Bayesian evidence fusion.

For each page and language l, four pieces of evidence are multiplied and normalised:

* the likelihood of the visible text's letter trigrams, learnt from the labelled documents and
  tempered to the root of their number, as neighbouring trigrams are not independent;
* P(declared markup language | l) and P(address suffix | l), where the page has them;
* the host's prior: its share of l, smoothed towards its domain's, itself smoothed towards that
  of all pages.

The last three come from grouped sums of the text's own posteriors over all pages, a page's own
share left out of its host's and domain's. Sums are aggregated before they are shuffled; the tables
of sums are settled and joined by their keys, which adaptive execution may split.

The languages are a parameter, and bound the size of the text model: one number for each language
and trigram bucket. Documents of other languages are not learnt from.

Cases: a null or empty page has no text evidence; a long page is passed once, whatever it leaves
unclosed; the first html tag alone declares a language; without an address there is no suffix and the
prior is that of all pages; without a declared language that factor is left out; equal
posteriors go to the language named first; repeated pages are all kept and count each; an
empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.columns import LOWER, map_texts
from reviewlens.session import settle

LANGUAGES = ("en", "fr", "de", "es")
BUCKETS = 1 << 13
SMOOTHING = 0.5
HOST_WEIGHT = 4.0  # pages that a smoothing prior counts for

#: Elements whose content is not shown, and how each ends.
_HIDDEN = {name: re.compile(rf"</{name}\s*>", re.I) for name in ("script", "style", "head")}
_OPENS = re.compile(r"<(?:!--|(script|style|head)\b)?", re.I)
_ENTITY = re.compile(r"&#?\w+;")
_LETTERS = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in LOWER)
#: The first html tag, and the language it declares.
HTML_TAG = r"(?i)<html\b[^>]*"
DECLARED = r"(?i)\blang\s*=\s*[\"']?([a-z]+)"
#: Names under a country's second level, such as co.uk, are no domain of their own.
SECOND_LEVEL = r"\.(?:co|com|org|net|ac|gov|edu|ne|or|go)\.[a-z]{2}$"


def trigrams(text: str | None) -> np.ndarray:
    """Buckets of the byte trigrams of lower-cased words, each word between blanks."""
    raw = (text or "").encode("utf-8", "surrogatepass").translate(_LETTERS)
    data = np.frombuffer(b" " + b" ".join(raw.split()) + b" ", np.uint8).astype(np.uint32)
    code = (data[:-2] << 16) + (data[1:-1] << 8) + data[2:]
    return ((code * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKETS.bit_length() + 1)).astype(np.int64)


def visible(html: str | None) -> str:
    """The text of a page without marks, scripts, styles, comments and its head.

    One cursor passes the page once. What is opened and never closed hides its own mark only, and that
    nothing closes it is found out once.
    """
    page, shown, at, unclosed = html or "", [], 0, set()

    def end(kind: str, start: int) -> int:
        """Where what opens at ``start`` ends, or -1."""
        if kind in unclosed:
            return -1
        if kind in _HIDDEN:
            found = _HIDDEN[kind].search(page, start)
            stop = found.end() if found else -1
        else:
            place = page.find(kind, start)
            stop = place + len(kind) if place >= 0 else -1
        if stop < 0:
            unclosed.add(kind)
        return stop

    for opened in iter(lambda: _OPENS.search(page, at), None):
        start = opened.start()
        kind = "-->" if opened[0] == "<!--" else (opened[1] or "").lower()
        stop = end(kind, opened.end()) if kind else -1
        stop = stop if stop >= 0 else end(">", start)
        if stop < 0:
            break
        shown.append(page[at:start])
        at = stop
    return _ENTITY.sub(" ", " ".join((*shown, page[at:])))


def text_model(docs: DataFrame, languages: tuple[str, ...], text: str = "text", lang: str = "lang") -> np.ndarray:
    """log P(bucket | language), from all documents of these languages."""
    known = docs.where(F.col(lang).isin(*languages)).select(F.col(lang).alias("lang"), F.col(text).alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(languages), BUCKETS), np.int64)
        for batch in batches:
            for name, body in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                total[languages.index(name)] += np.bincount(trigrams(body), minlength=BUCKETS)
        which, bucket = np.nonzero(total)
        yield pa.RecordBatch.from_pydict({"l": which, "bucket": bucket, "n": total[which, bucket]})

    schema = "l bigint, bucket bigint, n bigint"
    sums = settle(known.mapInArrow(run, schema).groupBy("l", "bucket").agg(F.sum("n").alias("n")), "language-trigrams")
    counts = np.full((len(languages), BUCKETS), SMOOTHING)
    for row in sums.collect():  # at most languages * buckets rows
        counts[row.l, row.bucket] += row.n
    return np.log(counts / counts.sum(axis=1, keepdims=True))


def text_evidence(html: str | None, model: np.ndarray) -> list[float]:
    """Tempered log likelihoods, the largest of them 0."""
    found = trigrams(visible(html))
    if not len(found):
        return [0.0] * len(model)
    sums = model[:, found].sum(axis=1) / len(found) ** 0.5
    return (sums - sums.max()).tolist()


def domain_of(host: Column) -> Column:
    """The last two labels of a host, or three where the second is a country's own."""
    return F.when(host.rlike(SECOND_LEVEL), F.substring_index(host, ".", -3)).otherwise(F.substring_index(host, ".", -2))


def _shares(values: list[Column]) -> list[Column]:
    total = sum(values[1:], values[0])
    return [v / total for v in values]


def _sums(n: int) -> list[Column]:
    return [F.sum(F.col("p")[i]).alias(f"s{i}") for i in range(n)]


def fused(pages: DataFrame, model: np.ndarray, languages: tuple[str, ...], id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``<id>, lang, probability, text_lang, declared, host`` per page."""
    n = len(languages)
    given = pages.sparkSession.sparkContext.broadcast(model)

    def make():
        return lambda texts: [[text_evidence(t, given.value) for t in texts]]

    address = F.lower(F.regexp_extract(F.col(f"`{url}`"), r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    facts = pages.select(
        F.col(f"`{id}`").alias("id"),
        F.nullif(address, F.lit("")).alias("host"),
        F.nullif(F.lower(F.regexp_extract(F.regexp_extract(F.col(f"`{html}`"), HTML_TAG, 0), DECLARED, 1)), F.lit("")).alias("declared"),
        F.col(f"`{html}`").alias("html"),
    )
    scored = map_texts(facts, ["id", "host", "declared"], ["html"], "ll array<double>", make)
    rows = scored.select(
        "id", "host", "declared", "ll",
        F.nullif(domain_of(F.col("host")), F.lit("")).alias("domain"),
        F.nullif(F.substring_index("host", ".", -1), F.lit("")).alias("suffix"),
        F.array(*_shares([F.exp(F.col("ll")[i]) for i in range(n)])).alias("p"),
    )
    rows = settle(rows, "page-evidence")

    def table(key: str, name: str) -> DataFrame:
        summed = rows.where(F.col(key).isNotNull()).groupBy(key).agg(*_sums(n))
        return settle(summed.select(key, F.array(*(f"s{i}" for i in range(n))).alias(name)), "page-sums")

    overall = rows.agg(*_sums(n)).first()  # a number for each language
    counts = [overall[i] or 0.0 for i in range(n)]
    base = [(c + SMOOTHING) / (sum(counts) + SMOOTHING * n) for c in counts]
    joined = rows
    for key, name in (("host", "of_host"), ("domain", "of_domain"), ("declared", "of_declared"), ("suffix", "of_suffix")):
        joined = joined.join(table(key, name), key, "left")

    def smoothed(name: str, towards: list[Column]) -> list[Column]:
        """Shares of a group without the page itself, and ``HOST_WEIGHT`` pages of the wider prior."""
        others = [F.greatest(F.col(name)[i] - F.col("p")[i], F.lit(0.0)) + HOST_WEIGHT * towards[i] for i in range(n)]
        return [F.coalesce(x, towards[i]) for i, x in enumerate(_shares(others))]

    def given_language(name: str, i: int) -> Column:
        """P(value | language), the value's share of the language's pages."""
        share = (F.col(name)[i] + SMOOTHING) / (counts[i] + 1.0)
        return F.coalesce(F.ln(share), F.lit(0.0))

    domain = smoothed("of_domain", [F.lit(b) for b in base])
    host = smoothed("of_host", domain)
    total = [
        F.col("ll")[i] + F.ln(host[i]) + given_language("of_declared", i) + given_language("of_suffix", i) for i in range(n)
    ]
    told = joined.select("id", "host", "declared", "ll", F.array(*total).alias("score"))
    normal = F.aggregate("score", F.lit(0.0), lambda a, x: a + F.exp(x - F.array_max("score")))
    names = F.array(*map(F.lit, languages))
    best = lambda scores: F.element_at(names, F.array_position(scores, F.array_max(scores)).cast("int"))
    return told.select(
        F.col("id").alias(id),
        best("score").alias("lang"),
        (F.lit(1.0) / normal).alias("probability"),
        best("ll").alias("text_lang"),
        "declared",
        "host",
    )


def op5_language(spark, sf: str) -> DataFrame:
    """Every page's language."""
    docs, pages = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "pages"))
    return fused(pages, text_model(docs, LANGUAGES), LANGUAGES)
