"""Quality rules: exact text counts, and a calibrated n-gram classifier against fixed thresholds.

The classifier is a logistic regression over hashed word unigrams and bigrams and hashed character
n-grams (of code points), each family as shares of the text's own n-grams. It learns from a bounded,
documented sample of labelled rows (``Settings.rows_per_class`` of each class, see ``labelled.py``);
every fifth row of the sample is kept from the fit and calibrates the margin into a probability (Platt's two numbers).
Texts are scored in Arrow batches; ``kept`` asks that no base rule fails and that the probability
reaches ``Settings.threshold``.

Base rules: fewer than ``min_words`` words, or more than ``max_repeat`` percent of the words
inside a window of five words that occurs at least twice in the text.

Cases: null and empty texts have no words and fail the base rules; without labelled rows of both
classes the probability is 0.5 and passes; labels that are null or not 0 or 1 are left out; rows
equal in id and text are learnt from once, and get equal results; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.columns import LOWER, map_texts
from reviewlens.llm.labelled import sample
from reviewlens.session import settle

SYMBOLS = b"#*$%&|<>"
CONTINUES = bytes(range(0x80, 0xC0))


@dataclass(frozen=True)
class Settings:
    bits: int = 14
    grams: tuple[int, ...] = (2, 3, 4)
    rows_per_class: int = 6000
    epochs: int = 8
    batch: int = 128
    rate: float = 0.5
    seed: int = 11
    threshold: float = 0.5
    min_words: int = 10
    max_repeat: int = 20

    @property
    def width(self) -> int:
        """One block of buckets for each family: words, pairs of words, and each length of n-gram."""
        return (2 + len(self.grams)) << self.bits


def repeated_words(words: list[bytes], window: int = 5) -> int:
    """How many words lie in a window that occurs at least twice; words are compared, not hashes."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    code, distinct = ids[:n], len(numbers)
    for k in range(1, window):  # a number for each window so far; renumbered before it overflows
        if (int(code.max()) + 1) * distinct >= 1 << 62:
            code = np.unique(code, return_inverse=True)[1]
        code = code * distinct + ids[k : k + n]
    _, which, counts = np.unique(code, return_inverse=True, return_counts=True)
    first = np.flatnonzero(counts[which] > 1)
    if not len(first):
        return 0
    edges = np.zeros(len(words) + 1, np.int64)
    edges[first] += 1
    edges[first + window] -= 1
    return int((np.cumsum(edges[:-1]) > 0).sum())


def counts(raw: bytes, words: list[bytes]) -> tuple[int, int, int, int, int]:
    """Words, their characters, symbols, duplicate lines and repeated words of a text in UTF-8."""
    chars = sum(map(len, words)) - (len(raw) - len(raw.translate(None, CONTINUES)))
    lines = [line for line in raw.split(b"\n") if line.strip(b" \t\n\r\x0b\x0c")]
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words)


def buckets(text: str, raw: bytes, words: list[bytes], settings: Settings) -> list[np.ndarray]:
    """The bucket of every n-gram of a text, one array for each family; ``raw`` is the text in UTF-8."""
    mask = (1 << settings.bits) - 1
    word = np.fromiter(map(crc32, raw.translate(LOWER).split()), np.uint64, len(words))
    pair = (word[:-1] * np.uint64(0x9E3779B1) + word[1:]) * np.uint64(0x85EBCA77) >> np.uint64(15)
    out = [word & np.uint64(mask), pair & np.uint64(mask)]
    data = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)  # code points
    for n in settings.grams:
        code = np.zeros(max(0, len(data) - n + 1), np.uint32)
        for k in range(n):
            code = code * np.uint32(0x01000193) + data[k : k + len(code)]
        out.append((code * np.uint32(0x9E3779B1)) >> np.uint32(32 - settings.bits))
    return [b.astype(np.int64) + (i << settings.bits) for i, b in enumerate(out)]


def margin(found: list[np.ndarray], bias: float, weights: np.ndarray) -> float:
    """Bias and, for each family, the mean weight of the text's n-grams."""
    return bias + sum(float(weights[b].mean()) for b in found if len(b))


def _shares(found: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and their shares in their family."""
    number, share = [np.zeros(0, np.int64)], [np.zeros(0)]
    for b in found:
        if len(b):
            at, n = np.unique(b, return_counts=True)
            number.append(at)
            share.append(n / len(b))
    return np.concatenate(number), np.concatenate(share)


def _logistic(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_weights(rows: list[tuple[float, float, np.ndarray, np.ndarray]], settings: Settings) -> tuple[float, np.ndarray]:
    """Bias and weights from (label, weight, buckets, shares), by adaptive gradient steps."""
    random = np.random.default_rng(settings.seed)
    bias, weights = 0.0, np.zeros(settings.width)
    g0, g = 1e-8, np.full(settings.width, 1e-8)
    label, weight = (np.array([r[i] for r in rows]) for i in (0, 1))
    for _ in range(settings.epochs):
        order = random.permutation(len(rows))
        for at in range(0, len(order), settings.batch):
            pick = order[at : at + settings.batch]
            number, share = (np.concatenate([rows[i][k] for i in pick]) for k in (2, 3))
            of = np.repeat(np.arange(len(pick)), [len(rows[i][2]) for i in pick])
            z = bias + np.bincount(of, weights[number] * share, len(pick))
            error = (_logistic(z) - label[pick]) * weight[pick] / weight[pick].mean()
            touched, where = np.unique(number, return_inverse=True)
            step = np.bincount(where, error[of] * share, len(touched))
            g[touched] += step * step
            g0 += error.sum() ** 2
            weights[touched] -= settings.rate * step / np.sqrt(g[touched])
            bias -= settings.rate * error.sum() / g0**0.5
    return bias, weights


def calibrate(z: np.ndarray, label: np.ndarray, weight: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """``a, b`` so that the logistic of ``a z + b`` is the share of label 1; Newton steps on
    softened labels, as Platt has them, so that separated classes give finite numbers."""
    n1, n0 = (weight * label).sum(), (weight * (1 - label)).sum()
    goal = np.where(label == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(steps):
        p = _logistic(a * z + b)
        slope = np.array([(weight * (p - goal) * z).sum(), (weight * (p - goal)).sum()])
        s = weight * p * (1 - p)
        bend = np.array([[(s * z * z).sum(), (s * z).sum()], [(s * z).sum(), s.sum()]]) + 1e-6 * np.eye(2)
        change = np.linalg.solve(bend, slope)
        change *= min(1.0, 2.0 / max(1e-12, np.abs(change).max()))
        a, b = a - change[0], b - change[1]
    return max(a, 1e-6), b


def fit(docs: DataFrame, labels: DataFrame, settings: Settings, id: str = "doc_id", text: str = "text"):
    """``bias, weights, a, b``; one task learns from the bounded sample."""
    learnt = sample(docs, labels, settings.rows_per_class, [text], id)

    def make():
        def run(texts):
            found = []
            for t in texts:
                raw = (t or "").encode("utf-8", "surrogatepass")
                found.append(_shares(buckets(t or "", raw, raw.split(), settings)))
            return [[n.astype(np.int32) for n, _ in found], [x.astype(np.float32) for _, x in found]]

        return run

    made = map_texts(learnt, ["h", "y", "weight"], ["c0"], "numbers array<int>, vals array<float>", make)
    bounded = made.orderBy("h", "y").limit(2 * settings.rows_per_class)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            numbers, values = batch.column("numbers"), batch.column("vals")
            for i, (y, weight) in enumerate(zip(batch.column("y").to_pylist(), batch.column("weight").to_pylist())):
                rows.append((y, weight, np.array(numbers[i].values), np.array(values[i].values)))
        if {r[0] for r in rows} == {0.0, 1.0}:
            kept = rows[::5]
            bias, weights = fit_weights([r for i, r in enumerate(rows) if i % 5], settings)
            z = np.array([bias + (weights[n] * x).sum() for _, _, n, x in kept])
            a, b = calibrate(z, np.array([r[0] for r in kept]), np.array([r[1] for r in kept]))
            yield pa.RecordBatch.from_pydict({"part": [0, 1], "w": [[bias, a, b], weights.tolist()]})

    model = settle(bounded.coalesce(1).mapInArrow(run, "part bigint, w array<double>"), "rules-model")
    parts = [r.w for r in model.orderBy("part").collect()]  # three numbers, and ``width`` weights
    if not parts:
        return 0.0, np.zeros(settings.width), 1.0, 0.0
    (bias, a, b), weights = parts
    return bias, np.array(weights), a, b


def judged(docs: DataFrame, labels: DataFrame, keep: list[str], settings: Settings = Settings(), text: str = "text") -> DataFrame:
    """The columns ``keep``, the five counts, ``base_failed``, ``probability`` and ``kept``."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, settings, text=text))

    def make():
        bias, weights, a, b = model.value

        def run(texts):
            out = []
            for t in texts:
                raw = (t or "").encode("utf-8", "surrogatepass")
                words = raw.split()
                five = counts(raw, words)
                p = float(_logistic(a * margin(buckets(t or "", raw, words, settings), bias, weights) + b))
                failed = five[0] < settings.min_words or 100 * five[4] > settings.max_repeat * five[0]
                out.append((*five, failed, p, not failed and p >= settings.threshold))
            return [list(c) for c in zip(*out)] if out else [[]] * 8

        return run

    schema = (
        "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
        "base_failed boolean, probability double, kept boolean"
    )
    return map_texts(docs, keep, [text], schema, make)


def op10_quality_rules(spark, sf: str) -> DataFrame:
    """Every document's counts, base rules and verdict."""
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    return judged(docs, labels, ["doc_id"])
