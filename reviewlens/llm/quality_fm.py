"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

The score of a text with features x is the logistic function of

    w0 + sum_i w_i x_i + 1/2 sum_f [ (sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2 ]

where the last sum, over the factors f, equals all pairwise interactions <v_i, v_j> x_i x_j and
takes time linear in the number of features. Features are the lower-cased words, hashed into
``Settings.buckets``, binned measures of the text's structure, and, as metadata, the bin of the
declared length and whether it is the true one.

The model is trained on a bounded, documented sample of labelled rows
(``Settings.rows_per_class`` of each class, see ``labelled.py``), weighted back to
the class shares of all labelled rows. Its size is bounded by ``buckets`` and ``factors``.

Cases: null and empty texts have no words, and a score like any other; without labelled rows
every score is 0.5; labels that are null or not 0 or 1 are left out; a document with two labels
counts with each; rows equal in id and text are learnt from once, and get equal scores; extra
columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.columns import LOWER, free_name, map_texts
from reviewlens.llm.labelled import held_out, sample
from reviewlens.session import settle

UPPER = bytes(range(65, 91))
DIGITS = b"0123456789"
SYMBOLS = b"#*$%&|<>^~=+@_\\{}[]"
MARKS = b".,;:!?'\"()-"
BANGS = b"!?"
BINS = 16
FIELDS = 12


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 14
    factors: int = 8
    rows_per_class: int = 6000
    epochs: int = 6
    batch: int = 256
    rate: float = 0.1
    decay: float = 1e-5
    seed: int = 7

    @property
    def width(self) -> int:
        return self.buckets + FIELDS * BINS


def _ratio_bin(part: float, whole: float) -> int:
    """Bins on a logarithmic scale from none to all."""
    return min(BINS - 1, int(1.5 * np.log2(1 + 1000 * part / whole))) if whole else 0


def _size_bin(n: float) -> int:
    return min(BINS - 1, int(np.log2(1 + n)))


def features(text: str | None, declared: int | None, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and values of one text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.translate(LOWER).split()
    counts = Counter(words)
    number = np.fromiter(map(crc32, counts), np.int64, len(counts)) % settings.buckets
    weight = np.log1p(np.fromiter(counts.values(), np.float64, len(counts)))
    weight /= np.sqrt((weight * weight).sum()) or 1.0

    lines = [line for line in raw.split(b"\n") if line.strip()]
    n, n_words = len(raw), len(words)
    share = lambda chars: _ratio_bin(n - len(raw.translate(None, chars)), n)
    fields = [
        _size_bin(n_words),
        _size_bin(n),
        share(UPPER),
        share(DIGITS),
        share(SYMBOLS),
        share(MARKS),
        share(BANGS),
        min(BINS - 1, n // (2 * n_words)) if n_words else 0,
        min(BINS - 1, BINS * len(counts) // (n_words + 1)),
        _ratio_bin(len(lines) - len(set(lines)), len(lines)),
        _ratio_bin(max(counts.values(), default=0), n_words),
        0 if declared is None else 1 + _size_bin(max(0, declared)) % 7 + 7 * (declared == len(text or "")),
    ]
    structure = settings.buckets + BINS * np.arange(FIELDS) + np.array(fields)
    return np.concatenate((number, structure)), np.concatenate((weight, np.full(FIELDS, 0.5)))


def margins(w0: float, w: np.ndarray, v: np.ndarray, number: np.ndarray, value: np.ndarray, starts: np.ndarray):
    """Score before the logistic function for each text, and the sums over its factors."""
    vx = v[number] * value[:, None]
    sums = np.add.reduceat(vx, starts, axis=0)
    squares = np.add.reduceat(vx * vx, starts, axis=0)
    linear = np.add.reduceat(w[number] * value, starts)
    return w0 + linear + 0.5 * (sums * sums - squares).sum(axis=1), sums, vx


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def train(rows: list[tuple[float, float, np.ndarray, np.ndarray]], settings: Settings):
    """``w0, w, v`` from (label, weight, numbers, values); adaptive gradient steps in fixed order."""
    random = np.random.default_rng(settings.seed)
    w0, w = 0.0, np.zeros(settings.width)
    v = random.normal(0, 0.05, (settings.width, settings.factors))
    g0, gw, gv = 1e-8, np.full(w.shape, 1e-8), np.full(v.shape, 1e-8)
    label, weight = (np.array([r[i] for r in rows], np.float64) for i in (0, 1))
    for _ in range(settings.epochs if rows else 0):
        order = random.permutation(len(rows))
        for at in range(0, len(order), settings.batch):
            pick = order[at : at + settings.batch]
            number, value = (np.concatenate([rows[i][k] for i in pick]) for k in (2, 3))
            sizes = np.array([len(rows[i][2]) for i in pick])
            margin, sums, vx = margins(w0, w, v, number, value, np.cumsum(sizes) - sizes)
            error = (_logistic(margin) - label[pick]) * weight[pick] / weight[pick].sum() * len(pick) ** 0.5
            each = np.repeat(error, sizes)
            touched, where = np.unique(number, return_inverse=True)
            dw = np.bincount(where, each * value, len(touched)) + settings.decay * w[touched]
            pairs = (np.repeat(sums, sizes, axis=0) - vx) * (each * value)[:, None]
            dv = np.stack([np.bincount(where, p, len(touched)) for p in pairs.T], axis=1) + settings.decay * v[touched]
            g0 += error.sum() ** 2
            gw[touched] += dw * dw
            gv[touched] += dv * dv
            w0 -= settings.rate * error.sum() / g0**0.5
            w[touched] -= settings.rate * dw / np.sqrt(gw[touched])
            v[touched] -= settings.rate * dv / np.sqrt(gv[touched])
    return w0, w, v


def fit(docs: DataFrame, labels: DataFrame, settings: Settings, id: str = "doc_id", text: str = "text", declared: str = "n_chars"):
    """``w0, w, v``. One task trains on the bounded sample's features; the model comes back."""
    given = docs.select(id, text, F.col(f"`{declared}`").cast("bigint").alias(declared))
    learnt = sample(given, labels, settings.rows_per_class, [text, declared], id)

    def make():
        def run(texts, lengths):
            found = [features(t, d, settings) for t, d in zip(texts, lengths)]
            return [[n.astype(np.int32) for n, _ in found], [x.astype(np.float32) for _, x in found]]

        return run

    made = map_texts(learnt, ["h", "y", "weight"], ["c0", "c1"], "numbers array<int>, vals array<float>", make)
    bounded = made.orderBy("h", "y").limit(2 * settings.rows_per_class)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = []
        for batch in batches:
            numbers, values = batch.column("numbers"), batch.column("vals")
            for i, (y, weight) in enumerate(zip(batch.column("y").to_pylist(), batch.column("weight").to_pylist())):
                pair = (np.asarray(numbers[i].values), np.asarray(values[i].values, dtype=np.float64))
                given.append((y, weight, *pair))
        if given:
            w0, w, v = train(given, settings)
            yield pa.RecordBatch.from_pydict({"w": [[w0, *w], *v.T.tolist()], "part": list(range(settings.factors + 1))})

    model = settle(bounded.coalesce(1).mapInArrow(run, "w array<double>, part bigint"), "quality-model")
    parts = [r.w for r in model.orderBy("part").collect()]  # (factors + 1) * width numbers
    if not parts:
        return 0.0, np.zeros(settings.width), np.zeros((settings.width, settings.factors))
    return parts[0][0], np.array(parts[0][1:]), np.array(parts[1:]).T.copy()


def scored(
    docs: DataFrame, labels: DataFrame, keep: list[str], name: str, settings: Settings = Settings(),
    id: str = "doc_id", text: str = "text", declared: str = "n_chars",
) -> DataFrame:
    """The columns ``keep`` of every row of ``docs``, and its score under ``name``."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, settings, id, text, declared))

    def make():
        w0, w, v = model.value

        def score(texts, lengths):
            out = []
            for at in range(0, len(texts), 512):
                found = [features(t, d, settings) for t, d in zip(texts[at : at + 512], lengths[at : at + 512])]
                sizes = np.array([len(n) for n, _ in found])
                number, value = (np.concatenate([f[k] for f in found]) for k in (0, 1))
                out.append(_logistic(margins(w0, w, v, number, value, np.cumsum(sizes) - sizes)[0]))
            return [np.concatenate(out) if out else []]

        return score

    return map_texts(docs, keep, [text, declared], f"`{name}` double", make)


def keep_good(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``docs`` without the rows whose score is under one half."""
    name = free_name(docs, "llm_quality")
    return scored(docs, labels, docs.columns, name, settings).where(F.col(name) >= 0.5).drop(name)


def op2_quality_fm(spark, sf: str) -> DataFrame:
    """Every document's quality score and verdict."""
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    return scored(docs, labels, ["doc_id"], "score").select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
