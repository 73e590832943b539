"""Online variational topic models by true mini-batches, for many models in the same jobs.

After Hoffman, Blei and Bach, "Online Learning for Latent Dirichlet Allocation", NIPS 2010. A pass is
cut into disjoint batches by a hash of the review, so every review is read once a pass. One job
handles a batch for all models: a task fits the topic shares of its reviews to the models of their
category, sums the expected counts per topic and term, and only these sums move. The driver holds the
models' parameters, ``k * vocabulary`` numbers each, and takes the step. As there are many jobs, all that
does not change from pass to pass is done before: reviews are packed into arrays and kept by batch.

Expected counts are rounded to ``UNIT`` and summed as integers: the sums, and so the models, are the
same whatever the partitions, and on every run.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from operator import add
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import RDD, SparkContext, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlens.session import settle

# Passes over the data, reviews of a batch, learning offset and decay, passes between perplexities.
PASSES = 20
BATCH = 4096
OFFSET = 50.0
DECAY = 0.7
EVERY = 5
# When the shares of a review have settled.
ROUNDS, TOLERANCE = 100, 1e-3
UNIT = 2.0**-24
MOST_BATCHES = 64  # of a pass; beyond, batches grow
CHUNK = 2048  # reviews that are fitted together
LEAST_WIDTH, BLOCK_BYTES = 16, 8 << 20  # of padded reviews, and of the products of those of one width
GROUP_BYTES = 64 << 20  # of parameters that are fitted, and sent out, together


@dataclass
class OnlineModel:
    """One model of one category: ``weights`` has a row for each topic, a column for each term.

    ``trace`` holds (pass, log perplexity). Without any review to learn from, ``weights`` is None.
    """

    category: str
    k: int
    terms: list[str]
    weights: np.ndarray | None = None
    trace: list[tuple[int, float]] = field(default_factory=list)

    @property
    def prior(self) -> float:
        """Of topics in a review and of terms in a topic."""
        return 1.0 / self.k


def digamma(x: np.ndarray) -> np.ndarray:
    """The derivative of the logarithm of the gamma function, for positive numbers."""
    t = x * (x + 5)  # the six fractions 1 / (x + i) in one
    first = (2 * x + 5) * (3 * t * t + 20 * t + 24) / (t * (t + 4) * (t + 6))
    y = x + 6
    z = 1 / (y * y)
    return np.log(y) - 0.5 / y - z * (1 / 12 - z * (1 / 120 - z * (1 / 252 - z * (1 / 240 - z / 132)))) - first


def log_gamma(x: np.ndarray) -> np.ndarray:
    """The logarithm of the gamma function, for positive numbers."""
    out = np.zeros_like(x)
    for i in range(6):
        out -= np.log(x + i)
    y = x + 6
    z = 1 / (y * y)
    return out + (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z / 1680))) / y


def expected_log(weights: np.ndarray) -> np.ndarray:
    """Expectation of the logarithm under Dirichlet rows."""
    return digamma(weights) - digamma(weights.sum(axis=-1, keepdims=True))


def _settle_shares(beta: np.ndarray, counts: np.ndarray, prior: float) -> np.ndarray:
    """The shares of reviews of one width: ``beta`` is reviews by topics by terms, ``counts`` reviews by 1 by terms."""
    shares = np.ones(beta.shape[:2])
    rows, now = np.arange(len(shares)), shares
    live = np.ones(len(shares), bool)
    for _ in range(ROUNDS):
        theta = np.exp(digamma(now))  # a factor common to a review's topics cancels out
        ratio = np.matmul(theta[:, None, :], beta)
        ratio += 1e-100
        np.divide(counts, ratio, out=ratio)
        new = np.matmul(beta, ratio.transpose(0, 2, 1))[:, :, 0]
        new *= theta
        new += prior
        ends = live & (np.abs(new - now).mean(axis=1) < TOLERANCE)
        now = new
        if not ends.any():
            continue
        shares[rows[ends]] = now[ends]
        live ^= ends
        left = np.count_nonzero(live)
        if not left:
            return shares
        if 4 * left <= 3 * len(live):  # until then, those that have settled go on unused
            beta, counts, now, rows = beta[live], counts[live], now[live], rows[live]
            live = np.ones(left, bool)
    shares[rows[live]] = now[live]
    return shares


def review_shares(offsets: np.ndarray, terms: np.ndarray, counts: np.ndarray, beta: np.ndarray, prior: float) -> np.ndarray:
    """Dirichlet parameters of each review's topics; ``beta`` has a row for each term.

    Reviews are ``terms`` and ``counts`` from one offset to the next, none empty. Each settles by
    itself, so that its result does not depend on its neighbours. Inside, reviews are padded to the
    next power of two of their own terms, and those of one width go through small matrix products.
    """
    sizes, topics = np.diff(offsets), np.ascontiguousarray(beta.T)
    widths = 1 << np.ceil(np.log2(np.maximum(sizes, LEAST_WIDTH))).astype(np.int64)
    shares = np.empty((len(sizes), len(topics)))
    for width in np.unique(widths).tolist():
        alike, most = np.flatnonzero(widths == width), max(1, BLOCK_BYTES // (8 * width * len(topics)))
        for i in range(0, len(alike), most):
            rows, places = alike[i : i + most], np.arange(width)
            held = places < sizes[rows, None]
            at = np.where(held, offsets[rows, None] + places, 0)
            own = np.ascontiguousarray(np.take(topics, terms[at], axis=1).transpose(1, 0, 2))
            shares[rows] = _settle_shares(own, np.where(held, counts[at], 0.0)[:, None, :], prior)
    return shares


def expected_counts(offsets: np.ndarray, terms: np.ndarray, counts: np.ndarray, beta: np.ndarray, prior: float) -> np.ndarray:
    """Expected counts per topic and term, in whole units."""
    shares = review_shares(offsets, terms, counts, beta, prior)
    phi = np.repeat(np.exp(expected_log(shares)).T, np.diff(offsets), axis=1)
    phi *= np.take(beta.T, terms, axis=1)
    phi *= counts / (phi.sum(axis=0) + 1e-100)
    units = np.rint(phi / UNIT)
    return np.stack([np.bincount(terms, row, len(beta)) for row in units]).astype(np.int64)


def review_bounds(offsets: np.ndarray, terms: np.ndarray, counts: np.ndarray, beta: np.ndarray, prior: float) -> np.ndarray:
    """Each review's part of the variational bound."""
    shares = review_shares(offsets, terms, counts, beta, prior)
    logs, k = expected_log(shares), beta.shape[1]
    of = np.repeat(np.arange(len(shares)), np.diff(offsets))
    words = np.add.reduceat(counts * np.log((np.exp(logs)[of] * beta[terms]).sum(axis=1) + 1e-100), offsets[:-1])
    rest = ((prior - shares) * logs + log_gamma(shares)).sum(axis=1) - log_gamma(shares.sum(axis=1))
    return words + rest + float(log_gamma(np.array([k * prior]))[0] - k * log_gamma(np.array([prior]))[0])


def topic_bound(model: OnlineModel) -> float:
    """The topics' part of the variational bound."""
    w, prior = model.weights, model.prior
    k, n = w.shape
    inner = ((prior - w) * expected_log(w) + log_gamma(w)).sum() - log_gamma(w.sum(axis=1)).sum()
    return float(inner + k * (log_gamma(np.array([n * prior]))[0] - n * log_gamma(np.array([prior]))[0]))


def start_weights(model: OnlineModel, seed: int) -> np.ndarray:
    random = np.random.default_rng([seed, model.k, crc32(model.category.encode())])
    return random.gamma(100.0, 0.01, (model.k, len(model.terms)))


def _by_category(batches: Iterable[pa.RecordBatch], sent: dict) -> Iterator[tuple]:
    """``category, rows, offsets, terms, counts`` of each batch's reviews, a category at a time."""
    for batch in batches:
        categories = batch.column("category").dictionary_encode()
        codes = np.asarray(categories.indices)
        for code, category in enumerate(categories.dictionary.to_pylist()):
            if category not in sent:
                continue
            rows = np.flatnonzero(codes == code)
            terms, counts = (batch.column(c).take(pa.array(rows)) for c in ("terms", "weights"))
            offsets = np.asarray(terms.offsets).astype(np.int64)
            yield category, rows, offsets - offsets[0], np.asarray(terms.flatten()), np.asarray(counts.flatten())


def _send(context: SparkContext, models: Sequence[OnlineModel]):
    """A broadcast of (number, terms by topics, prior) of the models, by category."""
    sent: dict[str, list] = {}
    for number, model in enumerate(models):
        if model.weights is not None:
            sent.setdefault(model.category, []).append((number, np.exp(expected_log(model.weights)).T.copy(), model.prior))
    return context.broadcast(sent)


def chunked(vectors: DataFrame, sizes: dict[tuple[str, int], int]) -> dict[int, RDD]:
    """Each batch's reviews as ``category, offsets, terms, counts`` arrays of some ``CHUNK`` reviews, kept.

    The reviews of a category are dealt by a hash that the batches do not use, so that every chunk of a
    large category has about as many. A fit reads a batch once a pass; only arrays are read again. A
    batch's chunks are numbered and dealt out in turn, so that no task has over one more than another.
    """
    spark = vectors.sparkSession
    largest: Counter[str] = Counter()
    for (category, _), n in sizes.items():
        largest[category] = max(largest[category], n)
    counts = {c: -(-n // CHUNK) for c, n in sorted(largest.items())}
    firsts = np.cumsum([0, *counts.values()]).tolist()
    slices = spark.createDataFrame([(c, n, first) for (c, n), first in zip(counts.items(), firsts)], "category string, slices int, first int")

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        terms, counts = (table.column(c).combine_chunks() for c in ("terms", "weights"))
        offsets = np.asarray(terms.offsets).astype(np.int64)
        arrays = (offsets - offsets[0], np.asarray(terms.flatten()), np.asarray(counts.flatten()))
        packed = [pa.array([a.tobytes()], pa.binary()) for a in arrays]
        return pa.Table.from_arrays([*(pa.array([k.as_py()], t) for k, t in zip(key, (pa.string(), pa.int32(), pa.int32()))), *packed], names=fields)

    def unpack(row) -> tuple:
        return row[0], np.frombuffer(row[1], np.int64), np.frombuffer(row[2], np.int32), np.frombuffer(row[3], np.float64)

    fields = ["category", "batch", "number", "offsets", "terms", "counts"]
    number = (F.col("first") + F.pmod(F.hash("Id"), F.col("slices"))).alias("number")
    dealt = vectors.join(F.broadcast(slices), "category").select("category", "batch", number, "terms", "weights")
    chunks = dealt.groupBy("category", "batch", "number").applyInArrow(
        pack, "category string, batch int, number int, offsets binary, terms binary, counts binary"
    )
    kept = settle(chunks, "topic-chunks", by="batch")
    found: dict[int, RDD] = {}
    for batch in sorted({b for _, b in sizes}):
        most = sum(-(-n // CHUNK) for (_, b), n in sizes.items() if b == batch)
        parts = min(most, spark.sparkContext.defaultParallelism)
        rows = kept.where(F.col("batch") == batch).repartitionById(parts, "number").select("category", "offsets", "terms", "counts")
        found[batch] = rows.rdd.map(unpack).persist(StorageLevel.MEMORY_AND_DISK)
    return found


def _summed(chunks: RDD, models: Sequence[OnlineModel], count: Callable) -> dict[int, np.ndarray]:
    """The sum of ``count(offsets, terms, counts, beta, prior)`` over the chunks of each model's category.

    A task sums its chunks first; what moves has the models' size, whatever the reviews. The sums of
    a few tasks go to the driver as they are, those of more are added up on the way.
    """
    given = _send(chunks.context, models)

    def run(rows: Iterable[tuple]) -> Iterator[tuple[int, np.ndarray]]:
        totals: dict[int, np.ndarray] = {}
        for category, *arrays in rows:
            for number, beta, prior in given.value.get(category, ()):
                own = count(*arrays, beta, prior)
                totals[number] = totals[number] + own if number in totals else own
        return iter(totals.items())

    sums, totals = chunks.mapPartitions(run), {}
    if chunks.getNumPartitions() * sum(m.weights.nbytes for m in models if m.weights is not None) > GROUP_BYTES:
        sums = sums.reduceByKey(add, min(len(models), chunks.context.defaultParallelism))
    try:
        for number, own in sums.collect():
            totals[number] = totals[number] + own if number in totals else own
        return totals
    finally:
        given.destroy()


def _bound_and_words(offsets: np.ndarray, terms: np.ndarray, counts: np.ndarray, beta: np.ndarray, prior: float) -> np.ndarray:
    bounds = review_bounds(offsets, terms, counts, beta, prior)
    return np.array([np.rint(x / UNIT).sum() for x in (bounds, counts)]).astype(np.int64)


def perplexities(chunks: RDD, models: Sequence[OnlineModel]) -> list[float | None]:
    """The bound on each model's log perplexity, over all reviews of its category."""
    told = _summed(chunks, models, _bound_and_words)
    return [
        float(-(told[i][0] * UNIT + topic_bound(model)) / (told[i][1] * UNIT)) if i in told and told[i][1] else None
        for i, model in enumerate(models)
    ]


def fit_models(
    vectors: DataFrame, vocabularies: dict[str, list[str]], counts: Sequence[int], passes: int = PASSES, seed: int = 42
) -> list[OnlineModel]:
    """A model of each category and number of topics.

    ``vectors`` holds ``category, Id, terms, weights, batch``, as ``topics.topic_vectors`` makes them:
    the columns and weights of a review's terms, and which batch of a pass it is in. A model's step
    counts a batch as much as all its category; a batch without reviews of it is no step.
    """
    counted = vectors.groupBy("category", "batch").agg(F.count("*").alias("n")).collect()  # MOST_BATCHES a category at most
    sizes = {(r["category"], r["batch"]): r["n"] for r in counted}
    reviews: Counter[str] = Counter()
    for (category, _), n in sizes.items():
        reviews[category] += n
    models = [OnlineModel(c, k, terms) for c, terms in sorted(vocabularies.items()) for k in counts]
    group, room, groups = [], 0, []
    for model in models:
        if not reviews.get(model.category):
            continue
        model.weights = start_weights(model, seed)
        if room + model.weights.nbytes > GROUP_BYTES and group:
            groups.append(group)
            group, room = [], 0
        group.append(model)
        room += model.weights.nbytes
    for group in [*groups, group] if group else []:
        names = {m.category for m in group}
        own = {key: n for key, n in sizes.items() if key[0] in names}
        chunks = chunked(vectors.where(F.col("category").isin(sorted(names))), own)
        every = vectors.sparkSession.sparkContext.union(list(chunks.values()))
        steps = [0] * len(group)
        for done in range(1, passes + 1):
            for batch, reviewed in chunks.items():
                for number, counted_units in _summed(reviewed, group, expected_counts).items():
                    model = group[number]
                    steps[number] += 1
                    rate = (OFFSET + steps[number]) ** -DECAY
                    whole = model.prior + counted_units * UNIT * (reviews[model.category] / sizes[model.category, batch])
                    model.weights = (1 - rate) * model.weights + rate * whole
            if done % EVERY == 0 or done == passes:
                for model, value in zip(group, perplexities(every, group)):
                    if value is not None:
                        model.trace.append((done, value))
        for reviewed in chunks.values():
            reviewed.unpersist()
    return models


def shares(vectors: DataFrame, models: Sequence[OnlineModel], keep: Sequence[str] = ()) -> DataFrame:
    """``category, Id, *keep, k, topics``: the topic shares of every review under its category's models."""
    given = _send(vectors.sparkSession.sparkContext, models)
    kept = vectors.select("category", "Id", *keep)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for category, rows, offsets, terms, counts in _by_category([batch], given.value):
                own = [c.take(pa.array(rows)) for c in batch.columns[:-2]]
                for _, beta, prior in given.value[category]:
                    found = review_shares(offsets, terms, counts, beta, prior)
                    found /= found.sum(axis=1, keepdims=True)
                    topics = pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1) * found.shape[1], pa.int32()), found.ravel())
                    k = pa.array(np.full(len(found), found.shape[1]), pa.int32())
                    yield pa.RecordBatch.from_arrays([*own, k, topics], names=[*batch.schema.names[:-2], "k", "topics"])

    schema = T.StructType([*kept.schema, T.StructField("k", T.IntegerType()), T.StructField("topics", T.ArrayType(T.DoubleType()))])
    return vectors.select("category", "Id", *keep, "terms", "weights").mapInArrow(run, schema)
