"""Exact top-k search by exhaustive term-at-a-time accumulation.

Vectors are sparse rows of integer weights; a term is a component's place. Distinct query rows go
to every task in blocks of at most about ``block_bytes``, measured first; for each block, the table
is read once. A task turns each Arrow batch of rows into postings, the rows and weights of each
term. Term by term, the queries that have it scatter their weight times the posting's weights
into dense arrays of scores, one for each of a few queries. Partition selection then keeps what
reaches the k-th score; the winners are merged with those of the task's earlier batches, and at
last with those of the other tasks.

Equal queries are searched once, for one row more than asked: each then leaves out its own row. So
a vector that a third of all queries share costs one search and k rows for each.

Cases: vectors that are null or hold a null, NaN or infinite component take no part, neither as
query nor as candidate; missing components of a shorter vector are 0; an empty vector scores 0 with
all; a null id is no query, and comes last among equal scores; rows with equal ids are rows of
their own, and find each other; an empty table gives no rows; extra columns are not read. Scores that
could leave 64 bits are summed as whole Python numbers, and held at the ends of the range.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.session import settle

LONGEST = np.iinfo(np.int64).max
SCORES = 1 << 20  # of dense scores that are held at once


def integer_rows(df: DataFrame, is_query: Column, id: str, vector: str, scale: int) -> DataFrame:
    """``row, id, is_query, v``: a number for each row that takes part, and its integer weights."""
    given = df.select(
        F.col(f"`{id}`").cast("bigint").alias("id"), F.coalesce(is_query, F.lit(False)).alias("is_query"),
        F.col(f"`{vector}`").alias("x"),
    )
    bad = F.exists("x", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform("x", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    return given.where(F.col("x").isNotNull() & ~F.coalesce(bad, F.lit(True))).select(
        F.monotonically_increasing_id().alias("row"), "id", "is_query", whole.alias("v")
    )


def postings(offsets: np.ndarray, values: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """The rows and weights of each term, from rows of weights laid end to end."""
    sizes = np.diff(offsets)
    row = np.repeat(np.arange(len(sizes)), sizes)
    term = np.arange(len(values)) - np.repeat(offsets[:-1], sizes)
    some = np.flatnonzero(values)
    some = some[np.argsort(term[some], kind="stable")]
    row, term, weight = row[some], term[some], values[some]
    first = np.flatnonzero(np.diff(term, prepend=-1))
    ends = [*first[1:].tolist(), len(term)]
    return {int(term[a]): (row[a:b], weight[a:b]) for a, b in zip(first.tolist(), ends)}


def accumulate(queries: dict, lists: dict, n_queries: int, n_rows: int) -> np.ndarray:
    """Dense scores of some queries, term at a time; both sides are postings."""
    scores = np.zeros((n_queries, n_rows), np.int64)
    largest = lambda side: max((int(abs(w.astype(float)).max()) for _, w in side.values()), default=0)
    wide = largest(queries) * largest(lists) * max(1, len(queries)) >= LONGEST
    scores = scores.astype(object) if wide else scores
    for term in queries.keys() & lists.keys():
        who, weight = queries[term]
        rows, posted = lists[term]
        if wide:
            weight, posted = weight.astype(object), posted.astype(object)
        where = slice(None) if len(rows) == n_rows else rows
        if len(who) == n_queries:
            scores[:, where] += weight[:, None] * posted
        else:
            scores[who[:, None], np.arange(n_rows) if len(rows) == n_rows else rows] += weight[:, None] * posted
    return np.clip(scores, -LONGEST - 1, LONGEST).astype(np.int64) if wide else scores


def best(query: np.ndarray, score: np.ndarray, none: np.ndarray, id: np.ndarray, row: np.ndarray, k: int) -> np.ndarray:
    """Places of each query's ``k`` best, by score, then id, null last, then row."""
    order = np.lexsort((row, id, none, ~score, query))
    sorted_query = query[order]
    first = np.searchsorted(sorted_query, sorted_query)
    return order[np.arange(len(order)) - first < k]


class Winners:
    """The best rows of each query so far, as parallel arrays, and the score that a row must reach."""

    def __init__(self, n_queries: int, k: int):
        self.k, self.floor = k, np.full(n_queries, -LONGEST - 1)
        self.found = [np.zeros(0, np.int64) for _ in range(5)]  # query, score, none, id, row

    def add(self, first: int, scores: np.ndarray, none: np.ndarray, id: np.ndarray, row: np.ndarray) -> None:
        """Merge the scores of the queries from ``first`` on with one batch of rows."""
        last, n = first + len(scores), scores.shape[1]
        floor = self.floor[first:last]
        if n > self.k:
            floor = np.maximum(floor, np.partition(scores, n - self.k, axis=1)[:, n - self.k])
        at, what = np.nonzero(scores >= floor[:, None])
        new = [at + first, scores[at, what], none[what], id[what], row[what]]
        own = (self.found[0] >= first) & (self.found[0] < last)
        joined = [np.concatenate((old[own], more)) for old, more in zip(self.found, new)]
        kept = best(*joined, self.k)
        joined = [x[kept] for x in joined]
        full = np.bincount(joined[0] - first, minlength=last - first) >= self.k
        low = np.full(last - first, LONGEST)
        np.minimum.at(low, joined[0] - first, joined[1])
        self.floor[first:last] = np.where(full, low, self.floor[first:last])
        self.found = [np.concatenate((old[~own], more)) for old, more in zip(self.found, joined)]


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.asarray(column.offsets).astype(np.int64)
    values = np.asarray(column.values)[offsets[0] : offsets[-1]]
    return offsets - offsets[0], values


def _search_block(rows: DataFrame, block: DataFrame, k: int) -> DataFrame:
    """``q, score, id, row``: for each query of the block, the best rows of each task."""
    table = block.select("q", "v").toArrow().combine_chunks()
    if not len(table):
        return rows.sparkSession.createDataFrame([], "q bigint, score bigint, id bigint, row bigint")
    numbers = np.asarray(table.column("q").combine_chunks())
    given = rows.sparkSession.sparkContext.broadcast((numbers, *_flat(table.column("v").combine_chunks())))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, offsets, values = given.value
        winners, parts = Winners(len(number), k), {}
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            lists = postings(*_flat(batch.column("v")))
            ids = batch.column("id")
            none = np.asarray(ids.is_null()).astype(np.int64)
            id, row = np.asarray(ids.fill_null(0)), np.asarray(batch.column("row"))
            step = max(1, SCORES // n)
            for first in range(0, len(number), step):
                last = min(first + step, len(number))
                if (first, last) not in parts:  # a task's batches are of one size, but for the last
                    parts = parts if len(parts) < 64 else {}
                    cut = offsets[first : last + 1]
                    parts[first, last] = postings(cut - cut[0], values[cut[0] : cut[-1]])
                scores = accumulate(parts[first, last], lists, last - first, n)
                winners.add(first, scores, none, id, row)
        query, score, none, id, row = winners.found
        yield pa.RecordBatch.from_pydict(
            {"q": number[query], "score": score, "id": pa.array(id, pa.int64(), mask=none.astype(bool)), "row": row}
        )

    return rows.select("row", "id", "v").mapInArrow(run, "q bigint, score bigint, id bigint, row bigint")


def _ranked(df: DataFrame, key: str, k: int) -> DataFrame:
    order = Window.partitionBy(key).orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(
    df: DataFrame, is_query: Column, k: int = 10, scale: int = 1024,
    id: str = "vec_id", vector: str = "embedding", block_bytes: int = 16 << 20,
) -> DataFrame:
    """``query_id, rank, <id>, score``: the ``k`` rows of largest inner product for each query row."""
    rows = settle(integer_rows(df, is_query, id, vector, scale), "search-rows")
    asked = rows.where("is_query")
    distinct = settle(asked.groupBy("v").agg(F.count("*").alias("n")).withColumn("q", F.monotonically_increasing_id()), "search-queries")
    size = distinct.agg(F.sum(8 + 8 * F.size("v").cast("bigint"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    if blocks > 1:
        distinct = settle(distinct.withColumn("block", F.pmod(F.xxhash64("q"), F.lit(blocks))), "search-blocks", by="block")
    merged = None
    for block in range(blocks):
        part = distinct if blocks == 1 else distinct.where(F.col("block") == block)
        found = settle(_ranked(_search_block(rows, part, k + 1), "q", k + 1).drop("rank"), "search-found")
        merged = found if merged is None else merged.union(found)
    own = asked.select("v", F.col("row").alias("own"), F.col("id").alias("query_id")).join(distinct.select("v", "q"), "v")
    others = own.select("own", "query_id", "q").join(merged, "q").where("row <> own")
    return _ranked(others, "own", k).select("query_id", "rank", F.col("id").alias(id), "score")


def op11_topk_search(spark, sf: str) -> DataFrame:
    """The ten rows closest to every hundredth one."""
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    return top_k(df, F.col("vec_id") % 100 == 0)


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
