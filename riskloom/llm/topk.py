"""Exact top-k inner-product search by columnar branch and bound.

Vectors are quantised to integers. A task holds its candidates in chunks in
vertical layout, one row per dimension, and adds up scores one block of
dimensions at a time. After each block a candidate stays only if its score so
far plus the most that the remaining dimensions can add (the product of the two
remaining norms) can still reach the query's k-th best score; the survivors are
compacted before the next block. Queries come in blocks of a fixed number, each
broadcast, searched, merged and written before the next one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import scratch_path

SCALE = 1024
BLOCK = 16  # dimensions added between two prunings
CHUNK = 8192  # candidates in one vertical array
QUERY_BLOCK = 4096  # queries broadcast at a time
LOWEST, HIGHEST = -(2**63), 2**63 - 1  # of a score
EXACT = 2.0**53  # integers below it are exact as doubles


def usable(vector: Column) -> Column:
    """Whether a vector and all its components are present and finite."""
    big = F.lit(float("inf"))
    return F.coalesce(
        vector.isNotNull()
        & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < big)),
        F.lit(False),
    )


def quantised(values: np.ndarray) -> np.ndarray:
    """floor(SCALE * x): doubles where they are exact, Python integers beyond."""
    if not len(values) or float(np.abs(values).max(initial=0)) * SCALE < EXACT:
        return np.floor(values * SCALE)
    flat = [math.floor(x * SCALE) if abs(x) < 2.0**60 else int(x) * SCALE for x in values.ravel().tolist()]
    return np.array(flat, object).reshape(values.shape)


class _Best:
    """The k best (score, smaller id first) of a query so far."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, np.empty(0), np.empty(0, np.int64)

    def bar(self):
        return self.scores[-1] if len(self.scores) == self.k else None

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        order = np.lexsort((ids, -scores)) if scores.dtype != object else np.array(
            sorted(range(len(ids)), key=lambda i: (-int(scores[i]), ids[i])), int
        )
        # repeated rows of one id are one candidate each
        self.scores, self.ids = scores[order[:self.k]], ids[order[:self.k]]


def _search_chunk(query: np.ndarray, query_id: int, best: _Best, columns: np.ndarray, left: np.ndarray, ids: np.ndarray):
    """Add the chunk's candidates that can be among the query's best."""
    alive = np.flatnonzero(ids != query_id)
    scores = np.zeros(len(alive), columns.dtype)
    exact = columns.dtype != object
    size = len(query)
    for j, start in enumerate(range(0, size, BLOCK)):
        rows = columns[start:start + BLOCK]
        part = query[start:start + BLOCK]
        whole_chunk = len(alive) == len(ids)
        scores = scores + (part @ (rows if whole_chunk else rows[:, alive]))
        bar = best.bar()
        if bar is not None and exact:
            rest = query[start + BLOCK:]
            most = math.sqrt(float(rest @ rest)) * left[j, alive] * (1 + 1e-9) + 1e-6
            stay = scores + most >= bar
            if not stay.all():
                alive, scores = alive[stay], scores[stay]
        if not len(alive):
            return
    if len(alive) > 4 * best.k and exact:  # a cheap cut before the sort; equal scores stay
        cut = np.partition(scores, len(scores) - best.k)[len(scores) - best.k]
        stay = scores >= cut
        alive, scores = alive[stay], scores[stay]
    if not exact:
        scores = np.array([min(max(s, LOWEST), HIGHEST) for s in scores.tolist()], object)
    best.add(scores, ids[alive])


def _searcher(k: int, queries_of):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_size, reach = {}, 0.0
        for size, (ids, raw) in queries_of().items():
            by_size[size] = (ids, quantised(raw), [_Best(k) for _ in ids])
        held: dict[int, list] = {}

        def run(size: int) -> None:
            ids = np.concatenate([i for i, _ in held[size]])
            values = quantised(np.concatenate([v for _, v in held[size]]))
            held[size] = []
            query_ids, queries, bests = by_size[size]
            limit = float(np.abs(values).max(initial=0)) * float(np.abs(queries).max(initial=0)) * max(size, 1)
            if limit >= EXACT or values.dtype == object or queries.dtype == object:
                values, asked = values.astype(object), queries.astype(object)
                if values.size:
                    values = np.vectorize(int, otypes=[object])(values)
                    asked = np.vectorize(int, otypes=[object])(asked)
                left = None
            else:
                asked = queries
                squares = np.concatenate([np.zeros((len(values), 1)), np.cumsum(values[:, ::-1] ** 2, axis=1)], axis=1)
                # norms of what is left after each block of dimensions
                after = [max(0, size - start - BLOCK) for start in range(0, max(size, 1), BLOCK)]
                left = np.sqrt(squares[:, after].T)
            columns = np.ascontiguousarray(values.T)
            for query, query_id, best in zip(asked, query_ids.tolist(), bests):
                _search_chunk(query, query_id, best, columns, left, ids)

        for batch in batches:
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            vectors = batch.column("vector")
            sizes = np.diff(vectors.offsets.to_numpy())
            values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            starts = np.cumsum(sizes) - sizes
            for size in np.unique(sizes).tolist():
                if size not in by_size:
                    continue
                rows = np.flatnonzero(sizes == size)
                taken = values[starts[rows][:, None] + np.arange(size)]
                for lo in range(0, len(rows), CHUNK):
                    held.setdefault(size, []).append((ids[rows[lo:lo + CHUNK]], taken[lo:lo + CHUNK]))
                    if sum(len(i) for i, _ in held[size]) >= CHUNK:
                        run(size)
        for size in list(held):
            if held[size]:
                run(size)
        for ids, _, bests in by_size.values():
            for query_id, best in zip(ids.tolist(), bests):
                if len(best.ids):
                    scores = [int(s) for s in best.scores]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([query_id] * len(scores), pa.int64()), pa.array(best.ids, pa.int64()),
                         pa.array(scores, pa.int64())],
                        ["query_id", "vec_id", "score"],
                    )

    return search


def top_k(
    candidates: DataFrame, queries: DataFrame, k: int = 10, key: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's ``k`` best candidates, ties to the smaller id.

    Components are quantised to floor(1024 x). A candidate with the query's own
    id is left out. Vectors that are null or hold a null or a non-finite
    component, and rows with a null id, take no part; only vectors of equal
    length are compared. Candidate rows that repeat an id count each, queries
    that repeat an id are asked once. A query without candidates, or an empty
    table, has no rows. Scores beyond 64 bits are cut to the range's ends before they are ranked.
    Other columns are not read.
    """
    spark = candidates.sparkSession
    pool = candidates.where(F.col(key).isNotNull() & usable(F.col(vector))).select(
        F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector")
    )
    asked = queries.where(F.col(key).isNotNull() & usable(F.col(vector))).groupBy(F.col(key).cast("long").alias("id")).agg(
        F.min(F.col(vector).cast("array<double>")).alias("vector")
    )
    path = scratch_path(spark, "top-k-queries")
    asked.write.parquet(path)
    asked = spark.read.parquet(path)
    blocks = max(1, math.ceil(asked.count() / QUERY_BLOCK))
    results = scratch_path(spark, "top-k")
    for b in range(blocks):
        block = asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).toArrow()  # about QUERY_BLOCK rows
        by_size: dict[int, tuple[list, list]] = {}
        for one_id, one in zip(block.column("id").to_pylist(), block.column("vector").to_pylist()):
            ids, vectors = by_size.setdefault(len(one), ([], []))
            ids.append(one_id)
            vectors.append(one)
        sent = spark.sparkContext.broadcast({
            size: (np.array(ids, np.int64), np.array(vectors, np.float64).reshape(len(ids), size))
            for size, (ids, vectors) in by_size.items()
        })
        found = pool.mapInArrow(_searcher(k, lambda: sent.value), "query_id bigint, vec_id bigint, score bigint")
        # at most k rows per query and task meet here
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        ranked.select("query_id", "rank", "vec_id", "score").write.mode("append").parquet(results)
        sent.destroy()
    return spark.read.parquet(results)
