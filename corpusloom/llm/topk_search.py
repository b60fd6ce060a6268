"""Exact top-k by inner product, with candidates eliminated by a pivot table.

The distances of every vector to a fixed number of pivots are worked out once. For a query q and a candidate x the largest
``|d(q, p) - d(x, p)|`` over all pivots is a lower bound of their distance, and ``(|q|^2 + |x|^2 - bound^2) / 2`` an
upper bound of their inner product. Candidates are evaluated in the order of that bound until it falls below the k-th
best score found, which makes the result exact. Vectors are whole numbers, so scores are exact too.

Pivots lie far apart: from a bounded sample, each one is the vector farthest from those chosen before. The same sample gives every
query a first k-th score, which the k-th score over all candidates can only exceed, so that each task leaves out from its start.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import top_by
from corpusloom.session import materialize

PIVOTS = 48
#: vectors, picked by hash, that the pivots are chosen from and that give first k-th scores
SAMPLE = 4096
#: queries per pass over the candidates; a pass ships at most so many vectors with its tasks
QUERY_BLOCK = 1024
#: candidates whose bounds are worked out together, and evaluated together
BATCH = 2048
STEP = 64

SCHEMA = "query_id long, vec_id long, score long"


def scaled(vectors: DataFrame, scale: int, key: str, vector: str) -> DataFrame:
    """``vec_id, dim, vec``: whole-number vectors without those that are null or hold null, NaN or infinite components."""
    x = F.col(vector).cast("array<double>")
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), x.alias("_x")).filter("vec_id is not null and _x is not null")
    rows = rows.filter(~F.exists("_x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))))
    return rows.select("vec_id", F.size("_x").alias("dim"), F.transform("_x", lambda c: F.floor(c * scale)).alias("vec"))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows to pivots; the squares are whole numbers."""
    square = (x * x).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1)[None] - 2 * (x @ pivots.T)
    return np.sqrt(square.astype(np.float64))


def far_apart(x: np.ndarray, n: int) -> np.ndarray:
    """Up to ``n`` different rows: the first one, then always the one farthest from those chosen, ties to the earlier row."""
    chosen = x[:1]
    nearest = np.full(len(x), np.inf)
    while 0 < len(chosen) < n:
        nearest = np.minimum(nearest, distances(x, chosen[-1:])[:, 0])
        i = int(nearest.argmax())
        if not nearest[i] > 0:
            break
        chosen = np.vstack([chosen, x[i]])
    return chosen


def first_limits(ids: np.ndarray, queries: np.ndarray, sample_ids: np.ndarray, sample: np.ndarray, k: int) -> np.ndarray:
    """Each query's k-th best score over the sample's other rows, a score that its k-th best of all is not below."""
    out = np.full(len(ids), -np.inf)
    for i, query in enumerate(ids):
        scores = (sample @ queries[i])[sample_ids != query]
        if len(scores) >= k:
            out[i] = np.partition(scores, len(scores) - k)[len(scores) - k]
    return out


class Best:
    """The ``k`` best candidates of each query so far, ties to the smaller id; ``limits`` are scores that they are known not to be below."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, pivots: np.ndarray, k: int, limits: np.ndarray | None = None):
        self.ids, self.queries, self.pivots, self.k = ids, queries, pivots, k
        self.limits = np.full(len(ids), -np.inf) if limits is None else limits
        self.square = (queries * queries).sum(axis=1)
        self.to_pivots = distances(queries, pivots)
        self.found: list[list[tuple[int, int]]] = [[] for _ in ids]  # (-score, vec_id), in order
        self.evaluated = 0

    def offer(self, ids: np.ndarray, x: np.ndarray, to_pivots: np.ndarray) -> None:
        square = (x * x).sum(axis=1)
        low = np.zeros((len(self.ids), len(ids)))
        for p in range(to_pivots.shape[1]):
            np.maximum(low, np.abs(self.to_pivots[:, p, None] - to_pivots[None, :, p]), out=low)
        total = (self.square[:, None] + square[None]).astype(np.float64)
        high = (total - low * low) / 2 + (1 + 1e-9 * total)  # the margin is far above the rounding errors
        for i, query in enumerate(self.ids):
            best = self.found[i]
            limit = max(-best[-1][0], self.limits[i]) if len(best) == self.k else self.limits[i]
            open_ = np.flatnonzero(high[i] >= limit)
            order = open_[np.argsort(-high[i][open_], kind="stable")]
            for at in range(0, len(order), STEP):
                step = order[at : at + STEP]
                if len(best) == self.k and high[i][step[0]] < -best[-1][0]:
                    break  # no candidate that is left can reach the k-th score
                scores = x[step] @ self.queries[i]
                self.evaluated += len(step)
                new = [(-s, v) for s, v in zip(scores.tolist(), ids[step].tolist()) if v != query]
                best = sorted(best + new)[: self.k]
            self.found[i] = best


def top_k(vectors: DataFrame, is_query, k: int, scale: int = 1024, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` best other rows for each row for which ``is_query`` holds.

    Scores are inner products of ``floor(scale * x)``, ties go to the smaller id; a query with fewer candidates gets all. Vectors that
    are null, without an id, or hold null or non-finite components take no part; vectors are compared with
    those of their own length. A repeated id is a candidate once per row, and a query once, with the least of its vectors. Components beyond 2^27
    after scaling overflow as long arithmetic does. No rows give no rows.

    Queries go in blocks of ``QUERY_BLOCK``, so what a task gets is bounded; each block reads the candidates once.
    """
    spark = vectors.sparkSession
    rows = materialize(scaled(vectors, scale, key, vector), "topk-vectors")
    parts = []
    for (dim,) in rows.select("dim").distinct().orderBy("dim").collect():  # lengths of vectors, a handful
        mine = rows.filter(F.col("dim") == dim)
        drawn = mine.orderBy(F.xxhash64("vec_id"), "vec_id", "vec").limit(SAMPLE).select("vec_id", "vec").toArrow().combine_chunks()
        sample_ids, sample = drawn.column("vec_id").to_numpy(), np.array(drawn.column("vec").to_pylist(), np.int64).reshape(-1, dim)
        pivots = far_apart(sample, PIVOTS)
        queries = materialize(mine.filter(is_query).groupBy("vec_id").agg(F.min("vec").alias("vec")), "topk-queries")
        table = materialize(_pivot_table(mine, pivots, dim), "topk-pivots")
        bounds = _block_bounds(queries)
        for low, high in zip(bounds, bounds[1:]):
            block = queries.filter((F.col("vec_id") >= low) & (F.col("vec_id") < high)).collect()  # at most a few QUERY_BLOCKs
            ids = np.array([r.vec_id for r in block], np.int64)
            vecs = np.array([r.vec for r in block], np.int64).reshape(-1, dim)
            found = _search(table, ids, vecs, pivots, dim, k, first_limits(ids, vecs, sample_ids, sample, k))
            best = top_by(found, ["query_id"], [F.desc("score"), F.asc("vec_id")], k)
            parts.append(materialize(best.select("query_id", F.col("_rn").alias("rank"), "vec_id", "score"), "topk-found"))
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _block_bounds(queries: DataFrame) -> list[int]:
    """Ids that cut the queries into blocks of about ``QUERY_BLOCK``."""
    n, low, high = queries.agg(F.count("*"), F.min("vec_id"), F.max("vec_id")).first()
    if not n:
        return []
    blocks = -(-n // QUERY_BLOCK)
    cuts = queries.agg(F.percentile_approx("vec_id", [i / blocks for i in range(1, blocks)], 100 * blocks)).first()[0] if blocks > 1 else []
    return sorted({low, *cuts, high + 1})


def _pivot_table(rows: DataFrame, pivots: np.ndarray, dim: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far = distances(matrix(batch.column("vec"), dim), pivots)
            held = pa.FixedSizeListArray.from_arrays(pa.array(far.ravel()), far.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("vec"), held], ["vec_id", "vec", "far"])

    return rows.select("vec_id", "vec").mapInArrow(run, "vec_id long, vec array<long>, far array<double>")


def _search(table: DataFrame, ids: np.ndarray, queries: np.ndarray, pivots: np.ndarray, dim: int, k: int, limits: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(ids, queries, pivots, k, limits)
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                best.offer(part.column("vec_id").to_numpy(), matrix(part.column("vec"), dim), matrix(part.column("far"), len(pivots)))
        rows = [(int(q), v, -s) for q, found in zip(ids, best.found) for s, v in found]
        if rows:
            columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
            yield pa.RecordBatch.from_arrays(columns, ["query_id", "vec_id", "score"])

    return table.mapInArrow(run, SCHEMA)
