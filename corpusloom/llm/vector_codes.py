"""Compression of vectors to codes: every part of a vector becomes the number of the nearest entry of the part's codebook.

Codebooks are learned in rounds over all vectors. A task finds the nearest entries by Orchard's search: every entry keeps the other ones
sorted by their distance from it; a search walks the list of the best entry so far, jumps to the list of any better one it meets, marks
what it has measured, and stops where the list goes beyond twice the best distance, since the triangle inequality rules out the rest. All
numbers are whole, squares of distances included, so results are exact. A task returns one row of sums for every part and entry; these
rows are summed by part and entry, and only the codebooks reach the driver.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import join_by_share, sliced
from corpusloom.session import materialize

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
MOST = 2**63 - 1
#: rows that are searched together
BATCH = 8192


def finite_vectors(vectors: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """``vec_id, label, vec`` without vectors that are null or hold null, NaN or infinite components."""
    kind = "array<float>" if dict(vectors.dtypes)[vector] == "array<float>" else "array<double>"
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(label).alias("label"), F.col(vector).cast(kind).alias("vec"))
    return rows.filter("vec IS NOT NULL").filter(~F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))


def whole(x: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)``; whole numbers of any size where 64 bits could overflow."""
    with np.errstate(over="ignore"):
        scaled = np.floor(x.astype(np.float64) * scale)
    if (np.abs(scaled) < 2**60).all():
        return scaled.astype(np.int64)
    numbers = [int(s) if math.isfinite(s) else int(v) * scale for s, v in zip(scaled.ravel().tolist(), x.ravel().tolist())]
    out = np.empty(len(numbers), object)
    out[:] = numbers
    return out.reshape(x.shape)


def largest(x: np.ndarray) -> int:
    return max(int(x.max()), -int(x.min())) if x.size else 0


class Codebook:
    """The entries of one part and, for each, the others in the order of their distance."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        n, width = entries.shape
        wide = entries if 8 * width * (2 * largest(entries)) ** 2 < 2**62 else entries.astype(object)
        gap = np.array([[((a - b) ** 2).sum() for b in wide] for a in wide]).reshape(n, n)
        order = [[j for _, j in sorted((int(gap[i, j]), j) for j in range(n) if j != i)] for i in range(n)]
        self.order = np.array(order, np.int64).reshape(n, n - 1)
        self.gap = np.take_along_axis(gap, self.order, axis=1)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For every row the nearest entry, ties to the lower one, the square of its distance, and how many entries were measured."""
        entries, gap, n = self.entries, self.gap, len(self.entries)
        if 8 * x.shape[1] * (largest(x) + largest(entries)) ** 2 >= 2**62:
            x, entries, gap = x.astype(object), entries.astype(object), gap.astype(object)
        best = np.zeros(len(x), np.int64)
        far = ((x - entries[0]) ** 2).sum(axis=1)
        seen = np.zeros((len(x), n), bool)
        seen[:, 0] = True
        place = np.zeros(len(x), np.int64)
        open_ = np.arange(len(x)) if n > 1 else np.zeros(0, np.int64)
        while len(open_):
            at = best[open_], place[open_]
            # entries beyond twice the distance are farther than the best one; at exactly twice one may be as far
            open_, entry = (v[gap[at] <= 4 * far[open_]] for v in (open_, self.order[at]))
            place[open_] += 1
            new = ~seen[open_, entry]
            rows, entry = open_[new], entry[new]
            seen[rows, entry] = True
            d = ((x[rows] - entries[entry]) ** 2).sum(axis=1)
            better = (d < far[rows]) | ((d == far[rows]) & (entry < best[rows]))
            rows = rows[better]
            best[rows], far[rows], place[rows] = entry[better], d[better], 0
            open_ = open_[place[open_] < n - 1]
        return best, far, seen.sum(axis=1)


def cuts(dim: int, parts: int) -> list[tuple[int, int]]:
    return [(i * dim // parts, (i + 1) * dim // parts) for i in range(parts)]


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def matrices(batches: Iterator[pa.RecordBatch], dim: int, scale: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in sliced(batches):
        for at in range(0, batch.num_rows, BATCH):
            part = batch.slice(at, BATCH)
            yield part, whole(matrix(part.column("vec"), dim), scale)


def update(rows: DataFrame, books: list[np.ndarray], dim: int, scale: int) -> list[np.ndarray]:
    """The codebooks after one round: each entry becomes the mean, rounded down, of the parts nearest to it; unused ones stay."""
    spans = cuts(dim, len(books))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [Codebook(b) for b in books]
        counts = [[0] * len(b) for b in books]
        sums = [np.zeros(b.shape, object) for b in books]
        for _, x in matrices(batches, dim, scale):
            for p, (lo, hi) in enumerate(spans):
                code, _, _ = found[p].nearest(x[:, lo:hi])
                for e, n in enumerate(np.bincount(code, minlength=len(books[p])).tolist()):
                    if n:
                        counts[p][e] += n
                        # a batch of numbers below 2^60 in parts that cannot overflow
                        sums[p][e] += _total(x[:, lo:hi][code == e])
        out = [(p, e, n, [str(s) for s in sums[p][e]]) for p, c in enumerate(counts) for e, n in enumerate(c) if n]
        yield _partials(out)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], tuple[int, list[int]]] = {}
        for batch in batches:
            for r in batch.to_pylist():
                n, total = held.get((r["part"], r["entry"]), (0, [0] * len(r["sums"])))
                held[r["part"], r["entry"]] = n + r["n"], [a + int(b) for a, b in zip(total, r["sums"])]
        yield _partials([(p, e, n, [str(s) for s in total]) for (p, e), (n, total) in held.items()])

    schema = "part int, entry int, n long, sums array<string>"
    merged = rows.select("vec").mapInArrow(assign, schema).repartition("part", "entry").mapInArrow(merge, schema)
    after = [[list(map(int, e)) for e in b.tolist()] for b in books]
    for r in merged.collect():  # one row for each part and entry
        after[r.part][r.entry] = [int(s) // r.n for s in r.sums]
    return [_entries(b, hi - lo) for b, (lo, hi) in zip(after, spans)]


def _total(x: np.ndarray) -> np.ndarray:
    return x.sum(axis=0) if largest(x) < 2**48 else x.astype(object).sum(axis=0)


def _partials(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"part": pa.int32(), "entry": pa.int32(), "n": pa.int64(), "sums": pa.list_(pa.string())}
    columns = zip(*rows) if rows else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds.values())], list(kinds))


def _entries(entries: list[list[int]], width: int) -> np.ndarray:
    small = all(abs(v) < 2**60 for e in entries for v in e)
    out = np.empty((len(entries), width), np.int64 if small else object)
    for i, e in enumerate(entries):
        out[i] = e
    return out


def books_hash(books: list[np.ndarray]) -> str:
    """SHA-256 of all numbers in order, with commas."""
    return hashlib.sha256(",".join(str(int(v)) for b in books for e in b for v in e).encode()).hexdigest()


def learn(rows: DataFrame, dim: int, scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[np.ndarray]:
    """Codebooks that start as the parts of the rows of the smallest ids."""
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "vec").limit(entries).collect()
    start = whole(np.array([r.vec for r in first], np.float64).reshape(len(first), dim), scale)
    books = [start[:, lo:hi] for lo, hi in cuts(dim, parts)]
    for _ in range(rounds):
        books = update(rows, books, dim, scale)
    return books


def assigned(rows: DataFrame, books: list[np.ndarray], dim: int, scale: int) -> DataFrame:
    """``vec_id, label, code, error, n_measured``."""
    spans, kind = cuts(dim, len(books)), dict(rows.dtypes)["label"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [Codebook(b) for b in books]
        for batch, x in matrices(batches, dim, scale):
            parts = [book.nearest(x[:, lo:hi]) for book, (lo, hi) in zip(found, spans)]
            codes = np.stack([p[0] for p in parts], axis=1).astype(np.uint8)
            error = [min(int(e), MOST) for e in sum(p[1].astype(object) for p in parts)]
            columns = [batch.column("vec_id"), batch.column("label"), pa.array([c.tobytes().hex() for c in codes], pa.string())]
            columns += [pa.array(error, pa.int64()), pa.array(sum(p[2] for p in parts), pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "code", "error", "n_measured"])

    return rows.mapInArrow(run, f"vec_id long, label {kind}, code string, error long, n_measured int")


def compress(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
) -> DataFrame:
    """``vec_id, label, code, error, label_error, codebooks_sha256, n_measured`` of every vector that takes part.

    Components become ``floor(scale * x)`` and vectors are cut into ``parts`` parts at ``i * length // parts``. Vectors that are null or hold null or
    non-finite components take no part, nor do those of another length than that of the smallest id. Rows without an id are coded
    like others and come last where the first ``entries`` ids (at most 256) start the codebooks; rows of equal ids go by their components.
    Fewer rows than that start fewer entries. ``error`` is the sum of the squares of the parts' distances, ``label_error`` the sum over the
    rows of one label, null being one; sums beyond a long become the greatest one. ``n_measured`` counts the distances worked out for
    the final code. No rows give no rows.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a codebook has 1 to 256 entries")
    rows = materialize(finite_vectors(vectors, key, vector, label), "codes-vectors")
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "vec").select(F.size("vec")).first()
    if first is None:
        none = F.lit(None).cast("long")
        return rows.select("vec_id", "label", F.lit("").alias("code"), none.alias("error"), none.alias("label_error"), F.lit("").alias("codebooks_sha256"), F.lit(0).alias("n_measured"))
    dim = first[0]
    rows = rows.filter(F.size("vec") == dim)
    books = learn(rows, dim, scale, parts, entries, rounds)
    coded = materialize(assigned(rows, books, dim, scale), "codes")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(MOST).cast("decimal(38,0)")).cast("long")
    labels = materialize(coded.groupBy("label").agg(total.alias("label_error"), F.count("*").alias("n")), "codes-labels")
    out = join_by_share(coded, labels, ["label"], "n").withColumn("codebooks_sha256", F.lit(books_hash(books)))
    return out.select("vec_id", "label", "code", "error", "label_error", "codebooks_sha256", "n_measured")
