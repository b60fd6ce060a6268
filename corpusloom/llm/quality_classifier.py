"""A quality classifier: random-indexing word vectors, pooled per document, and a small network.

Every token falls into one of ``BUCKETS`` buckets by hash, and every bucket has a sparse random index vector. The context vector
of a bucket sums the index vectors of the tokens around each of its occurrences in the whole corpus; these sums are whole numbers,
so the order of tasks changes nothing. The table of vectors has a fixed size whatever the vocabulary, so it can go to every task.
A document is the mean of the vectors of its tokens, and of its different tokens. A network with two layers is fitted on
a bounded sample of labelled rows, and its temperature on rows of the sample that it has not seen.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import keyed_texts, sliced
from corpusloom.session import materialize

#: size of the table of vectors: at most ``BUCKETS * DIM`` numbers, 2 MB
BUCKETS = 1 << 14
DIM = 32
NONZERO = 4
REACH = 2
SEED = 20
#: labelled rows that the network is fitted on, at most
SAMPLE_ROWS = 20_000
HIDDEN = 32
EPOCHS = 60
CALIBRATION = 5  # every fifth row of the sample sets the temperature
THRESHOLD = 0.3
SLICE_TOKENS = 200_000
CACHE_PIECES = 200_000

TOKEN = re.compile(r"[^\W\d_]+|\d|[^\w\s]|_")


def index_vectors() -> np.ndarray:
    """For every bucket ``NONZERO`` random entries of 1 or -1."""
    rng = np.random.default_rng(SEED)
    out = np.zeros((BUCKETS, DIM), np.int16)
    places = rng.random((BUCKETS, DIM)).argsort(axis=1)[:, :NONZERO]
    np.put_along_axis(out, places, rng.choice(np.array([-1, 1], np.int16), (BUCKETS, NONZERO)), axis=1)
    return out


def bucket(token: str) -> int:
    return zlib.crc32(token.encode()) % BUCKETS


class Tokens(dict):
    """Buckets of the tokens of a piece of text without white space: words in lower case, what case they are in, and signs."""

    def __missing__(self, piece: str) -> bytes:
        out = []
        for token in TOKEN.findall(piece):
            out.append(bucket(token.lower()))
            if len(token) > 1 and token.isupper():
                out.append(bucket("<upper>"))
        value = np.array(out, "<i4").tobytes()
        if len(piece) <= 48:
            if len(self) >= CACHE_PIECES:
                self.clear()
            self[piece] = value
        return value

    def of(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.__getitem__, text.split())), "<i4")


def context_sums(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``bucket`` and ``DIM`` sums: what stands within ``REACH`` tokens around a bucket's tokens, over all documents."""
    names = [f"v{d}" for d in range(DIM)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, index = Tokens(), index_vectors()
        sums = np.zeros((BUCKETS, DIM), np.int64)
        seen = np.zeros(BUCKETS, bool)
        gap = np.full(REACH, BUCKETS, np.int32)  # keeps the tokens of two documents apart
        index = np.vstack([index, np.zeros((1, DIM), np.int16)])

        def add(parts: list[np.ndarray]) -> None:
            ids = np.concatenate([gap, *parts, gap])
            for at in range(REACH, len(ids) - REACH, SLICE_TOKENS):
                part = ids[at - REACH : min(at + SLICE_TOKENS, len(ids) - REACH) + REACH]
                near = index[part]
                mid = part[REACH:-REACH]
                around = sum(near[REACH + o : len(part) - REACH + o] for o in range(-REACH, REACH + 1) if o)
                order = np.argsort(mid, kind="stable")
                sorted_ = mid[order]
                first = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]]))
                added = np.add.reduceat(around[order].astype(np.int32), first, axis=0)
                at_ids = sorted_[first]
                real = at_ids < BUCKETS
                sums[at_ids[real]] += added[real]
                seen[at_ids[real]] = True

        for batch in sliced(batches):
            held, n = [], 0
            for t in batch.column("text").to_pylist():
                ids = tokens.of(t)
                held += [ids, gap]
                n += len(ids) + REACH
                if n > SLICE_TOKENS:
                    add(held)
                    held, n = [], 0
            if held:
                add(held)
        rows = np.flatnonzero(seen)
        for at in range(0, len(rows), 4096):
            part = rows[at : at + 4096]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), *(pa.array(sums[part, d]) for d in range(DIM))], ["bucket", *names])

    parts = keyed_texts(docs, key, text).mapInArrow(run, "bucket int, " + ", ".join(f"{n} long" for n in names))
    return parts.groupBy("bucket").agg(*[F.sum(n).alias(n) for n in names])


def word_vectors(sums: DataFrame) -> np.ndarray:
    """The table of vectors, at most ``BUCKETS`` rows: a bucket's own index vector and its context, of equal lengths."""
    table = sums.toArrow()
    out = index_vectors() / np.sqrt(NONZERO)
    if table.num_rows:
        at = table.column("bucket").to_numpy()
        context = np.stack([table.column(f"v{d}").to_numpy() for d in range(DIM)], axis=1).astype(np.float64)
        out[at] += context / np.maximum(np.linalg.norm(context, axis=1, keepdims=True), 1e-12)
    return out.astype(np.float32)


def pooled(docs: DataFrame, vectors: np.ndarray, key: str = "doc_id", text: str = "text", row: str | None = None) -> DataFrame:
    """``doc_id, features`` (and ``row``): the mean vector of the tokens and that of the different tokens; zeros for a text without tokens."""

    carried = ["row"] if row else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens()
        for batch in sliced(batches):
            out = np.zeros((batch.num_rows, 2 * DIM), np.float32)
            for i, t in enumerate(batch.column("text").to_pylist()):
                counts = np.bincount(tokens.of(t), minlength=1)
                own = np.flatnonzero(counts)
                if len(own):
                    v = vectors[own]
                    out[i, :DIM] = counts[own] @ v / counts.sum()
                    out[i, DIM:] = v.mean(axis=0)
            held = pa.FixedSizeListArray.from_arrays(pa.array(out.ravel()), 2 * DIM).cast(pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), held, *(batch.column(c) for c in carried)], ["doc_id", "features", *carried])

    return keyed_texts(docs, key, text, row).mapInArrow(run, "doc_id long, features array<float>" + ", row long" * len(carried))


@dataclass
class Network:
    """Two layers; the logit over the temperature gives the probability."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -30, 30)))


def loss(logit: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, logit) - y * logit))


def fit(x: np.ndarray, y: np.ndarray) -> Network:
    """Adam on the logistic loss, then the temperature with the least loss on rows kept apart.

    Without rows, or with one class only, the score is that class's share.
    """
    d = x.shape[1] if x.ndim == 2 else 2 * DIM
    if len(y) == 0 or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.5
        bias = 30.0 * (2 * share - 1)
        return Network(np.zeros(d), np.ones(d), np.zeros((d, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), bias)
    rng = np.random.default_rng(SEED)
    held = np.arange(len(y)) % CALIBRATION == 0 if len(y) >= 10 * CALIBRATION else np.zeros(len(y), bool)
    a, b = x[~held].astype(np.float64), y[~held].astype(np.float64)
    net = Network(a.mean(axis=0), a.std(axis=0) + 1e-6, rng.normal(0, d**-0.5, (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), 0.0)
    a = (a - net.mean) / net.scale
    weights = [net.w1, net.b1, net.w2, np.zeros(1)]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    step = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(b))
        rate = 0.01 * (1 - epoch / EPOCHS) + 1e-4
        for at in range(0, len(order), 256):
            rows = order[at : at + 256]
            step += 1
            hidden = np.tanh(a[rows] @ weights[0] + weights[1])
            error = (1 / (1 + np.exp(-np.clip(hidden @ weights[2] + weights[3], -30, 30))) - b[rows]) / len(rows)
            back = np.outer(error, weights[2]) * (1 - hidden**2)
            gradients = [a[rows].T @ back + 1e-4 * weights[0], back.sum(axis=0), hidden.T @ error + 1e-4 * weights[2], error.sum(keepdims=True)]
            for k, g in enumerate(gradients):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                weights[k] -= rate * first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    net.w1, net.b1, net.w2, net.b2 = weights[0], weights[1], weights[2], float(weights[3][0])
    if held.any():
        logit = net.logit(x[held].astype(np.float64))
        choices = np.geomspace(0.25, 8, 61)
        net.temperature = float(choices[np.argmin([loss(logit / t, y[held]) for t in choices])])
    return net


def held_out(key: str = "doc_id"):
    """Rows that take no part in learning: the remainder of the CRC-32 of the id as text by 5 is 0."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 5 == 0, F.lit(False))


def quality_scores(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", row: str | None = None) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``; only its texts are inputs of a score. The column that ``row`` names is carried along as ``row``.

    The network learns from labelled rows that are not held out, at most ``SAMPLE_ROWS`` of them, picked by hash;
    the word vectors from all texts. A null text counts as empty, which is scored too. Null labels and labels
    of unknown documents play no part; of several labels of a document the highest counts. Repeated rows come out each.
    Without any label the score is 0.5.
    """
    features = materialize(pooled(docs, word_vectors(context_sums(docs, key, text)), key, text, row), "quality-features")
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
    known = known.filter(F.col("doc_id").isNotNull() & F.col("y").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max("y").alias("y"))
    unique = features.filter("doc_id is not null").dropDuplicates(["doc_id"])
    sample = unique.join(known, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_ROWS).toArrow()
    x = np.array(sample.column("features").to_pylist(), np.float32).reshape(-1, 2 * DIM)
    net = fit(x, sample.column("y").to_numpy())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("features").flatten().to_numpy(zero_copy_only=False).reshape(-1, 2 * DIM)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(net.score(x.astype(np.float64))), *(batch.column(c) for c in carried)], ["doc_id", "score", *carried])

    carried = ["row"] if row else []
    scored = features.mapInArrow(run, "doc_id long, score double" + ", row long" * len(carried))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), *carried)
