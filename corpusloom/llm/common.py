"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MIX = np.uint64(0x9E3779B97F4A7C15)


def keyed_texts(docs: DataFrame, key: str = "doc_id", text: str = "text", row: str | None = None) -> DataFrame:
    """Only the key and the text, and the whole numbers of the column ``row`` as ``row``; other columns, whatever their names, play no part. A null text counts as empty."""
    carried = [F.col(row).cast("long").alias("row")] if row else []
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), *carried)


#: bytes of a batch that a Python function works on at once
SLICE_BYTES = 4 << 20


def sliced(batches: Iterator[pa.RecordBatch], size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in parts of about ``size`` bytes, so that what Python makes of a batch stays small."""
    for batch in batches:
        if batch.num_rows:
            rows = max(1, batch.num_rows * size // max(batch.nbytes, 1))
            for at in range(0, batch.num_rows, rows):
                yield batch.slice(at, rows)
    pa.default_memory_pool().release_unused()


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``fn`` applied to every Arrow batch of every task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            if (out := fn(batch)) is not None:
                yield out

    return df.mapInArrow(run, schema)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts of a column without nulls, and the offsets of the texts among them."""
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, at - at[0]


def stream_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The groups of equal ``key`` in sorted input, each as one table, across batch borders."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key)
        same = pa.compute.equal(keys.slice(1), keys.slice(0, len(keys) - 1)) if len(keys) > 1 else None
        cuts = [0, *((np.flatnonzero(~same.to_numpy(zero_copy_only=False)) + 1).tolist() if same is not None else []), len(keys)]
        for lo, hi in zip(cuts, cuts[1:]):
            value = keys[lo].as_py()
            if held and value != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
            last = value
    if held:
        yield pa.Table.from_batches(held)


def top_by(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows of every key; Spark keeps at most ``n`` rows of a key per task before it shuffles."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n)


def hash128(*columns: str) -> tuple[Column, Column]:
    """Two 64-bit hashes with seeds of their own; hashes skip nulls, so that a value is null is hashed too."""
    values = [x for c in columns for x in (F.col(c).isNull(), F.col(c))]
    return F.xxhash64(F.lit(1), *values), F.xxhash64(F.lit(2), *values)


#: keys that a table can be sent to all tasks for
SHARES = 4096


def join_by_share(rows: DataFrame, table: DataFrame, keys: list[str], n: str) -> DataFrame:
    """``rows`` joined with ``table``, both read twice; ``keys`` are unique in ``table`` and ``n`` there tells how many rows hold them.

    Keys with a share of all rows of 1 / ``SHARES`` or more, of which there are ``SHARES`` at most, are sent to every task, so no
    task gets the rows of a hot key; the others meet in a merge join. Nulls are keys like others.
    """
    least = rows.count() / SHARES
    often, seldom = table.filter(F.col(n) >= least).drop(n), table.filter(F.col(n) < least).drop(n)
    names = [f"_{k}" for k in keys]

    def match(part: DataFrame) -> tuple[DataFrame, Column]:
        part = part.withColumnsRenamed(dict(zip(keys, names)))
        on = F.lit(True)
        for k, name in zip(keys, names):
            on &= F.col(k).eqNullSafe(F.col(name))
        return part, on

    often, on = match(often)
    seldom, _ = match(seldom)
    hot = rows.join(F.broadcast(often), on)
    rest = rows.join(F.broadcast(often.select(*names)), on, "left_anti").join(seldom.hint("merge"), on)
    return hot.unionByName(rest).drop(*names)
