"""Cutting an ordered corpus into shards by row count or by character budget."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from corpusloom.operators.prefix import BROADCAST_BUCKETS, bucket_of, key_bounds, number_rows, prefix_sums
from corpusloom.session import materialize

#: stretches that are composed at once
FAN = 64


def fixed_row_shards(
    docs: DataFrame, order: Sequence[str], rows_per_shard: int = 10_000, max_rows: int | None = None, **kw
) -> DataFrame:
    """Shards of exactly ``rows_per_shard`` rows, the last one short; optional head of ``max_rows``."""
    rows = number_rows(docs.select(*order), order, "_rn", **kw)
    if max_rows is not None:
        rows = rows.filter(F.col("_rn") <= max_rows)
    return rows.withColumn("shard", F.floor((F.col("_rn") - 1) / rows_per_shard).cast("long")).drop("_rn")


def _hops(ends: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """For a shard ending at each row: the last shard end reachable in this range and the steps to it."""
    n = len(ends)
    step = np.append(np.searchsorted(ends, ends + budget), n)  # row n: outside the range
    last = np.arange(n + 1)
    count = np.zeros(n + 1, dtype="int64")
    live = step < n
    last[live], count[live] = step[live], 1
    while live.any():  # pointer doubling
        nxt = last[last]
        live = nxt != last
        count = count + np.where(live, count[last], 0)
        last = nxt
    return last[:n], count[:n]


def _steps(until: np.ndarray, last: np.ndarray, count: np.ndarray, reach: int) -> dict[str, np.ndarray]:
    """What a stretch of rows does to a chain of shard ends, as a step function of the size that the next end needs.

    From the needed size up to ``until[i]`` the chain leaves the stretch at ``last[i]``, ``count[i]`` ends later; needing more it passes
    through. No chain that enters needs more than ``reach``; steps beyond the first one there are left out, and equal neighbours joined.
    """
    n = np.searchsorted(until, reach) + 1
    until, last, count = until[:n], last[:n], count[:n]
    first = np.ones(len(until), bool)
    first[1:] = until[1:] != until[:-1]  # of rows without a size the first one ends the shard
    until, last, count = until[first], last[first], count[first]
    ends = np.ones(len(until), bool)
    ends[:-1] = (last[1:] != last[:-1]) | (count[1:] != count[:-1])
    return {"until": until[ends], "last": last[ends], "count": count[ends]}


def _row_steps(ends: np.ndarray, start: int, budget: int) -> dict[str, np.ndarray]:
    """The steps of one key range, whose rows where a shard may end have the running sizes ``ends``."""
    last, count = _hops(ends, budget)
    return _steps(ends, ends[last], count + 1, start + budget)


def _through(steps: dict[str, np.ndarray], at: np.ndarray, closed: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Chains, by their last end and how many there were, after the stretch."""
    i = np.searchsorted(steps["until"], at + budget)
    inside = i < len(steps["until"])
    i = i[inside]
    at, closed = at.copy(), closed.copy()
    at[inside] = steps["last"][i]
    closed[inside] += steps["count"][i]
    return at, closed


def _compose(parts: list[dict[str, np.ndarray]], start: int, budget: int) -> dict[str, np.ndarray]:
    """The steps of neighbouring stretches one after the other, the first of which begins at ``start``."""
    reach = start + budget
    untils, ats, counts, enters = [], [], [], []
    for i, steps in enumerate(parts):  # where the first end of a chain can lie
        untils.append(steps["until"])
        ats.append(steps["last"])
        counts.append(steps["count"])
        enters.append(np.full(len(steps["until"]), i))
        if len(steps["until"]) and steps["until"][-1] >= reach:
            break
    until, at, count, enter = map(np.concatenate, (untils, ats, counts, enters))
    for i, steps in enumerate(parts[1:], 1):
        passing = enter < i
        at[passing], count[passing] = _through(steps, at[passing], count[passing], budget)
    return _steps(until, at, count, reach)


STEPS = "_b long, start long, until array<long>, last array<long>, count array<long>"


def _grouped(rows: DataFrame, key: str, order: str, fn: Callable[[pa.RecordBatch], dict], schema: str) -> DataFrame:
    """``fn`` of the rows of each ``key``, sorted by ``order``; a task goes through its groups one after the other."""

    def batch_of(group: list[pa.RecordBatch]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(fn(pa.Table.from_batches(group).combine_chunks().to_batches()[0]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            keys = batch.column(key).to_numpy()
            edges = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
            for low, high in zip(edges, edges[1:]):
                if held and low < high and held[-1].column(key)[0].as_py() != keys[low]:
                    yield batch_of(held)
                    held = []
                if low < high:
                    held.append(batch.slice(low, high - low))
        if held:
            yield batch_of(held)

    return rows.repartition(key).sortWithinPartitions(key, order).mapInArrow(run, schema)


def _entries(rows: DataFrame, blocks: int, budget: int) -> DataFrame:
    """``_b, at, closed, after`` for every key range of ``rows`` (``_b, _rn, _c, size, ends``): the last shard end before it, and how many there are before and after it.

    Steps of ``FAN`` neighbours at a time are composed until one stretch is left; then the chain is followed down again, each stretch telling its
    parts where it enters them. Both ways go through all stretches of a level in one job.
    """

    def row_of(b: int, start: int, steps: dict[str, np.ndarray]) -> dict:
        return {"_b": [b], "start": [start], **{k: pa.array([v], pa.list_(pa.int64())) for k, v in steps.items()}}

    def leaf(group: pa.RecordBatch) -> dict:
        size, start = group["_c"].to_numpy(), group["_c"][0].as_py() - group["size"][0].as_py()
        ends = size[group["ends"].to_numpy(zero_copy_only=False)]
        return row_of(group["_b"][0].as_py(), start, _row_steps(ends, start, budget))

    def parts_of(group: pa.RecordBatch) -> list[dict[str, np.ndarray]]:
        return [{k: group[k][i].values.to_numpy() for k in ("until", "last", "count")} for i in range(group.num_rows)]

    def up(group: pa.RecordBatch) -> dict:
        start = group["start"][0].as_py()
        return row_of(group["_p"][0].as_py(), start, _compose(parts_of(group), start, budget))

    def down(group: pa.RecordBatch) -> dict:
        at, closed = (group[c].to_numpy()[:1] for c in ("at", "closed"))
        found = []
        for steps in parts_of(group):
            before = at[0], closed[0]
            at, closed = _through(steps, at, closed, budget)
            found.append((*before, closed[0]))
        return {"_b": group["_b"], **dict(zip(("at", "closed", "after"), map(pa.array, zip(*found))))}

    levels = [(blocks, materialize(_grouped(rows.select("_b", "_rn", "_c", "size", "ends"), "_b", "_rn", leaf, STEPS), "greedy-steps"))]
    while blocks > FAN:
        blocks = -(-blocks // FAN)
        parents = levels[-1][1].withColumn("_p", F.floor(F.col("_b") / FAN))
        levels.append((blocks, materialize(_grouped(parents, "_p", "_b", up, STEPS), "greedy-steps")))
    found = None
    for n, steps in reversed(levels):
        steps = steps.withColumn("_p", F.floor(F.col("_b") / FAN))
        if found is None:  # one stretch is all there is
            steps = steps.withColumns({"at": F.lit(0).cast("long"), "closed": F.lit(0).cast("long")})
        else:
            steps = steps.join(_sent(found.select(F.col("_b").alias("_p"), "at", "closed"), -(-n // FAN)), "_p")
        found = _grouped(steps, "_p", "_b", down, "_b long, at long, closed long, after long")
    return materialize(found, "greedy-entries")


def _sent(table: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(table) if rows <= BROADCAST_BUCKETS else table.hint("merge")


def greedy_shards(
    docs: DataFrame,
    order: Sequence[str],
    size: Column,
    budget: int,
    align: int = 1,
    flush_tail: bool = True,
    rows_per_bucket: int | None = None,
) -> DataFrame:
    """A shard closes at the first row where its size reaches ``budget`` and its row count is a multiple of ``align``.

    Each key range works out, for every possible entry, where the chain of shard ends leaves the range. These steps are composed
    in a tree, which tells where the chain enters each range, and the ranges number their rows in parallel; the number of jobs grows with the logarithm
    of the number of ranges. Returns the order columns, ``size`` and ``shard``.
    """
    # the texts are read once; everything below works on keys and sizes
    seen = Observation()
    rows = materialize(docs.select(*order, size.cast("long").alias("size")).observe(seen, F.count(F.lit(1)).alias("n")), "greedy-sizes")
    bounds = key_bounds(rows, F.col(order[0]), rows_per_bucket, n=seen.get["n"])
    rows = prefix_sums(rows, order, {"_c": F.col("size"), "_rn": F.lit(1)}, bounds=bounds)
    rows = rows.withColumn("_b", bucket_of(F.col(order[0]), bounds).cast("long")).withColumn("ends", F.col("_rn") % align == 0)
    rows = materialize(rows, "greedy-rows")
    entries = _entries(rows, len(bounds) + 1, budget)

    def assign(group: pa.RecordBatch) -> dict:
        at, closed = group["at"][0].as_py(), group["closed"][0].as_py()
        where = np.flatnonzero(group["ends"].to_numpy(zero_copy_only=False))
        ends = group["_c"].to_numpy()[where]
        closes = []
        i = np.searchsorted(ends, at + budget)
        while i < len(ends):
            closes.append(where[i])
            i = np.searchsorted(ends, ends[i] + budget)
        shard = closed + np.searchsorted(np.array(closes, "int64"), np.arange(group.num_rows))
        return {**{c: group[c] for c in order}, "size": group["size"], "shard": pa.array(shard)}

    schema = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in order)
    placed = rows.join(_sent(entries.drop("after"), len(bounds) + 1), "_b")
    out = _grouped(placed, "_b", "_rn", assign, f"{schema}, size long, shard long")
    if flush_tail:
        return out
    closed = entries.agg(F.max("after")).first()[0] or 0
    return out.filter(F.col("shard") < closed)


def mixed_shards(mixed: DataFrame, sizes: DataFrame, key: str, budget: int) -> DataFrame:
    """Shards of an :func:`insert_mix <corpusloom.operators.mix.insert_mix>`: a shard closes only after a row and its insert.

    ``sizes`` has the key and ``size``. Returns the columns of ``mixed`` and ``shard``.
    """
    rows = mixed.join(sizes.select(key, "size"), key)
    groups = rows.groupBy("group").agg(F.sum("size").cast("long").alias("size"))
    closed = greedy_shards(groups, ["group"], F.col("size"), budget).select("group", "shard")
    return rows.join(closed, "group").select(*mixed.columns, "shard")


def write_shards(
    rows: DataFrame, path: str, order: Sequence[str], columns: Sequence[str] = ("text",), shard: str = "shard", rows_per_group: int = 1024
) -> int:
    """Write every shard as ``shard_%05d.parquet``, its rows along ``order``, in zstd row groups of ``rows_per_group`` rows.

    Shards that are there already are skipped. A shard gets its name when all its rows are written, so one that a lost job began
    is written again. Returns the number of shards written.
    """
    spark = rows.sparkSession
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(target)
    done = [f.getPath().getName() for f in files.globStatus(jvm.org.apache.hadoop.fs.Path(path, "shard_*.parquet")) or []]
    numbers = spark.createDataFrame([(int(name[6:-8]),) for name in done], f"{shard} long")
    todo = rows.withColumn(shard, F.col(shard).cast("long")).join(numbers, shard, "left_anti")
    begun = jvm.org.apache.hadoop.fs.Path(path, f"_begun-{uuid.uuid4().hex}")
    # a shard has a bounded size, so one task writes it
    dealt = todo.repartition(shard).sortWithinPartitions(shard, *order).select(*columns, shard)
    dealt.write.partitionBy(shard).option("compression", "zstd").option("parquet.block.row.count.limit", rows_per_group).parquet(begun.toString())
    written = 0
    for folder in files.globStatus(jvm.org.apache.hadoop.fs.Path(begun, f"{shard}=*")) or []:
        number = int(folder.getPath().getName().split("=")[1])
        (part,) = [f.getPath() for f in files.listStatus(folder.getPath()) if f.getPath().getName().endswith(".parquet")]
        files.rename(part, jvm.org.apache.hadoop.fs.Path(path, f"shard_{number:05d}.parquet"))
        written += 1
    files.delete(begun, True)
    return written
