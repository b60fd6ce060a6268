"""Packing documents into sequences by a grouping genetic algorithm on islands.

A solution is a set of bins. Crossover injects well-filled bins of one parent whole into the other, dissolves the
bins that then hold a document twice and places the displaced documents by best fit. Pieces are dealt to blocks of
bounded size by hash; every block is evolved on several islands, which are tasks of their own, and after each epoch
every island gets the elite of its neighbour. The best island's bins count. The bins of all blocks that are not well filled
go to the next round, dealt to other blocks, so that what a block leaves half empty is filled from other blocks. Rounds end
when one no longer lowers the number of bins.
"""

from __future__ import annotations

import random
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.bpe import SLICE_TEXT, Encoder, load
from corpusloom.llm.common import keyed_texts, sliced
from corpusloom.session import materialize

BLOCK_PIECES = 2048
ISLANDS = 3
POPULATION = 4
EPOCHS = 2
GENERATIONS = 6
#: a bin filled so far is passed on whole, and is not opened by a later round
WELL_FILLED = 0.99

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, path: str, capacity: int, end_id: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document's ids and ``end_id``, cut into pieces of ``capacity`` ids where it is longer.

    A row per piece: where it starts, its length and the CRC-32 of its ids as little-endian 4-byte integers.
    A null text counts as empty and still has ``end_id``.
    """
    closing = np.array([end_id], "<i4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, width = Encoder(load(path)), 4 * capacity
        for batch in sliced(batches, SLICE_TEXT):
            rows: list[tuple] = []
            found, ends = coder.encode(batch.column("text"))
            found, ends = found.astype("<i4").tobytes(), (4 * ends).tolist()
            for doc, start, end in zip(batch.column("doc_id").to_pylist(), ends, ends[1:]):
                ids = found[start:end] + closing
                for k, at in enumerate(range(0, len(ids), width)):
                    part = ids[at : at + width]
                    rows.append((doc, k, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = [list(c) for c in zip(*rows)]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return keyed_texts(docs, key, text).mapInArrow(run, PIECE)


class Bins:
    """Bins of items, each list with what it holds; best fit by a bit mask of the free room that occurs."""

    def __init__(self, capacity: int, sizes: list[int], bins: list[list[int]] = ()):
        self.capacity, self.sizes = capacity, sizes
        self.bins = [list(b) for b in bins]
        self.free = [capacity - sum(map(sizes.__getitem__, b)) for b in self.bins]

    def place(self, items: list[int]) -> None:
        """Put each item, in order, into the bin with the least room that takes it, or into a new one."""
        by_room: dict[int, list[int]] = {}
        mask = 0
        for b, room in enumerate(self.free):
            by_room.setdefault(room, []).append(b)
            mask |= 1 << room
        for item in items:
            size = self.sizes[item]
            if fits := mask >> size:
                room = size + (fits & -fits).bit_length() - 1
                b = by_room[room].pop()
                if not by_room[room]:
                    mask ^= 1 << room
            else:
                b, room = len(self.bins), self.capacity
                self.bins.append([])
                self.free.append(room)
            self.bins[b].append(item)
            self.free[b] = room = room - size
            by_room.setdefault(room, []).append(b)
            mask |= 1 << room

    def score(self) -> tuple[int, float]:
        """Fewer bins are better, then bins that are unlike in fill."""
        c = self.capacity
        return -len(self.bins), sum((1 - f / c) ** 2 for f in self.free)

    def labels(self) -> list[int]:
        out = [0] * len(self.sizes)
        for b, items in enumerate(self.bins):
            for item in items:
                out[item] = b
        return out


def from_labels(capacity: int, sizes: list[int], labels: list[int]) -> Bins:
    bins: list[list[int]] = [[] for _ in range(max(labels) + 1)]
    for item, b in enumerate(labels):
        bins[b].append(item)
    return Bins(capacity, sizes, bins)


def by_size(sizes: list[int], items, jitter: float, rng: random.Random) -> list[int]:
    return sorted(items, key=lambda i: (-sizes[i] * (1 + jitter * rng.random()), i))


def crossover(a: Bins, b: Bins, rng: random.Random) -> Bins:
    """Well-filled bins of ``b`` enter ``a`` whole; bins of ``a`` that share an item with them are dissolved."""
    limit = a.capacity * (1 - WELL_FILLED)
    chosen = [x for x, free in zip(b.bins, b.free) if free <= limit and rng.random() < 0.5]
    taken = {i for x in chosen for i in x}
    rest, displaced = [], []
    for x in a.bins:
        if taken.isdisjoint(x):
            rest.append(x)
        else:
            displaced += [i for i in x if i not in taken]
    child = Bins(a.capacity, a.sizes, chosen + rest)
    child.place(by_size(a.sizes, displaced, 0.0, rng))
    return child


def mutate(a: Bins, rng: random.Random) -> Bins:
    """The least filled bin and some others are dissolved and their items placed anew, in a slightly changed order."""
    gone = {max(range(len(a.free)), key=a.free.__getitem__), *rng.sample(range(len(a.bins)), min(len(a.bins), 4))}
    child = Bins(a.capacity, a.sizes, [x for k, x in enumerate(a.bins) if k not in gone])
    child.place(by_size(a.sizes, [i for k in gone for i in a.bins[k]], 0.2, rng))
    return child


def evolve(sizes: list[int], population: list[list[int]], capacity: int, seed: str) -> list[list[int]]:
    """One epoch of one island: solutions as bin numbers of the items, the best first.

    It ends early once the number of bins is the sum of sizes over the capacity, which no solution can beat.
    """
    rng = random.Random(seed)
    fewest = -(-sum(sizes) // capacity)
    found = [from_labels(capacity, sizes, x) for x in population]
    while len(found) < POPULATION:
        found.append(Bins(capacity, sizes))
        found[-1].place(by_size(sizes, range(len(sizes)), 0.1 * (len(found) - 1), rng))
        if len(found[-1].bins) <= fewest:
            break
    found.sort(key=Bins.score, reverse=True)
    for _ in range(GENERATIONS):
        if len(found[0].bins) <= fewest or len(found) < 2:
            break
        a, b = rng.sample(range(len(found)), 2)
        child = mutate(crossover(found[a], found[b], rng), rng)
        if child.score() > found[-1].score():
            found[-1] = child
            found.sort(key=Bins.score, reverse=True)
    return [x.labels() for x in found]


def _spread(spark, rows: int) -> int:
    return max(1, min(rows, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def _solve(items: DataFrame, blocks: int, capacity: int, seed: int) -> DataFrame:
    """``block``, its pieces in an array and the bin number of each."""
    spark = items.sparkSession
    held = (
        items.withColumn("block", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "piece", "ids_crc32"), F.lit(blocks)))
        .groupBy("block")
        .agg(F.sort_array(F.collect_list(F.struct("doc_id", "piece", "start", "length", "ids_crc32"))).alias("items"))
    )
    held = materialize(held, "packing-items")
    sizes = held.select("block", F.col("items.length").alias("sizes"), F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"))
    state = sizes.withColumn("population", F.expr("cast(array() as array<array<int>>)"))
    for epoch in range(EPOCHS):

        def run(batches: Iterator[pa.RecordBatch], epoch: int = epoch) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = batch.to_pylist()
                new = [evolve(r["sizes"], r["population"], capacity, f"{seed}:{epoch}:{r['block']}:{r['island']}") for r in rows]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("block"), batch.column("island"), batch.column("sizes"), pa.array(new, pa.list_(pa.list_(pa.int32())))],
                    ["block", "island", "sizes", "population"],
                )

        state = state.repartition(_spread(spark, blocks * ISLANDS), "block", "island").mapInArrow(
            run, "block long, island int, sizes array<long>, population array<array<int>>"
        )
        if epoch + 1 < EPOCHS:  # every island goes on with the elite of the next one in place of its own last
            ring = state.groupBy("block").agg(F.any_value("sizes").alias("sizes"), F.sort_array(F.collect_list(F.struct("island", "population"))).alias("_ring"))
            ring = ring.select("block", "sizes", "_ring", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"))
            own, other = F.col("_ring")[F.col("island")]["population"], F.col("_ring")[(F.col("island") + 1) % ISLANDS]["population"]
            keep = F.slice(own, 1, F.greatest(F.size(own) - 1, F.lit(1)))
            state = ring.select("block", "island", "sizes", F.concat(F.slice(other, 1, 1), keep).alias("population"))
    elite = state.select("block", F.col("population")[0].alias("bins"), F.array_max(F.col("population")[0]).alias("_n"), "island")
    best = elite.groupBy("block").agg(F.min_by("bins", F.struct("_n", "island")).alias("bins"))
    return held.join(best, "block")


def pack(pieces: DataFrame, capacity: int, block_pieces: int = BLOCK_PIECES) -> DataFrame:
    """``pieces`` (see :func:`token_pieces`) with ``sequence_id`` and ``offset``, gapless from 0 in every sequence.

    No sequence holds more than ``capacity``; longer pieces are refused. Repeated rows are packed each. An
    empty table gives no rows.
    """
    spark = pieces.sparkSession
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    pieces = materialize(pieces.select(*names), "packing-pieces")
    n, longest = pieces.filter(F.col("length") < capacity).count(), pieces.agg(F.max("length")).first()[0]
    if longest is not None and longest > capacity:
        raise ValueError(f"a piece of {longest} does not fit into {capacity}")
    full = pieces.filter(F.col("length") == capacity)
    parts = [full.withColumns({"sequence_id": -1 - F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})]
    items, turn = pieces.filter(F.col("length") < capacity), 0
    open_bins, before = None, 0
    while n:
        blocks = -(-n // block_pieces)
        solved = _solve(items, blocks, capacity, turn).select("block", F.posexplode("items").alias("_k", "_i"), "bins")
        solved = solved.select("block", F.col("bins")[F.col("_k")].alias("_bin"), "_i.*")
        solved = materialize(solved, "packing-bins")
        fill = solved.groupBy("block", "_bin").agg((F.sum("length") < WELL_FILLED * capacity).alias("_open"), F.count("*").alias("_n"))
        fill = materialize(fill, "packing-fill")
        bins, opened, left = fill.agg(F.count("*"), F.count_if("_open"), F.sum(F.when(F.col("_open"), F.col("_n")))).first()
        if open_bins is not None and bins >= before:  # dealt anew they are no fewer, so they stay as they were
            parts.append(open_bins)
            break
        if blocks == 1:
            parts.append(_number(solved, turn, names))
            break
        solved = materialize(solved.join(fill.drop("_n").hint("merge"), ["block", "_bin"]), "packing-open")
        items, n = solved.filter("_open").select(*names), left or 0
        open_bins, before = _number(solved.filter("_open"), turn, names), opened
        parts.append(_number(solved.filter("not _open"), turn, names))
        turn += 1
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _number(solved: DataFrame, turn: int, names: list[str]) -> DataFrame:
    """Sequence numbers that no other round, block or bin has, and the places of the pieces in order."""
    w = Window.partitionBy("block", "_bin").orderBy(F.desc("length"), "doc_id", "piece").rowsBetween(Window.unboundedPreceding, -1)
    number = F.lit(turn << 56) + (F.col("block").cast("long") * (1 << 24)) + F.col("_bin")
    return solved.select(*names, number.cast("long").alias("sequence_id"), F.coalesce(F.sum("length").over(w), F.lit(0)).cast("long").alias("offset"))
