"""Packing token sequences into rows of fixed length."""

from __future__ import annotations

import pickle
from bisect import bisect_right, insort
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.det import draw_index
from corpusloom.operators.prefix import prefix_sums
from corpusloom.session import materialize

PACKED_SCHEMA = "pack_group long, row_id long, ids array<int>, doc_ids array<long>, n_cropped long"


# --- flat rows -------------------------------------------------------------------------------------


def flat_rows(docs: DataFrame, order: str, ids: Column | str, width: int, batch: int = 1, size: Column | None = None) -> DataFrame:
    """The concatenated sequences cut into rows: row r has inputs [rT, rT+T) and targets shifted by one.

    Only whole batches of ``batch`` rows come out; the stream must hold one more id for the last target.
    ``size`` tells the number of ids where that is cheaper to know than the ids themselves; ``ids`` may then be an expression
    that is worked out after the rows have met their offsets, so that texts are moved, not ids.
    """
    tokens = F.col(ids) if isinstance(ids, str) else ids
    sized = docs.select(order, (F.size(tokens) if size is None else size).cast("long").alias("n"))
    ends = prefix_sums(sized, [order], {"_end": F.col("n")})
    total = sized.agg(F.sum("n")).first()[0] or 0
    rows = max(total - 1, 0) // (width * batch) * batch
    # both sides are dealt by key: neither is small
    spans = docs.join(ends.filter("n > 0").hint("merge"), order).withColumn("_start", F.col("_end") - F.col("n"))
    spans = spans.select("_start", "_end", tokens.alias("_ids"))
    # position p is an input of row p div T, and the last target of the row before when it starts a row
    first = F.greatest(F.floor((F.col("_start") - 1) / width), F.lit(0)).cast("long")
    last = F.least(F.floor((F.col("_end") - 1) / width), F.lit(rows - 1)).cast("long")
    cut = spans.withColumns({"_first": first, "_last": last}).filter("_first <= _last")
    cut = cut.withColumn("row_id", F.explode_outer(F.sequence("_first", "_last")))
    lo = F.greatest(F.col("_start"), F.col("row_id") * width)
    hi = F.least(F.col("_end"), (F.col("row_id") + 1) * width + 1)
    part = F.slice("_ids", (lo - F.col("_start") + 1).cast("int"), (hi - lo).cast("int"))
    parts = cut.filter(hi > lo).select("row_id", lo.alias("_at"), part.alias("_part"))
    # a row gathers at most T + 1 ids
    whole = parts.groupBy("row_id").agg(F.array_sort(F.collect_list(F.struct("_at", "_part"))).alias("_p"))
    stream = F.flatten(F.col("_p._part"))
    whole = whole.select("row_id", stream.alias("_s"))
    return whole.select("row_id", F.slice("_s", 1, width).alias("inputs"), F.slice("_s", 2, width).alias("targets"))


# --- best fit --------------------------------------------------------------------------------------


class Packer:
    """Best-fit packing with a bounded buffer, fed one sequence at a time.

    Sequences enter the buffer ``refill`` at a time and rows are filled while it holds at least ``buffer``
    of them, so the result does not depend on how the input arrives. The longest sequence that fits is
    placed; when none fits, the shortest (or the first) one is cropped and its rest discarded.
    """

    def __init__(self, capacity: int, buffer: int = 1000, refill: int = 128, crop: str = "shortest"):
        if crop not in ("shortest", "first"):
            raise ValueError("crop must be 'shortest' or 'first'")
        self.capacity, self.buffer, self.refill, self.crop = capacity, buffer, refill, crop
        self.pending: list[tuple[int, int]] = []  # (arrival number, length) of those that are not in the buffer yet
        self.docs: dict[int, tuple] = {}  # arrival number -> (doc id, as many of the ids as fit in a row)
        self.sizes: list[tuple[int, int]] = []  # (length, -arrival) of the buffer, sorted: ties give the first arrival
        self.length: dict[int, int] = {}  # arrival number -> length of the buffer
        self.queue: deque[int] = deque()
        self.arrived = 0
        self.row: list[np.ndarray] = []  # the pieces of the open row
        self.filled = 0
        self.row_docs: list = []
        self.row_cropped = 0

    def dump(self) -> bytes:
        """The buffer and the open row as plain data."""
        return pickle.dumps({**vars(self), "queue": list(self.queue)})

    @classmethod
    def load(cls, data: bytes) -> Packer:
        state = pickle.loads(data)
        packer = cls(state["capacity"], state["buffer"], state["refill"], state["crop"])
        vars(packer).update(state, queue=deque(state["queue"]))
        return packer

    def push(self, doc_id, ids):
        """Take one sequence; yields the rows that it completes."""
        # a copy, as a view would keep all of the batch it lies in; a row takes no more than its capacity of one sequence
        self.docs[self.arrived] = (doc_id, np.array(ids[: self.capacity], dtype="int32"))
        self.pending.append((self.arrived, len(ids)))
        self.arrived += 1
        if len(self.pending) >= self.refill:
            self._admit()
            while len(self.sizes) >= self.buffer:
                row = self._place()
                if row is not None:
                    yield row

    def finish(self):
        """End of input: yields what the buffer still fills; the last short row stays as leftover."""
        self._admit()
        while self.sizes:
            row = self._place()
            if row is not None:
                yield row

    def _admit(self):
        for n, size in self.pending:
            insort(self.sizes, (size, -n))
            self.length[n] = size
            if self.crop == "first":
                self.queue.append(n)
        self.pending = []

    def _place(self):
        room = self.capacity - self.filled
        at = bisect_right(self.sizes, (room, 1)) - 1
        if at >= 0 and self.sizes[at][0] > 0:
            key = self.sizes.pop(at)
        elif self.crop == "shortest":
            at = bisect_right(self.sizes, (self.sizes[0][0], 1)) - 1
            key = self.sizes.pop(at)
        else:
            while self.queue[0] not in self.length:
                self.queue.popleft()
            n = self.queue.popleft()
            key = (self.length[n], -n)
            self.sizes.remove(key)
        del self.length[-key[1]]
        doc_id, ids = self.docs.pop(-key[1])
        self.row_cropped += max(key[0] - room, 0)
        self.row.append(ids[:room])
        self.filled += len(self.row[-1])
        self.row_docs.append(doc_id)
        if self.filled < self.capacity:
            return None
        done = (np.concatenate(self.row), self.row_docs, self.row_cropped)
        self.row, self.filled, self.row_docs, self.row_cropped = [], 0, [], 0
        return done


def pack_groups(packers: int, key: str) -> Column:
    """Which of ``packers`` packers takes a row, by a hash of its key; more rows deal no row anew."""
    return draw_index(packers, "pack", key)


def bestfit_pack(
    docs: DataFrame,
    order: str,
    ids: Column | str,
    width: int,
    group: Column | str,
    buffer: int = 1000,
    refill: int = 128,
    crop: str = "shortest",
) -> DataFrame:
    """Rows of ``width + 1`` ids, one packer per group; every row starts with the start of a sequence.

    Groups are the parallel workers, see :func:`pack_groups`. A task reads the rows of its groups in order and holds no more than a packer's
    buffer, so the size of a group has no bound. ``ids`` may be an expression: it is worked out after the shuffle, which then
    moves texts rather than ids. A last row that stays short is dropped with its group.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, current, n, rows = None, None, 0, []

        def take(found) -> None:
            nonlocal n
            for tokens, doc_ids, cropped in found:
                rows.append((current, n, tokens, doc_ids, cropped))
                n += 1

        for batch in batches:
            groups, keys = batch.column("pack_group").to_pylist(), batch.column("doc").to_pylist()
            for g, doc, tokens in zip(groups, keys, batch.column("ids")):
                if packer is None or g != current:
                    if packer is not None:
                        take(packer.finish())
                    packer, current, n = Packer(width + 1, buffer, refill, crop), g, 0
                if tokens.is_valid and len(tokens.values):
                    take(packer.push(doc, tokens.values.to_numpy()))
            if rows:
                yield _packed_batch(rows)
                rows = []
        if packer is not None:
            take(packer.finish())
            if rows:
                yield _packed_batch(rows)

    group = F.col(group) if isinstance(group, str) else group
    tokens = F.col(ids) if isinstance(ids, str) else ids
    keyed = docs.withColumns({"_pack_group": group, "_pack_doc": F.col(order).cast("long")})
    rows = keyed.repartition("_pack_group").sortWithinPartitions("_pack_group", "_pack_doc")
    rows = rows.select(F.col("_pack_group").cast("long").alias("pack_group"), F.col("_pack_doc").alias("doc"), tokens.alias("ids"))
    return rows.mapInArrow(pack, PACKED_SCHEMA)


def pack_part(
    docs: DataFrame,
    order: str,
    ids: Column | str,
    width: int,
    group: Column,
    state: DataFrame | None = None,
    last: bool = False,
    buffer: int = 1000,
    refill: int = 128,
    crop: str = "shortest",
) -> tuple[DataFrame, DataFrame]:
    """Pack one part of a corpus: the rows that it completes, and the state of every group for the next part.

    Parts that follow each other along ``order`` give the rows of :func:`bestfit_pack` over all of them, wherever the corpus was cut. ``state`` is what the
    part before returned; both tables are in the shared folder, so a job can stop between two parts. ``last`` ends the input.
    A group's state is its buffer and open row, bounded by ``buffer`` and ``refill``.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, current, n = None, None, 0

        def close() -> Iterator[pa.RecordBatch]:
            if packer is not None:
                rows = [(current, n + i, *row) for i, row in enumerate(packer.finish() if last else [])]
                if rows:
                    yield _with_state(_packed_batch(rows), [None] * len(rows))
                yield _with_state(_packed_batch([(current, n + len(rows), None, None, None)]), [packer.dump()])

        for batch in batches:
            rows = []
            columns = (batch.column(c) for c in ("pack_group", "doc", "ids", "state", "n_rows"))
            for g, doc, tokens, data, before in zip(*columns):
                if packer is None or g.as_py() != current:
                    if rows:
                        yield _with_state(_packed_batch(rows), [None] * len(rows))
                        rows = []
                    yield from close()
                    packer, current, n = Packer(width + 1, buffer, refill, crop), g.as_py(), 0
                if data.is_valid:  # comes before the group's sequences
                    packer, n = Packer.load(data.as_py()), before.as_py()
                elif tokens.is_valid and len(tokens.values):
                    for row in packer.push(doc.as_py(), tokens.values.to_numpy()):
                        rows.append((current, n, *row))
                        n += 1
            if rows:
                yield _with_state(_packed_batch(rows), [None] * len(rows))
        yield from close()

    tokens = F.col(ids) if isinstance(ids, str) else ids
    rows = docs.withColumns({"pack_group": group.cast("long"), "doc": F.col(order).cast("long"), "state": F.lit(None).cast("binary"), "n_rows": F.lit(None).cast("long")})
    source = [c for c in docs.columns if c not in ("pack_group", "doc", "state", "n_rows")]
    rows = rows.select("pack_group", "doc", "state", "n_rows", F.struct(*source).alias("_row"))
    if state is not None:
        kind = rows.schema["_row"].dataType
        rows = rows.unionByName(state.select("pack_group", F.lit(None).cast("long").alias("doc"), "state", "n_rows", F.lit(None).cast(kind).alias("_row")))
    # the ids are worked out after the shuffle, which moves texts
    rows = rows.repartition("pack_group").sortWithinPartitions("pack_group", F.col("state").isNull(), "doc")
    rows = rows.select("pack_group", "doc", "state", "n_rows", "_row.*").select("pack_group", "doc", F.when(F.col("state").isNull(), tokens).alias("ids"), "state", "n_rows")
    found = materialize(rows.mapInArrow(pack, f"{PACKED_SCHEMA}, state binary"), "packed-part")
    packed = found.filter("state IS NULL").drop("state")
    return packed, found.filter("state IS NOT NULL").select("pack_group", F.col("row_id").alias("n_rows"), "state")


def _with_state(batch: pa.RecordBatch, state: list[bytes | None]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, pa.array(state, pa.binary())], [*batch.schema.names, "state"])


def _packed_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.int64()]
    names = [x.split()[0] for x in PACKED_SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), kinds)], names)


def packing_minimum(docs: DataFrame, n_tokens: Column, width: int, by: str) -> DataFrame:
    """Tokens beyond the row capacity in over-long sequences: no packing can keep them."""
    n = n_tokens.cast("long")
    over = F.greatest(n - (width + 1), F.lit(0))
    return docs.groupBy(by).agg(
        F.sum(n).alias("n_tokens"), F.sum(over).alias("min_cropped"), F.round(F.sum(over) / F.sum(n), 6).alias("min_crop")
    )


def packing_rates(packed: DataFrame, total_tokens: int, width: int) -> DataFrame:
    """Use, crop and padding of packed rows, and the share of tokens left over at the group ends."""
    sums = packed.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.size("ids")).cast("long").alias("n_packed"),
        F.sum("n_cropped").alias("n_cropped"),
    )
    slots = F.col("n_rows") * (width + 1)
    return sums.select(
        "n_rows", "n_packed", "n_cropped",
        (F.col("n_packed") / slots).alias("utilization"),
        (1 - F.col("n_packed") / slots).alias("padding"),
        (F.col("n_cropped") / (F.col("n_packed") + F.col("n_cropped"))).alias("crop"),
        (F.lit(total_tokens) - F.col("n_packed") - F.col("n_cropped")).alias("n_leftover"),
    )


def packer_function(width: int, buffer: int = 1000, refill: int = 128, crop: str = "shortest"):
    """A table function for SQL: ``SELECT * FROM pack(TABLE(docs) PARTITION BY pack_group ORDER BY doc)``.

    The table has columns (doc, ids, pack_group). The function takes a partition as Arrow batches and returns its rows by the batch.
    """

    class Pack:
        def __init__(self):
            self.packer = Packer(width + 1, buffer, refill, crop)
            self.group, self.n = None, 0

        def _rows(self, found) -> Iterator[pa.RecordBatch]:
            rows = [(self.group, self.n + i, *row) for i, row in enumerate(found)]
            self.n += len(rows)
            if rows:
                yield _packed_batch(rows)

        def eval(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            if batch.num_rows:
                self.group = batch.column("pack_group")[0].as_py()
                lists = batch.column("ids")
                flat, offsets = lists.flatten().to_numpy(), np.asarray(lists.offsets)
                offsets = offsets - offsets[0]
                docs = batch.column("doc").to_pylist()
                yield from self._rows(row for i, doc in enumerate(docs) for row in self.packer.push(doc, flat[offsets[i] : offsets[i + 1]]))

        def terminate(self) -> Iterator[pa.RecordBatch]:
            yield from self._rows(self.packer.finish())

    return F.arrow_udtf(Pack, returnType=PACKED_SCHEMA)
