"""Structured Streaming twins of the resumable readers, packers, metrics and checks.

Offsets and state live in the checkpoint folder, so a query that stops resumes exactly where it was.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from corpusloom.operators.pack import PACKED_SCHEMA, Packer
from corpusloom.sources import scan

FLAT_SCHEMA = "pack_group long, row_id long, inputs array<int>, targets array<int>"
#: bytes of sequences of a group that wait for others of their micro-batch outside the state
EARLY_BYTES = 32 << 20
#: entries that so many bytes take in the state at least
EARLY_PARTS = 16
#: ids that a task gathers before it hands on the rows they fill
CHUNK_IDS = 1 << 20
#: rows that a task makes into lists at once
ROWS = 1 << 10
METRIC_SCHEMA = "run_id long, step long, smooth_loss double, best double, n_passed long, n_total long"


def stream_shards(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 1) -> DataFrame:
    """Parquet shards in the order they were finished, a few files per micro-batch."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    return reader.option("pathGlobFilter", "*.parquet").parquet(path)


def with_place(shards: DataFrame) -> DataFrame:
    """The number in the shard's name and the row's place in the file, as ``shard`` and ``row``."""
    number = F.regexp_extract(F.col("_metadata.file_path"), r"([0-9]+)[.]parquet$", 1).cast("long")
    return shards.select("*", number.alias("shard"), F.col("_metadata.row_index").alias("row"))


def run_available(stream: DataFrame, out: str, checkpoint: str, mode: str = "append") -> None:
    """Process everything that is there and stop; a later call goes on from the checkpoint.

    Update-mode results keep their micro-batch number in ``epoch_id``.
    """
    writer = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if mode == "append":
        query = writer.format("parquet").outputMode("append").start(out)
    else:

        def save(batch: DataFrame, epoch_id: int) -> None:
            batch.withColumn("epoch_id", F.lit(epoch_id)).write.mode("overwrite").parquet(f"{out}/epoch={epoch_id}")

        query = writer.outputMode(mode).foreachBatch(save).start()
    query.awaitTermination()


def _id_bytes(ids: np.ndarray) -> tuple[bytes, int]:
    """The ids as bytes and how many bytes each takes: two where all fit, else four."""
    n = 2 if not len(ids) or (ids.min() >= 0 and ids.max() <= 0xFFFF) else 4
    return ids.astype("<u2" if n == 2 else "<i4").tobytes(), n


def _pack(ids: np.ndarray) -> bytes:
    """The ids as bytes, the last of which tells how many bytes each takes."""
    data, n = _id_bytes(ids)
    return data + bytes([n])


def _unpack(data: bytes) -> np.ndarray:
    n = data[-1]
    return np.frombuffer(data, "<u2" if n == 2 else "<i4", len(data) // n)


def _pack_lists(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Lists of ids as bytes, which move between the JVM and Python without a look at each id; null is no ids."""
    for column in columns:
        flat = column.flatten().to_numpy(zero_copy_only=False)
        ends, start = np.concatenate([[0], np.cumsum(column.value_lengths().fill_null(0).to_numpy())]), 0
        while start < len(column):
            stop = max(start + 1, int(np.searchsorted(ends, ends[start] + CHUNK_IDS, "right")) - 1)
            yield pa.array([_pack(flat[a:b]) for a, b in zip(ends[start:stop], ends[start + 1 : stop + 1])], pa.binary())
            start = stop


def _ordered(batches: Iterator[pd.DataFrame], by: str) -> pd.DataFrame:
    """The rows of one group in one micro-batch; the files per trigger bound them."""
    return pd.concat(list(batches)).sort_values(by)


@dataclass
class ShardOrder:
    """The order of rows by shard and place in it, whenever they arrive; each of ``groups`` groups takes every ``groups``-th shard.

    ``shard`` counts from 0 without gaps, ``row`` from 0 inside a shard, ``last`` marks a shard's last row. Rows that come early wait in the state
    until all before them in their group are there.
    """

    shard: Column
    row: Column
    last: Column
    groups: int


class InOrder(StatefulProcessor):
    """Hands sequences on in the order of their group: by shard and row, or sorted within each micro-batch where no shards are given.

    The state holds what came early, runs of rows that follow each other under the place of the first, and the place of the sequence that comes next.
    """

    def __init__(self, stride: int | None):
        self.stride = stride

    def init(self, handle: StatefulProcessorHandle) -> None:
        if self.stride:
            self.early = handle.getMapState("early", "shard long, row long", "docs binary, sizes binary, ids binary, last boolean")
            self.next = handle.getValueState("next", "shard long, row long")

    def sequences(self, key: tuple, batches: Iterator[pd.DataFrame]) -> Iterator[tuple[int, np.ndarray]]:
        if not self.stride:
            pdf = _ordered(batches, "doc")
            yield from zip(pdf["doc"].tolist(), map(_unpack, pdf["ids"]))
            return
        start = at = self.next.get() if self.next.exists() else (int(key[0]), 0)
        here: dict[tuple[int, int], tuple] = {}
        for pdf in batches:
            packed = (ids if isinstance(ids, bytes) else _pack(ids) for ids in pdf["ids"])
            here.update(zip(zip(pdf["shard"].tolist(), pdf["row"].tolist()), zip(pdf["doc"].tolist(), packed, pdf["last"].tolist())))
            while True:
                if at not in here:
                    if not self.early.containsKey(at):
                        break
                    here.update(self._run(at, *self.early.getValue(at)))
                    self.early.removeKey(at)
                doc, data, last = here.pop(at)
                at = (at[0] + self.stride, 0) if last else (at[0], at[1] + 1)
                yield int(doc), _unpack(data)
            # what waits goes to the state when it is too much
            here = {place: row for place, row in here.items() if place >= at}
            if sum(len(data) for _, data, _ in here.values()) > EARLY_BYTES:
                self._keep(here)
                here = {}
        self._keep(here)
        if at != start:
            self.next.update(at)

    def _run(self, first: tuple[int, int], docs: bytes, sizes: bytes, ids: bytes, last: bool) -> Iterator[tuple[tuple[int, int], tuple]]:
        """The rows of a run, by their places."""
        ends = np.cumsum(np.frombuffer(sizes, "int64")).tolist()
        for i, (doc, a, b) in enumerate(zip(np.frombuffer(docs, "int64").tolist(), [0, *ends], ends)):
            yield (first[0], first[1] + i), (doc, ids[a:b], last and i == len(ends) - 1)

    def _keep(self, rows: dict[tuple[int, int], tuple]) -> None:
        run: list[tuple[int, int]] = []
        size = 0
        for place in sorted(rows):
            if run and (place != (run[-1][0], run[-1][1] + 1) or size > EARLY_BYTES // EARLY_PARTS):
                self._save(run, [rows[x] for x in run])
                run, size = [], 0
            run.append(place)
            size += len(rows[place][1])
        if run:
            self._save(run, [rows[x] for x in run])

    def _save(self, places: list[tuple[int, int]], rows: list[tuple]) -> None:
        docs, ids, last = zip(*rows)
        self.early.updateValue(places[0], (np.array(docs, "int64").tobytes(), np.array(list(map(len, ids)), "int64").tobytes(), b"".join(ids), bool(last[-1])))


class _Waiting(dict):
    """Sequences by arrival number: those of this micro-batch in memory, the others in the state until they are taken."""

    def __init__(self, state):
        super().__init__()
        self.state, self.taken = state, []

    def pop(self, n: int) -> tuple[int, np.ndarray]:
        if n in self:
            return super().pop(n)
        doc, data = self.state.getValue((n,))
        self.taken.append(n)
        return doc, np.frombuffer(data, "int32")


class PackStream(InOrder):
    """Best-fit packing whose state holds single sequences, so that a micro-batch reads and writes only what it adds and places."""

    def __init__(self, stride: int | None, capacity: int, buffer: int, refill: int, crop: str):
        super().__init__(stride)
        self.make = lambda: Packer(capacity, buffer, refill, crop)

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.waiting = handle.getMapState("waiting", "n long", "doc long, ids binary")
        self.sizes = handle.getMapState("sizes", "n long", "size int")
        self.row = handle.getListState("row", "doc long, ids binary")
        self.counts = handle.getValueState("counts", "arrived long, pending long, rows long, cropped long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        packer = self.make()
        packer.docs = waiting = _Waiting(self.waiting)
        pending = n_rows = 0
        if self.counts.exists():
            packer.arrived, pending, n_rows, packer.row_cropped = self.counts.get()
        held = sorted((n, size) for (n,), (size,) in self.sizes.iterator())
        packer.pending = held[len(held) - pending :]
        buffered = held[: len(held) - pending]
        packer.length = dict(buffered)
        packer.sizes = sorted((size, -n) for n, size in buffered)
        packer.queue.extend(n for n, _ in buffered)
        for doc, data in self.row.get():
            packer.row_docs.append(doc)
            packer.row.append(np.frombuffer(data, "int32"))
            packer.filled += len(packer.row[-1])
        begun = len(packer.row)
        out, done = [], n_rows
        for doc, ids in self.sequences(key, rows):
            if len(ids):
                out += packer.push(doc, ids)
            if len(out) * packer.capacity > CHUNK_IDS:
                yield self._rows(key, n_rows, out)
                n_rows, out = n_rows + len(out), []
        n_rows, last = n_rows + len(out), n_rows
        for n in waiting.taken:
            self.waiting.removeKey((n,))
            self.sizes.removeKey((n,))
        lengths = packer.length | dict(packer.pending)
        for n, (doc, ids) in waiting.items():
            self.waiting.updateValue((n,), (doc, ids.tobytes()))
            self.sizes.updateValue((n,), (lengths[n],))
        pieces = [(doc, ids.tobytes()) for doc, ids in zip(packer.row_docs, packer.row)]
        if n_rows > done:
            self.row.clear()
            begun = 0
        if pieces[begun:]:
            self.row.appendList(pieces[begun:])
        self.counts.update((packer.arrived, len(packer.pending), n_rows, packer.row_cropped))
        if out:
            yield self._rows(key, last, out)

    def _rows(self, key: tuple, first: int, out: list[tuple]) -> pd.DataFrame:
        rows = [(key[0], first + i, ids, docs, cropped) for i, (ids, docs, cropped) in enumerate(out)]
        return pd.DataFrame(rows, columns=[x.split()[0] for x in PACKED_SCHEMA.split(", ")])


class FlatStream(InOrder):
    """Rows of the concatenated sequences; the ids that fill no row yet are carried. With ``packed`` a row is the bytes of its ids and the next one, ``ids``."""

    def __init__(self, stride: int | None, width: int, packed: bool = False):
        super().__init__(stride)
        self.width, self.packed = width, packed

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.rest = handle.getValueState("rest", "ids binary, rows long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        data, n = self.rest.get() if self.rest.exists() else (b"", 0)
        parts = [np.frombuffer(data, "int32")]
        size = len(parts[0])
        for _, ids in self.sequences(key, rows):
            parts.append(ids)
            size += len(ids)
            if size > max(CHUNK_IDS, self.width):
                rest, out = self._cut(key, n, parts)
                yield out
                parts, size, n = [rest], len(rest), n + len(out)
        rest, out = self._cut(key, n, parts)
        self.rest.update((rest.tobytes(), n + len(out)))
        if len(out):
            yield out

    def _cut(self, key: tuple, n: int, parts: list[np.ndarray]) -> tuple[np.ndarray, pd.DataFrame]:
        """What is left over of the parts, and the rows they fill, from number ``n``."""
        ids, width = np.concatenate(parts), self.width
        starts = range(0, max(len(ids) - 1, 0) // width * width, width)
        out = {"pack_group": key[0], "row_id": range(n, n + len(starts))}
        if self.packed:
            data, size = _id_bytes(ids)
            mark = bytes([size])
            out["ids"] = [data[i * size : (i + width + 1) * size] + mark for i in starts]
        else:
            out["inputs"] = [ids[i : i + width] for i in starts]
            out["targets"] = [ids[i + 1 : i + width + 1] for i in starts]
        return ids[len(starts) * width :].astype("int32"), pd.DataFrame(out)


def _flat_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed rows as lists of inputs and targets."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            part = batch.slice(start, ROWS)
            ids = np.array([_unpack(x) for x in part.column("ids").to_pylist()], "int32")
            ends = pa.array(np.arange(len(ids) + 1, dtype="int32") * (ids.shape[1] - 1))
            lists = [pa.ListArray.from_arrays(ends, pa.array(x.ravel())) for x in (ids[:, :-1], ids[:, 1:])]
            yield pa.RecordBatch.from_arrays([part.column("pack_group"), part.column("row_id"), *lists], [x.split()[0] for x in FLAT_SCHEMA.split(", ")])


def _keyed(docs: DataFrame, order: str | ShardOrder, ids: str, group: Column | None, doc: str, processor: InOrder, schema: str) -> DataFrame:
    # keyed state needs this store; with change logs a micro-batch writes only the keys that it changed
    docs.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    docs.sparkSession.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    columns = [F.col(doc).cast("long").alias("doc"), F.arrow_udf(_pack_lists, "binary")(F.col(ids)).alias("ids")]
    if isinstance(order, ShardOrder):
        group = F.pmod(order.shard.cast("long"), F.lit(order.groups))
        columns += [order.shard.cast("long").alias("shard"), order.row.cast("long").alias("row"), order.last.alias("last")]
    rows = docs.select(group.cast("long").alias("pack_group"), *columns)
    return rows.groupBy("pack_group").transformWithStateInPandas(processor, schema, "Append", "None")


def stream_pack(
    docs: DataFrame, order: str | ShardOrder, ids: str, group: Column | None, width: int, buffer: int = 1000, refill: int = 128,
    crop: str = "shortest", doc: str | None = None,
) -> DataFrame:
    """Best-fit packing; every group carries its buffer from one micro-batch to the next.

    ``order`` is the column that sorts each micro-batch and names the documents, or a :class:`ShardOrder`, which makes the groups itself
    (``group`` is None) and leaves the names to ``doc``.
    """
    stride = order.groups if isinstance(order, ShardOrder) else None
    return _keyed(docs, order, ids, group, doc or order, PackStream(stride, width + 1, buffer, refill, crop), PACKED_SCHEMA)


def stream_flat_rows(docs: DataFrame, order: str | ShardOrder, ids: str, group: Column | None, width: int, doc: str | None = None) -> DataFrame:
    """Rows of the concatenated sequences of every group, in an order as for :func:`stream_pack`.

    A group's task only cuts bytes; its rows are dealt to all tasks, which make them into lists and write them.
    """
    stride = order.groups if isinstance(order, ShardOrder) else None
    rows = _keyed(docs, order, ids, group, doc or order, FlatStream(stride, width, packed=True), "pack_group long, row_id long, ids binary")
    return rows.repartition("pack_group", "row_id").mapInArrow(_flat_lists, FLAT_SCHEMA)


def stream_metrics(steps: DataFrame, beta: float = 0.9) -> DataFrame:
    """Smoothed loss, best bpb and pass count of every run after its last step so far.

    ``steps`` has (run_id, step, loss, val_bpb, passed).
    """

    def smooth(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        ema, best, passed, total = state.get if state.exists else (0.0, float("inf"), 0, 0)
        pdf = _ordered(batches, "step")
        for loss in pdf["loss"]:
            ema = beta * ema + (1 - beta) * loss
        step = int(pdf["step"].iloc[-1])
        best = min(best, float(pdf["val_bpb"].min()))
        passed, total = passed + int(pdf["passed"].sum()), total + len(pdf)
        state.update((float(ema), best, passed, total))
        yield pd.DataFrame(
            [(key[0], step, ema / (1 - beta ** (step + 1)), best, passed, total)],
            columns=["run_id", "step", "smooth_loss", "best", "n_passed", "n_total"],
        )

    return steps.groupBy("run_id").applyInPandasWithState(
        smooth, METRIC_SCHEMA, "ema double, best double, passed long, total long", "update", GroupStateTimeout.NoTimeout
    )


def latest(spark: SparkSession, out: str, key: str) -> DataFrame:
    """The last update of every key, from the updates that :func:`run_available` saved."""
    rows = spark.read.option("recursiveFileLookup", "true").parquet(out)
    others = [c for c in rows.columns if c not in (key, "epoch_id")]
    return rows.groupBy(key).agg(F.max(F.struct("epoch_id", *others)).alias("_r")).select(key, *[f"_r.{c}" for c in others])


def run_latest(stream: DataFrame, out: str, checkpoint: str, key: str, files: int = 8) -> None:
    """Process everything that is there, keeping one table with the last update of every key; :func:`current` reads it.

    Every micro-batch writes a new version of the table, in ``files`` files, and then puts its name in place of the old one in one step, so
    a reader sees all of a micro-batch or nothing of it. A micro-batch that runs again puts the same rows in their place.
    Versions other than the last two are removed.
    """
    spark = stream.sparkSession
    spark_conf = spark.sparkContext._jsc.hadoopConfiguration()
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path

    def save(batch: DataFrame, epoch_id: int) -> None:
        before = _version(spark, out)
        rows = batch
        if before is not None:
            old = spark.read.schema(batch.schema).parquet(f"{out}/{before}")
            # the keys of a micro-batch grow with it, so they are not sent to every task
            rows = old.join(batch.select(key).hint("merge"), key, "left_anti").select(*batch.columns).unionByName(batch)
        name = f"version-{epoch_id:09d}-{uuid.uuid4().hex}"
        rows.repartition(files, key).write.parquet(f"{out}/{name}")
        begun = f"{out}/_begun-{uuid.uuid4().hex}"
        target = path(out)
        fs = target.getFileSystem(spark_conf)
        written = fs.create(path(begun))
        written.write(name.encode())
        written.close()
        over = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        over[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark_conf).rename(path(begun), path(out, "_current"), over)
        for found in fs.globStatus(path(out, "version-*")) or []:
            if found.getPath().getName() not in (name, before):
                fs.delete(found.getPath(), True)

    query = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).outputMode("update").foreachBatch(save).start()
    query.awaitTermination()


def _version(spark: SparkSession, out: str) -> str | None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(out, "_current")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return None
    file = fs.open(path)
    try:
        return bytes(file.readAllBytes()).decode()
    finally:
        file.close()


def current(spark: SparkSession, out: str) -> DataFrame:
    """The table that :func:`run_latest` keeps."""
    name = _version(spark, out)
    if name is None:
        raise ValueError(f"no micro-batch has been saved in {out}")
    return spark.read.parquet(f"{out}/{name}")


def stream_validate(spark: SparkSession, path: str, accepted: str, quarantined: str, checkpoint: str, files_per_trigger: int = 8) -> None:
    """Conversations arriving as JSON lines: sound ones to one folder, the others with their violations to another."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(path)
    parsed = scan.parse_message_lines(lines).withColumn("violations", scan.message_violations())

    def save(batch: DataFrame, epoch_id: int) -> None:
        good = F.size("violations") == 0
        # one folder per micro-batch, so a repeated micro-batch replaces its own output
        batch.filter(good).select("value").write.mode("overwrite").parquet(f"{accepted}/epoch={epoch_id}")
        batch.filter(~good).select("value", "violations").write.mode("overwrite").parquet(f"{quarantined}/epoch={epoch_id}")

    query = parsed.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(save).start()
    query.awaitTermination()
