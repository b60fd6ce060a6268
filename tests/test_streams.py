import random
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from corpusloom.operators import pack
from corpusloom.streaming import streams


def docs(seed, low, high):
    rng = random.Random(seed)
    return [(d, [1000 + d] + [rng.randrange(256) for _ in range(rng.randrange(40))]) for d in range(low, high)]


def test_packing_resumes_where_it_stopped(spark, tmp_path):
    """Two runs over arriving shards give the rows of one run over everything."""
    schema = "doc_id long, ids array<int>"
    path, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    group = F.col("doc_id") % 2
    everything = []
    for start in (0, 40, 80):
        part = docs(start, start, start + 40)
        everything += part
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
        stream = streams.stream_shards(spark, path, schema)
        streams.run_available(streams.stream_pack(stream, "doc_id", "ids", group, 20, buffer=6, refill=4), out, state)
    got = sorted(map(tuple, spark.read.schema(pack.PACKED_SCHEMA).parquet(out).select("pack_group", "row_id", "ids", "doc_ids").collect()))
    want = []
    for g in (0, 1):
        packer, n = pack.Packer(21, 6, 4), 0
        for d, ids in everything:
            if d % 2 == g:
                for row, used, _ in packer.push(d, ids):
                    want.append((g, n, row.tolist(), used))
                    n += 1
    assert got == sorted(want) and len(got) > 50


def test_flat_rows_resume(spark, tmp_path):
    schema = "doc_id long, ids array<int>"
    path, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    stream_ids = []
    for start in (0, 10):
        part = docs(start, start, start + 10)
        stream_ids += [t for _, ids in part for t in ids]
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
        flat = streams.stream_flat_rows(streams.stream_shards(spark, path, schema), "doc_id", "ids", F.lit(0).cast("long"), 8)
        streams.run_available(flat, out, state)
    rows = spark.read.schema(streams.FLAT_SCHEMA).parquet(out).orderBy("row_id").collect()
    assert len(rows) == (len(stream_ids) - 1) // 8
    for r in rows:
        at = 8 * r["row_id"]
        assert (r["inputs"], r["targets"]) == (stream_ids[at : at + 8], stream_ids[at + 1 : at + 9])


SHARDED = "doc_id long, ids array<int>, last boolean"


def write_shard(spark, path, number, rows):
    rows = [(d, ids, i == len(rows) - 1) for i, (d, ids) in enumerate(rows)]
    part = str(path) + f"-part-{number}"
    spark.createDataFrame(rows, SHARDED).coalesce(1).write.parquet(part)
    Path(path).mkdir(exist_ok=True)
    (file,) = Path(part).glob("*.parquet")
    file.rename(Path(path) / f"shard_{number:05d}.parquet")


def order(groups):
    return streams.ShardOrder(F.col("shard"), F.col("row"), F.col("last"), groups)


@pytest.mark.parametrize("files", [1, 3])
def test_late_shards_wait_for_their_turn(spark, tmp_path, files):
    """Shards that arrive in any order give the rows of shards in theirs; what is missing holds its group back."""
    path, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    parts = {n: docs(n, 10 * n, 10 * n + 7 + n % 3) for n in range(9)}

    def run():
        stream = streams.with_place(streams.stream_shards(spark, path, SHARDED, files))
        streams.run_available(streams.stream_flat_rows(stream, order(2), "ids", None, 8, doc="doc_id"), out, state)
        rows = spark.read.schema(streams.FLAT_SCHEMA).parquet(out).orderBy("pack_group", "row_id").collect()
        return {g: [(r["inputs"], r["targets"]) for r in rows if r["pack_group"] == g] for g in (0, 1)}

    def flat(numbers):
        ids = [t for n in numbers for _, ids in parts[n] for t in ids]
        return [(ids[i : i + 8], ids[i + 1 : i + 9]) for i in range(0, (len(ids) - 1) // 8 * 8, 8)]

    for n in (4, 1, 0, 5):
        write_shard(spark, path, n, parts[n])
    assert run() == {0: flat([0]), 1: flat([1])}  # 2 and 3 are late
    for n in (8, 3, 2):
        write_shard(spark, path, n, parts[n])
    assert run() == {0: flat([0, 2, 4]), 1: flat([1, 3, 5])}
    for n in (7, 6):
        write_shard(spark, path, n, parts[n])
    assert run() == {0: flat([0, 2, 4, 6, 8]), 1: flat([1, 3, 5, 7])}


@pytest.mark.parametrize("crop", ["shortest", "first"])
def test_packing_of_late_shards(spark, tmp_path, crop):
    path, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    parts = {n: docs(20 + n, 100 * n, 100 * n + 25) for n in range(6)}
    for some in ((5, 2, 0), (1, 4), (3,)):
        for n in some:
            write_shard(spark, path, n, parts[n])
        stream = streams.with_place(streams.stream_shards(spark, path, SHARDED))
        streams.run_available(streams.stream_pack(stream, order(3), "ids", None, 20, buffer=6, refill=4, crop=crop, doc="doc_id"), out, state)
    got = sorted(map(tuple, spark.read.schema(pack.PACKED_SCHEMA).parquet(out).collect()))
    want = []
    for g in range(3):
        packer, n = pack.Packer(21, 6, 4, crop), 0
        for d, ids in [x for number in (g, g + 3) for x in parts[number]]:
            for row, used, cropped in packer.push(d, ids):
                want.append((g, n, row.tolist(), used, cropped))
                n += 1
    assert got == sorted(want) and len(got) > 40


def test_a_micro_batch_writes_what_it_changes(spark, tmp_path):
    """Bytes of state of small micro-batches beside a large buffer, against those of the buffer as a whole."""
    schema = "doc_id long, ids array<int>"
    path, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    rng = random.Random(3)
    sizes, packer, at = [], pack.Packer(2049, 1000, 128), 0
    for n in (900, 12, 12, 12):
        part = [(d, [rng.randrange(50_000) for _ in range(600)]) for d in range(at, at + n)]
        at += n
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
        rows = streams.stream_pack(streams.stream_shards(spark, path, schema), "doc_id", "ids", F.lit(0).cast("long"), 2048)
        before = {f for f in Path(state, "state").rglob("*") if f.is_file()} if Path(state).exists() else set()
        streams.run_available(rows, out, state)
        sizes.append(sum(f.stat().st_size for f in Path(state, "state").rglob("*") if f.is_file() and f not in before))
        for d, ids in part:
            list(packer.push(d, ids))
    assert max(sizes[1:]) < len(packer.dump()) / 20, (sizes, len(packer.dump()))


def test_latest_table_stays_compact(spark, tmp_path):
    """Reading after many micro-batches opens as many files as after one; a micro-batch that runs again changes nothing."""
    schema = "run_id long, step long, loss double, val_bpb double, passed boolean"
    path, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    files = []
    for step in range(12):
        rows = [(run, step, 1.0 + run, 2.0 - step / 100, step % 2 == 0) for run in range(20) if run != 7 or step < 5]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
        streams.run_latest(streams.stream_metrics(streams.stream_shards(spark, path, schema)), out, state, "run_id", files=2)
        files.append(len(streams.current(spark, out).inputFiles()))
    assert set(files) == {2} and len(list(Path(out).glob("version-*"))) == 2
    found = {r["run_id"]: r for r in streams.current(spark, out).collect()}
    assert len(found) == 20 and {r["step"] for i, r in found.items() if i != 7} == {11} and found[7]["step"] == 4
    assert all(r["n_total"] == r["step"] + 1 and round(r["smooth_loss"], 9) == 1.0 + i for i, r in found.items())
    with pytest.raises(ValueError, match="no micro-batch"):
        streams.current(spark, str(tmp_path / "none"))


class Held:
    """A state of one group, as the processors use it."""

    def __init__(self):
        self.rows, self.value, self.most = {}, None, 0

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def containsKey(self, key):
        return key in self.rows

    def getValue(self, key):
        return self.rows[key]

    def updateValue(self, key, value):
        self.rows[key] = value
        self.most = max(self.most, len(self.rows))

    def removeKey(self, key):
        del self.rows[key]


def test_flat_rows_are_handed_on_in_parts(monkeypatch):
    """A group's micro-batch is not gathered as a whole: rows come out as they fill, and much that came early waits in the state."""
    monkeypatch.setattr(streams, "CHUNK_IDS", 50)
    monkeypatch.setattr(streams, "EARLY_BYTES", 400)
    rng = random.Random(1)
    shards = {s: [[rng.randrange(256) for _ in range(rng.randrange(1, 30))] for _ in range(20)] for s in (0, 1, 2)}
    rows = [(s, r, 20 * s + r, np.array(ids, "int32"), r == 19) for s in (0, 2, 1) for r, ids in enumerate(shards[s])]
    frames = [pd.DataFrame(rows[i : i + 7], columns=["shard", "row", "doc", "ids", "last"]) for i in range(0, 60, 7)]
    flat = streams.FlatStream(1, 8)
    flat.early, flat.next, flat.rest = Held(), Held(), Held()
    parts = list(flat.handleInputRows((0,), iter(frames), None))
    stream = [t for s in (0, 1, 2) for ids in shards[s] for t in ids]
    got = [(n, list(a), list(b)) for pdf in parts for n, a, b in zip(pdf["row_id"], pdf["inputs"], pdf["targets"])]
    assert got == [(n, stream[8 * n : 8 * n + 8], stream[8 * n + 1 : 8 * n + 9]) for n in range((len(stream) - 1) // 8)]
    assert len(parts) > 5 and flat.early.most > 5 and not flat.early.rows and flat.next.value == (3, 0)


def test_what_comes_early_waits_in_few_entries():
    """A row that waits for its turn does not cost a visit to the state of its own."""
    rng = random.Random(2)
    rows = [(s, r, 300 * s + r, np.array([rng.randrange(-5, 90_000 if r % 3 else 200) for _ in range(r % 7)], "int32"), r == 299) for s in (2, 1) for r in range(300)]
    late = [(0, r, r, np.array([r], "int32"), r == 299) for r in range(300)]
    flat = streams.FlatStream(1, 8)
    flat.early, flat.next, flat.rest = Held(), Held(), Held()
    got = []
    for part in (rows[450:] + rows[:200], rows[200:450], late[:150], late[150:]):
        pdf = pd.DataFrame(part, columns=["shard", "row", "doc", "ids", "last"])
        got += [(list(a), list(b)) for out in flat.handleInputRows((0,), iter([pdf]), None) for a, b in zip(out["inputs"], out["targets"])]
    stream = [int(t) for _, _, _, ids, _ in sorted(late + rows, key=lambda x: x[:2]) for t in ids]
    assert got == [(stream[i : i + 8], stream[i + 1 : i + 9]) for i in range(0, (len(stream) - 1) // 8 * 8, 8)]
    assert 0 < flat.early.most < 10 and not flat.early.rows and flat.next.value == (3, 0)


def test_rows_of_one_group_are_written_by_many_tasks(spark, tmp_path):
    """A group's task only cuts its rows; ids of any size come out as they were."""
    path, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    rng = random.Random(4)
    part = [(d, [rng.randrange(-3 if d > 50 else 0, 1 << (31 if d > 70 else 9)) for _ in range(d % 30)] if d else None) for d in range(100)]
    spark.createDataFrame(part, "doc_id long, ids array<int>").coalesce(1).write.parquet(path)
    stream = streams.stream_shards(spark, path, "doc_id long, ids array<int>")
    streams.run_available(streams.stream_flat_rows(stream, "doc_id", "ids", F.lit(0), 8), out, state)
    rows = spark.read.schema(streams.FLAT_SCHEMA).parquet(out).select("*", F.input_file_name().alias("file")).orderBy("row_id").collect()
    ids = [t for _, some in part for t in some or []]
    assert [(r["row_id"], r["inputs"], r["targets"]) for r in rows] == [(i // 8, ids[i : i + 8], ids[i + 1 : i + 9]) for i in range(0, (len(ids) - 1) // 8 * 8, 8)]
    assert len({r["file"] for r in rows}) > 4
