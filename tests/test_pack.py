import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.operators import pack


def naive(docs, capacity, size, refill, crop):
    """The packing loop on plain lists, refilled in batches, drained at the end of the input."""
    queue, buffer, rows = list(docs), [], []
    row, row_docs, cropped = [], [], 0
    while True:
        while len(buffer) < size and queue:
            buffer, queue = buffer + queue[:refill], queue[refill:]
        if not buffer:
            return rows
        room = capacity - len(row)
        best, best_len = -1, 0
        for i, (_, ids) in enumerate(buffer):
            if best_len < len(ids) <= room:
                best, best_len = i, len(ids)
        if best < 0:
            best = 0 if crop == "first" else min(range(len(buffer)), key=lambda i: len(buffer[i][1]))
        doc, ids = buffer.pop(best)
        cropped += max(len(ids) - room, 0)
        row, row_docs = row + list(ids[:room]), row_docs + [doc]
        if len(row) == capacity:
            rows.append((row, row_docs, cropped))
            row, row_docs, cropped = [], [], 0


def random_docs(seed, n, longest):
    rng = random.Random(seed)
    return [(d, [1000 + d] + [rng.randrange(256) for _ in range(rng.randrange(longest))]) for d in range(n)]


CASES = [(0, 50, 40, 33), (1, 300, 30, 65), (2, 120, 400, 33), (3, 1, 10, 33), (4, 40, 200, 5)]


def plain(rows):
    return [(list(map(int, r)), list(d), c) for r, d, c in rows]


@pytest.mark.parametrize("crop", ["shortest", "first"])
@pytest.mark.parametrize("seed,n,longest,capacity", CASES)
def test_packer_equals_the_loop(seed, n, longest, capacity, crop):
    docs = random_docs(seed, n, longest)
    packer = pack.Packer(capacity, 20, 8, crop)
    rows = []
    for i, (d, ids) in enumerate(docs):
        rows.extend(packer.push(d, ids))
        if i % 7 == 0:
            packer = pack.Packer.load(packer.dump())  # carrying the state changes nothing
    rows.extend(packer.finish())
    assert plain(rows) == naive(docs, capacity, 20, 8, crop)


def test_packed_rows(spark):
    docs = random_docs(5, 200, 60)
    df = spark.createDataFrame(docs, "doc_id long, ids array<int>")
    group = pack.pack_groups(4, "doc_id")
    rows = pack.bestfit_pack(df, "doc_id", "ids", 32, group, buffer=10, refill=4).collect()
    by_group = {}
    for r in df.withColumn("g", group).orderBy("doc_id").collect():
        by_group.setdefault(r["g"], []).append((r["doc_id"], r["ids"]))
    assert len(by_group) == 4
    for g, members in by_group.items():
        mine = sorted((r for r in rows if r["pack_group"] == g), key=lambda r: r["row_id"])
        assert [(r["ids"], r["doc_ids"], r["n_cropped"]) for r in mine] == naive(members, 33, 10, 4, "shortest")
    assert all(len(r["ids"]) == 33 and r["ids"][0] >= 1000 for r in rows)  # full rows, each starting with a document
    used = [d for r in rows for d in r["doc_ids"]]
    assert len(used) == len(set(used))


def test_table_function_equals_the_batch(spark):
    docs = random_docs(6, 80, 50)
    df = spark.createDataFrame(docs, "doc long, ids array<int>").withColumn("pack_group", F.col("doc") % 3)
    spark.udtf.register("pack_test", pack.packer_function(20, 6, 2))
    df.createOrReplaceTempView("pack_test_input")
    sql = spark.sql("SELECT * FROM pack_test(TABLE(pack_test_input) PARTITION BY pack_group ORDER BY doc)")
    batch = pack.bestfit_pack(df, "doc", "ids", 20, "pack_group", buffer=6, refill=2)
    key = lambda r: (r["pack_group"], r["row_id"])
    assert sorted(map(tuple, sql.collect())) == sorted(map(tuple, batch.collect())) and key


@pytest.mark.parametrize("lengths", [[5] * 9, [100], [1, 1, 1, 30, 2], [17], [16, 1], [0, 33, 0, 2]])
def test_flat_rows(spark, small_buckets, lengths):
    docs, at = [], 0
    for i, n in enumerate(lengths):
        docs.append((i, list(range(at, at + n))))
        at += n
    df = spark.createDataFrame(docs, "doc_id long, ids array<int>")
    for batch in (1, 2):
        rows = pack.flat_rows(df, "doc_id", "ids", 4, batch).orderBy("row_id").collect()
        n = max(at - 1, 0) // (4 * batch) * batch
        assert [(r["row_id"], r["inputs"], r["targets"]) for r in rows] == [
            (i, list(range(4 * i, 4 * i + 4)), list(range(4 * i + 1, 4 * i + 5))) for i in range(n)
        ]


def test_rates(spark):
    packed = spark.createDataFrame([(0, 0, [1] * 5, [1], 3), (0, 1, [1] * 5, [2], 0)], pack.PACKED_SCHEMA)
    r = pack.packing_rates(packed, 15, 4).first()
    assert (r["utilization"], r["padding"], r["n_leftover"]) == (1.0, 0.0, 2) and r["crop"] == pytest.approx(3 / 13)


@pytest.mark.parametrize("crop", ["shortest", "first"])
def test_parts_go_on_from_each_other(spark, crop):
    """However the corpus is cut, also in parts that some groups have no rows in."""
    docs = random_docs(8, 160, 40)
    df = spark.createDataFrame(docs, "doc_id long, ids array<int>").repartition(3)
    group = F.col("doc_id") % 4
    whole = sorted(map(tuple, pack.bestfit_pack(df, "doc_id", "ids", 20, group, 10, 4, crop).collect()))
    for cuts in ([0, 160], [0, 3, 3, 90, 160], [0, 80, 158, 160]):
        state, got = None, []
        for low, high in zip(cuts, cuts[1:]):
            rows, state = pack.pack_part(df.filter(f"doc_id >= {low} AND doc_id < {high}"), "doc_id", "ids", 20, group, state, high == 160, 10, 4, crop)
            got += map(tuple, rows.collect())
        assert sorted(got) == whole
    assert pack.pack_part(df.limit(0), "doc_id", "ids", 20, group, last=True)[0].collect() == []


def test_packer_holds_no_batches():
    """What waits in the buffer is a copy of no more ids than a row takes, not a view of the batch it came in."""
    packer = pack.Packer(11, buffer=4, refill=2)
    batch = np.arange(1000, dtype="int32")
    rows = [row for i in range(6) for row in packer.push(i, batch[100 * i : 100 * i + 50 + i])]
    assert packer.docs and all(ids.base is None and len(ids) <= 11 for _, ids in packer.docs.values())
    rows += packer.finish()
    assert [(row.tolist(), docs, cropped) for row, docs, cropped in rows] == [(list(range(100 * i, 100 * i + 11)), [i], 39 + i) for i in range(6)]
