import random

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import mix, shards


def ids(df, n, by="pos"):
    return [r[n] for r in df.orderBy(by).collect()]


def frame(spark, low, high):
    return spark.range(low, high).withColumnRenamed("id", "doc_id")


@pytest.mark.parametrize("ratio", [0.0, 0.3, 0.9])
@pytest.mark.parametrize("sizes", [(30, 10), (5, 40), (0, 7)])
def test_ratio_mix_keeps_everything_in_order(spark, small_buckets, ratio, sizes):
    first, second = frame(spark, 0, sizes[0]), frame(spark, 1000, 1000 + sizes[1])
    out = mix.ratio_mix(first, second, "doc_id", ratio)
    rows = out.orderBy("pos").collect()
    assert [r["pos"] for r in rows] == list(range(1, sum(sizes) + 1))
    assert [r["doc_id"] for r in rows if r["is_first"]] == list(range(sizes[0]))
    assert [r["doc_id"] for r in rows if not r["is_first"]] == list(range(1000, 1000 + sizes[1]))
    if ratio == 0.0:
        assert not any(r["is_first"] for r in rows[: sizes[1]])


def test_ratio_mix_edges(spark):
    first, none = frame(spark, 0, 5), frame(spark, 0, 0)
    assert ids(mix.ratio_mix(first, frame(spark, 9, 12), "doc_id", 1.0), "doc_id") == [0, 1, 2, 3, 4]
    assert ids(mix.ratio_mix(first, none, "doc_id", 0.5, strict=False), "doc_id") == [0, 1, 2, 3, 4]
    with pytest.raises(ValueError, match="second corpus"):
        mix.ratio_mix(first, none, "doc_id", 0.5)


@pytest.mark.parametrize("repeat", [True, False])
def test_insert_mix(spark, small_buckets, repeat):
    first, second = frame(spark, 0, 60), frame(spark, 1000, 1007)
    rows = mix.insert_mix(first, second, "doc_id", 0.4, repeat=repeat).orderBy("pos").collect()
    assert [r["pos"] for r in rows] == list(range(1, len(rows) + 1))
    assert [r["doc_id"] for r in rows if r["is_first"]] == list(range(60))
    drawn = [r["doc_id"] for r in rows if not r["is_first"]]
    assert drawn == [1000 + i % 7 for i in range(len(drawn))]
    assert len(drawn) > 20 if repeat else len(drawn) == 7
    for a, b in zip(rows, rows[1:]):
        assert a["is_first"] or b["is_first"]  # at most one insert in a row


def test_insert_mix_saturates(spark):
    rows = mix.insert_mix(frame(spark, 0, 20), frame(spark, 50, 55), "doc_id", 0.9)
    assert rows.filter("is_first").count() == rows.filter("NOT is_first").count() == 20
    assert mix.insert_mix(frame(spark, 0, 20), frame(spark, 0, 0), "doc_id", 0.9).count() == 20
    for bad in (0.0, 1.0):
        with pytest.raises(ValueError, match="ratio"):
            mix.insert_mix(frame(spark, 0, 2), frame(spark, 0, 2), "doc_id", bad)


def test_slice_is_offset_access(spark):
    task = frame(spark, 100, 150).withColumn("idx", F.col("doc_id") - 100)
    for start, stop, step in [(0, None, 1), (5, 10, 1), (3, None, 7), (3, 1000, 7), (4, 4, 2)]:
        got = [r["doc_id"] for r in mix.task_slice(task, "idx", start, stop, step).orderBy("idx").collect()]
        assert got == list(range(100, 150))[start:stop:step]
    with pytest.raises(ValueError, match="slice"):
        mix.task_slice(task, "idx", 5, 2)


def test_shuffle_is_a_permutation(spark, small_buckets):
    df = frame(spark, 0, 100)
    a, b = (ids(mix.seeded_shuffle(df, s, "doc_id"), "doc_id") for s in (1, 2))
    assert sorted(a) == sorted(b) == list(range(100)) and a != b
    assert a == ids(mix.seeded_shuffle(df.repartition(7), 1, "doc_id"), "doc_id")


def test_script_filter(spark):
    df = spark.createDataFrame([("abc",), ("안녕",), ("x힣",), ("ㄱ",)], "text string")
    assert sorted(r[0] for r in df.filter(mix.script_filter()).collect()) == ["x힣", "안녕"]


def greedy(sizes, budget, align):
    out, shard, chars, n = [], 0, 0, 0
    for s in sizes:
        out.append(shard)
        chars, n = chars + s, n + 1
        if chars >= budget and n % align == 0:
            shard, chars, n = shard + 1, 0, 0
    return out, shard


@pytest.mark.parametrize("align", [1, 4, 37])  # with 37 some key ranges hold no row where a shard may end
@pytest.mark.parametrize("budget", [1, 30, 250, 10_000])
def test_greedy_shards(spark, small_buckets, align, budget):
    rng = random.Random(budget)
    sizes = [rng.choice([0, 1, 5, 20, 90, 400]) for _ in range(133)]
    df = spark.createDataFrame(list(enumerate(sizes)), "doc_id long, n long")
    want, closed = greedy(sizes, budget, align)
    got = shards.greedy_shards(df, ["doc_id"], F.col("n"), budget, align)
    assert [r["shard"] for r in got.orderBy("doc_id").collect()] == want
    kept = shards.greedy_shards(df, ["doc_id"], F.col("n"), budget, align, flush_tail=False)
    assert [r["shard"] for r in kept.orderBy("doc_id").collect()] == [s for s in want if s < closed]


def test_fixed_row_shards(spark, small_buckets):
    got = shards.fixed_row_shards(frame(spark, 0, 70), ["doc_id"], 20, max_rows=50).orderBy("doc_id").collect()
    assert [r["shard"] for r in got] == [i // 20 for i in range(50)]
