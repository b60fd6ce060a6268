"""Writing numbered shards."""

import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from corpusloom.operators import shards


@pytest.fixture
def rows(spark):
    return spark.range(5000).select("id", F.lit("text").alias("text"), F.floor(F.col("id") / 2500).alias("shard"))


def test_shards_are_numbered_and_grouped(rows, tmp_path):
    path = str(tmp_path / "out")
    assert shards.write_shards(rows, path, ["id"], ["id", "text"]) == 2
    assert sorted(x.name for x in (tmp_path / "out").iterdir() if not x.name.startswith(".")) == ["shard_00000.parquet", "shard_00001.parquet"]
    file = pq.ParquetFile(tmp_path / "out" / "shard_00001.parquet")
    assert [file.metadata.row_group(i).num_rows for i in range(file.num_row_groups)] == [1024, 1024, 452]
    assert file.metadata.row_group(0).column(0).compression == "ZSTD"
    assert file.read()["id"].to_pylist() == list(range(2500, 5000))


def test_finished_shards_are_skipped(rows, tmp_path):
    path = str(tmp_path / "out")
    assert shards.write_shards(rows.filter("shard = 1"), path, ["id"], ["id"]) == 1
    before = (tmp_path / "out" / "shard_00001.parquet").stat().st_mtime_ns
    assert shards.write_shards(rows, path, ["id"], ["id"]) == 1
    assert (tmp_path / "out" / "shard_00001.parquet").stat().st_mtime_ns == before
    assert shards.write_shards(rows, path, ["id"], ["id"]) == 0


def test_no_shard_splits_a_group(spark):
    mixed = spark.createDataFrame([(i, i % 3 != 2, i // 3, i) for i in range(60)], "doc_id long, is_first boolean, group long, pos long")
    sizes = mixed.select("doc_id", (F.col("doc_id") % 7 + 1).alias("size"))
    out = shards.mixed_shards(mixed, sizes, "doc_id", 30).collect()
    assert len(out) == 60 and len({(r.group, r.shard) for r in out}) == 20 and len({r.shard for r in out}) > 3


def walk(sizes, budget, align):
    """The shard of every row, and how many shards were closed."""
    out, shard, held = [], 0, 0
    for i, n in enumerate(sizes, 1):
        held += n
        out.append(shard)
        if held >= budget and i % align == 0:
            shard, held = shard + 1, 0
    return out, shard


@pytest.mark.parametrize("budget, align", [(1, 1), (50, 1), (50, 7), (3000, 1), (400, 16), (10**9, 1)])
def test_greedy_shards_equal_a_walk(spark, monkeypatch, budget, align):
    """Many ranges, with shards far longer and far shorter than a range, and a tree of several levels."""
    monkeypatch.setattr(shards, "FAN", 4)
    rng = random.Random(budget + align)
    sizes = [rng.choice([0, 0, 1, 3, 10, 10, 40]) * (50 if 600 < i < 640 else 1) for i in range(1500)]
    df = spark.createDataFrame(list(enumerate(sizes)), "id long, n int").repartition(5)
    want, closed = walk(sizes, budget, align)
    got = shards.greedy_shards(df, ["id"], F.col("n"), budget, align, rows_per_bucket=13).collect()
    assert [r["shard"] for r in sorted(got)] == want
    got = shards.greedy_shards(df, ["id"], F.col("n"), budget, align, flush_tail=False, rows_per_bucket=13).collect()
    assert [(r["id"], r["shard"]) for r in sorted(got)] == [(i, s) for i, s in enumerate(want) if s < closed]


def test_jobs_do_not_grow_with_the_ranges(spark):
    """4,096 ranges in at most 20 jobs, that of reading the result included."""
    df = spark.range(1 << 13).select("id", (F.col("id") * 7919 % 101).alias("n"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("greedy", "greedy shards")
    try:
        out = shards.greedy_shards(df, ["id"], F.col("n"), 2000, rows_per_bucket=2)
        found = sorted((r["id"], r["shard"]) for r in out.collect())
        jobs = tracker.getJobIdsForGroup("greedy")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    sizes = [i * 7919 % 101 for i in range(1 << 13)]
    assert found == list(enumerate(walk(sizes, 2000, 1)[0]))
    assert len(jobs) <= 20, [tracker.getJobInfo(j) for j in sorted(jobs)]


def test_no_rows(spark):
    assert shards.greedy_shards(spark.range(0), ["id"], F.lit(1), 10).collect() == []
    assert shards.greedy_shards(spark.range(0), ["id"], F.lit(1), 10, flush_tail=False).collect() == []
