import random

import pytest
from pyspark.sql import functions as F

from corpusloom.functions.det import u
from corpusloom.operators import prefix


def rows(n, seed=1):
    rng = random.Random(seed)
    ids = rng.sample(range(10 * n), n // 2) + [10**9 + i for i in range(n - n // 2)]  # a sparse and a dense part
    return sorted((i, rng.choice("aaab"), rng.randrange(100)) for i in ids)


@pytest.mark.parametrize("size", [1, 3, 40, 10_000])
def test_running_sums(spark, size):
    data = rows(101)
    df = spark.createDataFrame(data, "id long, g string, v long")
    got = {r["id"]: (r["s"], r["k"]) for r in prefix.prefix_sums(df, ["id"], {"s": F.col("v"), "k": F.lit(1)}, rows_per_bucket=size).collect()}
    total = 0
    for k, (i, _, v) in enumerate(data, 1):
        total += v
        assert got[i] == (total, k)


@pytest.mark.parametrize("size", [3, 10_000])
def test_running_sums_and_minima_per_group(spark, size):
    data = rows(80) + [(5_000_000, None, 7), (5_000_001, None, 3)]
    df = spark.createDataFrame(data, "id long, g string, v long")
    sums = {r["id"]: r["s"] for r in prefix.prefix_sums(df, ["id"], {"s": F.col("v")}, ["g"], size).collect()}
    lows = {r["id"]: r["m"] for r in prefix.prefix_sums(df, ["id"], {"m": F.col("v")}, ["g"], size, lowest=True).collect()}
    run, low = {}, {}
    for i, g, v in sorted(data, key=lambda r: r[0]):
        run[g], low[g] = run.get(g, 0) + v, min(low.get(g, v), v)
        assert (sums[i], lows[i]) == (run[g], low[g])
    assert len(sums) == len(data)


@pytest.mark.parametrize("keep", [True, False])
@pytest.mark.parametrize("limit", [0, 1, 99, 2000, 10**6])
def test_budget(spark, limit, keep):
    data = rows(90)
    df = spark.createDataFrame(data, "id long, g string, v long")
    last = prefix.budget_cutoff(df, ["id"], F.col("v"), limit, keep, rows_per_bucket=7)
    got = sorted(r["id"] for r in df.filter(prefix.up_to(["id"], last)).collect())
    want, total = [], 0
    for i, _, v in data:
        if (total if keep else total + v) > limit:
            break
        total += v
        want.append(i)
    assert got == want


def test_budget_of_nothing(spark):
    df = spark.createDataFrame([], "id long, v long")
    assert prefix.budget_cutoff(df, ["id"], F.col("v"), 5, True) is None


def test_two_column_cutoff(spark):
    df = spark.range(200).withColumn("u", F.floor(u(1, "id") * 5) / 5)  # ties in the first column
    order = sorted((r["u"], r["id"]) for r in df.collect())
    last = prefix.budget_cutoff(df, ["u", "id"], F.lit(1), 77, False, rows_per_bucket=10)
    assert last == order[76]
    got = sorted((r["u"], r["id"]) for r in df.filter(prefix.up_to(["u", "id"], last)).collect())
    assert got == order[:77]


def test_buckets_are_balanced_and_stable(spark):
    df = spark.range(1000).withColumn("k", F.when(F.col("id") < 900, F.col("id")).otherwise(F.col("id") * 10**9))
    bounds = prefix.key_bounds(df, F.col("k"), 100)
    sizes = [r["count"] for r in df.groupBy(prefix.bucket_of(F.col("k"), bounds).alias("b")).count().collect()]
    assert len(sizes) == 10 and max(sizes) <= 110
