"""Prefix sums, dense numbering and budget cutoffs without a single-partition window.

A global running sum is computed in two levels: rows fall into balanced key ranges ("buckets"), each bucket
is summed, the small bucket table is accumulated, and a window runs inside every bucket. The bucket
boundaries are quantiles of the order key, so sparse or clustered ids still give balanced tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_BUCKET = 1 << 16
#: totals of up to so many buckets (a few MB) go to every task
BROADCAST_BUCKETS = 1 << 16


def key_bounds(df: DataFrame, key: Column, rows_per_bucket: int | None = None, n: int | None = None) -> list:
    """Upper-exclusive bucket boundaries of a numeric key.

    There are at least as many buckets as cores (or rows) and none has many more than ``rows_per_bucket`` rows, so the way is the same
    for tables of every size. The list is fixed on the driver so that every use of it
    (bucket totals, windows, retried tasks) cuts the rows at the same places.
    """
    n = df.count() if n is None else n
    rows_per_bucket = rows_per_bucket or ROWS_PER_BUCKET
    buckets = max(min(n, df.sparkSession.sparkContext.defaultParallelism), -(-n // rows_per_bucket))
    if buckets <= 1:
        return []
    cuts = [i / buckets for i in range(1, buckets)]
    found = df.agg(F.percentile_approx(key, cuts, max(10_000, 20 * buckets))).first()[0]
    return sorted(set(found))


def bucket_of(key: Column, bounds: Sequence) -> Column:
    """Bucket number of ``key``: how many boundaries are <= it, by binary search."""
    if not bounds:
        return F.lit(0)
    kind = "array<double>" if isinstance(bounds[0], float) else "array<bigint>"
    array = F.split(F.lit(",".join(repr(b) for b in bounds)), ",").cast(kind)

    def halve(state: Column, _: Column) -> Column:
        lo, hi = state["lo"], state["hi"]
        mid = F.shiftright(lo + hi, 1)
        right = F.element_at(array, mid + 1) <= key
        open_ = lo < hi
        return F.struct(
            F.when(open_ & right, mid + 1).otherwise(lo).alias("lo"),
            F.when(open_ & ~right, mid).otherwise(hi).alias("hi"),
        )

    steps = F.sequence(F.lit(0), F.lit(len(bounds).bit_length()))
    # the last probe reads past the end only when lo == hi, so keep the index in range
    array = F.concat(array, F.slice(array, -1, 1))
    start = F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi"))
    return F.aggregate(steps, start, halve, lambda s: s["lo"])


def prefix_sums(
    df: DataFrame,
    order: Sequence[str],
    sums: dict[str, Column],
    partition: Sequence[str] = (),
    rows_per_bucket: int | None = None,
    bounds: Sequence | None = None,
    lowest: bool = False,
    n: int | None = None,
) -> DataFrame:
    """Add inclusive running sums along ``order`` (first column numeric, all columns a unique key).

    ``lowest`` gives running minima instead. With ``partition`` the sums restart for every value; a value that holds most rows is still split
    into buckets. Pass narrow rows and join wide columns back where possible.
    """
    if bounds is None:
        bounds = key_bounds(df, F.col(order[0]), rows_per_bucket, n)
    rows = df
    gather = F.min if lowest else F.sum
    if not bounds:
        w = Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return rows.select("*", *[gather(c).over(w).alias(n) for n, c in sums.items()])

    rows = rows.withColumn("_b", bucket_of(F.col(order[0]), bounds))
    for name, col in sums.items():
        rows = rows.withColumn(f"_v_{name}", col)
    keys = [*partition, "_b"]
    totals = rows.groupBy(*keys).agg(*[gather(f"_v_{n}").alias(f"_t_{n}") for n in sums])
    before = Window.partitionBy(*partition).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys, *[gather(f"_t_{n}").over(before).alias(f"_o_{n}") for n in sums]
    )
    if not partition:
        if len(bounds) < BROADCAST_BUCKETS:
            offsets = F.broadcast(offsets)
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.select(
        "*", *[gather(f"_v_{n}").over(inside).alias(f"_s_{n}") for n in sums]
    )
    offsets = offsets.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    both = F.least if lowest else lambda a, b: a + F.coalesce(b, F.lit(0))
    match = reduce(lambda a, b: a & b, [rows[k].eqNullSafe(offsets[f"_k_{k}"]) for k in keys])
    return rows.join(offsets, match).select(
        *[rows[c] for c in df.columns],
        *[both(F.col(f"_s_{n}"), F.col(f"_o_{n}")).alias(n) for n in sums],
    )


def number_rows(
    df: DataFrame,
    order: Sequence[str],
    out: str = "rn",
    partition: Sequence[str] = (),
    rows_per_bucket: int | None = None,
    n: int | None = None,
) -> DataFrame:
    """Dense 1-based numbering along ``order``; ``n`` is the number of rows where it is known already."""
    return prefix_sums(df, order, {out: F.lit(1)}, partition, rows_per_bucket, n=n).withColumn(
        out, F.col(out).cast("long")
    )


def budget_cutoff(
    df: DataFrame,
    order: Sequence[str],
    size: Column,
    limit: int,
    keep_crossing: bool,
    rows_per_bucket: int | None = None,
) -> tuple | None:
    """Order key of the last row that a running budget keeps; None when no row is kept.

    ``keep_crossing=False`` keeps rows while the sum including the row is <= ``limit``;
    ``keep_crossing=True`` keeps rows while the sum of the rows before it is <= ``limit``.
    Only the bucket that holds the boundary is ordered, everything else is one aggregation.
    """
    rows = df.select(*order, size.alias("_size"))
    bounds = key_bounds(rows, F.col(order[0]), rows_per_bucket)
    rows = rows.withColumn("_b", bucket_of(F.col(order[0]), bounds))
    done, bucket = 0, None
    # a small row per bucket
    for b, total in rows.groupBy("_b").agg(F.sum("_size")).orderBy("_b").collect():
        bucket = b
        if done + total > limit:
            break
        done += total
    else:
        done, bucket = 0, None
    if bucket is None:  # everything fits
        last = rows.orderBy(*[F.desc(c) for c in order]).select(*order).first()
        return tuple(last) if last else None
    w = Window.partitionBy("_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    run = F.sum("_size").over(w) + F.lit(done)
    # the bucket as a range of the key, which reaches the scan
    low, high = (bounds[bucket - 1] if bucket else None), (bounds[bucket] if bucket < len(bounds) else None)
    inside = rows
    if low is not None:
        inside = inside.filter(F.col(order[0]) >= F.lit(low))
    if high is not None:
        inside = inside.filter(F.col(order[0]) < F.lit(high))
    kept = inside.withColumn("_run", run)
    kept = kept.filter((F.col("_run") - F.col("_size") if keep_crossing else F.col("_run")) <= limit)
    last = kept.orderBy(*[F.desc(c) for c in order]).select(*order).first()
    if last is None:  # the first row of the boundary bucket already crosses
        last = (
            rows.filter(F.col("_b") < bucket)
            .orderBy(*[F.desc(c) for c in order])
            .select(*order)
            .first()
        )
    return tuple(last) if last else None


def up_to(order: Sequence[str], last: tuple | None) -> Column:
    """Predicate ``order <= last``; its first comparison can be pushed to the scan."""
    if last is None:
        return F.lit(False)
    tail: Column | None = None
    for name, value in reversed(list(zip(order, last))):
        col, value = F.col(name), F.lit(value)
        tail = (col <= value) if tail is None else ((col < value) | ((col == value) & tail))
    if len(order) > 1:
        tail = (F.col(order[0]) <= F.lit(last[0])) & tail
    return tail
