"""Connected components of a graph whose edges are a table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.session import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root``: for every node of ``edges`` (``a, b``, long) the least node that it is connected with.

    Every round hangs the neighbours of each node on the least of them, first the larger ones, then the smaller ones, until
    nothing changes; the number of rounds grows with the logarithm of the graph. A node of many edges is handled by
    aggregation and a join, so no task gathers its neighbours. Nulls and loops play no part; no edges give no rows.
    """
    both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a is not null and a > b")
    held = materialize(both.distinct(), "components-edges")
    before = _print(held)
    while True:
        large = _hang(held.unionByName(held.select(F.col("b").alias("a"), F.col("a").alias("b"))), larger=True)
        held = materialize(_hang(materialize(large, "components-large"), larger=False), "components-edges")
        now = _print(held)
        if now == before:
            break
        before = now
    roots = held.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def _hang(edges: DataFrame, larger: bool) -> DataFrame:
    """Edges from the neighbours of ``a`` (larger ones, or smaller ones and itself) to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("_m"))
    joined = edges.join(least, "a")
    root = F.least("a", "_m")
    if larger:
        out = joined.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), root.alias("b"))
    else:
        out = joined.select(F.inline(F.array(F.struct(F.col("b").alias("a"), root.alias("b")), F.struct(F.col("a").alias("a"), root.alias("b")))))
    return out.filter("a > b").distinct()


def _print(edges: DataFrame):
    """Equal for equal tables."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
