"""Shuffling, slicing and mixing of corpora and tasks.

Functions return narrow tables of positions and row ids. Join them to the wide table once, at the end.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.det import draw_index, u
from corpusloom.operators.prefix import budget_cutoff, number_rows, prefix_sums, up_to
from corpusloom.session import materialize

log = logging.getLogger(__name__)


def nonempty(text: str = "text") -> Column:
    return F.col(text).isNotNull() & (F.col(text) != "")


def doc_cap(text: str = "text", cap: int = 10_000) -> Column:
    return F.substring(F.col(text), 1, cap)


def script_filter(text: str = "text", low: str = "가", high: str = "힣") -> Column:
    """The text has a character of the script; the default is the Hangul syllables."""
    return F.col(text).rlike(f"[{low}-{high}]")


def seeded_order(df: DataFrame, seed: int, *keys: str, out: str = "u") -> DataFrame:
    return df.withColumn(out, u(seed, *keys))


def seeded_shuffle(df: DataFrame, seed: int, *keys: str) -> DataFrame:
    """The keys with their dense 0-based position ``pos`` in a full permutation."""
    rows = seeded_order(df.select(*keys), seed, *keys, out="_u")
    rows = number_rows(rows, ["_u", *keys], "pos")
    return rows.withColumn("pos", F.col("pos") - 1).drop("_u")


def head_per_task(df: DataFrame, task: str, seed: int, n: int, *keys: str) -> DataFrame:
    """First ``n`` rows of every shuffled task; a negative ``n`` keeps all."""
    if n < 0:
        return df
    w = Window.partitionBy(task).orderBy(u(seed, *keys), *keys)
    # the rank filter is applied before the shuffle too, so a hot task sends at most n rows per input task
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def task_slice(df: DataFrame, idx: str, start: int = 0, stop: int | None = None, step: int = 1) -> DataFrame:
    """Rows ``start:stop:step`` of a densely numbered task, renumbered from 0."""
    if start < 0 or step < 1 or (stop is not None and stop < start):
        raise ValueError(f"bad slice {start}:{stop}:{step}")
    keep = (F.col(idx) >= start) & (F.pmod(F.col(idx) - start, F.lit(step)) == 0)
    if stop is not None:
        keep &= F.col(idx) < stop
    return df.filter(keep).withColumn(idx, F.floor((F.col(idx) - start) / step).cast("long"))


def index_rows(df: DataFrame, order: str, idx: str = "idx") -> DataFrame:
    """The order column with a dense 0-based index."""
    return number_rows(df.select(order), [order], idx).withColumn(idx, F.col(idx) - 1)


def _listed(tasks: Sequence[DataFrame | None], idx: str) -> DataFrame:
    kept = [(i, t) for i, t in enumerate(tasks) if t is not None]
    for i in sorted(set(range(len(tasks))) - {i for i, _ in kept}):
        log.warning("task %d is missing and left out", i)
    parts = [t.withColumn("task_pos", F.lit(i)).withColumnRenamed(idx, "local_idx") for i, t in kept]
    return reduce(DataFrame.unionByName, parts)


def task_mixture(tasks: Sequence[DataFrame | None], seed: int = 42, idx: str = "idx") -> DataFrame:
    """All tasks shuffled together; a task listed twice is oversampled, a missing one (None) is left out."""
    rows = _listed(tasks, idx).withColumn("_u", u(seed, "task_pos", "local_idx"))
    rows = number_rows(rows, ["_u", "task_pos", "local_idx"], "pos")
    return rows.withColumn("pos", F.col("pos") - 1).drop("_u")


def task_sequence(tasks: Sequence[DataFrame | None], idx: str = "idx") -> DataFrame:
    """Tasks one after the other (curriculum), densely numbered."""
    rows = _listed(tasks, idx)
    lengths = {r[0]: r[1] for r in rows.groupBy("task_pos").count().collect()}  # one row per listed task
    offset, before = F.lit(0).cast("long"), 0
    for i in range(len(tasks)):
        offset = F.when(F.col("task_pos") == i, F.lit(before)).otherwise(offset)
        before += lengths.get(i, 0)
    return rows.withColumn("pos", (F.col("local_idx") + offset).cast("long"))


def first_available(candidates: Sequence[DataFrame]) -> DataFrame:
    """The first candidate that yields rows; the last one when none does."""
    for c in candidates[:-1]:
        if not c.isEmpty():
            return c
        log.warning("candidate without rows, trying the next one")
    return candidates[-1]


def epoch_repeat(df: DataFrame, epochs: int, pos: str = "pos") -> DataFrame:
    """The data set repeated; ``epoch`` counts from 1, order by (epoch, pos)."""
    return df.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(epochs))))


def draw_from_pool(rows: DataFrame, pool: DataFrame, n: int, seed: int | str, *keys: str, idx: str = "idx") -> DataFrame:
    """Every row gets the pool row at ``floor(u * n)``; the pool is densely indexed from 0."""
    return rows.withColumn(idx, draw_index(n, seed, *keys)).join(pool, idx)


# --- two corpora -----------------------------------------------------------------------------------


def ratio_slots(docs: DataFrame, n_first: int, n_second: int, ratio: float, seed: int) -> tuple[DataFrame, int]:
    """Slots 1..n with the drawn corpus and the ordinal in it, and the last slot before one corpus runs out."""
    slots = docs.sparkSession.range(1, n_first + n_second + 1).withColumnRenamed("id", "slot")
    slots = slots.withColumn("is_first", u(seed, "slot") < ratio)
    slots = prefix_sums(slots, ["slot"], {"_f": F.col("is_first").cast("long")}, n=n_first + n_second)
    slots = slots.withColumn("k", F.when(F.col("is_first"), F.col("_f")).otherwise(F.col("slot") - F.col("_f")))
    out = (F.col("_f") == n_first) | (F.col("slot") - F.col("_f") == n_second)
    last = slots.filter(out).agg(F.min("slot")).first()[0]
    return slots.drop("_f"), last


def ratio_merge(first: DataFrame, second: DataFrame, order: str, ratio: float, seed: int = 42) -> DataFrame:
    """The k-th slot of a corpus gets its k-th row, while both corpora last."""
    n1, n2 = first.count(), second.count()
    f = number_rows(first.select(order), [order], "k", n=n1)
    s = number_rows(second.select(order), [order], "k", n=n2)
    slots, last = ratio_slots(first, n1, n2, ratio, seed)
    last = 0 if not n1 or not n2 else last
    slots = slots.filter(F.col("slot") <= last)
    rows = f.withColumn("is_first", F.lit(True)).unionByName(s.withColumn("is_first", F.lit(False)))
    return rows.join(slots, ["is_first", "k"])


def ratio_mix(
    first: DataFrame, second: DataFrame, order: str, ratio: float, seed: int = 42, strict: bool = True
) -> DataFrame:
    """Slot by slot: the first corpus when ``u < ratio``, while both last; the rest of the other follows.

    ``ratio`` 1.0 never reads the second corpus. An empty second corpus is an error when ``strict``, else
    the mix falls back to the first corpus alone.
    """
    n1 = first.count()
    f = number_rows(first.select(order), [order], "k", n=n1).withColumn("is_first", F.lit(True))
    alone = f.withColumn("pos", F.col("k")).drop("k")
    if ratio >= 1.0:
        return alone
    n2 = second.count()
    if not n2:
        if strict:
            raise ValueError("the second corpus is empty")
        log.warning("the second corpus is empty, falling back to the first alone")
        return alone
    s = number_rows(second.select(order), [order], "k", n=n2).withColumn("is_first", F.lit(False))
    slots, last = ratio_slots(first, n1, n2, ratio, seed)
    slots = slots.filter(F.col("slot") <= (last if n1 else 0))
    rows = f.unionByName(s).join(slots, ["is_first", "k"], "left")
    # a leftover row comes after all rows of the other corpus
    rest = F.col("k") + F.when(F.col("is_first"), F.lit(n2)).otherwise(F.lit(n1))
    return rows.select(order, "is_first", F.coalesce("slot", rest).alias("pos"))


def cycle_join(rows: DataFrame, pool: DataFrame, ordinal: str, n: int, repeat: bool = True) -> DataFrame:
    """Row with ordinal j (from 0) gets pool row ``j mod n``, or only rows below ``n`` when not repeating.

    ``pool`` has a dense 0-based ``pool_idx``.
    """
    at = F.pmod(F.col(ordinal), F.lit(n)) if repeat else F.col(ordinal)
    return rows.withColumn("pool_idx", at.cast("long")).join(pool, "pool_idx")


def insert_probability(ratio: float) -> float:
    if not 0.0 < ratio < 1.0:
        raise ValueError("ratio must be between 0 and 1")
    p = ratio / (1.0 - ratio)
    if p > 1.0:
        log.warning("ratio %s is above one half: one insert per row is the most, the share stays at 50%%", ratio)
    return p


def insert_mix(
    first: DataFrame, second: DataFrame, order: str, ratio: float, seed: int = 42, repeat: bool = True
) -> DataFrame:
    """After each first row at most one second row, drawn with probability r / (1 - r).

    Returns (order column, is_first, group, pos): ``group`` numbers the first rows, ``pos`` the mix.
    """
    p = insert_probability(ratio)
    n2 = second.count()
    flagged = first.select(order).withColumn("_flag", (u(seed, order) < p).cast("long"))
    rows = prefix_sums(flagged, [order], {"group": F.lit(1), "_c": F.col("_flag")})
    rows = rows.withColumn("group", F.col("group").cast("long"))
    cap = F.lit(None) if repeat and n2 else F.lit(n2)
    before = F.least(F.col("_c") - F.col("_flag"), cap.cast("long"))
    own = rows.select(order, F.lit(True).alias("is_first"), "group", (F.col("group") + before).alias("pos"))
    if not n2:
        return own
    pool = number_rows(second.select(order), [order], "pool_idx", n=n2)
    pool = pool.withColumn("pool_idx", F.col("pool_idx") - 1)
    drawn = rows.filter(F.col("_flag") == 1).withColumn("_j", F.col("_c") - 1).drop(order)
    drawn = cycle_join(drawn, pool, "_j", n2, repeat)
    return own.unionByName(
        drawn.select(order, F.lit(False).alias("is_first"), "group", (F.col("group") + F.col("_c")).alias("pos"))
    )


# --- character budgets -----------------------------------------------------------------------------


def text_sizes(docs: DataFrame, order: Sequence[str], text: str = "text") -> DataFrame:
    """The order columns and ``size`` in characters, written once: budgets that share the table read each text once between them."""
    return materialize(docs.select(*order, F.length(text).cast("long").alias("size")), "text-sizes")


def _budget(docs: DataFrame, order: Sequence[str], max_chars: int, text: str, sizes: DataFrame | None, keep_crossing: bool, **kw) -> DataFrame:
    sizes = text_sizes(docs, order, text) if sizes is None else sizes
    return docs.filter(up_to(order, budget_cutoff(sizes, order, F.col("size"), max_chars, keep_crossing, **kw)))


def char_budget_exclusive(docs: DataFrame, order: Sequence[str], max_chars: int, text: str = "text", sizes: DataFrame | None = None, **kw) -> DataFrame:
    """Rows while the running sum including the row stays within the budget; the crossing row is dropped.

    ``sizes`` is :func:`text_sizes` of ``docs`` where that is there already.
    """
    return _budget(docs, order, max_chars, text, sizes, False, **kw)


def char_budget_inclusive(docs: DataFrame, order: Sequence[str], max_chars: int, text: str = "text", sizes: DataFrame | None = None, **kw) -> DataFrame:
    """As above, but the crossing row is kept and ends the corpus."""
    return _budget(docs, order, max_chars, text, sizes, True, **kw)


def val_budget(
    first: DataFrame, second: DataFrame, order: str, ratio: float, max_chars: int, text: str = "text", seed: int = 42, sizes: DataFrame | None = None
) -> DataFrame:
    """Exclusive budget over the first corpus, then mixing, then stop once the mixed size reaches the budget.

    Keys and sizes are all that is worked on. With ``sizes``, the :func:`text_sizes` of both corpora, no text is read here.
    """
    if sizes is None:
        sizes = text_sizes(first.select(order, text).unionByName(second.select(order, text)), [order], text)
    own = first.select(order).join(sizes.hint("merge"), order)
    kept = char_budget_exclusive(own, [order], max_chars, sizes=own)
    mixed = insert_mix(kept, second.select(order), order, ratio, seed)
    mixed = materialize(mixed.join(sizes, order), "val-mix")  # narrow, and read for the budget and for the result
    groups = mixed.groupBy("group").agg(F.sum("size").alias("size"))
    # a group is kept while the sum of the groups before it is still below the budget
    last = budget_cutoff(groups, ["group"], F.col("size"), max_chars - 1, True)
    return mixed.filter(up_to(["group"], last)).drop("size")
