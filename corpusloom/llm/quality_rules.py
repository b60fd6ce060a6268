"""Quality rules whose cutoffs adapt to the language and the source.

Every document is measured once. The measures of a group (language and source) go into a mergeable quantile sketch: counts of
values in buckets of a relative width of 1/32, which add up in any order, so that lost and repeated tasks change nothing.
Quartiles read from the sketches give fences per group: three interquartile ranges beyond the quartiles or, for a measure that most documents
have the same value of, beyond the quartiles of the values above that. No fence is fixed; the least distance is the width of a bucket.
Groups with few documents use the merged sketch of their language, and languages with few documents that of the whole corpus.
A join then filters the documents.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import map_batches
from corpusloom.session import materialize

WINDOW_WORDS = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: a sketch of fewer documents is merged with the next wider one
MIN_GROUP = 50
#: bits of a value that its bucket keeps
BUCKET_BITS = 6
#: fences stand so many interquartile ranges beyond the quartiles
FENCE = 3
WHITE = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"

#: measure: whether low values are fenced too
MEASURES = {"word_size": True, "symbol_rate": False, "dup_line_rate": False, "repeat_rate": False}

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


def repeated_words(words: list[bytes]) -> int:
    """How many words stand in a window of ``WINDOW_WORDS`` words that occurs at least twice."""
    n = len(words) - WINDOW_WORDS + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    keys = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    if len(numbers) == len(words):
        return 0
    step = 1
    while step < WINDOW_WORDS:  # keys of windows of 2, 4 and 8 words
        keys = np.unique(keys[:-step] * (int(keys.max()) + 1) + keys[step:], return_inverse=True)[1]
        step *= 2
    again = np.bincount(keys)[keys] > 1
    edges = np.zeros(len(words) + 1, np.int64)
    edges[:n] += again
    edges[WINDOW_WORDS:] -= again
    return int((np.cumsum(edges) > 0).sum())


def measure_text(text: str) -> tuple[int, ...]:
    words = text.encode().split()  # the white space of bytes is exactly blank and \t to \r
    lines = Counter(line for line in text.split("\n") if line and not line.strip(WHITE) == "")
    return (
        len(words),
        len(text) - sum(map(text.count, WHITE)),
        sum(map(text.count, SYMBOLS)),
        sum(lines.values()) - len(lines),
        repeated_words(words),
        sum(lines.values()),
    )


def measure(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source", row: str | None = None) -> DataFrame:
    """``doc_id, lang, source`` (and ``row``) and the counts of every whole text; a null text has no words."""
    carried = [F.col(row).cast("long").alias("row")] if row else []
    names = ["doc_id", "lang", "source", *(["row"] if row else [])]
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(lang).alias("lang"), F.col(source).alias("source"), F.col(text).alias("text"), *carried)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [measure_text(t or "") for t in batch.column("text").to_pylist()]
        counts = [pa.array(c, pa.int64()) for c in zip(*found)]
        return pa.RecordBatch.from_arrays([batch.column(c) for c in names] + counts, [*names, *COUNTS])

    schema = "doc_id long, lang string, source string, " + ("row long, " if row else "") + ", ".join(f"{c} long" for c in COUNTS)
    return map_batches(rows.withColumns({c: F.col(c).cast("string") for c in ("lang", "source", "text")}), run, schema)


def base_failed() -> Column:
    n = F.col("n_words")
    return (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * n)


def rates() -> dict[str, Column]:
    """The fenced measures as whole numbers, per thousand."""

    def per_mille(a: str, b: str) -> Column:
        return F.expr(f"{a} * 1000 div greatest({b}, 1)")

    return {
        "word_size": per_mille("word_chars", "n_words"),
        "symbol_rate": per_mille("n_symbols", "word_chars"),
        "dup_line_rate": per_mille("n_dup_lines", "n_lines"),
        "repeat_rate": per_mille("n_repeat_words", "n_words"),
    }


def bucket(value: str) -> Column:
    """The value with all but its ``BUCKET_BITS`` leading bits cleared."""
    shift = f"greatest(length(bin({value})) - {BUCKET_BITS}, 0)"
    return F.expr(f"shiftleft(shiftright({value}, {shift}), {shift})")


def width(value: Column) -> Column:
    """The width of the value's bucket."""
    return F.pow(F.lit(2), F.greatest(F.length(F.bin(value)) - BUCKET_BITS, F.lit(0))).cast("long")


def sketch(measures: DataFrame) -> DataFrame:
    """``lang, source, measure, bucket, n``: a quantile sketch per group over all documents that pass the base rules.

    Sketches merge by adding ``n``; Spark adds up within each task before it shuffles, so a hot source costs no more than
    another.
    """
    found = F.array(*[F.struct(F.lit(name).alias("measure"), value.alias("value")) for name, value in rates().items()])
    rows = measures.filter(~base_failed()).select("lang", "source", F.inline(found))
    return rows.groupBy("lang", "source", "measure", bucket("value").alias("bucket")).agg(F.count("*").alias("n"))


def quartiles(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """The documents and the quartiles of each group's sketch, merged over what ``keys`` leave out; ``t1`` and ``t3`` are those of the values above ``q3``, if any."""
    group = [*keys, "measure"]
    rows = sketches.groupBy(*group, "bucket").agg(F.sum("n").alias("n"))
    w = Window.partitionBy(*group)  # the buckets of a measure, a few hundred at most
    rows = rows.select(*group, "bucket", F.sum("n").over(w).alias("total"), F.sum("n").over(w.orderBy("bucket")).alias("upto"))
    at, upto, total = F.col("bucket"), F.col("upto"), F.col("total")
    rows = rows.withColumn("q1", F.min(F.when(upto * 4 >= total, at)).over(w)).withColumn("q3", F.min(F.when(upto * 4 >= total * 3, at)).over(w))
    rows = rows.withColumn("body", F.max(F.when(at <= F.col("q3"), upto)).over(w))
    above, tail = F.when(at > F.col("q3"), (upto - F.col("body")) * 4), total - F.col("body")
    return rows.groupBy(*group).agg(
        F.max("total").alias("total"), F.max("q1").alias("q1"), F.max("q3").alias("q3"),
        F.min(F.when(above >= tail, at)).alias("t1"), F.min(F.when(above >= tail * 3, at)).alias("t3"),
    )


def thresholds(sketches: DataFrame) -> DataFrame:
    """``lang, source`` and, for every measure, the bounds ``<measure>_low`` and ``<measure>_high``; one row per group."""
    marks = ["q1", "q3", "t1", "t3"]
    levels = [quartiles(sketches, keys) for keys in (["lang", "source"], ["lang"], [])]
    found = levels[0].withColumnsRenamed({"total": "_total0"} | {m: f"_{m}0" for m in marks})
    for i, keys in ((1, ["lang"]), (2, [])):
        wider = levels[i].withColumnsRenamed({c: f"_k_{c}" for c in [*keys, "measure"]} | {"total": f"_total{i}"} | {m: f"_{m}{i}" for m in marks})
        on = found["measure"] == wider["_k_measure"]
        for k in keys:
            on &= found[k].eqNullSafe(wider[f"_k_{k}"])
        found = found.join(wider, on).drop("_k_measure", *[f"_k_{k}" for k in keys])

    def pick(mark: str) -> Column:
        return F.when(F.col("_total0") >= MIN_GROUP, F.col(f"_{mark}0")).when(F.col("_total1") >= MIN_GROUP, F.col(f"_{mark}1")).otherwise(F.col(f"_{mark}2"))

    found = found.select("lang", "source", "measure", *[pick(m).alias(m) for m in marks])
    q1, q3, t1, t3 = (F.col(m) for m in marks)
    flat = (q1 == q3) & t3.isNotNull()
    top, spread = F.when(flat, t3).otherwise(q3), F.when(flat, t3 - t1).otherwise(q3 - q1)
    columns = []
    for name, both in MEASURES.items():
        mine = F.col("measure") == name
        columns.append(F.max(F.when(mine, top + F.greatest(FENCE * spread, width(top)))).alias(f"{name}_high"))
        if both:
            columns.append(F.max(F.when(mine, q1 - F.greatest(FENCE * (q3 - q1), width(q1)))).alias(f"{name}_low"))
    return found.groupBy("lang", "source").agg(*columns)


def judge(measures: DataFrame, limits: DataFrame) -> DataFrame:
    """``measures`` with ``base_failed`` and ``kept``; a document without words fails the base rules."""
    limits = limits.withColumnsRenamed({"lang": "_lang", "source": "_source"})
    on = measures["lang"].eqNullSafe(limits["_lang"]) & measures["source"].eqNullSafe(limits["_source"])
    inside = F.lit(True)
    for name, value in rates().items():
        inside &= value <= F.col(f"{name}_high")
        if MEASURES[name]:
            inside &= value >= F.col(f"{name}_low")
    joined = measures.join(limits, on, "left")
    return joined.withColumns({"base_failed": base_failed(), "kept": ~base_failed() & F.coalesce(inside, F.lit(True))}).select(
        *measures.columns, "base_failed", "kept"
    )


def quality_rules(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source", row: str | None = None) -> DataFrame:
    """Measures and verdict of every row of ``docs``; the column that ``row`` names is carried along as ``row``.

    Nulls: a null text counts as empty and fails, null languages and sources are groups of their own, a null key stays null.
    Repeated rows count and come out each; values equal to a fence are kept. An empty table gives no rows.
    """
    measures = materialize(measure(docs, key, text, lang, source, row), "quality-measures")
    return judge(measures, materialize(thresholds(sketch(measures)), "quality-limits"))
