"""Removal of lines that many documents share.

Lines are exploded and normalised to keys; the 128-bit hashes of the keys are counted, first per document and then per hash, so that a very
common line is summed inside the tasks before it is shuffled. Hashes over the threshold meet the lines again, which tells the places to
drop, and every text is put together from what lies between them. DataFrame functions only.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import hash128, join_by_share
from corpusloom.session import materialize

#: code points of a key and documents that hold it, from which on it counts
MIN_CHARS = 20
MIN_DOCS = 3
WHITE = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A to Z in lower case."""
    return F.btrim(F.translate(line, string.ascii_uppercase, string.ascii_lowercase), F.lit(WHITE))


def without_places(text: Column, places: Column) -> Column:
    """The lines of ``text`` but those at the sorted ``places``, joined again; the work is linear in the text."""

    def rest(lines: Column) -> Column:
        def between(i: Column) -> Column:
            start = F.when(i == 0, 0).otherwise(F.get(places, i - 1) + 1)
            stop = F.when(i == F.size(places), F.size(lines)).otherwise(F.get(places, i))
            return F.slice(lines, start + 1, stop - start)

        return F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), F.size(places)), between)), "\n")

    # an array of one element binds the lines, so that the text is split once
    return F.get(F.transform(F.array(F.split(text, "\n", -1)), rest), 0)


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc_id, n_lines, n_dropped, dropped, kept`` of every row of ``docs``.

    Keys of ``min_chars`` code points or more that ``min_docs`` documents or more hold lose all their lines but those of the largest id among these.
    ``dropped`` holds the places of the lines that go, from 0 (null: none), ``kept`` the others. A null or empty text is one empty line.
    Rows that share an id are one document; so are all rows without an id, and any id is larger than none. Repeated rows get the same
    result each. No rows give no rows.
    """
    texts = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    row = hash128("doc_id", "text")
    rows = texts.select("doc_id", "text", row[0].alias("r1"), row[1].alias("r2"))
    lines = rows.select("doc_id", "r1", "r2", F.posexplode(F.split("text", "\n", -1)).alias("place", "line"))
    lines = lines.withColumn("line", line_key(F.col("line"))).filter(F.length("line") >= min_chars)
    h = hash128("line")
    lines = materialize(lines.select("doc_id", "r1", "r2", "place", h[0].alias("h1"), h[1].alias("h2")), "lines")
    holders = lines.groupBy("h1", "h2", "doc_id").agg(F.count("*").alias("n"))
    counts = holders.groupBy("h1", "h2").agg(F.count("*").alias("docs"), F.sum("n").alias("n"), F.max("doc_id").alias("keeper"))
    counts = materialize(counts.filter(F.col("docs") >= min_docs).drop("docs"), "lines-shared")
    gone = join_by_share(lines, counts, ["h1", "h2"], "n").filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    gone = gone.groupBy("r1", "r2").agg(F.sort_array(F.collect_set("place")).alias("dropped"))
    rows = rows.join(gone.hint("merge"), ["r1", "r2"], "left")
    return rows.select(
        "doc_id",
        F.size(F.split("text", "\n", -1)).cast("long").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        "dropped",
        F.when(F.col("dropped").isNull(), F.col("text")).otherwise(without_places(F.col("text"), F.col("dropped"))).alias("kept"),
    )
