"""The corpus pipeline: every stage is one of the operators, its result is written and read again by the next.

All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import near_join, packing, quality_classifier, quality_rules, queries, suffix_dedup
from corpusloom.session import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
ORACLE_SQL = None
#: bytes that a passage must share to be a repeat: fewer than 50 words of running text have, so that a passage of over 50 words is found
REPEAT = 200


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts to be of quality.

    Null and empty texts are scored like others, rows without an id too; of equal rows all stay or all go.
    """
    scores = quality_classifier.quality_scores(_with_row(docs), queries.table(spark, sf_dir, "labels"), row="row")
    return _only(docs, scores.filter("predicted = 1").select("row")).select(*COLUMNS)


def keep_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the adaptive rules keep. A null text has no words, so its row goes; rows without an id are judged like others."""
    return _only(docs, quality_rules.quality_rules(_with_row(docs), row="row").filter("kept").select("row")).select(*COLUMNS)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, that of the least id, of every group of near copies; one without an id only if none has any, and of equal rows one.

    Rows are compared and named by their row keys, so that an id that several texts share joins nothing.
    """
    found = near_join.near_join(_with_row(docs), key="row", row="doc_id").select("class_id", F.col("doc_id").alias("row"), F.col("row").alias("id"))
    first = found.groupBy("class_id").agg(F.min(F.struct(F.col("id").isNull(), "id", "row")).alias("first"))
    return _only(docs, first.select("first.row")).dropDuplicates(["row"]).select(*COLUMNS)


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without byte strings of ``REPEAT`` bytes that occur elsewhere too; of a character that is cut in two both parts go.

    A null text becomes an empty one; a text that is all repeats stays as an empty one. Rows without an id are rows like others. No rows give no rows.
    """
    rows = suffix_dedup.dedup(docs, keep=("lang", "source"), length=REPEAT)
    return rows.select("doc_id", "text", "kept_columns.lang", "kept_columns.source", F.length("text").cast("long").alias("n_chars"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences.

    A null or empty text is a document of one end id. Rows without an id, or that share one, are packed like others. No rows give no rows.
    """
    pieces = packing.token_pieces(docs, queries.vocabulary(), queries.SEQUENCE_TOKENS, queries.END_ID)
    return packing.pack(pieces, queries.SEQUENCE_TOKENS)


STAGES = [
    ("quality_classifier", keep_quality),
    ("quality_rules", keep_rules),
    ("near_join", keep_one_of_near_copies),
    ("suffix_dedup", remove_repeats),
    ("bestfit_packing", pack_sequences),
]


def _row() -> Column:
    """A key of the row from all that decisions depend on; only equal rows share it, and those get equal decisions.

    Hashes skip nulls, so that a column is null is hashed too. Any two of ten million rows share a key by chance with a probability of 0.000003.
    """
    return F.xxhash64(*[x for c in ("doc_id", "text", "lang", "source") for x in (F.col(c).isNull(), F.col(c))])


def _with_row(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS, _row().alias("row"))


def _only(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows, with their keys, whose key is among ``rows``, each row once; rows without an id are rows like others.

    The keys grow with the corpus, so they are not sent to every task, however few there may be.
    """
    return _with_row(docs).join(rows.hint("merge"), "row", "left_semi")


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
