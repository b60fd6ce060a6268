"""One query per operator, over its whole table, and the SQL of those that SQL can state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.det import draw_index
from corpusloom.llm import (
    bpe, license_scan, line_dedup, near_join, oracle, packing, prefix_trie, quality_classifier, quality_rules, suffix_dedup, token_counts, topk_search, url_filters, vector_codes,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

SEQUENCE_TOKENS = 4096
#: the id that ends a document, a plain token of the vocabulary
END_ID = 1
#: characters of a document per edit
EDIT_EVERY = 2000
TOP = 10
#: conversations of a family, whose first one lends the others up to ``LENT`` - 1 turns
FAMILY = 20
LENT = 4
#: days that captures and list entries are spread over
DAYS = 366


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary() -> str:
    """The place of the public tokenizer file, the same on every machine that has it."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def list_entries(pages: DataFrame) -> DataFrame:
    """Dated entries that every page gives rise to: its domain, or one above it, and its path, or a folder of it, added or removed on a drawn day."""
    h = url_filters.host(F.col("url"))
    found = [
        (url_filters.DOMAIN, url_filters.domain_rules(h)),
        (url_filters.PREFIX, url_filters.prefix_rules(h, url_filters.path(F.col("url")))),
    ]
    parts = []
    for kind, rules in found:
        pick = F.get(rules, draw_index(F.size(rules), f"{kind}-rule", "page_id").cast("int"))
        day, added = draw_index(DAYS, f"{kind}-day", "page_id").cast("int"), draw_index(2, f"{kind}-added", "page_id") == 0
        parts.append(F.struct(F.lit(f"{kind}s").alias("list"), F.lit(kind).alias("kind"), pick.alias("rule"), day.alias("day"), added.alias("added")))
    return pages.select(F.inline(F.array(*parts)))


@query("op1_url_filters", oracle.url_filter_sql(DAYS))
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    captures = pages.withColumn("day", draw_index(DAYS, "fetched", "page_id").cast("int"))
    return url_filters.filter_urls(captures, list_entries(pages))


@query("op2_suffix_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = suffix_dedup.dedup(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
        "text", "spans",
    )


@query("op3_quality_rules", oracle.quality_rules_sql())
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.quality_rules(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op4_bpe_round_trip")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode(table(spark, sf_dir, "documents"), vocabulary(), decoded=True)
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op5_near_join", oracle.near_join_sql())
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_join.near_join(table(spark, sf_dir, "documents"))


@query("op6_license_scan")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = license_scan.scan(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score")


@query("op7_exact_top_k", oracle.top_k_sql(TOP))
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, TOP)


def with_edits(docs: DataFrame) -> DataFrame:
    """``docs`` with an edit per ``EDIT_EVERY`` characters and one more: places and sizes from hashes, added text from the document."""
    text, k = F.coalesce(F.col("text"), F.lit("")), F.col("doc_id")
    size = F.length(text)

    def edit(i):
        at = F.pmod(F.xxhash64(k, i), size + 1)
        removed = F.pmod(F.xxhash64(k, i, F.lit(1)), F.lit(3)) * F.pmod(F.xxhash64(k, i, F.lit(2)), F.lit(40))
        start = F.pmod(F.xxhash64(k, i, F.lit(3)), size + 1)
        added = F.substring(text, (start + 1).cast("int"), F.pmod(F.xxhash64(k, i, F.lit(4)), F.lit(60)).cast("int"))
        return F.struct(at.alias("at"), removed.alias("removed"), added.alias("added"))

    edits = F.transform(F.sequence(F.lit(0), F.floor(size / EDIT_EVERY).cast("int")), edit)
    return docs.select("doc_id", "text", edits.alias("edits"))


@query("op8_edited_token_counts")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(with_edits(table(spark, sf_dir, "documents")), vocabulary())


@query("op9_quality_classifier")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op10_bestfit_islands")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(table(spark, sf_dir, "documents"), vocabulary(), SEQUENCE_TOKENS, END_ID)
    return packing.pack(pieces, SEQUENCE_TOKENS)


@query("op11_vector_codes", oracle.vector_codes_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    return rows.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def rebuilt(turns: DataFrame) -> DataFrame:
    """Conversations of :func:`prefix_trie.conversation_turns` that start with the first turns of the first one of their family."""
    own = turns.withColumn("head", F.col("conv_id") - F.col("conv_id") % FAMILY).withColumn("h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % LENT).cast("int"))
    heads = turns.filter(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("head"), F.slice("turns", 1, LENT - 1).alias("lent"))
    lent = F.slice(F.coalesce("lent", F.slice("turns", 1, 0)), F.lit(1), F.col("h"))
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    # the heads grow with the table, so they are not sent to every task
    return own.join(heads.hint("merge"), "head", "left").select("conv_id", F.concat(lent, rest).alias("turns"))


@query("op12_prefix_trie", oracle.prefix_trie_sql(FAMILY, LENT))
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(rebuilt(prefix_trie.conversation_turns(table(spark, sf_dir, "conversations"))))


@query("op13_line_dedup", oracle.line_dedup_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))
