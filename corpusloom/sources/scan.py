"""Reading and writing corpus shards, conversations and small tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.text import strip
from corpusloom.operators.prefix import number_rows

MAX_SHARD = 1822  # fixed value: last shard number of the published English corpus

MESSAGES = "array<struct<role:string,content:variant>>"


def read_shards(spark: SparkSession, path: str, schema: T.StructType | str = "text string") -> DataFrame:
    """Parquet shards with the file name and the row position in the file; unfinished files are ignored."""
    try:
        df = spark.read.schema(schema).option("pathGlobFilter", "*.parquet").parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        empty = spark.createDataFrame([], spark.createDataFrame([], schema).schema)
        return empty.withColumns({"shard": F.lit(""), "row_index": F.lit(0).cast("long")})
    return df.select(
        "*",
        F.element_at(F.split("_metadata.file_path", "/"), -1).alias("shard"),
        F.col("_metadata.row_index").alias("row_index"),
    )


def spread(df: DataFrame, key: str, task_bytes: int | None = None) -> DataFrame:
    """Deal the rows of a table with fewer files than cores to all cores, for work that is heavy per row.

    A table with as many files as cores is already spread and is returned as it is, without a shuffle.
    With ``task_bytes`` rows always go by ``key`` to as many tasks as the table has so many bytes in its files: a task does not grow with the table,
    in however few or many files it is, and tables dealt by one key to as many tasks join there.
    """
    files = df.inputFiles()
    tasks = df.sparkSession.sparkContext.defaultParallelism
    if task_bytes:
        return df.repartition(max(tasks, -(-_file_bytes(df.sparkSession, files) // task_bytes)), key)
    return df.repartition(tasks, key) if len(files) < tasks else df


def _file_bytes(spark: SparkSession, files: list[str]) -> int:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    paths = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f)) for f in files]
    return sum(p.getFileSystem(conf).getFileStatus(p).getLen() for p in paths)


def shard_inventory(docs: DataFrame, shard: str = "shard", text: str = "text") -> DataFrame:
    """Rows and characters per shard."""
    return docs.groupBy(F.col(shard).alias("shard")).agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(F.length(text)).alias("n_chars")
    )


def split_train_val(docs: DataFrame, split: str, shard: str = "shard") -> DataFrame:
    """``val`` is the lexicographically last shard, ``train`` everything before it.

    The last shard name is looked up first, so the predicate is a literal that prunes files and row groups.
    """
    if split not in ("train", "val"):
        raise ValueError("split must be 'train' or 'val'")
    last = docs.agg(F.max(shard)).first()[0]
    if last is None:
        return docs
    return docs.filter(F.col(shard) == last if split == "val" else F.col(shard) < last)


def rank_stride(
    docs: DataFrame, workers: int, group_rows: int = 1024, shard: str = "shard", order: str = "row_index"
) -> DataFrame:
    """Worker of every row: row groups are dealt round robin and dealing restarts in each shard.

    Files read with :func:`read_shards` carry their position and need no shuffle. Other tables are
    numbered inside the shard along ``order``.
    """
    if order == "row_index":
        pos = F.col("row_index")
    else:
        narrow = number_rows(docs.select(shard, order), [order], "_rn", [shard])
        docs, pos = narrow, F.col("_rn") - 1
    group = F.floor(pos / group_rows).cast("long")
    return docs.withColumn("row_group", group).withColumn("worker", F.pmod("row_group", F.lit(workers)))


def missing_shards(spark: SparkSession, present: DataFrame, n: int = MAX_SHARD + 1, shard_id: str = "shard_id") -> DataFrame:
    """Shard numbers below ``n`` that are not on disk; by default those of the published corpus."""
    wanted = spark.range(n).withColumnRenamed("id", shard_id)
    return wanted.join(present.select(F.col(shard_id).cast("long")).distinct(), shard_id, "left_anti")


def guarded_overwrite(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """Write zstd parquet; a target that holds parquet files is refused unless ``overwrite``."""
    if not overwrite and holds_parquet(df.sparkSession, path):
        raise FileExistsError(f"{path} already exists and holds parquet files")
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)


def holds_parquet(spark: SparkSession, path: str) -> bool:
    """Are there parquet files in the folder? Looked up through Spark's file systems, so any store will do."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(files.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target, "*.parquet")))


def pick_text_column(df: DataFrame) -> DataFrame:
    """Alias the text column: ``text`` if present, else the first string column, else a ``text`` of nulls."""
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if "text" in df.columns:
        return df
    return df.withColumnRenamed(strings[0], "text") if strings else df.withColumn("text", F.lit(None).cast("string"))


# --- conversations as JSON lines -------------------------------------------------------------------


def parse_message_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """Blank lines dropped, every other line parsed as a JSON array of messages (null when it is not).

    ``messages`` has role, content as text, and whether the content was a JSON string.
    """
    text = strip(line)
    parsed = lines.filter(text != "").withColumn("_m", F.from_json(text, MESSAGES, {"mode": "PERMISSIVE"}))

    def message(x: Column) -> Column:
        content = x["content"]
        return F.struct(
            x["role"].alias("role"),
            F.try_variant_get(content, "$", "string").alias("content"),
            F.coalesce(F.schema_of_variant(content) == "STRING", F.lit(False)).alias("is_text"),
        )

    return parsed.withColumn("messages", F.when(text.startswith("["), F.transform("_m", message))).drop("_m")


def file_states(spark: SparkSession, path: str) -> tuple:
    """Name, size and time of every file under a path: equal as long as the data is."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(target, True)
    states = []
    while found.hasNext():
        f = found.next()
        states.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(states))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of text files as ``value``; a path where nothing is counts as empty."""
    try:
        return spark.read.text(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "value string")


def read_conversations(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """Conversations of JSON-lines files: the strict form fails on the first bad line, the lenient one drops lines that are no lists."""
    lines = read_lines(spark, path)
    return conversations_strict(lines) if strict else conversations_lenient(lines)


def message_violations(messages: str = "messages") -> Column:
    """Names of the failed checks, in a fixed order; empty when the messages are sound."""
    m = F.col(messages)
    n = F.size(m)
    at = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    expected = lambda i: F.when(i % 2 == 0, F.lit("user")).otherwise(F.lit("assistant"))
    role = lambda i: F.get(m, i)["role"]
    checks = [
        ("not_a_list", m.isNull()),
        ("too_few_messages", m.isNotNull() & (n < 2)),
        ("missing_role", F.exists(m, lambda x: x["role"].isNull())),
        ("missing_content", F.exists(m, lambda x: x["content"].isNull())),
        ("content_not_text", F.exists(m, lambda x: x["content"].isNotNull() & ~x["is_text"])),
        ("wrong_role_order", F.exists(at, lambda i: role(i).isNotNull() & (role(i) != expected(i)))),
    ]
    return F.filter(F.array(*[F.when(c, F.lit(name)) for name, c in checks]), lambda x: x.isNotNull())


def conversations_strict(lines: DataFrame, line: str = "value", strict: bool = True) -> DataFrame:
    """Sound conversations only. ``strict`` fails the job on the first violation, else rows are dropped."""
    parsed = parse_message_lines(lines, line).withColumn("violations", message_violations())
    if strict:
        ok = F.when(F.size("violations") == 0, F.lit(True)).otherwise(
            F.raise_error(F.concat(F.lit("bad conversation: "), F.array_join("violations", ","))).cast("boolean")
        )
        return parsed.filter(ok).drop("violations")
    return parsed.filter(F.size("violations") == 0).drop("violations")


def conversations_lenient(lines: DataFrame, line: str = "value") -> DataFrame:
    """Lines that are not JSON arrays or have fewer than two messages are dropped; roles are not checked."""
    return parse_message_lines(lines, line).filter(F.size("messages") >= 2)


def message_line(messages: str = "messages") -> Column:
    """One JSON array per conversation; non-ASCII characters are kept."""
    return F.to_json(F.transform(messages, lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))))


def write_jsonl(df: DataFrame, path: str, messages: str = "messages", mode: str = "errorifexists") -> None:
    df.select(message_line(messages).alias("value")).write.mode(mode).text(path)


def word_list(lines: DataFrame, line: str = "value") -> DataFrame:
    """One stripped word per line."""
    return lines.select(strip(line).alias("word"))
