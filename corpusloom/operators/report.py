"""Report sections of many runs: metrics, duration and the summary table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import strip

# fixed values: section files in report order, the stage that each metric section reports, and its keys
SECTIONS = [
    "tokenizer-training.md",
    "tokenizer-evaluation.md",
    "base-model-training.md",
    "base-model-loss.md",
    "base-model-evaluation.md",
    "midtraining.md",
    "chat-evaluation-mid.md",
    "chat-sft.md",
    "chat-evaluation-sft.md",
    "chat-rl.md",
    "chat-evaluation-rl.md",
]
CHAT_METRICS = ["ARC-Easy", "ARC-Challenge", "MMLU", "GSM8K", "HumanEval", "ChatCORE"]
STAGES = {
    "base-model-evaluation.md": ("base", ["CORE"]),
    "chat-evaluation-mid.md": ("mid", CHAT_METRICS),
    "chat-evaluation-sft.md": ("sft", CHAT_METRICS),
    "chat-evaluation-rl.md": ("rl", ["GSM8K"]),
}
HEADER = "header.md"


def report_sections(files: DataFrame, run: str) -> DataFrame:
    """Every run's section files in report order; a missing one has a null text.

    ``files`` has (run, file, text), for example from whole-text reading.
    """
    order = F.posexplode(F.array(*[F.lit(s) for s in SECTIONS])).alias("section_order", "file")
    wanted = files.select(run).distinct().select(run, order)
    return wanted.join(files, [run, "file"], "left")


def report_lines(files: DataFrame, run: str) -> DataFrame:
    return files.select(run, "file", F.posexplode_outer(F.split("text", "\n")).alias("line_no", "line"))


def report_extract(lines: DataFrame, run: str) -> DataFrame:
    """Metrics of the stages: for every line that contains a key the text between its first two colons.

    The last such line wins. ``CORE`` is also found in ``ChatCORE``.
    """
    stage, keys = F.lit(None).cast("string"), F.array().cast("array<string>")
    for file, (name, wanted) in STAGES.items():
        stage = F.when(F.col("file") == file, F.lit(name)).otherwise(stage)
        keys = F.when(F.col("file") == file, F.array(*[F.lit(k) for k in wanted])).otherwise(keys)
    held = lines.filter(F.col("file").isin(list(STAGES))).select(
        run, "line_no", "line", stage.alias("stage"), F.explode(keys).alias("metric")
    )
    held = held.filter(F.contains("line", "metric"))
    value = strip(F.get(F.split("line", ":"), F.lit(1)))
    last = F.max(F.struct("line_no", value.alias("v")))["v"]
    return held.groupBy(run, "stage", "metric").agg(last.alias("value"))


def metric_order(metric: Column) -> Column:
    """CORE first, ChatCORE last, the others by name."""
    return F.when(metric == "CORE", 0).when(metric == "ChatCORE", 2).otherwise(1)


def metrics_pivot(metrics: DataFrame, run: str) -> DataFrame:
    """One row per metric with a column per stage, ``-`` where a stage has none; sort by (ord, metric)."""
    stages = [name for name, _ in STAGES.values()]
    cell = lambda s: F.coalesce(F.max(F.when(F.col("stage") == s, F.col("value"))), F.lit("-")).alias(s)
    table = metrics.groupBy(run, "metric").agg(*[cell(s) for s in stages])
    return table.withColumn("ord", metric_order(F.col("metric")))


def metric_names(metrics: DataFrame, run: str) -> DataFrame:
    return metrics.select(run, "metric").distinct()


def _stamp(line: Column) -> Column:
    text = strip(F.regexp_replace(line, "^[^:]*:", ""))
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss"))


def report_duration(files: DataFrame, run: str) -> DataFrame:
    """``XhYm`` between the header's start and the stamp of the last section that is there, RL sections aside."""
    lines = report_lines(files, run)
    order = F.array_position(F.array(*[F.lit(s) for s in SECTIONS]), F.col("file"))
    prefix = F.when(F.col("file") == HEADER, F.lit("Run started:")).otherwise(F.lit("timestamp:"))
    marked = F.startswith("line", prefix)
    # the first line of a file that carries a readable stamp
    stamp = F.min(F.when(marked & _stamp(F.col("line")).isNotNull(), F.struct("line_no", _stamp(F.col("line")).alias("v"))))["v"]
    per_file = lines.groupBy(run, "file").agg(stamp.alias("stamp"))
    counts = ~F.contains("file", F.lit("rl")) & (order > 0)
    ends = per_file.groupBy(run).agg(
        F.max(F.when(F.col("file") == HEADER, F.col("stamp"))).alias("start"),
        F.max(F.when(counts, F.struct(order.alias("o"), "stamp")))["stamp"].alias("end"),
    )
    seconds = F.unix_timestamp("end") - F.unix_timestamp("start")
    text = F.concat(F.floor(seconds / 3600).cast("string"), F.lit("h"), F.floor(F.pmod(seconds, F.lit(3600)) / 60).cast("string"), F.lit("m"))
    return ends.select(run, F.coalesce(text, F.lit("unknown")).alias("duration"))
