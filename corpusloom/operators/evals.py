"""Evaluation: few-shot prompts, answer spans, scores, outcomes and metrics. Model outputs are input tables."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import answers as an
from corpusloom.functions import text as tx
from corpusloom.functions.det import u
from corpusloom.operators.bpe import MAX_VOCAB
from corpusloom.operators.prefix import number_rows, prefix_sums

ITEM_SEED = 1337  # fixed values: seeds of the item shuffle and of the few-shot draws
FEWSHOT_SEED = 1234


# --- inputs ----------------------------------------------------------------------------------------


def eval_items(items: DataFrame, key: str, max_items: int = -1, seed: int = ITEM_SEED) -> DataFrame:
    """Keys of the items in shuffled order as a dense ``idx``; optionally only the first ones."""
    rows = items.select(key).withColumn("_u", u(seed, key))
    rows = number_rows(rows, ["_u", key], "idx").select(key, (F.col("idx") - 1).alias("idx"))
    return rows.filter(F.col("idx") < max_items) if max_items >= 0 else rows


def task_config(config: DataFrame) -> DataFrame:
    """One row per task; the first few-shot number counts, the delimiter defaults to one blank."""
    return config.select(
        "label",
        F.col("icl_task_type").alias("task_type"),
        "dataset_uri",
        F.element_at("num_fewshot", 1).alias("num_fewshot"),
        F.coalesce("continuation_delimiter", F.lit(" ")).alias("continuation_delimiter"),
    )


def random_baselines(spark: SparkSession, path: str) -> DataFrame:
    """Task and baseline in percent from a CSV file with a header."""
    raw = spark.read.csv(path, header=True)
    return raw.select(F.col("Eval Task").alias("task"), F.col("Random baseline").cast("double").alias("baseline"))


def write_core_results(results: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Task, accuracy and centered accuracy, and a last row with the mean and a blank accuracy."""
    mean = results.agg(F.avg("centered").alias("centered")).select(
        F.lit("CORE").alias("task"), F.lit(None).cast("double").alias("accuracy"), "centered"
    )
    rows = results.select("task", "accuracy", "centered").unionByName(mean)
    number = lambda c: F.format_string("%.6f", F.col(c))
    out = rows.select(
        F.col("task").alias("Task"),
        F.when(F.col("accuracy").isNotNull(), number("accuracy")).otherwise(F.lit("")).alias("Accuracy"),
        number("centered").alias("Centered"),
    )
    out.coalesce(1).write.mode(mode).csv(path, header=True, emptyValue="")  # one row per task


def read_core_results(spark: SparkSession, path: str) -> DataFrame:
    """Blank numbers are null; rows that hold something else are skipped."""
    raw = spark.read.csv(path, header=True, schema="Task string, Accuracy string, Centered string")
    task, acc, cen = (tx.strip(F.coalesce(c, F.lit(""))) for c in ("Task", "Accuracy", "Centered"))
    number = lambda c: c.try_cast("double")
    ok = ((acc == "") | number(acc).isNotNull()) & ((cen == "") | number(cen).isNotNull())
    return raw.filter(ok & (task != "")).select(task.alias("task"), number(acc).alias("accuracy"), number(cen).alias("centered"))


# --- few-shot prompts ------------------------------------------------------------------------------


def fewshot_sample(items: DataFrame, idx: str, k: int, seed: int = FEWSHOT_SEED) -> DataFrame:
    """``k`` distinct other items for every item: its successors in a seeded ring.

    One equi join with k rows per item. Partners of neighbours in the ring overlap.
    """
    n = items.count()
    if k >= n:
        raise ValueError(f"cannot draw {k} partners from {n} items")
    if k <= 0:
        return items.select(idx, F.lit(0).alias("j"), F.lit(0).cast("long").alias("partner")).filter(F.lit(False))
    ring = number_rows(items.select(idx).withColumn("_u", u(seed, idx)), ["_u", idx], "_r")
    rows = ring.select(idx, F.col("_r"), F.explode(F.sequence(F.lit(1), F.lit(k))).alias("j"))
    rows = rows.withColumn("_r", F.pmod(F.col("_r") - 1 + F.col("j"), F.lit(n)) + 1)
    return rows.join(ring.select("_r", F.col(idx).alias("partner")), "_r").select(idx, "j", "partner")


def fewshot_prefix(pairs: DataFrame, items: DataFrame, idx: str, block: Column) -> DataFrame:
    """The text before an item: one block per partner, in order. ``block`` is a column over ``items``."""
    blocks = items.select(F.col(idx).alias("partner"), F.concat(block, F.lit("\n\n")).alias("_block"))
    text = F.array_join(F.array_sort(F.collect_list(F.struct("j", "_block")))["_block"], "")
    return pairs.join(blocks, "partner").groupBy(idx).agg(text.alias("prefix"))  # k rows per item


def mc_block(query: Column, delim: str, choices: Column, gold: Column) -> Column:
    return F.concat(query, F.lit(delim), F.element_at(choices, gold.cast("int") + 1))


def mc_prompts(prefix: Column, query: Column, delim: str, choices: Column) -> Column:
    """One prompt per choice."""
    return F.transform(choices, lambda c: F.concat(prefix, query, F.lit(delim), c))


def schema_prompts(prefix: Column, contexts: Column, delim: str, continuation: Column) -> Column:
    """One prompt per context."""
    return F.transform(contexts, lambda c: F.concat(prefix, c, F.lit(delim), continuation))


def lm_block(context: Column, delim: str, continuation: Column) -> Column:
    return F.concat(tx.strip(context), F.lit(delim), continuation)


def lm_prompts(prefix: Column, context: Column, delim: str, continuation: Column) -> Column:
    """The prompt without and with the continuation; only the first is stripped."""
    head = F.concat(prefix, tx.strip(context), F.lit(delim))
    return F.array(tx.strip(head), F.concat(head, continuation))


# --- spans -----------------------------------------------------------------------------------------


def option_ids(tok, prompts: Column) -> Column:
    """Token ids of every prompt with the document start in front."""
    bos = F.array(F.lit(tok.special(tx.BOS)))
    return F.transform(tok.encode_each(prompts), lambda ids: F.concat(bos, ids))


def with_common_length(items: DataFrame, options: str, suffix: bool = False, out: str = "common") -> DataFrame:
    """Length of the common prefix (or suffix) of the id lists of every item.

    All lists are compared with the first one; each step is a column of its own and worked out once.
    """
    seqs = F.transform(options, lambda o: F.reverse(o)) if suffix else F.col(options)
    rows = items.withColumn("_seqs", seqs).withColumn("_m", F.array_min(F.transform("_seqs", lambda o: F.size(o))))
    rows = rows.withColumn("_head", F.slice(F.element_at("_seqs", 1), 1, F.col("_m")))
    differs = lambda o: F.zip_with("_head", F.slice(o, 1, F.col("_m")), lambda a, b: a != b)
    rows = rows.withColumn("_at", F.transform("_seqs", lambda o: F.array_position(differs(o), True)))
    first = F.array_min(F.filter("_at", lambda p: p > 0))  # null when no list differs
    return rows.withColumn(out, F.coalesce(first - 1, F.col("_m")).cast("int")).drop("_seqs", "_m", "_head", "_at")


def with_spans(items: DataFrame, kind: str, options: str = "options") -> DataFrame:
    """Add ``spans``, ``array<struct<ids, start, end>>`` of the answer in every option.

    ``multiple_choice``: behind the common prefix. ``schema``: the common suffix. ``language_modeling``: what the
    second list adds to the first, which must be a proper prefix; the only row is the second list.
    """
    span = lambda o, s, e: F.struct(o.alias("ids"), s.cast("int").alias("start"), e.cast("int").alias("end"))
    n = F.col("_n")
    if kind == "multiple_choice":
        rows = with_common_length(items, options, out="_n")
        return rows.withColumn("spans", F.transform(options, lambda o: span(o, n, F.size(o)))).drop("_n")
    if kind == "schema":
        rows = with_common_length(items, options, suffix=True, out="_n")
        return rows.withColumn("spans", F.transform(options, lambda o: span(o, F.size(o) - n, F.size(o)))).drop("_n")
    if kind != "language_modeling":
        raise ValueError(f"unknown task type {kind!r}")
    without, whole = F.element_at(options, 1), F.element_at(options, 2)
    start = F.size(without)
    proper = (start < F.size(whole)) & (F.slice(whole, 1, start) == without)
    return items.withColumn(
        "spans",
        F.when(proper, F.array(span(whole, start, F.size(whole)))).otherwise(
            F.raise_error(F.lit("the prompt without continuation must be a proper prefix of the prompt with it"))
        ),
    )


def explode_spans(items: DataFrame, keys: list[str], spans_column: str = "spans") -> DataFrame:
    rows = items.select(*keys, F.posexplode_outer(spans_column).alias("option_idx", "_s")).filter("_s IS NOT NULL")
    return rows.select(*keys, "option_idx", "_s.ids", F.col("_s.start").alias("start_idx"), F.col("_s.end").alias("end_idx"))


def left_truncate(rows: DataFrame, max_len: int) -> DataFrame:
    """Keep the last ``max_len`` ids and move the span; a span that would start before 0 is an error."""
    crop = F.greatest(F.size("ids") - max_len, F.lit(0))
    ok = (F.col("start_idx") - crop >= 0) & (F.col("end_idx") - crop >= 0)
    start = F.when(ok, F.col("start_idx") - crop).otherwise(
        F.raise_error(F.lit("the answer was cropped away")).cast("int")
    )
    return rows.select(
        *[c for c in rows.columns if c not in ("ids", "start_idx", "end_idx")],
        F.slice("ids", crop + 1, F.size("ids")).alias("ids"),
        start.alias("start_idx"),
        (F.col("end_idx") - crop).alias("end_idx"),
    )


def span_scores(rows: DataFrame, scores: DataFrame, keys: list[str]) -> DataFrame:
    """Mean loss of every answer span and whether all its ids were predicted.

    Position p of ``scores`` (keys, pos, loss, pred_id) predicts id p + 1, so a span [s, e) reads [s - 1, e - 1).
    """
    checked = _span_end() - 1
    at = rows.select(*keys, "ids", F.explode(F.sequence(F.col("start_idx") - 1, checked - 1)).alias("pos"))
    at = at.select(*keys, "pos", F.element_at("ids", F.col("pos") + 2).alias("actual"))
    hit = at.join(scores, [*keys, "pos"])
    return hit.groupBy(*keys).agg(
        F.avg("loss").alias("mean_loss"), F.bool_and(F.col("pred_id") == F.col("actual")).alias("all_predicted")
    )


def _span_end() -> Column:
    return F.when(F.col("end_idx") > F.col("start_idx"), F.col("end_idx")).otherwise(F.raise_error(F.lit("empty answer span")).cast("int"))


def array_span_scores(rows: DataFrame, scores: DataFrame, keys: list[str]) -> DataFrame:
    """As :func:`span_scores`, for scores held as one row of an option with the arrays ``losses`` and ``pred_ids`` over all positions.

    Spans are slices of these arrays, so nothing is exploded, and the join has one row per option on either side.
    """
    n = _span_end() - F.col("start_idx")
    both = rows.select(*keys, "ids", "start_idx", "end_idx").join(scores.select(*keys, "losses", "pred_ids"), keys)
    losses, pred = F.slice("losses", F.col("start_idx"), n), F.slice("pred_ids", F.col("start_idx"), n)
    actual = F.slice("ids", F.col("start_idx") + 1, n)
    # a span that the scores do not cover has no mean
    whole = F.size("losses") >= F.col("end_idx") - 1
    mean = F.aggregate(losses, F.lit(0.0), lambda a, x: a + x) / n
    hits = F.forall(F.arrays_zip(pred.alias("a"), actual.alias("b")), lambda z: z["a"] == z["b"])
    return both.select(*keys, F.when(whole, mean).alias("mean_loss"), F.when(whole, hits).alias("all_predicted"))


def best_option(losses: DataFrame, item: list[str], keep: list[str] | None = None) -> DataFrame:
    """Option with the lowest mean loss, ties to the lowest index; ``keep`` names more columns of that row."""
    columns = ["option_idx", *(keep or [])]
    best = losses.groupBy(*item).agg(F.min(F.struct("mean_loss", *columns)).alias("_b"))
    return best.select(*item, *[F.col(f"_b.{c}").alias(c) for c in columns])


def best_letter(scores: DataFrame, problems: DataFrame, key: str) -> DataFrame:
    """Letter with the highest score among the letters of the problem, ties to the first letter."""
    # problems grow with the table: they meet their scores before anything is exploded or sorted, and go to no other task
    hit = scores.join(problems.select(key, "letters").hint("merge"), key)
    hit = hit.withColumn("_pos", F.array_position("letters", F.col("letter"))).filter("_pos > 0")
    best = hit.groupBy(key).agg(F.min(F.struct((-F.col("score")).alias("s"), F.col("_pos"), F.col("letter"))).alias("_b"))
    return best.select(key, F.col("_b.letter").alias("letter"))


# --- metrics ---------------------------------------------------------------------------------------


def task_accuracy(outcomes: DataFrame, by: str = "task", ok: str = "is_correct") -> DataFrame:
    return outcomes.groupBy(by).agg(F.avg(F.col(ok).cast("double")).alias("accuracy"))


def center(accuracy: Column, baseline: Column) -> Column:
    return (accuracy - baseline) / (1.0 - baseline)


def baseline_join(accuracy: DataFrame, baselines: DataFrame, key: str = "task") -> DataFrame:
    """Every task needs a baseline; a missing one is an error before any metric is made."""
    missing = accuracy.join(baselines, key, "left_anti").select(key).limit(5).collect()
    if missing:
        raise KeyError(f"tasks without a baseline: {[r[0] for r in missing]}")
    return accuracy.join(baselines, key)


def chat_baseline_join(accuracy: DataFrame, baselines: DataFrame, key: str = "task") -> DataFrame:
    """A task without a baseline gets 0."""
    return accuracy.join(baselines, key, "left").withColumn("baseline", F.coalesce("baseline", F.lit(0.0)))


def core_results(accuracy: DataFrame, baselines: DataFrame) -> DataFrame:
    """Centered accuracy per task; baselines are percentages."""
    return baseline_join(accuracy, baselines).withColumn("centered", center(F.col("accuracy"), F.col("baseline") * 0.01))


def core_metric(results: DataFrame) -> DataFrame:
    return results.agg(F.avg("centered").alias("core"))


def chatcore_metric(accuracy: DataFrame, baselines: DataFrame, tasks: list[str]) -> DataFrame:
    """Mean centered accuracy (fractional baselines); no row unless all ``tasks`` are there."""
    rows = chat_baseline_join(accuracy.filter(F.col("task").isin(tasks)), baselines)
    rows = rows.withColumn("centered", center(F.col("accuracy"), F.col("baseline")))
    return rows.agg(F.avg("centered").alias("chatcore"), F.countDistinct("task").alias("_n")).filter(
        F.col("_n") == len(tasks)
    ).drop("_n")


def gather_token_bytes(targets: DataFrame, vocab: DataFrame, target: str = "target_id") -> DataFrame:
    """Byte length of every target; ignored targets (below 0) have none."""
    if vocab.count() > MAX_VOCAB:
        raise ValueError("not a vocabulary")
    sizes = F.broadcast(vocab.select(F.col("token_id").alias(target), "n_bytes"))
    return targets.join(sizes, target, "left").withColumn("n_bytes", F.coalesce("n_bytes", F.lit(0)))


def bits_per_byte(losses: DataFrame, by: str) -> DataFrame:
    """Loss in bits per byte of text; targets without bytes count in neither sum; no bytes give infinity."""
    counted = F.col("n_bytes") > 0
    sums = losses.groupBy(by).agg(
        F.coalesce(F.sum(F.when(counted, F.col("loss"))), F.lit(0.0)).alias("nats"), F.sum("n_bytes").alias("n_bytes")
    )
    bpb = F.when(F.col("n_bytes") > 0, F.try_divide(F.col("nats"), F.col("n_bytes") * math.log(2)))
    return sums.select(by, "n_bytes", F.coalesce(bpb, F.lit(float("inf"))).alias("bpb"))


def validation_loss(losses: DataFrame, batch: str, steps: int, loss: str = "loss") -> DataFrame:
    """Mean of the mean losses of batches 0..steps-1."""
    means = losses.filter(F.col(batch) < steps).groupBy(batch).agg(F.avg(loss).alias("_m"))
    return means.agg(F.avg("_m").alias("val_loss"), F.count(F.lit(1)).alias("n_batches"))


def passed_items(outcomes: DataFrame, item: str, ok: str = "is_correct") -> DataFrame:
    return outcomes.groupBy(item).agg(F.bool_or(ok).alias("passed"))


def pass_at_any(outcomes: DataFrame, item: str, ok: str = "is_correct") -> DataFrame:
    p = passed_items(outcomes, item, ok)
    return p.agg(
        F.count_if("passed").alias("n_passed"), F.count(F.lit(1)).alias("n_items"),
        F.avg(F.col("passed").cast("double")).alias("pass_rate"),
    )


def pass_at_k(outcomes: DataFrame, item: str, sample: str, n: int, ok: str = "is_correct") -> DataFrame:
    """For k = 1..n the share of items with a success among their first k samples (samples count from 0)."""
    first = outcomes.groupBy(item).agg(F.min(F.when(F.col(ok), F.col(sample))).alias("_first"))
    hit = lambda k: F.coalesce(F.col("_first") < k, F.lit(False)).cast("double")
    shares = first.agg(*[F.avg(hit(k)).alias(f"k{k}") for k in range(1, n + 1)])
    return shares.select(
        F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"k{k}").alias("pass_rate")) for k in range(1, n + 1)])).alias("_r")
    ).select("_r.*")


def running_pass_rate(passed: DataFrame, order: str) -> DataFrame:
    """Passed and total after each problem."""
    runs = prefix_sums(passed, [order], {"n_passed": F.col("passed").cast("long"), "n_total": F.lit(1)})
    return runs.select(order, "n_passed", F.col("n_total").cast("long").alias("n_total"),
                       (F.col("n_passed") / F.col("n_total")).alias("pass_rate"))


def group_advantage(rewards: DataFrame, item: str, reward: str = "reward") -> DataFrame:
    """Reward minus the mean reward of the same example."""
    # one mean per example: their number grows with the table, so they are not sent to every task
    means = rewards.groupBy(item).agg(F.avg(reward).alias("_mean")).hint("merge")
    return rewards.join(means, item).withColumn("advantage", F.col(reward) - F.col("_mean")).drop("_mean")


def reward_summary(rewards: DataFrame, item: str, reward: str, length: str) -> DataFrame:
    """Mean reward over examples (of their mean rewards) and mean sequence length."""
    per = rewards.groupBy(item).agg(F.avg(reward).alias("_r"), F.sum(length).alias("_n"), F.count(F.lit(1)).alias("_c"))
    return per.agg(
        F.avg("_r").alias("mean_reward"), (F.sum("_n") / F.sum("_c")).alias("mean_length"), F.count(F.lit(1)).alias("n_items")
    )


# --- pluggable evaluators --------------------------------------------------------------------------

EVALUATORS: dict[str, Callable[..., Column]] = {
    "generative": lambda predicted, reference, letters=None: an.answer_correct(predicted, reference),
    "categorical": lambda predicted, reference, letters: an.letter_correct(letters, predicted, reference),
}


def evaluate(kind: str, predicted: Column, reference: Column, letters: Column | None = None) -> Column:
    """Correctness column of the registered evaluator; users add their own to ``EVALUATORS``."""
    if kind not in EVALUATORS:
        raise ValueError(f"unknown evaluator {kind!r}")
    return EVALUATORS[kind](predicted, reference, letters)
