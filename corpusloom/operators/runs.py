"""Training runs: logs to tables, step metrics, and scaling fits. Many runs per table, keyed by run."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.operators.prefix import prefix_sums

RUNS_SCHEMA = (
    "flops_budget double, depth int, model_dim int, num_params long, num_scaling_params long, num_iterations long, "
    "tokens_trained long, param_data_ratio double, val_bpb double, core_score double, train_time_sec long"
)
TOKENS_PER_ITERATION = 524_288  # fixed values of the sweep
DIM_PER_DEPTH = 64


# --- tables ----------------------------------------------------------------------------------------


def append_runs(runs: DataFrame, path: str) -> None:
    """Add finished runs to the results table."""
    runs.write.mode("append").csv(path, header=True)


def read_runs(spark: SparkSession, path: str, key: str = "") -> DataFrame:
    """The results table; ``key`` adds a leading column such as ``family string``."""
    return spark.read.csv(path, header=True, schema=f"{key}, {RUNS_SCHEMA}" if key else RUNS_SCHEMA)


def pending_cells(sweeps: DataFrame, runs: DataFrame, budgets: Sequence[float], depths: Sequence[int], sweep: str) -> DataFrame:
    """Cells (budget, depth) of every sweep that have no run yet."""
    grid = sweeps.select(sweep, F.explode(F.lit(list(budgets))).alias("flops_budget"))
    grid = grid.select("*", F.explode(F.lit(list(depths))).alias("depth"))
    return grid.join(runs, [sweep, "flops_budget", "depth"], "left_anti")


def _number(text: Column) -> Column:
    return F.nullif(F.replace(text, F.lit(","), F.lit("")), F.lit("")).cast("double")


def run_log_extract(lines: DataFrame, run: str, order: str, line: str = "line") -> DataFrame:
    """Last reported sizes, iterations, validation bpb and CORE (0 when missing) of every run's log.

    ``depth`` must be a column of ``lines``.
    """
    c = F.col(line)
    first = F.regexp_extract(c, r"([\d,]+)", 1)
    scaling = F.regexp_extract(c, r"scaling: ([\d,]+)", 1)
    wanted = {
        "num_params": ("Number of parameters:", first),
        "num_scaling_params": ("Number of parameters:", scaling),
        "num_iterations": ("Calculated number of iterations", F.substring_index(c, ": ", -1)),
        "val_bpb": ("Validation bpb:", F.regexp_extract(c, r"([\d.]+)$", 1)),
        "core_score": ("CORE metric:", F.regexp_extract(c, r"(\S+)\s*$", 1)),
    }
    last = lambda mark, value: F.max(F.when(c.contains(mark), F.struct(F.col(order), value.alias("v"))))["v"]
    found = lines.groupBy(run, "depth").agg(*[last(m, v).alias(n) for n, (m, v) in wanted.items()])
    whole = [_number(F.col(n)).cast("long").alias(n) for n in ("num_params", "num_scaling_params", "num_iterations")]
    tokens = F.col("num_iterations") * TOKENS_PER_ITERATION
    return found.select(
        run, "depth", *whole, F.col("val_bpb").cast("double").alias("val_bpb"),
        F.coalesce(F.col("core_score").cast("double"), F.lit(0.0)).alias("core_score"),
    ).select(
        "*",
        tokens.alias("tokens_trained"),
        F.round(F.try_divide(tokens, F.col("num_scaling_params")), 2).alias("param_data_ratio"),
        (F.col("depth") * DIM_PER_DEPTH).alias("model_dim"),
    )


def step_metrics(lines: DataFrame, line: str = "line") -> DataFrame:
    """Fields of progress lines; fields that a line does not report are null, other lines are dropped."""
    c = F.col(line)

    def field(pattern: str) -> Column:
        return _number(F.regexp_extract(c, pattern, 1))

    fields = {
        "step": field(r"^[sS]tep (\d+)").cast("long"),
        "num_iterations": field(r"^[sS]tep \d+/(\d+)").cast("long"),
        "pct_done": field(r"\(([\d.]+)%\)"),
        "loss": field(r"(?:\| loss|Training loss): (-?[\d.]+)"),
        "lrm": field(r"lrm: ([\d.]+)"),
        "dt_ms": field(r"dt: ([\d.]+)ms"),
        "tok_per_sec": field(r"tok/sec: ([\d,]+)").cast("long"),
        "mfu": field(r"mfu: ([\d.]+)"),
        "epoch": field(r"epoch: (\d+)").cast("long"),
        "total_minutes": field(r"total time: ([\d.]+)m"),
        "eta_minutes": field(r"eta: ([\d.]+)m"),
        "num_tokens": field(r"num_tokens: ([\d,]+)").cast("long"),
    }
    return lines.filter(c.rlike(r"^[sS]tep \d+.*loss: ")).withColumns(fields)


# --- per step --------------------------------------------------------------------------------------


def run_rates(steps: DataFrame, batch_tokens: int, flops_per_token: float, peak_flops: float, workers: int = 1) -> DataFrame:
    """Tokens and FLOPs per second, utilization in percent, FLOPs so far, share done; ``dt`` in seconds."""
    dt, step = F.col("dt"), F.col("step")
    per_sec = F.lit(flops_per_token * batch_tokens) / dt
    return steps.withColumns(
        {
            "tok_per_sec": F.floor(F.lit(batch_tokens) / dt).cast("long"),
            "flops_per_sec": per_sec,
            "mfu": 100 * per_sec / (peak_flops * workers),
            "flops_so_far": F.lit(flops_per_token * batch_tokens) * step,
            "pct_done": 100 * step / F.col("num_iterations"),
        }
    )


def debiased_ema(steps: DataFrame, run: str, beta: float = 0.9, exponent: int = 1, value: str = "loss", step: str = "step") -> DataFrame:
    """s <- beta s + (1 - beta) x along the steps 0, 1, ... of a run, divided by 1 - beta^(step + exponent).

    Steps are cut into blocks so long that what an earlier block than the last one leaves is below double
    precision. A block needs only the end value of the block before it, so a long run spreads over many tasks.
    """
    block = max(512, math.ceil(45 / -math.log(beta)))
    rows = steps.withColumns({"_b": F.floor(F.col(step) / block), "_i": F.pmod(F.col(step), F.lit(block))})
    w = Window.partitionBy(run, "_b").orderBy(step).rowsBetween(Window.unboundedPreceding, 0)
    local = F.sum(F.col(value) * F.pow(F.lit(beta), -F.col("_i"))).over(w) * F.pow(F.lit(beta), F.col("_i")) * (1 - beta)
    rows = rows.withColumn("_local", local)
    ends = rows.filter(F.col("_i") == block - 1).select(run, (F.col("_b") + 1).alias("_b"), F.col("_local").alias("_carry"))
    rows = rows.join(ends, [run, "_b"], "left")
    ema = F.col("_local") + F.coalesce("_carry", F.lit(0.0)) * F.pow(F.lit(beta), F.col("_i") + 1)
    out = ema / (1 - F.pow(F.lit(beta), F.col(step) + exponent))
    return rows.withColumn("smooth_loss", out).drop("_b", "_i", "_local", "_carry")


def running_best(steps: DataFrame, run: str, value: str = "val_bpb", step: str = "step") -> DataFrame:
    """Lowest value so far."""
    return prefix_sums(steps, [step], {"best": F.col(value)}, [run], lowest=True)


def training_time_eta(steps: DataFrame, run: str, warmup: int = 10, step: str = "step", dt: str = "dt") -> DataFrame:
    """Training time after the warm-up steps, and the time left at the mean step time; blank during warm-up."""
    counted = F.when(F.col(step) > warmup, F.col(dt)).otherwise(F.lit(0.0))
    rows = prefix_sums(steps, [step], {"total_time": counted}, [run])
    left = F.col("num_iterations") - F.col(step)
    eta = F.when(F.col(step) > warmup, left * F.col("total_time") / (F.col(step) - warmup))
    return rows.withColumn("eta", eta)


# --- fits ------------------------------------------------------------------------------------------


def linear_fit(points: DataFrame, by: list[str], x: str, y: str) -> DataFrame:
    """Least squares slope, intercept and R squared per group."""
    return points.groupBy(*by).agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2"),
        F.count(F.lit(1)).alias("n"),
    )


def power_law_fit(points: DataFrame, by: list[str], x: str, y: str) -> DataFrame:
    """y = 10^intercept x^slope; groups with a single point have no fit."""
    logs = points.withColumns({"_x": F.log10(x), "_y": F.log10(y)})
    return linear_fit(logs, by, "_x", "_y").filter("n >= 2")


def top_predictors(points: DataFrame, features: list[str], y: str) -> DataFrame:
    """Single features ranked by the R squared of their own fit; one pass over the points."""
    long = points.select(
        y, F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("x")) for f in features])).alias("_f")
    ).select(y, "_f.*")
    return linear_fit(long, ["feature"], "x", y).orderBy(F.desc("r2"), "feature")


def best_per_budget(runs: DataFrame, by: list[str], value: str = "val_bpb", tie: str = "depth") -> DataFrame:
    """The whole row with the lowest value of every budget, ties to the smaller depth."""
    others = [c for c in runs.columns if c not in (*by, value, tie)]
    best = runs.groupBy(*by).agg(F.min(F.struct(value, tie, *others)).alias("_r"))
    return best.select(*by, "_r.*")


def quadratic_fit(points: DataFrame, by: list[str], x: str, y: str) -> DataFrame:
    """Coefficients of a (t - mean x)^2 + b (t - mean x) + c per group, from centered power sums."""
    means = points.groupBy(*by).agg(F.avg(x).alias("mx"), F.avg(y).alias("my"), F.count(F.lit(1)).alias("n"))
    rows = points.join(means, by)
    d, e = F.col(x) - F.col("mx"), F.col(y) - F.col("my")
    sums = rows.groupBy(*by, "mx", "my", "n").agg(
        F.sum(d * d).alias("s2"), F.sum(d * d * d).alias("s3"), F.sum(d * d * d * d).alias("s4"),
        F.sum(d * e).alias("p1"), F.sum(d * d * e).alias("p2"),
    )
    s2, s3, s4, p1, p2, n = (F.col(c) for c in ("s2", "s3", "s4", "p1", "p2", "n"))
    a = F.try_divide(p2 - F.try_divide(s3 * p1, s2), s4 - F.try_divide(s3 * s3, s2) - s2 * s2 / n)
    with_a = sums.withColumn("a", a)
    return with_a.select(
        *by, "mx", "n", "a",
        F.try_divide(p1 - s3 * F.col("a"), s2).alias("b"),
        (F.col("my") - s2 * F.col("a") / n).alias("c"),
    )


def interp_at(points: DataFrame, targets: DataFrame, by: list[str], x: str, ys: list[str], target: str) -> DataFrame:
    """Linear interpolation of ``ys`` at one target per group, held constant beyond the ends.

    The neighbours of the target are a maximum and a minimum, so no range join is needed.
    """
    rows = points.join(targets.select(*by, target), by)
    below, above = F.col(x) <= F.col(target), F.col(x) >= F.col(target)
    at = F.struct(F.col(x).alias("x"), *[F.col(c) for c in ys])
    near = rows.groupBy(*by, target).agg(F.max(F.when(below, at)).alias("lo"), F.min(F.when(above, at)).alias("hi"))
    share = F.try_divide(F.col(target) - F.col("lo.x"), F.col("hi.x") - F.col("lo.x"))

    def value(c: str) -> Column:
        lo, hi = F.col(f"lo.{c}").cast("double"), F.col(f"hi.{c}").cast("double")
        return F.coalesce(lo + F.coalesce(share, F.lit(0.0)) * (hi - lo), lo, hi).alias(c)

    return near.select(*by, target, *[value(c) for c in ys])


def isoflop_fit(runs: DataFrame, by: list[str], size: str = "num_scaling_params", value: str = "val_bpb") -> DataFrame:
    """Best model size per budget: the minimum of a parabola in log size, or the best run when it opens downward."""
    ys = ["tokens_trained", "param_data_ratio"]
    rows = runs.withColumn("_x", F.log10(size))
    fit = quadratic_fit(rows, by, "_x", value).withColumn("_t", F.try_divide(-F.col("b"), 2 * F.col("a")))
    good = fit.filter("a > 0").select(
        *by, (F.col("mx") + F.col("_t")).alias("_opt"),
        (F.col("a") * F.col("_t") * F.col("_t") + F.col("b") * F.col("_t") + F.col("c")).alias("bpb"),
    )
    at = interp_at(rows, good, by, "_x", ys, "_opt").join(good.drop("_opt"), by)
    fitted = at.select(*by, F.pow(F.lit(10.0), "_opt").alias("params"), *ys, "bpb", F.lit(True).alias("fitted"))
    best = best_per_budget(runs.select(*by, value, size, *ys), by, value, size).join(fit.filter("a > 0"), by, "left_anti")
    raw = best.select(
        *by, F.col(size).cast("double").alias("params"), *[F.col(c).cast("double").alias(c) for c in ys],
        F.col(value).alias("bpb"), F.lit(False).alias("fitted"),
    )
    return fitted.unionByName(raw)


def ridge_fit(points: DataFrame, features: list[str], y: str, alphas: Sequence[float]) -> DataFrame:
    """Weights of (X'X + alpha I) w = X'y for several alphas; the intercept is not penalised, alpha is not scaled.

    The points are read once into sums of products (a table of features squared); the small systems are
    solved on the driver, and R squared follows from the same sums.
    """
    cols = [F.lit(1.0), *[F.col(f).cast("double") for f in features], F.col(y).cast("double")]
    k = len(cols)
    cells = [(i, j) for i in range(k) for j in range(i, k)]
    row = points.agg(*[F.sum(cols[i] * cols[j]).alias(f"m{i}_{j}") for i, j in cells]).first()
    m = np.zeros((k, k))
    for i, j in cells:
        m[i, j] = m[j, i] = row[f"m{i}_{j}"] or 0.0
    xx, xy, yy, n = m[:-1, :-1], m[:-1, -1], m[-1, -1], m[0, 0]
    penalty = np.eye(k - 1)
    penalty[0, 0] = 0.0
    out = []
    for alpha in alphas:
        w = np.linalg.solve(xx + alpha * penalty, xy)
        residual = yy - 2 * w @ xy + w @ xx @ w
        total = yy - m[0, -1] ** 2 / n
        out.append((float(alpha), float(w[0]), [float(v) for v in w[1:]], float(1 - residual / total), float(np.sqrt(w[1:] @ w[1:]))))
    schema = "alpha double, intercept double, weights array<double>, r2 double, weight_norm double"
    return points.sparkSession.createDataFrame(out, schema)
