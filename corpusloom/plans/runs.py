"""Training logs, step metrics, scaling fits and reports of many runs.

Sweep results come from ``customer`` (27 runs per family), logs and reports from ``events`` (one run per user).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions.det import u
from corpusloom.operators import report, runs
from corpusloom.operators.conversations import tasks
from corpusloom.operators.prefix import number_rows
from corpusloom.plans import fixtures as fx
from corpusloom.plans.registry import query, sql_u, table
from corpusloom.session import new_dir

BUDGETS = [1e18, 3e18, 6e18]
DEPTHS = list(range(6, 15))

# --- sweeps ----------------------------------------------------------------------------------------

SWEEP = f"""
  cells AS (SELECT c_custkey, c_custkey // 27 AS family, [1e18, 3e18, 6e18][c_custkey % 3 + 1] AS flops_budget,
                   6 + (c_custkey // 3) % 9 AS depth, 1000 + (c_custkey * 37) % 900 AS num_iterations FROM customer),
  curved AS (SELECT *, log10(depth * depth * 1000000) - (8 + 0.3 * log10(flops_budget / 1e18)) AS d,
                    CASE WHEN family % 5 = 4 THEN -0.05 ELSE 0.05 END AS bend FROM cells),
  runs AS (SELECT family, flops_budget, CAST(depth AS INT) AS depth, CAST(depth * 64 AS INT) AS model_dim,
                  depth * depth * 1200000 AS num_params, depth * depth * 1000000 AS num_scaling_params, num_iterations,
                  num_iterations * 524288 AS tokens_trained,
                  round(CAST(num_iterations * 524288 AS DOUBLE) / (depth * depth * 1000000), 2) AS param_data_ratio,
                  0.9 + bend * d * d + 0.001 * {sql_u('r', 'c_custkey')} AS val_bpb,
                  0.1 + 0.01 * depth + 0.05 * {sql_u('s', 'c_custkey')} AS core_score,
                  100 * depth + c_custkey % 60 AS train_time_sec, c_custkey FROM curved)"""


def sweep(spark, sf):
    key = F.col("c_custkey")
    cells = table(spark, sf, "customer").select(
        key,
        F.floor(key / 27).alias("family"),
        F.element_at(F.lit(BUDGETS), (key % 3 + 1).cast("int")).alias("flops_budget"),
        (6 + F.floor(key / 3) % 9).cast("long").alias("depth"),
        (1000 + (key * 37) % 900).alias("num_iterations"),
    )
    depth = F.col("depth")
    size = depth * depth * 1_000_000
    tokens = F.col("num_iterations") * runs.TOKENS_PER_ITERATION
    d = F.log10(size) - (8 + 0.3 * F.log10(F.col("flops_budget") / 1e18))
    bend = F.when(F.col("family") % 5 == 4, -0.05).otherwise(0.05)
    return cells.select(
        "family", "flops_budget", depth.cast("int").alias("depth"), (depth * 64).cast("int").alias("model_dim"),
        (depth * depth * 1_200_000).alias("num_params"), size.alias("num_scaling_params"), "num_iterations",
        tokens.alias("tokens_trained"),
        F.round(tokens.cast("double") / size, 2).alias("param_data_ratio"),
        (0.9 + bend * d * d + 0.001 * u("r", key)).alias("val_bpb"),
        (0.1 + 0.01 * depth + 0.05 * u("s", key)).alias("core_score"),
        (100 * depth + key % 60).alias("train_time_sec"), key,
    )


COLUMNS = "family, flops_budget, depth, model_dim, num_params, num_scaling_params, num_iterations, tokens_trained, param_data_ratio"


@query(
    "runs_table",
    f"WITH {SWEEP} SELECT {COLUMNS}, round(val_bpb, 6) AS val_bpb, round(core_score, 6) AS core_score, train_time_sec FROM runs",
)
def runs_table(spark, sf):
    """Two batches of finished runs appended to one table and read back."""
    rows = sweep(spark, sf).withColumns({c: F.round(c, 6) for c in ("val_bpb", "core_score")})
    path = new_dir(spark, "runs")
    rows.limit(0).drop("c_custkey").write.mode("overwrite").csv(path, header=True)
    for part in (0, 1):
        runs.append_runs(rows.filter(F.col("c_custkey") % 2 == part).drop("c_custkey"), path)
    return runs.read_runs(spark, path, "family long")


@query(
    "skip_existing_runs",
    f"""WITH {SWEEP}, done AS (SELECT * FROM runs WHERE {sql_u('done', 'c_custkey')} < 0.7),
      grid AS (SELECT DISTINCT family, b AS flops_budget, CAST(d AS INT) AS depth
               FROM runs CROSS JOIN (SELECT unnest([1e18, 3e18, 6e18]) AS b) CROSS JOIN range(6, 15) t(d))
    SELECT g.* FROM grid g ANTI JOIN done USING (family, flops_budget, depth)""",
)
def skip_existing_runs(spark, sf):
    rows = sweep(spark, sf)
    done = rows.filter(u("done", "c_custkey") < 0.7)
    return runs.pending_cells(rows.select("family").distinct(), done, BUDGETS, DEPTHS, "family")


@query(
    "linear_fit",
    f"""WITH {SWEEP} SELECT family, round(regr_slope(core_score, val_bpb), 6) AS slope, round(regr_intercept(core_score, val_bpb), 6) AS intercept,
          round(regr_r2(core_score, val_bpb), 6) AS r2, count(*) AS n FROM runs GROUP BY family""",
)
def linear_fit(spark, sf):
    return rounded(runs.linear_fit(sweep(spark, sf), ["family"], "val_bpb", "core_score"), "slope", "intercept", "r2")


def rounded(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


FEATURES = ["depth", "num_iterations", "param_data_ratio", "val_bpb"]


@query(
    "top_predictors",
    f"WITH {SWEEP} "
    + " UNION ALL ".join(
        f"SELECT '{f}' AS feature, round(regr_r2(core_score, {f}), 6) AS r2, round(regr_slope(core_score, {f}), 6) AS slope FROM runs"
        for f in FEATURES
    ),
)
def top_predictors(spark, sf):
    return rounded(runs.top_predictors(sweep(spark, sf), FEATURES, "core_score"), "r2", "slope").select("feature", "r2", "slope")


ALPHAS = [0.0, 0.001, 0.01, 0.1, 1.0]
SCALED = ["depth / 10.0", "num_iterations / 1000.0", "param_data_ratio / 10.0", "val_bpb"]


def sql_ridge() -> str:
    """Gaussian elimination on the sums of products, one step per CTE."""
    cols = ["1.0", *SCALED, "core_score"]
    k = len(cols) - 1
    sums = [f"sum(CAST({cols[i]} AS DOUBLE) * ({cols[j]})) AS m0_{i}_{j}" for i in range(k) for j in range(k + 1)]
    sums += ["sum(core_score * core_score) AS yy", "sum(core_score) AS y1", "count(*) AS n"]
    steps = f"sums AS (SELECT {', '.join(sums)} FROM runs),\n"
    first = [f"m0_{i}_{j}" + (" + alpha" if i == j and i else "") + f" AS e0_{i}_{j}" for i in range(k) for j in range(k + 1)]
    steps += f"e0 AS (SELECT *, {', '.join(first)} FROM sums CROSS JOIN (SELECT unnest({ALPHAS}) AS alpha))"
    for p in range(k):  # clear column p in all other rows
        cells = []
        for i in range(k):
            for j in range(k + 1):
                e, pivot = f"e{p}_{i}_{j}", f"e{p}_{p}_{j} / e{p}_{p}_{p}"
                cells.append((pivot if i == p else f"{e} - e{p}_{i}_{p} * {pivot}") + f" AS e{p + 1}_{i}_{j}")
        steps += f",\ne{p + 1} AS (SELECT *, {', '.join(cells)} FROM e{p})"
    w = [f"e{k}_{i}_{k}" for i in range(k)]
    fitted = " + ".join(f"{w[i]} * {w[j]} * m0_{i}_{j}" for i in range(k) for j in range(k))
    cross = " + ".join(f"{w[i]} * m0_{i}_{k}" for i in range(k))
    names = ", ".join(f"round({w[i]}, 5) AS w{i}" for i in range(1, k))
    return f"""WITH {SWEEP}, {steps} SELECT CAST(alpha AS DOUBLE) AS alpha, round({w[0]}, 5) AS intercept, {names},
      round(1 - (yy - 2 * ({cross}) + ({fitted})) / (yy - y1 * y1 / n), 5) AS r2,
      round(sqrt({' + '.join(f'{x} * {x}' for x in w[1:])}), 5) AS weight_norm FROM e{k}"""


@query("ridge_fit", sql_ridge())
def ridge_fit(spark, sf):
    points = sweep(spark, sf).select("core_score", *[F.expr(e).cast("double").alias(f"w{i}") for i, e in enumerate(SCALED, 1)])
    names = [f"w{i}" for i in range(1, len(SCALED) + 1)]
    fit = runs.ridge_fit(points, names, "core_score", ALPHAS)
    fit = fit.select("alpha", "intercept", *[F.col("weights")[i].alias(n) for i, n in enumerate(names)], "r2", "weight_norm")
    return rounded(fit, "intercept", *names, "r2", "weight_norm", digits=5)


ISO = f"""{SWEEP},
  pts AS (SELECT *, log10(num_scaling_params) AS x FROM runs),
  mid AS (SELECT family, flops_budget, avg(x) AS mx, avg(val_bpb) AS my, count(*) AS n FROM pts GROUP BY ALL),
  pw AS (SELECT family, flops_budget, mx, my, n, sum(pow(x - mx, 2)) AS s2, sum(pow(x - mx, 3)) AS s3, sum(pow(x - mx, 4)) AS s4,
                sum((x - mx) * (val_bpb - my)) AS p1, sum(pow(x - mx, 2) * (val_bpb - my)) AS p2
         FROM pts JOIN mid USING (family, flops_budget) GROUP BY ALL),
  ca AS (SELECT *, (p2 - s3 * p1 / s2) / (s4 - s3 * s3 / s2 - s2 * s2 / n) AS a FROM pw WHERE n > 2),
  fit AS (SELECT *, (p1 - s3 * a) / s2 AS b, my - s2 * a / n AS c FROM ca),
  opt AS (SELECT family, flops_budget, mx - b / (2 * a) AS t, c - b * b / (4 * a) AS bpb FROM fit WHERE a > 0),
  seg AS (SELECT family, flops_budget, x AS x0, lead(x) OVER w AS x1, tokens_trained AS t0, lead(tokens_trained) OVER w AS t1,
                 param_data_ratio AS r0, lead(param_data_ratio) OVER w AS r1, row_number() OVER w AS i, count(*) OVER (PARTITION BY family, flops_budget) AS k
          FROM pts WINDOW w AS (PARTITION BY family, flops_budget ORDER BY x)),
  hit AS (SELECT o.family, o.flops_budget, o.t, o.bpb,
                 CASE WHEN o.t < x0 OR x1 IS NULL THEN t0 ELSE t0 + (o.t - x0) / (x1 - x0) * (t1 - t0) END AS tokens_trained,
                 CASE WHEN o.t < x0 OR x1 IS NULL THEN r0 ELSE r0 + (o.t - x0) / (x1 - x0) * (r1 - r0) END AS param_data_ratio
          FROM opt o JOIN seg s ON s.family = o.family AND s.flops_budget = o.flops_budget
           AND ((o.t >= x0 AND (o.t < x1 OR x1 IS NULL)) OR (i = 1 AND o.t < x0))),
  raw AS (SELECT family, flops_budget, arg_min({{'p': num_scaling_params, 't': tokens_trained, 'r': param_data_ratio, 'b': val_bpb}}, val_bpb) AS v
          FROM runs WHERE (family, flops_budget) NOT IN (SELECT (family, flops_budget) FROM opt) GROUP BY ALL),
  best AS (SELECT family, flops_budget, pow(10, t) AS params, tokens_trained, param_data_ratio, bpb, true AS fitted FROM hit
           UNION ALL SELECT family, flops_budget, CAST(v.p AS DOUBLE), CAST(v.t AS DOUBLE), v.r, v.b, false FROM raw)"""


@query(
    "isoflop_fit",
    f"""WITH {ISO} SELECT family, flops_budget, round(log10(params), 5) AS log_params, round(log10(tokens_trained), 5) AS log_tokens,
          round(param_data_ratio, 4) AS ratio, round(bpb, 6) AS bpb, fitted FROM best""",
)
def isoflop_fit(spark, sf):
    fit = runs.isoflop_fit(sweep(spark, sf), ["family", "flops_budget"])
    return fit.select(
        "family", "flops_budget", F.round(F.log10("params"), 5).alias("log_params"), F.round(F.log10("tokens_trained"), 5).alias("log_tokens"),
        F.round("param_data_ratio", 4).alias("ratio"), F.round("bpb", 6).alias("bpb"), "fitted",
    )


@query(
    "power_law_fit",
    f"""WITH {ISO} SELECT family, round(regr_slope(log10(params), log10(flops_budget)), 4) AS params_slope,
          round(regr_slope(log10(tokens_trained), log10(flops_budget)), 4) AS tokens_slope, count(*) AS n
        FROM best GROUP BY family HAVING count(*) >= 2""",
)
def power_law_fit(spark, sf):
    best = runs.isoflop_fit(sweep(spark, sf), ["family", "flops_budget"])
    fit = lambda y, name: runs.power_law_fit(best, ["family"], "flops_budget", y).select(
        "family", F.round("slope", 4).alias(name), "n"
    )
    return fit("params", "params_slope").join(fit("tokens_trained", "tokens_slope").drop("n"), "family")


@query(
    "interp_at",
    f"""WITH {SWEEP}, pts AS (SELECT *, log10(num_scaling_params) AS x FROM runs),
      o AS (SELECT DISTINCT family, flops_budget, 7.4 + 1.1 * {sql_u('t', 'family')} AS t FROM runs),
      seg AS (SELECT family, flops_budget, x AS x0, lead(x) OVER w AS x1, tokens_trained AS t0, lead(tokens_trained) OVER w AS t1, row_number() OVER w AS i
              FROM pts WINDOW w AS (PARTITION BY family, flops_budget ORDER BY x))
    SELECT o.family, o.flops_budget, round(CASE WHEN o.t < x0 OR x1 IS NULL THEN t0 ELSE t0 + (o.t - x0) / (x1 - x0) * (t1 - t0) END, 0) AS tokens
    FROM o JOIN seg s ON s.family = o.family AND s.flops_budget = o.flops_budget
     AND ((o.t >= x0 AND (o.t < x1 OR x1 IS NULL)) OR (i = 1 AND o.t < x0))""",
)
def interp_at(spark, sf):
    points = sweep(spark, sf).withColumn("x", F.log10("num_scaling_params"))
    targets = points.select("family", "flops_budget").distinct().withColumn("t", 7.4 + 1.1 * u("t", "family"))
    out = runs.interp_at(points, targets, ["family", "flops_budget"], "x", ["tokens_trained"], "t")
    return out.select("family", "flops_budget", F.round("tokens_trained", 0).alias("tokens"))


@query(
    "best_per_budget",
    f"""WITH {SWEEP} SELECT family, flops_budget, depth, round(val_bpb, 6) AS val_bpb, num_params FROM runs
        QUALIFY row_number() OVER (PARTITION BY family, flops_budget ORDER BY val_bpb, depth) = 1""",
)
def best_per_budget(spark, sf):
    best = runs.best_per_budget(sweep(spark, sf).select("family", "flops_budget", "val_bpb", "depth", "num_params"), ["family", "flops_budget"])
    return rounded(best, "val_bpb")


# --- logs ------------------------------------------------------------------------------------------

LOG = """log AS (SELECT user_id AS run_id, 6 + user_id % 9 AS depth, event_id, CASE event_type
  WHEN 'click' THEN 'Number of parameters: ' || format('{:,}', 1000000 + event_id * 7) || ' (scaling: ' || format('{:,}', 900000 + event_id * 5) || ')'
  WHEN 'view' THEN 'Calculated number of iterations from target data:param ratio: ' || format('{:,}', 1000 + event_id % 5000)
  WHEN 'signup' THEN 'Step 00012 | Validation bpb: ' || printf('%.6f', 0.8 + value / 10000)
  WHEN 'purchase' THEN 'Step 00012 | CORE metric: ' || printf('%.4f', (event_id % 1000) / 10000)
  ELSE 'warning ' || event_id END AS line FROM events)"""


def log_lines(spark, sf):
    e = F.col("event_id")
    commas = lambda c: F.format_number(c, 0)
    line = (
        F.when(F.col("event_type") == "click", F.concat(F.lit("Number of parameters: "), commas(1_000_000 + e * 7), F.lit(" (scaling: "), commas(900_000 + e * 5), F.lit(")")))
        .when(F.col("event_type") == "view", F.concat(F.lit("Calculated number of iterations from target data:param ratio: "), commas(1000 + e % 5000)))
        .when(F.col("event_type") == "signup", F.concat(F.lit("Step 00012 | Validation bpb: "), F.format_string("%.6f", 0.8 + F.col("value") / 10000)))
        .when(F.col("event_type") == "purchase", F.concat(F.lit("Step 00012 | CORE metric: "), F.format_string("%.4f", (e % 1000) / 10000)))
        .otherwise(F.concat(F.lit("warning "), e.cast("string")))
    )
    return table(spark, sf, "events").select(
        F.col("user_id").alias("run_id"), (6 + F.col("user_id") % 9).alias("depth"), "event_id", line.alias("line")
    )


@query(
    "run_log_extract",
    f"""WITH {LOG}, m AS (SELECT run_id, depth,
        arg_max(line, event_id) FILTER (contains(line, 'Number of parameters:')) AS p,
        arg_max(line, event_id) FILTER (contains(line, 'Calculated number of iterations')) AS i,
        arg_max(line, event_id) FILTER (contains(line, 'Validation bpb:')) AS v,
        arg_max(line, event_id) FILTER (contains(line, 'CORE metric:')) AS c FROM log GROUP BY run_id, depth),
      x AS (SELECT run_id, depth, CAST(replace(regexp_extract(p, '[\\d,]+'), ',', '') AS BIGINT) AS num_params,
              CAST(replace(regexp_extract(p, 'scaling: ([\\d,]+)', 1), ',', '') AS BIGINT) AS num_scaling_params,
              CAST(replace(regexp_extract(i, ': ([\\d,]+)$', 1), ',', '') AS BIGINT) AS num_iterations,
              CAST(regexp_extract(v, '[\\d.]+$') AS DOUBLE) AS val_bpb,
              coalesce(CAST(regexp_extract(c, '[\\d.]+$') AS DOUBLE), 0.0) AS core_score FROM m)
    SELECT *, num_iterations * 524288 AS tokens_trained, round(CAST(num_iterations * 524288 AS DOUBLE) / num_scaling_params, 2) AS param_data_ratio,
           depth * 64 AS model_dim FROM x""",
)
def run_log_extract(spark, sf):
    return runs.run_log_extract(log_lines(spark, sf), "run_id", "event_id")


STEPS = """numbered AS (SELECT user_id AS run_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS step FROM events),
  progress AS (SELECT *, 1000 + event_id % 997 AS ms FROM numbered),
  lines AS (SELECT run_id, event_id, CASE
     WHEN event_id % 5 = 0 THEN 'Step ' || printf('%05d', step) || '/05000 | Training loss: ' || printf('%.6f', value) || '| lrm: 0.500000| num_tokens: 12,345'
     WHEN event_id % 3 = 0 THEN 'step ' || printf('%05d', step) || ' (' || printf('%.2f', step / 50) || '%) | loss: ' || printf('%.6f', value)
       || ' | lrm: 1.00 | dt: ' || printf('%.2f', CAST(ms AS DOUBLE)) || 'ms | tok/sec: ' || format('{:,}', 524288000 // ms) || ' | mfu: '
       || printf('%.2f', event_id % 60 + 0.25) || ' | epoch: ' || (1 + event_id % 3) || ' | total time: ' || printf('%.2f', step * 0.5) || 'm | eta: ' || printf('%.2f', abs(5000 - step) * 0.5) || 'm'
     ELSE 'step ' || printf('%05d', step) || '/05000 (' || printf('%.2f', step / 50) || '%) | loss: ' || printf('%.6f', value)
       || ' | lrm: 1.00 | dt: ' || printf('%.2f', CAST(ms AS DOUBLE)) || 'ms | tok/sec: ' || format('{:,}', 524288000 // ms) || ' | mfu: '
       || printf('%.2f', event_id % 60 + 0.25) || ' | epoch: ' || (1 + event_id % 3) || ' | total time: ' || printf('%.2f', step * 0.5) || 'm | eta: ' || printf('%.2f', abs(5000 - step) * 0.5) || 'm' END AS line
   FROM progress)"""


def numbered(spark, sf):
    events = table(spark, sf, "events").select(F.col("user_id").alias("run_id"), "event_id", "value")
    rows = number_rows(events, ["event_id"], "step", ["run_id"])
    return rows.withColumns({"step": F.col("step") - 1, "ms": 1000 + F.col("event_id") % 997})


def progress_lines(spark, sf):
    e, step, ms = F.col("event_id"), F.col("step"), F.col("ms")
    two = lambda c: F.format_string("%.2f", c.cast("double"))
    no, loss = F.format_string("%05d", step), F.format_string("%.6f", "value")
    rest = F.concat(
        F.lit(" ("), two(step / 50), F.lit("%) | loss: "), loss, F.lit(" | lrm: 1.00 | dt: "), two(ms), F.lit("ms | tok/sec: "),
        F.format_number(F.floor(F.lit(524_288_000) / ms), 0), F.lit(" | mfu: "), two(e % 60 + 0.25), F.lit(" | epoch: "),
        (1 + e % 3).cast("string"), F.lit(" | total time: "), two(step * 0.5), F.lit("m | eta: "), two(F.abs(5000 - step) * 0.5), F.lit("m"),
    )
    line = (
        F.when(e % 5 == 0, F.concat(F.lit("Step "), no, F.lit("/05000 | Training loss: "), loss, F.lit("| lrm: 0.500000| num_tokens: 12,345")))
        .when(e % 3 == 0, F.concat(F.lit("step "), no, rest))
        .otherwise(F.concat(F.lit("step "), no, F.lit("/05000"), rest))
    )
    rows = numbered(spark, sf)
    return rows.repartition(tasks(rows), "event_id").select("run_id", "event_id", line.alias("line"))


@query(
    "step_metrics_extract",
    """WITH """ + STEPS + """
    SELECT run_id, event_id, step, round(value, 6) AS loss, CASE WHEN event_id % 5 = 0 OR event_id % 3 <> 0 THEN 5000 ELSE -1 END AS num_iterations,
      CAST(CASE WHEN event_id % 5 = 0 THEN 0.5 ELSE 1.0 END AS DOUBLE) AS lrm, CAST(CASE WHEN event_id % 5 = 0 THEN -1.0 ELSE round(step / 50, 2) END AS DOUBLE) AS pct_done,
      CASE WHEN event_id % 5 = 0 THEN -1.0 ELSE CAST(ms AS DOUBLE) END AS dt_ms, CASE WHEN event_id % 5 = 0 THEN -1 ELSE 524288000 // ms END AS tok_per_sec,
      CAST(CASE WHEN event_id % 5 = 0 THEN -1.0 ELSE event_id % 60 + 0.25 END AS DOUBLE) AS mfu, CASE WHEN event_id % 5 = 0 THEN -1 ELSE 1 + event_id % 3 END AS epoch,
      CAST(CASE WHEN event_id % 5 = 0 THEN -1.0 ELSE step * 0.5 END AS DOUBLE) AS total_minutes, length(line) AS n_line,
      CAST(CASE WHEN event_id % 5 = 0 THEN -1.0 ELSE abs(5000 - step) * 0.5 END AS DOUBLE) AS eta_minutes, CASE WHEN event_id % 5 = 0 THEN 12345 ELSE -1 END AS num_tokens
    FROM progress JOIN lines USING (run_id, event_id)""",
)
def step_metrics_extract(spark, sf):
    found = runs.step_metrics(progress_lines(spark, sf))
    blank = {c: F.coalesce(c, F.lit(-1)) for c in ("num_iterations", "pct_done", "dt_ms", "tok_per_sec", "mfu", "epoch", "total_minutes", "eta_minutes", "num_tokens")}
    return found.withColumns(blank).withColumn("n_line", F.length("line").cast("long")).drop("line")


def steps(spark, sf):
    return numbered(spark, sf).select(
        "run_id", "step", F.lit(5000).cast("long").alias("num_iterations"), F.col("value").alias("loss"),
        (F.col("ms") / 1000).alias("dt"), (1 + F.col("value") / 1000).alias("val_bpb"),
    )


@query(
    "run_rates",
    "WITH " + STEPS + """ SELECT run_id, step, CAST(floor(524288 / (ms / 1000)) AS BIGINT) AS tok_per_sec, round(2e9 * 524288 / (ms / 1000) / 1e12, 6) AS tflops_per_sec,
      round(100 * (2e9 * 524288 / (ms / 1000)) / (989e12 * 8), 6) AS mfu, round(2e9 * 524288 * step / 1e18, 6) AS exaflops, round(100 * step / 5000, 6) AS pct_done
    FROM progress""",
)
def run_rates(spark, sf):
    rows = runs.run_rates(steps(spark, sf), 524_288, 2e9, 989e12, 8)
    return rows.select(
        "run_id", "step", "tok_per_sec", F.round(F.col("flops_per_sec") / 1e12, 6).alias("tflops_per_sec"), F.round("mfu", 6).alias("mfu"),
        F.round(F.col("flops_so_far") / 1e18, 6).alias("exaflops"), F.round("pct_done", 6).alias("pct_done"),
    )


def sql_ema(exponent: int) -> str:
    """The weighted sum of all earlier losses, without recursion."""
    return f"""SELECT a.run_id, a.step, round(sum(0.1 * b.value * pow(0.9, a.step - b.step)) / (1 - pow(0.9, a.step + {exponent})), 6) AS smooth_loss
      FROM numbered a JOIN numbered b ON a.run_id = b.run_id AND b.step <= a.step GROUP BY a.run_id, a.step"""


@query("debiased_ema", f"WITH {STEPS} {sql_ema(1)}")
def debiased_ema(spark, sf):
    return runs.debiased_ema(steps(spark, sf), "run_id").select("run_id", "step", F.round("smooth_loss", 6).alias("smooth_loss"))


@query("debiased_ema_mid", f"WITH {STEPS} {sql_ema(2)}")
def debiased_ema_mid(spark, sf):
    """The variant that counts the step before it smooths."""
    rows = runs.debiased_ema(steps(spark, sf), "run_id", exponent=2)
    return rows.select("run_id", "step", F.round("smooth_loss", 6).alias("smooth_loss"))


@query(
    "running_best",
    f"WITH {STEPS} SELECT run_id, step, round(min(1 + value / 1000) OVER (PARTITION BY run_id ORDER BY step), 6) AS best FROM numbered",
)
def running_best(spark, sf):
    return rounded(runs.running_best(steps(spark, sf), "run_id").select("run_id", "step", "best"), "best")


@query(
    "training_time_eta",
    "WITH " + STEPS + """, t AS (SELECT run_id, step, sum(CASE WHEN step > 10 THEN ms / 1000 ELSE 0 END) OVER (PARTITION BY run_id ORDER BY step) AS total
      FROM progress) SELECT run_id, step, round(total, 6) AS total_time, coalesce(round(CASE WHEN step > 10 THEN (5000 - step) * total / (step - 10) END + 1e-9, 4), -1) AS eta FROM t""",
)
def training_time_eta(spark, sf):
    rows = runs.training_time_eta(steps(spark, sf), "run_id")
    return rows.select("run_id", "step", F.round("total_time", 6).alias("total_time"), F.coalesce(F.round(F.col("eta") + 1e-9, 4), F.lit(-1.0)).alias("eta"))


# --- reports ---------------------------------------------------------------------------------------

_FILES = [report.HEADER, *report.SECTIONS]
_CHAT = [f for f in report.SECTIONS if f.startswith("chat-evaluation")]
_METRICS = " || ".join(f"'- {m}: ' || printf('%.4f', {sql_u(m, 'run_id', 'file')}) || chr(10)" for m in report.CHAT_METRICS)
FILES = f"""
  listed AS (SELECT run_id, file, ord, TIMESTAMP '2025-01-01 00:00:00' + run_id * INTERVAL 1 MINUTE AS start FROM
    (SELECT DISTINCT user_id AS run_id FROM events) CROSS JOIN (SELECT unnest({fx.sql_strings(_FILES)}) AS file, unnest(range({len(_FILES)})) AS ord)),
  stamped AS (SELECT *, CASE WHEN {sql_u('bad', 'run_id', 'file')} < 0.1 THEN 'soon'
      ELSE strftime(start + ord * (30 + run_id % 50) * INTERVAL 1 MINUTE, '%Y-%m-%d %H:%M:%S') END AS stamp
    FROM listed WHERE {sql_u('sec', 'run_id', 'file')} < 0.9),
  files AS (SELECT run_id, file, CASE WHEN ord = 0 THEN '# Report' || chr(10) || 'Run started: ' || stamp || chr(10)
      ELSE '## ' || file || chr(10) || 'timestamp: ' || stamp || chr(10) || chr(10) || CASE
        WHEN file = 'base-model-evaluation.md' THEN '- CORE: ' || printf('%.4f', {sql_u('first', 'run_id')}) || chr(10) || '- CORE metric: '
          || printf('%.4f', {sql_u('core', 'run_id')}) || chr(10)
        WHEN file IN ({', '.join(f"'{f}'" for f in _CHAT)}) THEN {_METRICS} ELSE '- loss: 1' || chr(10) END END AS text FROM stamped)"""


def files(spark, sf):
    runs_ = table(spark, sf, "events").select(F.col("user_id").alias("run_id")).distinct()
    rows = runs_.select("run_id", F.posexplode(F.lit(_FILES)).alias("ord", "file"))
    rows = rows.filter(u("sec", "run_id", "file") < 0.9)
    seconds = F.lit(1_735_689_600) + (F.col("run_id") + F.col("ord") * (30 + F.col("run_id") % 50)) * 60
    stamp = F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd HH:mm:ss")
    stamp = F.when(u("bad", "run_id", "file") < 0.1, F.lit("soon")).otherwise(stamp)
    four = lambda c: F.format_string("%.4f", c)
    metrics = F.concat(*[F.concat(F.lit(f"- {m}: "), four(u(m, "run_id", "file")), F.lit("\n")) for m in report.CHAT_METRICS])
    base = F.concat(F.lit("- CORE: "), four(u("first", "run_id")), F.lit("\n- CORE metric: "), four(u("core", "run_id")), F.lit("\n"))
    body = F.when(F.col("file") == "base-model-evaluation.md", base).when(F.col("file").isin(_CHAT), metrics).otherwise(F.lit("- loss: 1\n"))
    text = F.when(F.col("ord") == 0, F.concat(F.lit("# Report\nRun started: "), stamp, F.lit("\n"))).otherwise(
        F.concat(F.lit("## "), "file", F.lit("\ntimestamp: "), stamp, F.lit("\n\n"), body)
    )
    return rows.select("run_id", "file", text.alias("text"))


EXTRACTED = f"""{FILES},
  split AS (SELECT run_id, file, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS line_no FROM files),
  wanted AS (SELECT 'base-model-evaluation.md' AS file, 'base' AS stage, ['CORE'] AS keys
             UNION ALL SELECT 'chat-evaluation-mid.md', 'mid', {fx.sql_strings(report.CHAT_METRICS)}
             UNION ALL SELECT 'chat-evaluation-sft.md', 'sft', {fx.sql_strings(report.CHAT_METRICS)}
             UNION ALL SELECT 'chat-evaluation-rl.md', 'rl', ['GSM8K']),
  keyed AS (SELECT run_id, stage, line, line_no, unnest(keys) AS metric FROM split JOIN wanted USING (file)),
  metrics AS (SELECT run_id, stage, metric, arg_max(trim(string_split(line, ':')[2]), line_no) AS value
              FROM keyed WHERE contains(line, metric) GROUP BY run_id, stage, metric)"""


def metrics(spark, sf):
    return report.report_extract(report.report_lines(files(spark, sf), "run_id"), "run_id")


@query(
    "report_sections",
    f"""WITH {FILES} SELECT l.run_id, l.file, CAST(l.ord - 1 AS INT) AS section_order, coalesce(md5(f.text), 'missing') AS text
        FROM listed l LEFT JOIN files f USING (run_id, file) WHERE l.ord > 0 AND l.run_id IN (SELECT run_id FROM files)""",
)
def report_sections(spark, sf):
    rows = report.report_sections(files(spark, sf), "run_id")
    return rows.select("run_id", "file", "section_order", F.coalesce(F.md5("text"), F.lit("missing")).alias("text"))


@query("report_extract", f"WITH {EXTRACTED} SELECT * FROM metrics")
def report_extract(spark, sf):
    return metrics(spark, sf)


@query(
    "report_duration",
    f"""WITH {FILES}, s AS (SELECT run_id, file, ord, start, CASE WHEN {sql_u('bad', 'run_id', 'file')} < 0.1 THEN NULL
                                 ELSE start + ord * (30 + run_id % 50) * INTERVAL 1 MINUTE END AS stamp FROM listed
                               WHERE {sql_u('sec', 'run_id', 'file')} < 0.9),
      b AS (SELECT run_id, max(stamp) FILTER (ord = 0) AS t0, arg_max({{'v': stamp}}, ord) FILTER (ord > 0 AND NOT contains(file, 'rl')) AS t1
            FROM s GROUP BY run_id),
      d AS (SELECT run_id, CAST(epoch(t1.v) - epoch(t0) AS BIGINT) AS n FROM b)
    SELECT run_id, coalesce((n // 3600) || 'h' || ((n % 3600) // 60) || 'm', 'unknown') AS duration FROM d""",
)
def report_duration(spark, sf):
    return report.report_duration(files(spark, sf), "run_id")


@query(
    "report_metrics_pivot",
    f"""WITH {EXTRACTED} SELECT run_id, CASE metric WHEN 'CORE' THEN 0 WHEN 'ChatCORE' THEN 2 ELSE 1 END AS ord, metric,
      coalesce(max(value) FILTER (stage = 'base'), '-') AS base, coalesce(max(value) FILTER (stage = 'mid'), '-') AS mid,
      coalesce(max(value) FILTER (stage = 'sft'), '-') AS sft, coalesce(max(value) FILTER (stage = 'rl'), '-') AS rl
    FROM metrics GROUP BY run_id, metric""",
)
def report_metrics_pivot(spark, sf):
    return report.metrics_pivot(metrics(spark, sf), "run_id")


@query("metric_name_set", f"WITH {EXTRACTED} SELECT DISTINCT run_id, metric FROM metrics")
def metric_name_set(spark, sf):
    return report.metric_names(metrics(spark, sf), "run_id")
