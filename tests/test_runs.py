import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.operators import report, runs


def test_ema_over_block_ends(spark):
    rng = np.random.default_rng(1)
    data = [(r, i, float(x)) for r in (0, 1) for i, x in enumerate(rng.normal(3, 1, 1300))]
    df = spark.createDataFrame(data, "run_id long, step long, loss double").repartition(5)
    for beta, exponent in ((0.9, 1), (0.5, 2), (0.99, 1)):
        got = {(r["run_id"], r["step"]): r["smooth_loss"] for r in runs.debiased_ema(df, "run_id", beta, exponent).collect()}
        for run in (0, 1):
            s = 0.0
            for r, i, x in data:
                if r == run:
                    s = beta * s + (1 - beta) * x
                    assert got[run, i] == pytest.approx(s / (1 - beta ** (i + exponent)), rel=1e-9)


def test_ridge_equals_the_closed_form(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(30, 3))
    y = x @ [1.0, -2.0, 0.5] + 4 + rng.normal(scale=0.1, size=30)
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], "a double, b double, c double, y double")
    for r in runs.ridge_fit(df, ["a", "b", "c"], "y", [0.0, 0.1, 1.0]).collect():
        aug = np.column_stack([np.ones(30), x])
        reg = r["alpha"] * np.diag([0, 1, 1, 1])
        w = np.linalg.solve(aug.T @ aug + reg, aug.T @ y)
        assert [r["intercept"], *r["weights"]] == pytest.approx(w)
        res = ((y - aug @ w) ** 2).sum() / ((y - y.mean()) ** 2).sum()
        assert r["r2"] == pytest.approx(1 - res)


def test_parabola_and_interpolation(spark):
    xs = np.linspace(6.5, 8.5, 9)
    ys = 0.3 * (xs - 7.7) ** 2 + 0.9 + np.sin(40 * xs) * 0.001
    rows = [("up", float(10**x), float(y), int(1e9 * i + 1), float(i)) for i, (x, y) in enumerate(zip(xs, ys))]
    rows += [("down", float(10**x), float(2 - y), int(1e9 * i + 1), float(i)) for i, (x, y) in enumerate(zip(xs, ys))]
    df = spark.createDataFrame(rows, "g string, num_scaling_params double, val_bpb double, tokens_trained long, param_data_ratio double")
    got = {r["g"]: r for r in runs.isoflop_fit(df, ["g"]).collect()}
    a, b, c = np.polyfit(xs, ys, 2)
    opt = -b / (2 * a)
    assert np.log10(got["up"]["params"]) == pytest.approx(opt, rel=1e-9)
    assert got["up"]["bpb"] == pytest.approx(a * opt**2 + b * opt + c)
    assert got["up"]["param_data_ratio"] == pytest.approx(np.interp(opt, xs, range(9)))
    low = int(np.argmin(2 - ys))
    assert not got["down"]["fitted"] and got["down"]["param_data_ratio"] == float(low)
    points = df.filter("g = 'up'").withColumn("x", F.log10("num_scaling_params"))
    for t in (5.0, 6.5, 7.3, 8.5, 9.9):
        targets = spark.createDataFrame([("up", t)], "g string, t double")
        r = runs.interp_at(points, targets, ["g"], "x", ["param_data_ratio"], "t").first()
        assert r["param_data_ratio"] == pytest.approx(np.interp(t, xs, range(9)))


def test_power_law_needs_two_points(spark):
    df = spark.createDataFrame([("a", 1.0, 10.0), ("a", 10.0, 1000.0), ("b", 1.0, 1.0)], "g string, x double, y double")
    rows = runs.power_law_fit(df, ["g"], "x", "y").collect()
    assert [(r["g"], round(r["slope"], 9)) for r in rows] == [("a", 2.0)]


def test_log_lines(spark):
    lines = [
        "Number of parameters: 1,234,567 (scaling: 900,000)", "Calculated number of iterations from target FLOPs: 1,100",
        "Step 00010 | Validation bpb: 1.5", "Step 00020 | Validation bpb: 0.987654", "noise",
    ]
    df = spark.createDataFrame([(1, 8, i, x) for i, x in enumerate(lines)], "run_id int, depth int, line_no int, line string")
    r = runs.run_log_extract(df, "run_id", "line_no").first()
    assert (r["num_params"], r["num_scaling_params"], r["num_iterations"]) == (1234567, 900000, 1100)
    assert (r["val_bpb"], r["core_score"], r["model_dim"]) == (0.987654, 0.0, 512)
    assert r["tokens_trained"] == 1100 * 524288 and r["param_data_ratio"] == round(1100 * 524288 / 900000, 2)


def test_progress_line(spark):
    line = "step 00004/71680 (0.01%) | loss: 8.813754 | lrm: 1.00 | dt: 1571.88ms | tok/sec: 83,385 | mfu: 50.92 | total time: 0.00m"
    r = runs.step_metrics(spark.createDataFrame([(line,), ("Step 00010 | Validation bpb: 1.0",)], "line string")).collect()
    assert len(r) == 1
    assert (r[0]["step"], r[0]["num_iterations"], r[0]["loss"], r[0]["tok_per_sec"], r[0]["epoch"]) == (4, 71680, 8.813754, 83385, None)


def files(spark, **texts):
    names = {"header": "header.md", "sft": "chat-sft.md", "base": "base-model-evaluation.md", "mid": "chat-evaluation-mid.md", "rl": "chat-rl.md"}
    return spark.createDataFrame([(1, names[k], v) for k, v in texts.items()], "run_id int, file string, text string")


def test_report(spark):
    f = files(
        spark, header="Run started: 2025-01-01 10:00:00\n", base="## x\ntimestamp: 2025-01-01 11:00:00\n\n- CORE: 0.1\n- CORE: 0.2: more\n",
        mid="timestamp: 2025-01-01 12:30:59\n- ARC-Easy: 1\n- ChatCORE: 7\n", rl="timestamp: 2025-01-09 12:00:00\n",
    )
    assert report.report_duration(f, "run_id").first()["duration"] == "2h30m"
    metrics = report.report_extract(report.report_lines(f, "run_id"), "run_id")
    table = [tuple(r) for r in report.metrics_pivot(metrics, "run_id").orderBy("ord", "metric").select("metric", "base", "mid", "sft", "rl").collect()]
    assert table == [("CORE", "0.2", "-", "-", "-"), ("ARC-Easy", "-", "1", "-", "-"), ("ChatCORE", "-", "7", "-", "-")]
    assert report.report_sections(f, "run_id").filter("text IS NULL").count() == len(report.SECTIONS) - 3


def test_unknown_duration(spark):
    bad_end = files(spark, header="Run started: 2025-01-01 10:00:00", base="timestamp: 2025-01-01 11:00:00", sft="timestamp: soon")
    assert report.report_duration(bad_end, "run_id").first()["duration"] == "unknown"
    no_start = files(spark, base="timestamp: 2025-01-01 11:00:00")
    assert report.report_duration(no_start, "run_id").first()["duration"] == "unknown"
