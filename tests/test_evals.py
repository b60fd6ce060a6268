import math

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import text as tx
from corpusloom.operators import evals

TOK = tx.ByteTokenizer()


def options(spark, lists):
    return spark.createDataFrame([(0, lists)], "idx long, options array<array<int>>")


@pytest.mark.parametrize(
    "lists,prefix,suffix",
    [([[1, 2, 3], [1, 2, 4]], 2, 0), ([[1, 2], [1, 2, 3]], 2, 0), ([[5, 9], [6, 7, 9]], 0, 1), ([[1, 2], [1, 2]], 2, 2), ([[1, 8, 2], [1, 2]], 1, 1)],
)
def test_common_length(spark, lists, prefix, suffix):
    df = options(spark, lists)
    assert evals.with_common_length(df, "options").first()["common"] == prefix
    assert evals.with_common_length(df, "options", suffix=True).first()["common"] == suffix


def test_spans(spark):
    span = lambda kind, lists: [(s["start"], s["end"]) for s in evals.with_spans(options(spark, lists), kind).first()["spans"]]
    assert span("multiple_choice", [[1, 2, 3], [1, 2, 4, 5]]) == [(2, 3), (2, 4)]
    assert span("schema", [[1, 2, 9, 9], [3, 9, 9]]) == [(2, 4), (1, 3)]
    assert span("language_modeling", [[1, 2], [1, 2, 3]]) == [(2, 3)]
    for bad in ([[1, 2], [1, 3, 4]], [[1, 2], [1, 2]]):
        with pytest.raises(Exception, match="proper prefix"):
            span("language_modeling", bad)
    with pytest.raises(ValueError, match="unknown task type"):
        evals.with_spans(options(spark, [[1]]), "other")


def test_truncation(spark):
    rows = spark.createDataFrame([([1, 2, 3, 4, 5], 3, 5)], "ids array<int>, start_idx int, end_idx int")
    r = evals.left_truncate(rows, 3).first()
    assert (r["ids"], r["start_idx"], r["end_idx"]) == ([3, 4, 5], 1, 3)
    assert evals.left_truncate(rows, 9).first()["start_idx"] == 3
    with pytest.raises(Exception, match="cropped away"):
        evals.left_truncate(rows, 1).collect()


def test_scores_and_ties(spark):
    spans = spark.createDataFrame([(0, 0, [9, 1, 2], 1, 3), (0, 1, [9, 1, 3], 1, 3)], "idx int, option_idx int, ids array<int>, start_idx int, end_idx int")
    scores = spark.createDataFrame(
        [(0, o, p, loss, pred) for o in (0, 1) for p, loss, pred in ((0, 1.0, 1), (1, 3.0, 2), (2, math.nan, 0))],
        "idx int, option_idx int, pos int, loss double, pred_id int",
    )
    got = evals.span_scores(spans, scores, ["idx", "option_idx"])
    assert sorted(map(tuple, got.collect())) == [(0, 0, 2.0, True), (0, 1, 2.0, False)]
    assert evals.best_option(got, ["idx"]).first()["option_idx"] == 0
    empty = spans.withColumn("end_idx", F.col("start_idx"))
    with pytest.raises(Exception, match="empty answer span"):
        evals.span_scores(empty, scores, ["idx", "option_idx"]).collect()


def test_scores_as_arrays(spark):
    spans = spark.createDataFrame(
        [(0, 0, [9, 1, 2], 1, 3), (0, 1, [9, 1, 3], 1, 3), (1, 0, [4, 5, 6, 7], 2, 3), (1, 1, [4, 5, 6, 7], 3, 4), (2, 0, [1, 2, 3], 2, 3)],
        "idx int, option_idx int, ids array<int>, start_idx int, end_idx int",
    )
    scores = spark.createDataFrame(
        [(0, 0, [1.0, 3.0, math.nan], [1, 2, 0]), (0, 1, [1.0, 3.0, math.nan], [1, 2, 0]), (1, 0, [9.0, 0.5, 9.0], [0, 6, 0]), (1, 1, [9.0, 9.0, 0.25], [0, 0, 6]), (2, 0, [1.0], [2])],
        "idx int, option_idx int, losses array<double>, pred_ids array<int>",
    )
    keys = ["idx", "option_idx"]
    got = sorted(map(tuple, evals.array_span_scores(spans, scores, keys).collect()))
    assert got == [(0, 0, 2.0, True), (0, 1, 2.0, False), (1, 0, 0.5, True), (1, 1, 0.25, False), (2, 0, None, None)]
    rows = scores.select(*keys, F.posexplode(F.arrays_zip("losses", "pred_ids")).alias("pos", "z")).select(*keys, "pos", F.col("z.losses").alias("loss"), F.col("z.pred_ids").alias("pred_id"))
    assert sorted(map(tuple, evals.span_scores(spans.filter("idx < 2"), rows, keys).collect())) == got[:4]
    with pytest.raises(Exception, match="empty answer span"):
        evals.array_span_scores(spans.withColumn("end_idx", F.col("start_idx")), scores, keys).collect()


def test_fewshot_partners(spark, small_buckets):
    items = spark.range(40).withColumnRenamed("id", "idx")
    rows = evals.fewshot_sample(items, "idx", 5).collect()
    for i in range(40):
        mine = [r["partner"] for r in rows if r["idx"] == i]
        assert len(set(mine)) == 5 and i not in mine
    assert evals.fewshot_sample(items, "idx", 0).count() == 0
    with pytest.raises(ValueError, match="cannot draw"):
        evals.fewshot_sample(items, "idx", 40)


def test_prompts(spark):
    df = spark.createDataFrame([(" c ", "d", ["x", "y"], 1)], "c string, d string, o array<string>, g int")
    col = F.col
    assert df.select(evals.mc_block(col("c"), "|", col("o"), col("g"))).first()[0] == " c |y"
    assert df.select(evals.mc_prompts(F.lit("P\n\n"), col("c"), "|", col("o"))).first()[0] == ["P\n\n c |x", "P\n\n c |y"]
    assert df.select(evals.schema_prompts(F.lit(""), col("o"), " ", col("d"))).first()[0] == ["x d", "y d"]
    assert df.select(evals.lm_prompts(F.lit(""), col("c"), " ", col("d"))).first()[0] == ["c", "c d"]


def test_metrics(spark, tmp_path):
    acc = spark.createDataFrame([("a", 0.5), ("b", 0.25)], "task string, accuracy double")
    base = spark.createDataFrame([("a", 25.0), ("b", 25.0)], "task string, baseline double")
    results = evals.core_results(acc, base)
    assert evals.core_metric(results).first()[0] == pytest.approx((1 / 3 + 0) / 2)
    with pytest.raises(KeyError, match="b"):
        evals.core_results(acc, base.filter("task = 'a'"))
    evals.write_core_results(results, str(tmp_path / "core"))
    back = {r["task"]: (r["accuracy"], r["centered"]) for r in evals.read_core_results(spark, str(tmp_path / "core")).collect()}
    assert back == {"a": (0.5, 0.333333), "b": (0.25, 0.0), "CORE": (None, 0.166667)}
    chat = evals.chatcore_metric(acc, spark.createDataFrame([("a", 0.25)], "task string, baseline double"), ["a", "b"])
    assert chat.first()[0] == pytest.approx((1 / 3 + 0.25) / 2)
    assert evals.chatcore_metric(acc, base, ["a", "b", "c"]).count() == 0


def test_unreadable_result_rows_are_skipped(spark, tmp_path):
    (tmp_path / "r.csv").write_text("Task, Accuracy, Centered\na, 0.5, 0.1\nb, x, 0.2\nCORE, , 0.3\n")
    rows = [tuple(r) for r in evals.read_core_results(spark, str(tmp_path / "r.csv")).collect()]
    assert rows == [("a", 0.5, 0.1), ("CORE", None, 0.3)]


def test_bits_per_byte(spark):
    rows = spark.createDataFrame([("v", 2.0, 1), ("v", 4.0, 3), ("v", 100.0, 0), ("s", 5.0, 0)], "split string, loss double, n_bytes int")
    got = {r["split"]: r["bpb"] for r in evals.bits_per_byte(rows, "split").collect()}
    assert got["v"] == pytest.approx(6 / (math.log(2) * 4)) and got["s"] == math.inf


def test_passes(spark):
    rows = [(1, 0, False), (1, 1, True), (2, 0, False), (2, 1, False), (3, 0, True), (3, 1, False)]
    df = spark.createDataFrame(rows, "item long, sample long, is_correct boolean")
    assert [r["pass_rate"] for r in evals.pass_at_k(df, "item", "sample", 2).orderBy("k").collect()] == pytest.approx([1 / 3, 2 / 3])
    assert evals.pass_at_any(df, "item").first()["n_passed"] == 2
    with pytest.raises(ValueError, match="unknown evaluator"):
        evals.evaluate("other", F.lit("a"), F.lit("b"))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_means_of_examples_are_not_broadcast(spark):
    """There is a mean per example, as many as the table has, so neither side may go to the driver and to every task."""
    rewards = spark.createDataFrame([(i % 3, float(i)) for i in range(9)], "item long, reward double")
    got = evals.group_advantage(rewards, "item")
    assert "Broadcast" not in plan_of(got)
    assert sorted(map(tuple, got.collect())) == sorted((i % 3, float(i), float(i - 3 - i % 3)) for i in range(9))


def test_problems_are_not_broadcast_to_their_scores(spark):
    """Letters of a problem are looked up in its own row; a letter that it does not offer does not count, ties go to the first."""
    problems = spark.createDataFrame([(0, ["B", "A"]), (1, ["A", "B", "A"]), (2, ["C"])], "key long, letters array<string>")
    scores = spark.createDataFrame([(k, x, s) for k in range(3) for x, s in (("A", 2), ("B", 2), ("Z", 9))], "key long, letter string, score long")
    got = evals.best_letter(scores, problems, "key")
    assert "Broadcast" not in plan_of(got)
    assert sorted(map(tuple, got.collect())) == [(0, "B"), (1, "A")]


def test_tasks_of_a_spread_table_do_not_grow_with_it(spark, tmp_path):
    from corpusloom.sources import scan

    path = str(tmp_path / "a b")
    spark.range(20_000).coalesce(1).write.parquet(path)
    df = spark.read.parquet(path)
    assert scan.spread(df, "id").rdd.getNumPartitions() == 8
    assert scan.spread(df, "id", 4096).rdd.getNumPartitions() > 8
    assert scan.spread(df, "id", 4096).distinct().count() == 20_000
