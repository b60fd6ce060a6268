"""Plans and sources: nothing that cannot grow."""

import re
from pathlib import Path

from conftest import SF

from corpusloom import plans
from corpusloom.operators import mix

ROOT = Path(__file__).resolve().parents[1]


def test_filters_and_columns_reach_the_scan(spark):
    plan = plans.QUERIES["char_budget_exclusive"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(lang), IsNotNull(doc_id), EqualTo(lang,en), LessThanOrEqual(doc_id," in plan
    plan = plans.QUERIES["corpus_totals"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<text:string,lang:string,source:string>" in plan


def test_lineage_is_cut_in_the_shared_folder_only():
    code = "\n".join(p.read_text() for p in ROOT.joinpath("corpusloom").rglob("*.py"))
    assert "localCheckpoint" not in code and ".toPandas" not in code and "crossJoin" not in code
    assert len(re.findall(r"mkdtemp", code)) == 1  # only where spark.checkpoint.dir is unset


def test_budgets_read_each_text_once(spark, monkeypatch):
    """One scan reads texts, that of the sizes, which all budgets share; the results need keys alone."""
    written = []
    keep = mix.materialize

    def watch(df, name):
        written.append(df._jdf.queryExecution().executedPlan().toString())
        return keep(df, name)

    monkeypatch.setattr(mix, "materialize", watch)
    for name in ("val_budget", "char_budget_exclusive"):
        written.clear()
        plan = plans.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        texts = [len(re.findall(r"ReadSchema: struct<[^>]*\btext:string", p)) for p in (*written, plan)]
        assert sum(texts) == 1 and texts[0] == 1, (name, texts)


def test_budgets_share_sizes(spark):
    docs = spark.createDataFrame([(i, "x" * (i % 7)) for i in range(300)], "doc_id long, text string")
    sizes = mix.text_sizes(docs, ["doc_id"])
    for n in (0, 5, 100, 10_000):
        for budget in (mix.char_budget_exclusive, mix.char_budget_inclusive):
            assert budget(docs, ["doc_id"], n, sizes=sizes).count() == budget(docs, ["doc_id"], n).count()
    first, second = docs.filter("doc_id % 3 = 0"), docs.filter("doc_id % 3 > 0")
    one, two = (mix.val_budget(first, second, "doc_id", 0.3, 200, sizes=s).collect() for s in (sizes, None))
    assert sorted(one) == sorted(two) and one


def test_questions_have_a_task_per_piece_of_their_table(spark, monkeypatch):
    """The rows of one task do not grow with ``lineitem``."""
    from corpusloom.plans import fixtures as fx

    few = fx.math(spark, SF).rdd.getNumPartitions()
    monkeypatch.setattr(fx, "LINE_BYTES", 4096)
    assert fx.math(spark, SF).rdd.getNumPartitions() > few


def test_answers_are_checked_in_a_task_per_piece_of_their_tables(spark, monkeypatch):
    """Completions meet their questions, and letters their problems, where the rows were dealt to, not in a fixed number of tasks."""
    from corpusloom.plans import evals as ev
    from corpusloom.plans import fixtures as fx

    monkeypatch.setattr(fx, "LINE_BYTES", 4096)
    monkeypatch.setattr(ev, "PART_BYTES", 256)
    for rows, dealt in ((ev.checked(spark, SF), fx.math(spark, SF)), (ev.judged(spark, SF), ev.problems(spark, SF))):
        assert rows.rdd.getNumPartitions() == dealt.rdd.getNumPartitions() > 8


def test_letters_meet_their_problems_in_a_task_per_piece_of_a_table_in_many_files(spark, monkeypatch, tmp_path):
    """Many small files are no reason to leave the join to a fixed number of tasks."""
    from corpusloom.plans import evals as ev

    part = spark.read.parquet(f"{SF}/part.parquet")
    part.repartition(40).write.parquet(str(tmp_path / "part.parquet"))
    size = sum(f.stat().st_size for f in (tmp_path / "part.parquet").glob("*.parquet"))
    monkeypatch.setattr(ev, "PART_BYTES", size // 20)
    few, many = ev.judged(spark, SF), ev.judged(spark, str(tmp_path))
    assert 20 <= many.rdd.getNumPartitions() <= 21
    assert sorted(map(str, many.collect())) == sorted(map(str, few.collect()))
