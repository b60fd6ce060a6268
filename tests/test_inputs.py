"""Input that the test tables do not hold: odd JSON lines, white space, folders, turns and parts."""

import json

import pytest
from pyspark.sql import functions as F

from corpusloom import session
from corpusloom.functions import text as tx
from corpusloom.operators import conversations as cv
from corpusloom.operators import pack, prefix
from corpusloom.sources import scan

TOK = tx.ByteTokenizer()


def lines(spark, *rows):
    return spark.createDataFrame([(x if isinstance(x, str) else json.dumps(x),) for x in rows], "value string").coalesce(1)


def pair(content):
    return [{"role": "user", "content": content}, {"role": "assistant", "content": "x"}]


def test_content_must_be_text(spark):
    df = lines(spark, pair(5), pair(["a"]), pair(None), pair("5"), pair(""))
    found = [r[0] for r in scan.parse_message_lines(df).select(scan.message_violations()).collect()]
    assert found == [["content_not_text"], ["content_not_text"], ["missing_content"], [], []]
    with pytest.raises(Exception, match="content_not_text"):
        scan.conversations_strict(lines(spark, pair(5))).collect()


def test_white_space_around_lines(spark):
    df = lines(spark, "\t", "　", "\t" + json.dumps(pair("a")), json.dumps(pair("b")) + "\r")
    assert scan.conversations_strict(df).count() == 2
    assert scan.conversations_lenient(df).count() == 2
    words = scan.word_list(spark.createDataFrame([("abc\r",), ("\tx ",)], "value string")).collect()
    assert [r.word for r in words] == ["abc", "x"]


def test_readers_of_lines(spark, tmp_path):
    assert scan.read_conversations(spark, str(tmp_path / "none")).count() == 0
    (tmp_path / "in.jsonl").write_text(json.dumps(pair("a")) + "\n\n" + json.dumps(pair("é")) + "\n")
    assert scan.read_conversations(spark, str(tmp_path / "in.jsonl")).count() == 2
    (tmp_path / "bad.jsonl").write_text("[{\n" + json.dumps(pair("a")))
    assert scan.read_conversations(spark, str(tmp_path / "bad.jsonl"), strict=False).count() == 1
    with pytest.raises(Exception, match="bad conversation"):
        scan.read_conversations(spark, str(tmp_path / "bad.jsonl")).collect()


def test_an_empty_folder_is_no_obstacle(spark, tmp_path):
    (tmp_path / "out").mkdir()
    scan.guarded_overwrite(spark.range(3), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_any_number_of_shards(spark):
    present = spark.createDataFrame([(3,), (4999,)], "shard_id long")
    assert scan.missing_shards(spark, present, 5000).count() == 4998


def test_text_column_of_a_table_without_one(spark):
    assert scan.pick_text_column(spark.range(2)).collect()[0].text is None


@pytest.mark.parametrize("first", [0, 5000])
def test_long_conversations_keep_all_turns(spark, first):
    rows = spark.range(2060).select(F.lit(1).alias("conv_id"), (F.col("id") + first).alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.lit("t").alias("text"))
    held = cv.gather_messages(rows)
    assert held.select(F.size("messages")).first()[0] == 2060
    assert len(cv.render_for_completion(held, TOK).first()["ids"]) == 2049


def test_parts_are_checked(spark):
    kind = "messages array<struct<role:string,parts:array<struct<type:string,text:string>>,is_plain:boolean>>"
    plain = ("user", [("text", "u")], True)
    image = spark.createDataFrame([([plain, ("assistant", [("image", "x")], False)],)], kind)
    with pytest.raises(Exception, match="python_output"):
        cv.render(image, TOK).collect()
    many = spark.createDataFrame([([("user", [("text", "u"), ("text", "v")], False), ("assistant", [("text", "x")], True)],)], kind)
    with pytest.raises(Exception, match="must be plain"):
        cv.render(many, TOK).collect()


def test_shared_folder(spark, monkeypatch, tmp_path):
    assert session.is_local("local[8]") and session.is_local("local") and not session.is_local("local-cluster[2,1,1024]") and not session.is_local("yarn")
    assert session.new_dir(spark, "x") != session.new_dir(spark, "x")
    with session.scratch(spark) as paths:
        df = session.materialize(spark.range(5), "kept")
        assert df.count() == 5
    assert len(paths) == 1 and not scan.holds_parquet(spark, paths[0])

    class Cluster:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master = "yarn"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.work_dir(Cluster)


def test_byte_ids(spark):
    rows = ["", None, "aé", "\U0001f600x"]
    df = spark.createDataFrame([(t, [t, "z", None]) for t in rows], "t string, ts array<string>").repartition(1)
    out = df.select("t", TOK.encode("t").alias("ids"), TOK.encode_each(F.col("ts")).alias("each")).collect()
    for r in out:
        want = None if r.t is None else list(r.t.encode())
        assert r.ids == want and r.each == [want, [122], None]


def test_no_single_partition_window_over_rows(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), F.lit(1).alias("n"))
    plan = prefix.prefix_sums(df, ["k"], {"s": F.col("n")})._jdf.queryExecution().executedPlan().toString()
    totals = plan.count("SinglePartition")
    assert "Window" in plan and totals <= 1  # only the totals of the buckets meet in one task
    assert "hashpartitioning(_b" in plan.replace("#", " ").replace("hashpartitioning( _b", "hashpartitioning(_b")


def test_budget_reads_the_key_range_of_the_boundary(spark, tmp_path, monkeypatch):
    spark.range(4000).select(F.col("id").alias("k"), F.lit("ab").alias("t")).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    assert prefix.budget_cutoff(df, ["k"], F.length("t"), 2 * 1234, keep_crossing=False, rows_per_bucket=100) == (1233,)
    assert prefix.budget_cutoff(df, ["k"], F.length("t"), 2 * 1234, keep_crossing=True, rows_per_bucket=100) == (1234,)


def test_one_more_document_deals_no_other_anew(spark):
    group = pack.pack_groups(8, "id")
    a = {r.id: r.g for r in spark.range(5000).select("id", group.alias("g")).collect()}
    b = {r.id: r.g for r in spark.range(5001).select("id", group.alias("g")).collect()}
    assert all(b[i] == g for i, g in a.items()) and len(set(a.values())) == 8
