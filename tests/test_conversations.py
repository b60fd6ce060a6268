import json

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import answers as an
from corpusloom.functions import text as tx
from corpusloom.operators import adapters
from corpusloom.operators import conversations as cv
from corpusloom.sources import scan

TOK = tx.ByteTokenizer()
S = [256 + i for i in range(9)]


def model(messages):
    """Ids and mask of a conversation, message by message."""
    ids, mask = [S[0]], [0]

    def add(more, bit):
        ids.extend(more)
        mask.extend([bit] * len(more))

    for role, parts in messages:
        if role == "user":
            add([S[1], *parts[0][1].encode(), S[2]], 0)
            continue
        add([S[3]], 0)
        for kind, text in parts:
            b = list(text.encode())
            if kind == "text":
                add(b, 1)
            elif kind == "python":
                add([S[5], *b, S[6]], 1)
            else:
                add([S[7], *b, S[8]], 0)
        add([S[4]], 1)
    return ids, mask


CONVERSATIONS = [
    [("user", [("text", "héllo")]), ("assistant", [("text", "안녕 🌍")])],
    [("user", [("text", "")]), ("assistant", [("text", "")]), ("user", [("text", "x")])],
    [("user", [("text", "q")]), ("assistant", [("text", "a "), ("python", "1+1"), ("python_output", "2"), ("text", ".")])],
    [("user", [("text", "q")]), ("assistant", [("python", "1"), ("python_output", "")])],
    [("user", [("text", "x" * 3000)]), ("assistant", [("text", "y")])],
]
KIND = "id int, messages array<struct<role:string,parts:array<struct<type:string,text:string>>,is_plain:boolean>>"


def frame(spark, conversations):
    rows = [(i, [(r, p, len(p) == 1) for r, p in c]) for i, c in enumerate(conversations)]
    return spark.createDataFrame(rows, KIND)


def test_render(spark):
    for r in cv.render(frame(spark, CONVERSATIONS), TOK).collect():
        ids, mask = model(CONVERSATIONS[r["id"]])
        assert (r["ids"], r["mask"]) == (ids[:2048], mask[:2048])


def test_system_is_merged_and_must_precede_a_user(spark):
    good = [("system", [("text", "s")]), ("user", [("text", "u")]), ("assistant", [("text", "a")])]
    r = cv.render(frame(spark, [good]), TOK).first()
    assert r["ids"] == model([("user", [("text", "s\n\nu")]), good[2]])[0]
    bad = [("system", [("text", "s")]), ("assistant", [("text", "u")])]
    with pytest.raises(Exception, match="must be followed by a user"):
        cv.render(frame(spark, [bad]), TOK).collect()


def test_roles_must_alternate(spark):
    bad = [("user", [("text", "s")]), ("user", [("text", "u")])]
    with pytest.raises(Exception, match="alternate"):
        cv.render(frame(spark, [bad]), TOK).collect()


def test_completion_drops_the_last_message(spark):
    r = cv.render_for_completion(frame(spark, CONVERSATIONS[:1]), TOK).first()
    assert r["ids"] == model(CONVERSATIONS[0][:1])[0] + [S[3]]
    with pytest.raises(Exception, match="come from the assistant"):
        cv.render_for_completion(frame(spark, CONVERSATIONS[1:2]), TOK).collect()


def test_targets(spark):
    df = spark.createDataFrame([([5, 6, 7], [0, 1, 0]), ([9], [0])], "ids array<int>, mask array<int>")
    inputs, targets = cv.next_token_targets()
    rows = df.select(inputs.alias("i"), targets.alias("t"), cv.supervised_targets().alias("s"), cv.supervised_count().alias("n")).collect()
    assert [tuple(r) for r in rows] == [([5, 6], [6, 7], [6, -1], 1), ([], [], [], 0)]


LINES = [
    json.dumps([{"role": "user", "content": "hi"}, {"role": "assistant", "content": "héllo"}], ensure_ascii=False),
    "   ",
    json.dumps([{"role": "assistant", "content": "hi"}, {"role": "user", "content": "x"}]),
    json.dumps([{"role": "user", "content": "hi"}]),
    '{"role": "user"}',
    "[{",
    json.dumps([{"role": "user"}, {"role": "assistant", "content": "x"}]),
]


def test_json_lines(spark, tmp_path):
    lines = spark.createDataFrame([(x,) for x in LINES], "value string").coalesce(1)
    found = [r[0] for r in scan.parse_message_lines(lines).select(scan.message_violations()).collect()]
    assert found == [[], ["wrong_role_order"], ["too_few_messages"], ["not_a_list"], ["not_a_list"], ["missing_content"]]
    assert scan.conversations_strict(lines, strict=False).count() == 1
    with pytest.raises(Exception, match="bad conversation"):
        scan.conversations_strict(lines).collect()
    lenient = scan.conversations_lenient(lines)
    assert lenient.count() == 3  # roles are not checked
    scan.write_jsonl(lenient.limit(1), str(tmp_path / "out"))
    assert json.loads(spark.read.text(str(tmp_path / "out")).first()[0]) == json.loads(LINES[0])


def test_guarded_overwrite(spark, tmp_path):
    path = str(tmp_path / "t")
    scan.guarded_overwrite(spark.range(3), path)
    with pytest.raises(Exception, match="(?i)already exists"):
        scan.guarded_overwrite(spark.range(4), path)
    scan.guarded_overwrite(spark.range(4), path, overwrite=True)
    assert spark.read.parquet(path).count() == 4


def test_shards_carry_their_position(spark, tmp_path):
    assert scan.read_shards(spark, str(tmp_path / "none")).count() == 0
    for i in range(2):
        spark.createDataFrame([(f"{i}-{j}",) for j in range(5)], "text string").coalesce(1).write.parquet(str(tmp_path / "in"), mode="append")
    (tmp_path / "in" / "shard_00009.parquet.tmp").write_bytes(b"unfinished")
    docs = scan.read_shards(spark, str(tmp_path / "in"))
    assert docs.select("shard").distinct().count() == 2
    worker = scan.rank_stride(docs, 2, group_rows=2)
    assert sorted(r["worker"] for r in worker.collect()) == [0] * 6 + [1] * 4


def test_limits_and_alternation(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (2, 0, "system", "s"), (2, 1, "user", ""), (2, 2, "assistant", "x" * 8001)]
    rows += [(3, i, "user", "x" * 100) for i in range(501)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r[0]: r[1] for r in cv.conversation_limits(df).collect()}
    assert got == {1: [], 2: ["empty_message", "message_too_long", "invalid_role"], 3: ["too_many_messages", "conversation_too_long"]}
    ok = {r["conv_id"]: r["alternates"] for r in cv.role_alternation(df).collect()}
    assert ok == {1: True, 2: True, 3: False}


def test_extract_messages_layouts(spark):
    df = spark.createDataFrame([("i", "in", "o"), ("i", None, "o"), (" i ", "", "o"), (None, "x", "o")], "instruction string, input string, output string")
    got = [[(m["role"], m["parts"][0]["text"]) for m in r["messages"]] for r in cv.extract_messages(df.coalesce(1)).collect()]
    assert got == [[("user", q), ("assistant", "o")] for q in ("in i", "i", "i")]


def test_adapters(spark):
    arc = spark.createDataFrame([("q", (["x", "y", "z"], ["A", "B", "C"]), "B")], "question string, choices struct<text:array<string>,label:array<string>>, answerKey string")
    code = spark.createDataFrame([("p", "s", "f", "t")], "prompt string, canonical_solution string, entry_point string, test string")
    math = spark.createDataFrame([("q", "1+1=<<1+1=2>>2\n#### 2")], "question string, answer string")
    solved = spark.createDataFrame([("p", "long solution")], "problem string, generated_solution string")
    rows = adapters.adapt([("arc", "keyed_choice", arc), ("code", "code", code), ("math", "math", math), ("cot", "solution", solved)])
    got = {r["task"]: [[(p["type"], p["text"]) for p in m["parts"]] for m in r["messages"]] for r in rows.collect()}
    assert got["arc"][0][0][1] == "Multiple Choice question: q\n- x=A\n- y=B\n- z=C\n\nRespond only with the letter of the correct answer."
    assert got["arc"][1] == [("text", "B")] and got["code"][1] == [("text", "p\ns")] and got["cot"][1] == [("text", "long solution")]
    assert got["math"][1] == [("text", "1+1="), ("python", "1+1"), ("python_output", "2"), ("text", "2\n#### 2")]
    with pytest.raises(Exception, match="one of the letters"):
        adapters.ADAPTERS["keyed_choice"](arc.withColumn("answerKey", F.lit("D"))).collect()


def test_tool_calls_without_result(spark):
    df = spark.createDataFrame([("<<a=b=3>>",), ("x<<5>>y",), ("plain",), ("",)], "t string").coalesce(1)
    got = [[tuple(p) for p in r[0]] for r in df.select(an.tool_call_parts(F.col("t"))).collect()]
    assert got == [
        [("text", ""), ("python", "a=b"), ("python_output", "3"), ("text", "")],
        [("text", "x"), ("python", "5"), ("python_output", ""), ("text", "y")],
        [("text", "plain")],
        [("text", "")],
    ]


def test_answers(spark):
    df = spark.createDataFrame([("#### 1,234.",), ("#### -5 #### 6",), ("none",), ("####7",)], "t string").coalesce(1)
    assert [r[0] for r in df.select(an.extract_answer(F.col("t"))).collect()] == ["1234.", "-5", None, None]
    pair = spark.createDataFrame([("#### 1", "#### 1"), ("x", "#### 1"), ("x", "y")], "p string, r string").coalesce(1)
    assert [r[0] for r in pair.select(an.answer_correct(F.col("p"), F.col("r"))).collect()] == [True, False, True]


def test_calculator(spark):
    cases = {
        "12*3": "36", "1,000+1": "1001", "7/2": "3.5", "7//2": "3", "-(2+3)*4": "-20", "2**9": None, "1/0": None, "5(3)": None, "": None,
        "'strawberry'.count('r')": "3", '"aa".count("a")': "2", "'import'.count('i')": None, "'a'.upper()": None, "__import__('os')": None,
        "'direct'.count('r')": None, "1 +": None, "(": None,
    }
    df = spark.createDataFrame([(k,) for k in cases] + [(None,)], "e string").coalesce(1)
    assert [r[0] for r in df.select(an.calculator("e")).collect()] == [*cases.values(), None]


def test_programs(spark):
    df = spark.createDataFrame([("a\n```python\nx = 1\n```\n```\ny\n```",), ("  plain \n",), ("```\n\n```",)], "c string").coalesce(1)
    assert [r[0] for r in df.select(an.extract_program(F.col("c"))).collect()] == ["x = 1", "plain", ""]
    prompts = spark.createDataFrame([("# c\n\nimport a\n  from b import c\ndef f():\n  import d",), ("x",)], "p string").coalesce(1)
    assert [r[0] for r in prompts.select(an.extract_imports(F.col("p"))).collect()] == ["import a\nfrom b import c", ""]
