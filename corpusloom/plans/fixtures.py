"""Inputs that the given tables do not hold, derived from them: each as a DataFrame and as a SQL CTE."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.det import u
from corpusloom.operators.prefix import number_rows
from corpusloom.plans.registry import sql_u, table
from corpusloom.sources.scan import spread

#: bytes of the file of ``lineitem`` for a task; every row becomes a conversation or a few
LINE_BYTES = 4 << 20

# --- word pool: the distinct words of ``benchmark`` in word order ------------------------------------

WORDS = """words AS (SELECT word, row_number() OVER (ORDER BY word) - 1 AS idx FROM
  (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]{3,}')) AS word FROM benchmark)),
  n_words AS (SELECT count(*) AS n FROM words)"""


def words(spark, sf):
    """(idx, word) and the number of words; buckets come from the first two letters."""
    found = table(spark, sf, "benchmark").select(
        F.explode(F.regexp_extract_all(F.lower("text"), F.lit("([a-z]{3,})"))).alias("word")
    )
    pool = found.distinct().withColumn("_h", (F.ascii("word") * 256 + F.ascii(F.substring("word", 2, 1))).cast("long"))
    rows = number_rows(pool, ["_h", "word"], "idx")
    return rows.select("word", (F.col("idx") - 1).alias("idx")), pool.count()


# --- conversations with every seventh role changed and every eleventh text blank ---------------------

BAD_TURNS = """bad AS (SELECT conv_id, turn,
  CASE WHEN (conv_id * 10 + turn) % 7 = 0
       THEN CASE role WHEN 'user' THEN 'assistant' WHEN 'assistant' THEN 'user' ELSE 'tool' END ELSE role END AS role,
  CASE WHEN (conv_id * 10 + turn) % 11 = 0 THEN '' ELSE text END AS text FROM conversations)"""


def bad_turns(spark, sf):
    n = F.col("conv_id") * 10 + F.col("turn")
    other = F.when(F.col("role") == "user", "assistant").when(F.col("role") == "assistant", "user").otherwise("tool")
    return table(spark, sf, "conversations").select(
        "conv_id", "turn",
        F.when(n % 7 == 0, other).otherwise(F.col("role")).alias("role"),
        F.when(n % 11 == 0, F.lit("")).otherwise(F.col("text")).alias("text"),
    )


def json_lines(turns):
    """One JSON array of messages per conversation."""
    gathered = turns.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))).alias("m")
    )
    messages = F.transform("m", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content")))
    return gathered.select("conv_id", F.to_json(messages).alias("value"))


# --- questions with a worked answer and a tool call, from ``lineitem`` -------------------------------

MATH = """math AS (SELECT key, q, n, r, flag, 'What is ' || q || ' times ' || n || '?' AS question,
  q || ' times ' || n || ' is <<' || q || '*' || n || '=' || r || '>>' || r || '.' || chr(10) || '#### ' || r AS answer
  FROM (SELECT l_orderkey || ':' || l_linenumber || ':' || l_partkey || ':' || l_suppkey AS key, l_returnflag AS flag,
               CAST(l_quantity AS INT) AS q, l_linenumber AS n, CAST(l_quantity AS INT) * l_linenumber AS r FROM lineitem))"""


def _text(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def math(spark, sf):
    q, n, r = F.col("q"), F.col("n"), F.col("r")
    rows = table(spark, sf, "lineitem").select(
        _text(F.col("l_orderkey"), ":", F.col("l_linenumber"), ":", F.col("l_partkey"), ":", F.col("l_suppkey")).alias("key"),
        F.col("l_returnflag").alias("flag"),
        F.col("l_quantity").cast("int").alias("q"),
        F.col("l_linenumber").alias("n"),
        (F.col("l_quantity").cast("int") * F.col("l_linenumber")).alias("r"),
    )
    # dealt by the key that completions and questions meet by, so that their join has as many tasks and no shuffle of its own
    rows = spread(rows, "key", LINE_BYTES)
    return rows.select(
        "*",
        _text("What is ", q, " times ", n, "?").alias("question"),
        _text(q, " times ", n, " is <<", q, "*", n, "=", r, ">>", r, ".\n#### ", r).alias("answer"),
    )


# completions of the questions: three in ten are off by one, one in ten lacks the answer line
COMPLETIONS = f"""completions AS (SELECT key, n AS sample, CASE WHEN d < 0.1 THEN q || ' times ' || n || ' is ' || r
  WHEN d < 0.3 THEN 'It is ' || (r + 1) || '.' || chr(10) || '#### ' || (r + 1) || ' is it'
  ELSE 'It is ' || r || '.' || chr(10) || '#### ' || r || ',' END AS completion
  FROM (SELECT *, {sql_u('c', 'key')} AS d FROM math))"""


def completions(spark, sf):
    q, n, r = F.col("q"), F.col("n"), F.col("r")
    d = u("c", "key")
    wrong = (r + 1).cast("string")
    return math(spark, sf).select(
        "key",
        n.alias("sample"),
        F.when(d < 0.1, _text(q, " times ", n, " is ", r))
        .when(d < 0.3, _text("It is ", wrong, ".\n#### ", wrong, " is it"))
        .otherwise(_text("It is ", r, ".\n#### ", r, ","))
        .alias("completion"),
    )


# --- multiple choice questions, from ``part`` --------------------------------------------------------

CHOICE = """choice AS (SELECT p_partkey, p_name AS question, p_type AS subject, p_partkey % 4 AS answer,
  ['Brand#' || ((p_size + 0) % 5 + 1), 'Brand#' || ((p_size + 1) % 5 + 1),
   'Brand#' || ((p_size + 2) % 5 + 1), 'Brand#' || ((p_size + 3) % 5 + 1)] AS choices FROM part)"""


def choice(spark, sf):
    option = lambda i: F.concat(F.lit("Brand#"), ((F.col("p_size") + i) % 5 + 1).cast("string"))
    return table(spark, sf, "part").select(
        "p_partkey",
        F.col("p_name").alias("question"),
        F.col("p_type").alias("subject"),
        (F.col("p_partkey") % 4).alias("answer"),
        F.array(*[option(i) for i in range(4)]).alias("choices"),
    )


# --- question-answer rows that fill different columns ------------------------------------------------

MIXED_QA = """qa AS (SELECT conv_id, turn,
  CASE WHEN k = 0 THEN 'Q ' || text END AS question, CASE WHEN k IN (0, 3) THEN 'A ' || role END AS answer,
  CASE WHEN k = 1 THEN 'I ' || text END AS instruction, CASE WHEN k IN (1, 2) THEN 'O ' || role END AS output,
  CASE WHEN k IN (2, 3) THEN 'N ' || text END AS input, CASE WHEN k = 4 THEN 'R ' || role END AS response
  FROM (SELECT *, (conv_id + turn) % 5 AS k FROM conversations))"""


def mixed_qa(spark, sf):
    k = (F.col("conv_id") + F.col("turn")) % 5
    say = lambda p, c, *on: F.when(k.isin(*on), F.concat(F.lit(p), F.col(c)))
    return table(spark, sf, "conversations").select(
        "conv_id", "turn",
        say("Q ", "text", 0).alias("question"), say("A ", "role", 0, 3).alias("answer"),
        say("I ", "text", 1).alias("instruction"), say("O ", "role", 1, 2).alias("output"),
        say("N ", "text", 2, 3).alias("input"), say("R ", "role", 4).alias("response"),
    )


# --- byte ids in SQL ---------------------------------------------------------------------------------


def sql_bytes(text: str) -> str:
    """SQL list of the UTF-8 byte values of a text."""
    return f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: CAST('0x' || h AS INT))"


def sql_join(ids: str) -> str:
    return f"array_to_string({ids}, ',')"


def joined(ids: str | Column) -> Column:
    """Ids as comma separated text."""
    ids = F.col(ids) if isinstance(ids, str) else ids
    return F.array_join(ids.cast("array<string>"), ",")


def sql_strings(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


