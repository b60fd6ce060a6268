"""Evaluation inputs, prompts, spans, scores and metrics.

Items come from ``benchmark``, multiple choice questions and samples from ``part``, math questions from ``lineitem``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import answers as an
from corpusloom.functions import text as tx
from corpusloom.functions.det import u
from corpusloom.operators import adapters, evals
from corpusloom.operators import conversations as cv
from corpusloom.operators.bpe import vocab_table
from corpusloom.plans import fixtures as fx
from corpusloom.plans.chat import MERGED, rendered, sql_rendered
from corpusloom.plans.registry import query, sql_u, table
from corpusloom.session import materialize, new_dir
from corpusloom.sources.scan import spread

TOK = tx.ByteTokenizer()
SHOTS = 3
#: bytes of the file of ``part`` for a task; every row makes several
PART_BYTES = 1 << 20
DELIM = " "

# --- items -----------------------------------------------------------------------------------------

ITEMS = f"""
  ws AS (SELECT item_id, string_split(text, ' ') AS ws, row_number() OVER (ORDER BY {sql_u(1337, 'item_id')}, item_id) - 1 AS idx
         FROM benchmark),
  half AS (SELECT idx, item_id, array_to_string(ws[:len(ws) // 2], ' ') AS context,
                  array_to_string(ws[len(ws) // 2 + 1:], ' ') AS continuation, item_id % 4 AS gold FROM ws),
  n_items AS (SELECT count(*) AS n FROM half),
  opts AS (SELECT h.idx, p, o.continuation, o.context FROM half h CROSS JOIN range(4) t(p) CROSS JOIN n_items
           JOIN half o ON o.idx = (h.idx + (p - h.gold + 4) % 4) % n_items.n),
  lists AS (SELECT idx, list(continuation ORDER BY p) AS choices, list(context ORDER BY p) AS contexts FROM opts GROUP BY idx),
  items AS (SELECT * FROM half JOIN lists USING (idx))"""


def halves(spark, sf):
    bench = table(spark, sf, "benchmark")
    ws = F.split("text", " ")
    cut = F.floor(F.size(ws) / 2).cast("int")
    split = bench.select(
        "item_id",
        F.array_join(F.slice(ws, 1, cut), " ").alias("context"),
        F.array_join(F.slice(ws, cut + 1, F.size(ws)), " ").alias("continuation"),
        (F.col("item_id") % 4).alias("gold"),
    )
    return split.join(evals.eval_items(bench, "item_id"), "item_id")


def items(spark, sf):
    half = halves(spark, sf)
    n = table(spark, sf, "benchmark").count()
    want = half.select("idx", "gold", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("p"))
    want = want.withColumn("o", F.pmod(F.col("idx") + F.pmod(F.col("p") - F.col("gold"), F.lit(4)), F.lit(n)))
    other = half.select(F.col("idx").alias("o"), "context", "continuation")
    lists = want.join(other, "o").groupBy("idx").agg(
        F.array_sort(F.collect_list(F.struct("p", "context", "continuation"))).alias("l")  # four rows
    )
    lists = lists.select("idx", F.col("l.continuation").alias("choices"), F.col("l.context").alias("contexts"))
    return half.join(lists, "idx")


@query(
    "eval_items",
    f"""WITH {ITEMS} SELECT idx, item_id, context, continuation, gold FROM items""",
)
def eval_items(spark, sf):
    """Items written and read as JSON lines, then shuffled."""
    path = new_dir(spark, "eval-items")
    kept = items(spark, sf).select("item_id", "context", "continuation", "gold")
    kept.select(F.to_json(F.struct("*")).alias("value")).write.mode("overwrite").text(path)
    again = spark.read.schema("item_id long, context string, continuation string, gold long").json(path)
    return again.join(evals.eval_items(again, "item_id"), "item_id").select("idx", "item_id", "context", "continuation", "gold")


@query(
    "task_config",
    """SELECT p_type AS label, CASE count(*) % 2 WHEN 0 THEN 'multiple_choice' ELSE 'language_modeling' END AS task_type,
         'eval/' || lower(p_type) || '.jsonl' AS dataset_uri, CAST(count(*) % 10 AS INT) AS num_fewshot,
         CASE count(*) % 2 WHEN 0 THEN chr(10) ELSE ' ' END AS continuation_delimiter FROM part GROUP BY p_type""",
)
def task_config(spark, sf):
    counts = table(spark, sf, "part").groupBy("p_type").count()
    even = F.col("count") % 2 == 0
    config = counts.select(
        F.col("p_type").alias("label"),
        F.when(even, "multiple_choice").otherwise("language_modeling").alias("icl_task_type"),
        F.concat(F.lit("eval/"), F.lower("p_type"), F.lit(".jsonl")).alias("dataset_uri"),
        F.array((F.col("count") % 10).cast("int"), F.lit(0)).alias("num_fewshot"),
        F.when(even, F.lit("\n")).alias("continuation_delimiter"),
    )
    return evals.task_config(config)


BASELINES = "baselines AS (SELECT p_type AS task, round(avg(p_size), 3) AS baseline FROM part GROUP BY p_type)"


def baselines(spark, sf):
    sizes = table(spark, sf, "part").groupBy(F.col("p_type").alias("task")).agg(F.round(F.avg("p_size"), 3).alias("baseline"))
    path = new_dir(spark, "baselines")
    out = sizes.select(F.col("task").alias("Eval Task"), F.col("baseline").alias("Random baseline"))
    out.coalesce(1).write.mode("overwrite").csv(path, header=True)
    return evals.random_baselines(spark, path)


@query("random_baselines", f"WITH {BASELINES} SELECT task, baseline FROM baselines")
def random_baselines(spark, sf):
    return baselines(spark, sf)


# --- few-shot prompts ------------------------------------------------------------------------------

FEW = f"""{ITEMS},
  ring AS (SELECT idx, row_number() OVER (ORDER BY {sql_u(1234, 'idx')}, idx) - 1 AS r FROM half),
  few AS (SELECT a.idx, j, b.idx AS partner FROM ring a CROSS JOIN range(1, {SHOTS + 1}) t(j) CROSS JOIN n_items
          JOIN ring b ON b.r = (a.r + j) % n_items.n)"""


def sql_prefix(block: str) -> str:
    return f"""{FEW},
  prefix AS (SELECT f.idx, string_agg({block} || chr(10) || chr(10), '' ORDER BY j) AS prefix
             FROM few f JOIN items p ON p.idx = f.partner GROUP BY f.idx)"""


MC = sql_prefix("p.context || ' ' || p.choices[p.gold + 1]") + """,
  prompts AS (SELECT idx, o AS option_idx, prefix || context || ' ' || choices[o + 1] AS prompt
              FROM items JOIN prefix USING (idx) CROSS JOIN range(4) t(o))"""
SCHEMA = sql_prefix("p.contexts[p.gold + 1] || ' ' || p.continuation") + """,
  prompts AS (SELECT idx, o AS option_idx, prefix || contexts[o + 1] || ' ' || continuation AS prompt
              FROM items JOIN prefix USING (idx) CROSS JOIN range(4) t(o))"""
LM = sql_prefix("trim(p.context) || ' ' || p.continuation") + """,
  prompts AS (SELECT idx, o AS option_idx, CASE o WHEN 0 THEN trim(prefix || trim(context) || ' ')
                ELSE prefix || trim(context) || ' ' || continuation END AS prompt
              FROM items JOIN prefix USING (idx) CROSS JOIN range(2) t(o))"""
KINDS = {"multiple_choice": MC, "schema": SCHEMA, "language_modeling": LM}


@query("fewshot_sample", f"WITH {FEW} SELECT idx, CAST(j AS INT) AS j, partner FROM few")
def fewshot_sample(spark, sf):
    return evals.fewshot_sample(halves(spark, sf), "idx", SHOTS)


def prepared(spark, sf):
    """The item table, written once, and the few-shot partners of every item."""
    all_items = materialize(items(spark, sf), "items")
    return all_items, evals.fewshot_sample(all_items.select("idx"), "idx", SHOTS)


def prompts(spark, sf, kind, base=None):
    all_items, pairs = base or prepared(spark, sf)
    c = F.col
    blocks = {
        "multiple_choice": evals.mc_block(c("context"), DELIM, c("choices"), c("gold")),
        "schema": evals.mc_block(F.element_at("contexts", (c("gold") + 1).cast("int")), DELIM, F.array("continuation"), F.lit(0)),
        "language_modeling": evals.lm_block(c("context"), DELIM, c("continuation")),
    }
    rows = all_items.join(evals.fewshot_prefix(pairs, all_items, "idx", blocks[kind]), "idx")
    built = {
        "multiple_choice": evals.mc_prompts(c("prefix"), c("context"), DELIM, c("choices")),
        "schema": evals.schema_prompts(c("prefix"), c("contexts"), DELIM, c("continuation")),
        "language_modeling": evals.lm_prompts(c("prefix"), c("context"), DELIM, c("continuation")),
    }
    return rows.select("idx", "gold", built[kind].alias("prompts"))


def exploded_prompts(spark, sf, kind):
    rows = prompts(spark, sf, kind).select("idx", F.posexplode_outer("prompts").alias("option_idx", "prompt"))
    return rows.withColumn("option_idx", F.col("option_idx").cast("long"))


@query("render_prompts_mc", f"WITH {MC} SELECT idx, option_idx, prompt FROM prompts")
def render_prompts_mc(spark, sf):
    return exploded_prompts(spark, sf, "multiple_choice")


@query("render_prompts_schema", f"WITH {SCHEMA} SELECT idx, option_idx, prompt FROM prompts")
def render_prompts_schema(spark, sf):
    return exploded_prompts(spark, sf, "schema")


@query("render_prompts_lm", f"WITH {LM} SELECT idx, option_idx, prompt FROM prompts")
def render_prompts_lm(spark, sf):
    return exploded_prompts(spark, sf, "language_modeling")


# --- spans -----------------------------------------------------------------------------------------


def sql_spans(kind: str) -> str:
    """Spans of one task type; positions count from 0 with the document start at 0."""
    head = f"""{KINDS[kind]},
  toks AS (SELECT idx, option_idx, list_concat([256], {fx.sql_bytes('prompt')}) AS ids FROM prompts)"""
    if kind == "language_modeling":
        return head + """,
  spans AS (SELECT w.idx, 0 AS option_idx, w.ids, len(o.ids) AS start_idx, len(w.ids) AS end_idx
            FROM toks o JOIN toks w ON w.idx = o.idx AND o.option_idx = 0 AND w.option_idx = 1)"""
    turned = "list_reverse(ids)" if kind == "schema" else "ids"
    return head + f""",
  us AS (SELECT idx, option_idx, unnest(range(len(ids))) AS pos, unnest({turned}) AS id FROM toks),
  same AS (SELECT idx, pos FROM us GROUP BY idx, pos HAVING count(*) = 4 AND count(DISTINCT id) = 1),
  lens AS (SELECT idx, min(len(ids)) AS m FROM toks GROUP BY idx),
  common AS (SELECT l.idx, min(p) AS c FROM (SELECT idx, unnest(range(m + 1)) AS p FROM lens) l
             LEFT JOIN same s ON s.idx = l.idx AND s.pos = l.p WHERE s.pos IS NULL GROUP BY l.idx),
  spans AS (SELECT idx, option_idx, ids, {'len(ids) - c' if kind == 'schema' else 'c'} AS start_idx, len(ids) AS end_idx
            FROM toks JOIN common USING (idx))"""


def spans(spark, sf, kind, base=None):
    # prompts are kept as a table, like the items: encoding them reads that table on all cores
    text = spread(materialize(prompts(spark, sf, kind, base), "prompts"), "idx")
    rows = text.select("idx", "gold", evals.option_ids(TOK, F.col("prompts")).alias("options"))
    return evals.explode_spans(evals.with_spans(rows, kind), ["idx", "gold"])


def union_sql(make) -> str:
    """The same CTE chain for the three task types, one result below the other."""
    return " UNION ALL ".join(f"SELECT * FROM (WITH {sql_spans(k)} {make(k)})" for k in KINDS)


def all_spans(spark, sf) -> DataFrame:
    base = prepared(spark, sf)
    parts = [spans(spark, sf, k, base).withColumn("task", F.lit(k)) for k in KINDS]
    return reduce(DataFrame.unionByName, parts)


@query(
    "common_span",
    union_sql(
        lambda k: f"SELECT '{k}' AS task, idx, CAST(option_idx AS INT) AS option_idx, CAST(start_idx AS INT) AS start_idx, "
        f"CAST(end_idx AS INT) AS end_idx FROM spans"
    ),
)
def common_span(spark, sf):
    return all_spans(spark, sf).select("task", "idx", "option_idx", "start_idx", "end_idx")


MAX_LEN = 320


@query(
    "left_truncate_span",
    f"""WITH {sql_spans('language_modeling')}, t AS (SELECT *, greatest(len(ids) - {MAX_LEN}, 0) AS crop FROM spans)
    SELECT idx, md5({fx.sql_join(f'ids[greatest(len(ids) - {MAX_LEN}, 0) + 1:]')}) AS ids,
           CAST(start_idx - crop AS INT) AS start_idx, CAST(end_idx - crop AS INT) AS end_idx FROM t""",
)
def left_truncate_span(spark, sf):
    rows = evals.left_truncate(spans(spark, sf, "language_modeling"), MAX_LEN)
    return rows.select("idx", F.md5(fx.joined("ids")).alias("ids"), "start_idx", "end_idx")


def token_scores(rows: DataFrame) -> DataFrame:
    """Stand-in for model output: a loss and a predicted id at every position, as arrays of every option."""
    keys = ("task", "idx", "option_idx")
    positions = F.sequence(F.lit(0), F.size("ids") - 2)
    losses = F.transform(positions, lambda pos: 4 * u("l", *keys, pos))
    hits = F.zip_with(positions, F.slice("ids", F.lit(2), F.size("ids") - 1), lambda pos, nxt: F.when(u("p", *keys, pos) < 0.9, nxt).otherwise(F.lit(0)))
    return rows.select("gold", *keys, losses.alias("losses"), hits.alias("pred_ids"))


KEYS = ["task", "idx", "option_idx"]


def sql_scored(k: str) -> str:
    key = (f"'{k}'", "idx", "option_idx", "pos")
    return f"""SELECT '{k}' AS task, idx, gold, option_idx, avg(4 * {sql_u('l', *key)}) AS mean_loss,
        bool_and({sql_u('p', *key)} < 0.9 OR actual = 0) AS all_predicted
      FROM (SELECT idx, option_idx, p - 1 AS pos, ids[p + 1] AS actual
            FROM (SELECT idx, option_idx, ids, unnest(range(CAST(start_idx AS BIGINT), CAST(end_idx AS BIGINT))) AS p FROM spans))
      JOIN half USING (idx) GROUP BY idx, gold, option_idx"""


SCORED = f"scored AS ({union_sql(sql_scored)})"


def scored(spark, sf):
    # the model run reads the spans from a table, and so do the scores that stand in for it
    rows = spread(materialize(all_spans(spark, sf), "spans"), "idx")
    keys = ["task", "idx", "gold", "option_idx"]
    return evals.array_span_scores(rows, token_scores(rows), keys)


@query(
    "span_score",
    f"""WITH {SCORED} SELECT task, idx, CAST(option_idx AS INT) AS option_idx, round(mean_loss, 6) AS mean_loss, all_predicted FROM scored""",
)
def span_score(spark, sf):
    return scored(spark, sf).select(*KEYS, F.round("mean_loss", 6).alias("mean_loss"), "all_predicted")


OUTCOMES = f"""{SCORED},
  best AS (SELECT task, idx, first(option_idx ORDER BY mean_loss, option_idx) AS option_idx, any_value(gold) AS gold,
                  bool_and(all_predicted) AS all_predicted FROM scored GROUP BY task, idx),
  outcomes AS (SELECT task, idx, CASE WHEN task = 'language_modeling' THEN all_predicted ELSE option_idx = gold END AS is_correct FROM best)"""


def outcomes(spark, sf):
    rows = scored(spark, sf)
    hit = evals.best_option(rows, ["task", "idx"], keep=["gold", "all_predicted"])
    correct = F.when(F.col("task") == "language_modeling", F.col("all_predicted")).otherwise(F.col("option_idx") == F.col("gold"))
    return hit.select("task", "idx", "option_idx", correct.alias("is_correct"))


@query("best_option", f"WITH {OUTCOMES} SELECT task, idx, CAST(option_idx AS INT) AS option_idx FROM best")
def best_option(spark, sf):
    return evals.best_option(scored(spark, sf), ["task", "idx"])


@query("task_accuracy", f"WITH {OUTCOMES} SELECT task, round(avg(CAST(is_correct AS DOUBLE)), 6) AS accuracy FROM outcomes GROUP BY task")
def task_accuracy(spark, sf):
    return evals.task_accuracy(outcomes(spark, sf)).withColumn("accuracy", F.round("accuracy", 6))


# --- multiple choice by letter ---------------------------------------------------------------------

LETTERED = f"""{fx.CHOICE},
  scores AS (SELECT p_partkey, letter, floor(5 * {sql_u('k', 'p_partkey', 'letter')}) AS score
             FROM part CROSS JOIN (SELECT unnest(['A', 'B', 'C', 'D', 'E', 'F']) AS letter)),
  picked AS (SELECT p_partkey, first(letter ORDER BY score DESC, letter) AS letter FROM scores
             WHERE letter IN ('A', 'B', 'C', 'D') GROUP BY p_partkey),
  judged AS (SELECT p_partkey, subject, letter, ['A', 'B', 'C', 'D'][answer + 1] AS reference,
                    letter = ['A', 'B', 'C', 'D'][answer + 1] AS is_correct FROM picked JOIN choice USING (p_partkey))"""


def problems(spark, sf):
    rows = spread(fx.choice(spark, sf), "p_partkey", PART_BYTES).withColumn("letters", an.strings(an.LETTERS))
    return rows.withColumn("reference", an.mc_answer_by_index(F.col("choices"), F.col("answer")))


def picked(spark, sf):
    six = an.strings(["A", "B", "C", "D", "E", "F"])
    scores = spread(table(spark, sf, "part"), "p_partkey", PART_BYTES).select("p_partkey", F.explode(six).alias("letter"))
    scores = scores.withColumn("score", F.floor(5 * u("k", "p_partkey", "letter")))
    return evals.best_letter(scores, problems(spark, sf), "p_partkey")


def judged(spark, sf):
    rows = picked(spark, sf).join(problems(spark, sf).hint("merge"), "p_partkey")
    return rows.withColumn("is_correct", an.letter_correct(F.col("letters"), F.col("letter"), F.col("reference")))


@query("best_letter", f"WITH {LETTERED} SELECT p_partkey, letter FROM picked")
def best_letter(spark, sf):
    return picked(spark, sf)


@query("letter_correct", f"WITH {LETTERED} SELECT p_partkey, letter, reference, is_correct FROM judged")
def letter_correct(spark, sf):
    return judged(spark, sf).select("p_partkey", "letter", "reference", "is_correct")


@query(
    "subject_breakdown",
    f"""WITH {LETTERED} SELECT coalesce(subject, 'ALL') AS subject, count(*) AS n_items,
          round(avg(CAST(is_correct AS DOUBLE)), 6) AS accuracy FROM judged GROUP BY ROLLUP (subject)""",
)
def subject_breakdown(spark, sf):
    rows = judged(spark, sf).rollup("subject").agg(
        F.count(F.lit(1)).alias("n_items"), F.round(F.avg(F.col("is_correct").cast("double")), 6).alias("accuracy")
    )
    return rows.withColumn("subject", F.coalesce("subject", F.lit("ALL")))


ACCURACY = f"""{LETTERED}, {BASELINES},
  accuracy AS (SELECT subject AS task, avg(CAST(is_correct AS DOUBLE)) AS accuracy FROM judged GROUP BY subject)"""


def accuracy(spark, sf):
    return evals.task_accuracy(judged(spark, sf).withColumnRenamed("subject", "task"))


@query(
    "baseline_join",
    f"""WITH {ACCURACY} SELECT task, round(accuracy, 6) AS accuracy, baseline,
          round((accuracy - 0.01 * baseline) / (1.0 - 0.01 * baseline), 6) AS centered FROM accuracy JOIN baselines USING (task)""",
)
def baseline_join(spark, sf):
    rows = evals.core_results(accuracy(spark, sf), baselines(spark, sf))
    return rows.select("task", F.round("accuracy", 6).alias("accuracy"), "baseline", F.round("centered", 6).alias("centered"))


CORE = f"""{ACCURACY},
  results AS (SELECT task, accuracy, (accuracy - CAST(0.01 AS DOUBLE) * baseline) / (1.0 - CAST(0.01 AS DOUBLE) * baseline) AS centered
              FROM accuracy JOIN baselines USING (task))"""


@query("core_metric", f"WITH {CORE} SELECT round(avg(centered), 6) AS core FROM results")
def core_metric(spark, sf):
    results = evals.core_results(accuracy(spark, sf), baselines(spark, sf))
    return evals.core_metric(results).withColumn("core", F.round("core", 6))


@query(
    "core_results_csv",
    f"""WITH {CORE} SELECT task, round(accuracy, 6) AS accuracy, round(centered, 6) AS centered FROM results
        UNION ALL SELECT 'CORE', NULL, round(avg(centered), 6) FROM results""",
)
def core_results_csv(spark, sf):
    path = new_dir(spark, "core-results")
    evals.write_core_results(evals.core_results(accuracy(spark, sf), baselines(spark, sf)), path, mode="overwrite")
    return evals.read_core_results(spark, path)


FRACTIONS = "fractions AS (SELECT p_type AS task, round(avg(p_size), 3) * 0.01 AS baseline FROM part WHERE p_type <> 'SMALL' GROUP BY p_type)"


def fractions(spark, sf):
    rows = table(spark, sf, "part").filter(F.col("p_type") != "SMALL").groupBy(F.col("p_type").alias("task"))
    return rows.agg((F.round(F.avg("p_size"), 3) * 0.01).alias("baseline"))


@query(
    "chat_baseline_join",
    f"""WITH {ACCURACY}, {FRACTIONS} SELECT a.task, round(accuracy, 6) AS accuracy, round(coalesce(f.baseline, 0.0), 6) AS baseline
        FROM accuracy a LEFT JOIN fractions f USING (task)""",
)
def chat_baseline_join(spark, sf):
    rows = evals.chat_baseline_join(accuracy(spark, sf), fractions(spark, sf))
    return rows.select("task", F.round("accuracy", 6).alias("accuracy"), F.round("baseline", 6).alias("baseline"))


@query(
    "chatcore_metric",
    f"""WITH {ACCURACY}, {FRACTIONS},
      c AS (SELECT a.task, (accuracy - coalesce(f.baseline, 0.0)) / (1.0 - coalesce(f.baseline, 0.0)) AS centered
            FROM accuracy a LEFT JOIN fractions f USING (task))
    SELECT round(avg(centered), 6) AS chatcore FROM c HAVING count(DISTINCT task) = (SELECT count(DISTINCT p_type) FROM part)""",
)
def chatcore_metric(spark, sf):
    tasks = [r[0] for r in table(spark, sf, "part").select("p_type").distinct().collect()]  # the task list
    out = evals.chatcore_metric(accuracy(spark, sf), fractions(spark, sf), tasks)
    return out.withColumn("chatcore", F.round("chatcore", 6))


@query(
    "center_accuracy",
    f"WITH {ACCURACY} SELECT task, round((accuracy - 0.25) / (1.0 - 0.25), 6) AS centered FROM accuracy",
)
def center_accuracy(spark, sf):
    return accuracy(spark, sf).select("task", F.round(evals.center(F.col("accuracy"), F.lit(0.25)), 6).alias("centered"))


# --- math answers ----------------------------------------------------------------------------------

ANSWERS = f"""{fx.MATH}, {fx.COMPLETIONS},
  found AS (SELECT key, sample, replace(nullif(regexp_extract(completion, '#### (-?[0-9.,]+)', 1), ''), ',', '') AS predicted FROM completions),
  checked AS (SELECT f.key, sample, predicted, CAST(m.r AS VARCHAR) AS reference, predicted IS NOT DISTINCT FROM CAST(m.r AS VARCHAR) AS is_correct
              FROM found f JOIN math m USING (key))"""


@query("extract_answer", f"WITH {ANSWERS} SELECT key, coalesce(predicted, 'none') AS predicted FROM found")
def extract_answer(spark, sf):
    found = an.extract_answer(F.col("completion"))
    return fx.completions(spark, sf).select("key", F.coalesce(found, F.lit("none")).alias("predicted"))


def checked(spark, sf):
    """Completions against the questions they answer; keys are unique, one row each."""
    known = fx.math(spark, sf).select("key", "answer")
    rows = fx.completions(spark, sf).join(known.hint("merge"), "key")
    return rows.withColumn("is_correct", an.answer_correct(F.col("completion"), F.col("answer")))


@query("completion_match", f"WITH {ANSWERS} SELECT sample, count(*) AS n, count(*) FILTER (is_correct) AS n_correct FROM checked GROUP BY sample")
def completion_match(spark, sf):
    return checked(spark, sf).groupBy("sample").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_correct").alias("n_correct"))


@query(
    "answer_correct",
    f"""WITH {ANSWERS} SELECT key, is_correct, false AS both_missing FROM checked
        UNION ALL SELECT key, predicted IS NULL, predicted IS NULL FROM checked""",
)
def answer_correct(spark, sf):
    """Also against a reference without an answer, where a missing prediction counts as right."""
    rows = checked(spark, sf).select("key", "completion", F.explode(F.array("answer", F.lit("no mark"))).alias("reference"))
    c, r = F.col("completion"), F.col("reference")
    missing = an.extract_answer(c).isNull() & an.extract_answer(r).isNull()
    return rows.select("key", an.answer_correct(c, r).alias("is_correct"), missing.alias("both_missing"))


@query("reward", f"WITH {ANSWERS} SELECT key, CAST(is_correct AS DOUBLE) AS reward FROM checked")
def reward(spark, sf):
    return checked(spark, sf).select("key", an.reward(F.col("is_correct")).alias("reward"))


# --- code answers ----------------------------------------------------------------------------------

CODE = """code AS (SELECT p_partkey, CASE p_partkey % 3
    WHEN 0 THEN concat_ws(chr(10), 'import math', 'from os import path', '# ' || p_name, '', 'def f_' || p_partkey || '(x):', '    import sys')
    WHEN 1 THEN concat_ws(chr(10), '  import re  ', '', 'x = ' || p_size, 'import late') ELSE 'def g(): pass' END AS prompt,
  CASE p_partkey % 3
    WHEN 0 THEN 'Sure:' || chr(10) || '```python' || chr(10) || 'def f(x):' || chr(10) || '    return ' || p_size || chr(10) || '```' || chr(10)
                || 'Or ```' || chr(10) || 'x' || chr(10) || '```'
    WHEN 1 THEN '```' || chr(10) || 'y = ' || p_size || chr(10) || '```' ELSE '  def g(): return ' || p_size || ' ' || chr(10) END AS completion
  FROM part),
  lined AS (SELECT *, list_transform(string_split(prompt, chr(10)), lambda x: trim(x)) AS ls FROM code),
  stopped AS (SELECT *, coalesce(nullif(list_position(list_transform(ls, lambda x: NOT (starts_with(x, 'import ') OR starts_with(x, 'from ')
                OR x = '' OR starts_with(x, '#'))), true), 0), len(ls) + 1) AS stop FROM lined),
  parsed AS (SELECT p_partkey,
      array_to_string(list_filter(ls[:stop - 1], lambda x: starts_with(x, 'import ') OR starts_with(x, 'from ')), chr(10)) AS imports,
      regexp_replace(coalesce(nullif(regexp_extract(completion, '(?s)```(?:python)?\\s*\\n(.*?)\\n```', 1), ''), completion),
                     '^\\s+|\\s+$', '', 'g') AS program FROM stopped)"""


def code(spark, sf):
    size, key = F.col("p_size").cast("string"), F.col("p_partkey").cast("string")
    k = F.col("p_partkey") % 3
    text = lambda *p: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in p])
    prompt = (
        F.when(k == 0, text("import math\nfrom os import path\n# ", F.col("p_name"), "\n\ndef f_", key, "(x):\n    import sys"))
        .when(k == 1, text("  import re  \n\nx = ", size, "\nimport late"))
        .otherwise(F.lit("def g(): pass"))
    )
    completion = (
        F.when(k == 0, text("Sure:\n```python\ndef f(x):\n    return ", size, "\n```\nOr ```\nx\n```"))
        .when(k == 1, text("```\ny = ", size, "\n```"))
        .otherwise(text("  def g(): return ", size, " \n"))
    )
    return table(spark, sf, "part").select(
        "p_partkey", prompt.alias("prompt"), completion.alias("completion"),
        F.lit("def check(f): assert f").alias("test"), text("f_", key).alias("entry_point"),
    )


@query("extract_imports", f"WITH {CODE} SELECT p_partkey, imports FROM parsed")
def extract_imports(spark, sf):
    return code(spark, sf).select("p_partkey", an.extract_imports(F.col("prompt")).alias("imports"))


@query("extract_program", f"WITH {CODE} SELECT p_partkey, program FROM parsed")
def extract_program(spark, sf):
    return code(spark, sf).select("p_partkey", an.extract_program(F.col("completion")).alias("program"))


@query(
    "check_program",
    f"""WITH {CODE} SELECT p_partkey, imports || chr(10) || chr(10) || program || chr(10) || chr(10) || 'def check(f): assert f' || chr(10)
          || 'check(f_' || p_partkey || ')' AS program FROM parsed""",
)
def check_program(spark, sf):
    program = an.check_program(*[F.col(c) for c in ("prompt", "completion", "test", "entry_point")])
    return code(spark, sf).select("p_partkey", program.alias("program"))


# --- samples and rewards ---------------------------------------------------------------------------

SAMPLES = f"""samples AS (SELECT p_partkey, s AS sample, {sql_u('o', 'p_partkey', 's')} < 0.3 AS is_correct,
  10 + CAST(floor(100 * {sql_u('n', 'p_partkey', 's')}) AS BIGINT) AS n_ids FROM part CROSS JOIN range(8) t(s))"""


def samples(spark, sf):
    rows = spread(table(spark, sf, "part"), "p_partkey", PART_BYTES).select("p_partkey", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("sample"))
    rows = rows.withColumn("sample", F.col("sample").cast("long"))
    return rows.withColumns(
        {
            "is_correct": u("o", "p_partkey", "sample") < 0.3,
            "n_ids": 10 + F.floor(100 * u("n", "p_partkey", "sample")),
            "reward": an.reward(u("o", "p_partkey", "sample") < 0.3),
        }
    )


@query(
    "pass_at_any",
    f"""WITH {SAMPLES}, p AS (SELECT p_partkey, bool_or(is_correct) AS passed FROM samples GROUP BY p_partkey)
    SELECT count(*) FILTER (passed) AS n_passed, count(*) AS n_items, round(avg(CAST(passed AS DOUBLE)), 6) AS pass_rate FROM p""",
)
def pass_at_any(spark, sf):
    return evals.pass_at_any(samples(spark, sf), "p_partkey").withColumn("pass_rate", F.round("pass_rate", 6))


@query(
    "pass_at_k",
    f"""WITH {SAMPLES}, r AS (SELECT p_partkey, sample, max(CAST(is_correct AS INT))
          OVER (PARTITION BY p_partkey ORDER BY sample ROWS UNBOUNDED PRECEDING) AS hit FROM samples)
    SELECT CAST(sample + 1 AS INT) AS k, round(avg(hit), 6) AS pass_rate FROM r GROUP BY sample""",
)
def pass_at_k(spark, sf):
    return evals.pass_at_k(samples(spark, sf), "p_partkey", "sample", 8).withColumn("pass_rate", F.round("pass_rate", 6))


@query(
    "running_pass_rate",
    f"""WITH {SAMPLES}, p AS (SELECT p_partkey, bool_or(is_correct) AS passed FROM samples GROUP BY p_partkey)
    SELECT p_partkey, CAST(sum(CAST(passed AS INT)) OVER w AS BIGINT) AS n_passed, count(*) OVER w AS n_total,
           round(avg(CAST(passed AS INT)) OVER w, 6) AS pass_rate FROM p
    WINDOW w AS (ORDER BY p_partkey ROWS UNBOUNDED PRECEDING)""",
)
def running_pass_rate(spark, sf):
    passed = evals.passed_items(samples(spark, sf), "p_partkey")
    return evals.running_pass_rate(passed, "p_partkey").withColumn("pass_rate", F.round("pass_rate", 6))


@query(
    "group_advantage",
    f"""WITH {SAMPLES} SELECT p_partkey, sample, round(CAST(is_correct AS DOUBLE) - avg(CAST(is_correct AS DOUBLE))
          OVER (PARTITION BY p_partkey), 6) AS advantage FROM samples""",
)
def group_advantage(spark, sf):
    rows = evals.group_advantage(samples(spark, sf), "p_partkey")
    return rows.select("p_partkey", "sample", F.round("advantage", 6).alias("advantage"))


@query(
    "reward_summary",
    f"""WITH {SAMPLES}, e AS (SELECT p_partkey, avg(CAST(is_correct AS DOUBLE)) AS r FROM samples GROUP BY p_partkey)
    SELECT round(avg(r), 6) AS mean_reward, (SELECT round(avg(n_ids), 6) FROM samples) AS mean_length, count(*) AS n_items FROM e""",
)
def reward_summary(spark, sf):
    rows = evals.reward_summary(samples(spark, sf), "p_partkey", "reward", "n_ids")
    return rows.withColumns({c: F.round(c, 6) for c in ("mean_reward", "mean_length")})


# --- losses ----------------------------------------------------------------------------------------

TARGETS = f"""{MERGED}, {sql_rendered('merged')},
  targets AS (SELECT conv_id, pos, CASE WHEN mask[pos + 2] = 0 THEN -1 ELSE ids[pos + 2] END AS target_id
              FROM (SELECT conv_id, ids, mask, unnest(range(len(ids) - 1)) AS pos FROM rendered)),
  sized AS (SELECT *, CASE WHEN target_id BETWEEN 0 AND 255 THEN 1 ELSE 0 END AS n_bytes FROM targets)"""


def sized(spark, sf):
    rows = rendered(spark, sf).select("conv_id", F.posexplode_outer(cv.supervised_targets()).alias("pos", "target_id"))
    rows = rows.filter("target_id IS NOT NULL")
    rows = rows.withColumn("pos", F.col("pos").cast("long"))
    return evals.gather_token_bytes(rows, vocab_table(spark, []).select("token_id", "n_bytes"))


@query("token_byte_gather", f"WITH {TARGETS} SELECT conv_id, pos, target_id, n_bytes FROM sized")
def token_byte_gather(spark, sf):
    return sized(spark, sf).select("conv_id", "pos", "target_id", "n_bytes")


@query(
    "bits_per_byte",
    f"""WITH {TARGETS}, l AS (SELECT *, CASE WHEN {sql_u('split', 'conv_id')} < 0.5 THEN 'val' ELSE 'train' END AS split,
                                    4 * {sql_u('l', 'conv_id', 'pos')} AS loss FROM sized)
    SELECT split, CAST(sum(n_bytes) AS BIGINT) AS n_bytes, round(sum(loss) FILTER (n_bytes > 0) / (ln(2) * sum(n_bytes)), 6) AS bpb
    FROM l GROUP BY split""",
)
def bits_per_byte(spark, sf):
    split = F.when(u("split", "conv_id") < 0.5, "val").otherwise("train")
    rows = sized(spark, sf).withColumns({"split": split, "loss": 4 * u("l", "conv_id", "pos")})
    return evals.bits_per_byte(rows, "split").withColumn("bpb", F.round("bpb", 6))


@query(
    "validation_loss",
    """WITH m AS (SELECT event_id // 32 AS batch, avg(value) AS m FROM events WHERE event_id // 32 < 200 GROUP BY batch)
    SELECT round(avg(m), 6) AS val_loss, count(*) AS n_batches FROM m""",
)
def validation_loss(spark, sf):
    rows = table(spark, sf, "events").select(F.floor(F.col("event_id") / 32).alias("batch"), F.col("value").alias("loss"))
    return evals.validation_loss(rows, "batch", 200).withColumn("val_loss", F.round("val_loss", 6))


# --- pluggable functions ---------------------------------------------------------------------------


@query(
    "task_adapter",
    f"""WITH {fx.MATH}, {fx.CHOICE}, {fx.MIXED_QA} SELECT 'math' AS task, count(*) AS n, CAST(2 * count(*) AS BIGINT) AS n_messages FROM math
        UNION ALL SELECT 'solution', count(*), 2 * count(*) FROM math
        UNION ALL SELECT 'choice', count(*), 2 * count(*) FROM choice UNION ALL SELECT 'qa', count(*), 2 * count(*) FROM qa""",
)
def task_adapter(spark, sf):
    math = fx.math(spark, sf)
    rows = adapters.adapt(
        [
            ("math", "math", math),
            ("solution", "solution", math.select("question", "answer")),
            ("choice", "choice", fx.choice(spark, sf)),
            ("qa", "qa", fx.mixed_qa(spark, sf)),
        ]
    )
    return rows.groupBy("task").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("messages")).alias("n_messages"))


@query(
    "evaluator",
    f"""WITH {LETTERED}, {ANSWERS} SELECT 'categorical' AS kind, count(*) AS n, count(*) FILTER (is_correct) AS n_passed FROM judged
        UNION ALL SELECT 'generative', count(*), count(*) FILTER (is_correct) FROM checked""",
)
def evaluator(spark, sf):
    letters = picked(spark, sf).join(problems(spark, sf).hint("merge"), "p_partkey").select(
        F.lit("categorical").alias("kind"),
        evals.evaluate("categorical", F.col("letter"), F.col("reference"), F.col("letters")).alias("ok"),
    )
    known = fx.math(spark, sf).select("key", "answer")
    texts = fx.completions(spark, sf).join(known.hint("merge"), "key").select(
        F.lit("generative").alias("kind"), evals.evaluate("generative", F.col("completion"), F.col("answer")).alias("ok")
    )
    return letters.unionByName(texts).groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.count_if("ok").alias("n_passed"))


@query("row_mapper", "SELECT p_partkey, upper(p_name) AS title FROM part")
def row_mapper(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", "p_name")
    return adapters.map_rows(rows, lambda d: d.withColumn("title", F.upper("p_name")), ["p_name"])
