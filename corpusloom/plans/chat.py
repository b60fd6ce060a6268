"""Conversations: reading, checking, adapting, rendering and batching."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import answers as an
from corpusloom.functions import text as tx
from corpusloom.functions.det import draw_index, u
from corpusloom.operators import conversations as cv
from corpusloom.operators import mix
from corpusloom.operators.prefix import number_rows
from corpusloom.plans import fixtures as fx
from corpusloom.plans.registry import query, sql_u, table
from corpusloom.sources import scan

TOK = tx.ByteTokenizer()


def turns(spark, sf):
    return table(spark, sf, "conversations")


# --- JSON lines ------------------------------------------------------------------------------------


@query(
    "jsonl_conversations_strict",
    """WITH c AS (SELECT conv_id, list({'role': role, 'content': text} ORDER BY turn) AS m, count(*) AS n,
                         bool_and(role = CASE WHEN turn % 2 = 0 THEN 'user' ELSE 'assistant' END) AS ok
                  FROM conversations GROUP BY conv_id)
       SELECT conv_id, n AS n_messages, m[1].content AS first FROM c WHERE ok AND n >= 2""",
)
def jsonl_conversations_strict(spark, sf):
    lines = fx.json_lines(turns(spark, sf))
    out = scan.conversations_strict(lines, strict=False)
    return out.select("conv_id", F.size("messages").cast("long").alias("n_messages"), F.col("messages")[0]["content"].alias("first"))


@query(
    "jsonl_conversations_lenient",
    """WITH c AS (SELECT conv_id, count(*) AS n, first(role ORDER BY turn DESC) AS last_role FROM conversations GROUP BY conv_id)
       SELECT conv_id, n AS n_messages, last_role FROM c WHERE n >= 2 AND conv_id % 5 <> 0""",
)
def jsonl_conversations_lenient(spark, sf):
    lines = fx.json_lines(turns(spark, sf))
    # every fifth line is cut off, and a blank line follows each
    cut = F.when(F.col("conv_id") % 5 == 0, F.expr("left(value, length(value) - 9)")).otherwise(F.col("value"))
    lines = lines.withColumn("value", F.explode(F.array(cut, F.lit("  "))))
    out = scan.conversations_lenient(lines)
    return out.select(
        "conv_id", F.size("messages").cast("long").alias("n_messages"), F.element_at("messages", -1)["role"].alias("last_role")
    )


@query(
    "jsonl_sink",
    """SELECT conv_id, CAST(to_json(list({'role': role, 'content': text} ORDER BY turn)) AS VARCHAR) AS line
       FROM conversations GROUP BY conv_id""",
)
def jsonl_sink(spark, sf):
    parsed = scan.parse_message_lines(fx.json_lines(turns(spark, sf)))
    return parsed.select("conv_id", scan.message_line().alias("line"))


@query("word_list", f"WITH {fx.WORDS} SELECT word, idx FROM words")
def word_list(spark, sf):
    pool, _ = fx.words(spark, sf)
    return scan.word_list(pool.select("idx", F.concat(F.lit(" "), "word", F.lit(" ")).alias("value")).select("value")).join(
        pool, "word"
    )


# --- checks ----------------------------------------------------------------------------------------


@query(
    "conversation_violations",
    f"""WITH {fx.BAD_TURNS},
      c AS (SELECT conv_id, count(*) AS n, bool_or(role <> CASE WHEN turn % 2 = 0 THEN 'user' ELSE 'assistant' END) AS wrong
            FROM bad GROUP BY conv_id)
    SELECT conv_id, CASE WHEN conv_id % 13 = 0 THEN 'not_a_list' ELSE
      concat_ws(',', CASE WHEN n < 2 THEN 'too_few_messages' END, CASE WHEN wrong THEN 'wrong_role_order' END) END AS violations
    FROM c""",
)
def conversation_violations(spark, sf):
    lines = fx.json_lines(fx.bad_turns(spark, sf))
    lines = lines.withColumn("value", F.when(F.col("conv_id") % 13 == 0, F.lit('{"role": "user"}')).otherwise(F.col("value")))
    parsed = scan.parse_message_lines(lines)
    return parsed.select("conv_id", F.array_join(scan.message_violations(), ",").alias("violations"))


@query(
    "conversation_limits",
    f"""WITH {fx.BAD_TURNS},
      c AS (SELECT conv_id, count(*) AS n, bool_or(text = '') AS empty, max(length(text)) AS longest, sum(length(text)) AS total,
                   bool_or(role NOT IN ('user', 'assistant')) AS bad_role FROM bad GROUP BY conv_id)
    SELECT conv_id, concat_ws(',', CASE WHEN n = 0 THEN 'no_messages' END, CASE WHEN n > 500 THEN 'too_many_messages' END,
      CASE WHEN empty THEN 'empty_message' END, CASE WHEN longest > 8000 THEN 'message_too_long' END,
      CASE WHEN total > 32000 THEN 'conversation_too_long' END, CASE WHEN bad_role THEN 'invalid_role' END) AS violations
    FROM c""",
)
def conversation_limits(spark, sf):
    out = cv.conversation_limits(fx.bad_turns(spark, sf))
    return out.select("conv_id", F.array_join("violations", ",").alias("violations"))


@query(
    "role_alternation",
    f"""WITH {fx.BAD_TURNS},
      s AS (SELECT *, bool_or(turn = 0 AND role = 'system') OVER (PARTITION BY conv_id) AS has_system FROM bad),
      r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i FROM s WHERE NOT (has_system AND turn = 0)),
      g AS (SELECT conv_id, bool_and(role = CASE WHEN i % 2 = 0 THEN 'user' ELSE 'assistant' END) AND count(*) >= 2 AS alternates
            FROM r GROUP BY conv_id)
    SELECT conv_id, any_value(has_system) AS has_system, count(*) AS n_messages, any_value(coalesce(g.alternates, false)) AS alternates
    FROM s LEFT JOIN g USING (conv_id) GROUP BY conv_id""",
)
def role_alternation(spark, sf):
    return cv.role_alternation(fx.bad_turns(spark, sf))


# --- adapters --------------------------------------------------------------------------------------

QA = f"""{fx.MIXED_QA},
  told AS (SELECT conv_id, turn,
    CASE WHEN question IS NOT NULL AND answer IS NOT NULL THEN question WHEN instruction IS NOT NULL AND output IS NOT NULL THEN instruction
         WHEN input IS NOT NULL AND output IS NOT NULL THEN input ELSE coalesce(question, input, instruction, '') END AS question_text,
    CASE WHEN question IS NOT NULL AND answer IS NOT NULL THEN answer WHEN instruction IS NOT NULL AND output IS NOT NULL THEN output
         WHEN input IS NOT NULL AND output IS NOT NULL THEN output ELSE coalesce(answer, output, response, '') END AS answer_text FROM qa)"""


@query("coalesce_qa", f"WITH {QA} SELECT * FROM told")
def coalesce_qa(spark, sf):
    return cv.coalesce_qa(fx.mixed_qa(spark, sf)).select("conv_id", "turn", "question_text", "answer_text")


@query(
    "qa_conversation",
    f"""WITH {QA} SELECT conv_id, turn, 'user|' || question_text || '|assistant|' || answer_text AS conversation FROM told""",
)
def qa_conversation(spark, sf):
    qa = cv.coalesce_qa(fx.mixed_qa(spark, sf))
    messages = cv.qa_conversation(F.col("question_text"), F.col("answer_text"))
    return qa.select("conv_id", "turn", flat_text(messages).alias("conversation"))


def flat_text(messages):
    return F.array_join(F.transform(messages, lambda m: F.concat(m["role"], F.lit("|"), cv.first_text(m))), "|")


@query(
    "extract_messages",
    """WITH c AS (SELECT conv_id, conv_id % 5 AS k, count(*) AS n, string_agg(role || '|' || text, '|' ORDER BY turn) AS t,
                         first(text ORDER BY turn) AS q, first(text ORDER BY turn DESC) AS a FROM conversations GROUP BY conv_id)
       SELECT conv_id, CASE WHEN k <= 1 THEN t WHEN k = 2 THEN 'user|in ' || q || '|assistant|' || a
                            ELSE 'user|' || q || '|assistant|' || a END AS conversation
       FROM c WHERE (k <= 1 AND n >= 2) OR k IN (2, 3)""",
)
def extract_messages(spark, sf):
    c = cv.gather_messages(turns(spark, sf)).withColumn("k", F.col("conv_id") % 5)
    q, a = cv.first_text(F.col("messages")[0]), cv.first_text(F.element_at("messages", -1))
    rows = c.select(
        "conv_id",
        F.when(F.col("k") == 0, F.col("messages")).alias("messages"),
        F.when(F.col("k") == 1, F.col("messages")).alias("conversation"),
        F.when(F.col("k") == 2, F.concat(q, F.lit("  "))).alias("instruction"),
        F.when(F.col("k") == 2, F.lit("in")).alias("input"),
        F.when(F.col("k") == 2, a).alias("output"),
        F.when(F.col("k") == 3, q).alias("question"),
        F.when(F.col("k") == 3, a).alias("answer"),
    )
    return cv.extract_messages(rows).select("conv_id", flat_text(F.col("messages")).alias("conversation"))


@query("unwrap_struct", "SELECT p_partkey, p_name AS question, p_type AS subject FROM part")
def unwrap_struct(spark, sf):
    wrapped = fx.choice(spark, sf).select(F.struct("p_partkey", "question", "subject").alias("train"))
    return cv.unwrap_struct(wrapped, "train")


MC_TEXT = """'Multiple Choice question: ' || question || chr(10) || '- ' || choices[1] || '=A' || chr(10) || '- ' || choices[2] || '=B'
  || chr(10) || '- ' || choices[3] || '=C' || chr(10) || '- ' || choices[4] || '=D' || chr(10) || chr(10)
  || 'Respond only with the letter of the correct answer.'"""


@query("render_mc", f"WITH {fx.CHOICE} SELECT p_partkey, {MC_TEXT} AS prompt FROM choice")
def render_mc(spark, sf):
    prompt = an.render_mc(F.col("question"), an.strings(an.LETTERS), F.col("choices"))
    return fx.choice(spark, sf).select("p_partkey", prompt.alias("prompt"))


@query(
    "mc_conversation",
    f"""WITH {fx.CHOICE} SELECT p_partkey, subject, 'user|' || {MC_TEXT} || '|assistant|' || ['A', 'B', 'C', 'D'][answer + 1] AS conversation
        FROM choice""",
)
def mc_conversation(spark, sf):
    rows = fx.choice(spark, sf)
    prompt = an.render_mc(F.col("question"), an.strings(an.LETTERS), F.col("choices"))
    by_index = an.mc_answer_by_index(F.col("choices"), F.col("answer"))
    by_key = an.mc_answer_by_key(an.strings(an.LETTERS), by_index)
    conversation = cv.qa_conversation(prompt, by_key)
    return rows.select("p_partkey", "subject", flat_text(conversation).alias("conversation"))


@query(
    "kmmlu_conversation",
    """SELECT p_partkey, p_name || chr(10) || 'A. ' || p_brand || chr(10) || 'B. ' || p_type
          || CASE WHEN p_size % 10 <> 0 THEN chr(10) || 'C. ' || p_size ELSE '' END AS question,
        CASE p_partkey % 4 WHEN 0 THEN 'A. ' || p_brand WHEN 1 THEN 'B. ' || p_type
          WHEN 2 THEN CASE WHEN p_size % 10 <> 0 THEN 'C. ' || p_size ELSE 'C' END ELSE 'none' END AS answer FROM part""",
)
def kmmlu_conversation(spark, sf):
    options = {
        "A": F.col("p_brand"),
        "B": F.col("p_type"),
        "C": F.when(F.col("p_size") % 10 != 0, F.col("p_size").cast("string")),
    }
    answer = F.element_at(an.strings(["A", "B", "C", "none"]), (F.col("p_partkey") % 4 + 1).cast("int"))
    return table(spark, sf, "part").select(
        "p_partkey",
        an.lettered_question(F.col("p_name"), options).alias("question"),
        an.lettered_answer(answer, options).alias("answer"),
    )


def flat_parts(parts):
    return F.array_join(F.transform(parts, lambda p: F.concat(p["type"], F.lit(":"), p["text"])), "|")


@query(
    "tool_call_parts",
    f"""WITH {fx.MATH} SELECT key, 'text:' || q || ' times ' || n || ' is |python:' || q || '*' || n || '|python_output:' || r
          || '|text:' || r || '.' || chr(10) || '#### ' || r AS parts FROM math""",
)
def tool_call_parts(spark, sf):
    return fx.math(spark, sf).select("key", flat_parts(an.tool_call_parts(F.col("answer"))).alias("parts"))


@query(
    "cot_clean",
    f"""WITH {fx.MATH} SELECT key, regexp_replace(replace(answer, '####', 'The answer is'), '<<[^>]+>>', '', 'g') AS answer FROM math""",
)
def cot_clean(spark, sf):
    return fx.math(spark, sf).select("key", an.cot_clean(F.col("answer")).alias("answer"))


# --- spelling tasks --------------------------------------------------------------------------------

DRAWN = f"""{fx.WORDS},
  drawn AS (SELECT d.doc_id, w.word FROM documents d CROSS JOIN n_words n
            JOIN words w ON w.idx = CAST(floor({sql_u('word', 'd.doc_id')} * n.n) AS BIGINT))"""


def drawn(spark, sf):
    pool, n = fx.words(spark, sf)
    return mix.draw_from_pool(table(spark, sf, "documents").select("doc_id"), pool, n, "word", "doc_id")


@query(
    "spelling_rows",
    f"""WITH {DRAWN} SELECT doc_id, 'Spell the word: ' || word AS question,
          word || ':' || array_to_string(string_split(word, ''), ',') AS answer FROM drawn""",
)
def spelling_rows(spark, sf):
    return drawn(spark, sf).select(
        "doc_id",
        F.concat(F.lit("Spell the word: "), "word").alias("question"),
        F.concat("word", F.lit(":"), an.spelled(F.col("word"))).alias("answer"),
    )


def sql_index(salt: str, n: str) -> str:
    return f"CAST(floor({sql_u('bee-' + salt, 'doc_id')} * {n}) AS BIGINT)"


LETTER = f"""{DRAWN},
  lettered AS (SELECT doc_id, word, CASE WHEN {sql_u('bee-pick', 'doc_id')} < 0.9
      THEN substr(word, {sql_index('own', 'length(word)')} + 1, 1)
      ELSE substr('{an.ALPHABET}', {sql_index('any', '26')} + 1, 1) END AS letter FROM drawn)"""
_LINE = """i || ':' || substr(word, i, 1) || CASE WHEN substr(word, i, 1) = letter THEN ' hit! count='
  || (i - length(replace(substr(word, 1, i), letter, ''))) ELSE '' END || chr(10)"""


@query(
    "letter_count_rows",
    f"""WITH {LETTER},
      t AS (SELECT *, length(word) - length(replace(word, letter, '')) AS c,
                   {fx.sql_strings(an.LETTER_TEMPLATES)}[{sql_index('template', str(len(an.LETTER_TEMPLATES)))} + 1] AS template,
                   ['', '''', '"'][{sql_index('lq', '3')} + 1] AS lq, ['', '''', '"'][{sql_index('wq', '3')} + 1] AS wq FROM lettered)
    SELECT doc_id,
      replace(replace(CASE WHEN {sql_u('bee-lower', 'doc_id')} < 0.3 THEN lower(template) ELSE template END,
              '{{letter}}', lq || letter || lq), '{{word}}', wq || word || wq)
        || CASE WHEN {sql_u('bee-mark', 'doc_id')} < 0.5 THEN '?' ELSE '' END AS question,
      'text:We are asked to find the number ''' || letter || ''' in the word ''' || word
        || '''. Let me try a manual approach first.' || chr(10) || chr(10) || 'First spell the word out:' || chr(10) || word || ':'
        || array_to_string(string_split(word, ''), ',') || chr(10) || chr(10) || 'Then count the occurrences of ''' || letter || ''':'
        || chr(10) || array_to_string(list_transform(range(1, length(word) + 1), lambda i: {_LINE}), '')
        || chr(10) || 'This gives us ' || c || '.|text:' || chr(10) || chr(10) || 'Let me double check this using Python:' || chr(10) || chr(10)
        || '|python:''' || word || '''.count(''' || letter || ''')|python_output:' || c || '|text:' || chr(10) || chr(10)
        || 'Python gives us ' || c || '.' || chr(10) || chr(10) || 'My final answer is:' || chr(10) || chr(10) || '#### ' || c AS parts
    FROM t""",
)
def letter_count_rows(spark, sf):
    rows = drawn(spark, sf).withColumn("letter", an.drawn_letter(F.col("word"), "bee", "doc_id"))
    word, letter = F.col("word"), F.col("letter")
    return rows.select(
        "doc_id",
        an.letter_question(word, letter, "bee", "doc_id").alias("question"),
        flat_parts(an.letter_answer_parts(word, letter)).alias("parts"),
    )


@query(
    "letter_count",
    f"WITH {LETTER} SELECT doc_id, word, letter, length(word) - length(replace(word, letter, '')) AS n FROM lettered",
)
def letter_count(spark, sf):
    rows = drawn(spark, sf).withColumn("letter", an.drawn_letter(F.col("word"), "bee", "doc_id"))
    return rows.select("doc_id", "word", "letter", an.letter_count(F.col("word"), F.col("letter")).cast("long").alias("n"))


# --- fixed conversations and prompts ---------------------------------------------------------------


@query(
    "template_conversations",
    f"""WITH c AS (SELECT conv_id, count(*) AS n, row_number() OVER (ORDER BY conv_id) - 1 AS idx,
                          md5(string_agg(role || ':' || text, chr(10) ORDER BY turn)) AS messages FROM conversations GROUP BY conv_id)
    SELECT doc_id, conv_id, n AS n_messages, messages FROM documents
    JOIN c ON c.idx = CAST(floor({sql_u(42, 'doc_id')} * (SELECT count(*) FROM c)) AS BIGINT)""",
)
def template_conversations(spark, sf):
    out = cv.template_conversations(table(spark, sf, "documents").select("doc_id"), cv.gather_messages(turns(spark, sf)), "doc_id", "conv_id", 42)
    said = F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), cv.first_text(m)))
    return out.select("doc_id", "conv_id", F.size("messages").cast("long").alias("n_messages"), F.md5(F.array_join(said, "\n")).alias("messages"))


PROMPTS = f"""pool AS (SELECT conv_id, turn, text, regexp_matches(text, '[À-ÿ]') AS accented FROM conversations WHERE role = 'user'),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY accented ORDER BY {sql_u('p', 'conv_id', 'turn')}, conv_id, turn) - 1 AS r,
                    count(*) OVER (PARTITION BY accented) AS n FROM pool),
  sizes AS (SELECT DISTINCT accented, n FROM ranked),
  starts AS (SELECT d.doc_id, s.accented, s.n, CAST(floor({sql_u('start', 'd.doc_id')} * s.n) AS BIGINT) AS start
             FROM documents d JOIN sizes s ON s.accented = ({sql_u('lang', 'd.doc_id')} < 0.6)),
  sampled AS (SELECT doc_id, j, r.conv_id, r.turn, r.text FROM starts s CROSS JOIN range(5) t(j)
              JOIN ranked r ON r.accented = s.accented AND r.r = (s.start + j) % s.n WHERE j < s.n),
  redrawn AS (SELECT doc_id, j, r.conv_id, r.turn FROM starts s CROSS JOIN range(5) t(j)
              JOIN ranked r ON r.accented = s.accented AND r.r = CAST(floor({sql_u('any', 's.doc_id', 'j')} * s.n) AS BIGINT))"""


def sampled(spark, sf, k=5, with_replacement=False):
    """Up to ``k`` starter prompts per row from one of two pools.

    The pool is put into a seeded order; a row takes ``k`` neighbours from a drawn start, or ``k`` drawn ranks.
    """
    pool = turns(spark, sf).filter(F.col("role") == "user")
    pool = pool.select("conv_id", "turn", "text", mix.script_filter("text", "À", "ÿ").alias("accented"))
    pool = mix.seeded_order(pool, "p", "conv_id", "turn", out="_u")
    ranked = number_rows(pool, ["_u", "conv_id", "turn"], "r", ["accented"]).withColumn("r", F.col("r") - 1).drop("_u")
    sizes = {r[0]: r[1] for r in pool.groupBy("accented").count().collect()}  # two rows
    rows = table(spark, sf, "documents").select("doc_id", (u("lang", "doc_id") < 0.6).alias("accented"))
    n = F.when(F.col("accented"), F.lit(sizes.get(True, 0))).otherwise(F.lit(sizes.get(False, 0))).cast("long")
    rows = rows.withColumn("n", n).filter("n > 0")
    last = F.lit(k - 1).cast("long") if with_replacement else F.least(F.lit(k), F.col("n")) - 1
    rows = rows.withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    if with_replacement:
        rank = draw_index(F.col("n"), "any", "doc_id", "j")
    else:
        rank = F.pmod(draw_index(F.col("n"), "start", "doc_id") + F.col("j"), F.col("n"))
    return rows.withColumn("r", rank).join(ranked, ["accented", "r"])


@query(
    "prompt_sample",
    f"""WITH {PROMPTS} SELECT doc_id, j, conv_id, turn, false AS replaced FROM sampled
    UNION ALL SELECT doc_id, j, conv_id, turn, true FROM redrawn""",
)
def prompt_sample(spark, sf):
    """Different prompts per row, and prompts drawn with replacement."""
    parts = [sampled(spark, sf, with_replacement=again).select("doc_id", "j", "conv_id", "turn", F.lit(again).alias("replaced")) for again in (False, True)]
    return parts[0].unionByName(parts[1])


@query(
    "generation_prompts",
    f"""WITH {PROMPTS} SELECT doc_id, 'Write a conversation. It may start like one of these:' || chr(10)
          || string_agg(text, chr(10) ORDER BY j) || chr(10) || 'Answer in JSON.' AS prompt FROM sampled GROUP BY doc_id""",
)
def generation_prompts(spark, sf):
    template = "Write a conversation. It may start like one of these:\n%USER_FIRST_PROMPTS%\nAnswer in JSON."
    rows = sampled(spark, sf).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("j", "text"))).alias("s"))
    text = F.array_join(F.col("s.text"), "\n")
    return rows.select("doc_id", F.replace(F.lit(template), F.lit("%USER_FIRST_PROMPTS%"), text).alias("prompt"))


# --- rendering -------------------------------------------------------------------------------------

MERGED = """sys AS (SELECT conv_id, text AS sys_text FROM conversations WHERE turn = 0 AND role = 'system'),
  merged AS (SELECT c.conv_id, c.turn, c.role, CASE WHEN c.turn = 1 AND s.sys_text IS NOT NULL
               THEN s.sys_text || chr(10) || chr(10) || c.text ELSE c.text END AS text
             FROM conversations c LEFT JOIN sys s USING (conv_id) WHERE c.role <> 'system')"""


@query("merge_system", f"WITH {MERGED} SELECT conv_id, role, text FROM merged")
def merge_system(spark, sf):
    c = cv.gather_messages(turns(spark, sf)).select("conv_id", F.explode_outer(cv.merge_system()).alias("m"))
    return c.select("conv_id", F.col("m.role").alias("role"), cv.first_text(F.col("m")).alias("text"))


def sql_rendered(source: str) -> str:
    b = fx.sql_bytes("text")
    return f"""
  seg AS (SELECT conv_id, turn, role, CASE WHEN role = 'user' THEN list_concat([257], {b}, [258])
                 ELSE list_concat([259], {b}, [260]) END AS ids FROM {source}),
  seg2 AS (SELECT *, list_transform(range(1, len(ids) + 1), lambda i: CASE WHEN role = 'user' OR i = 1 THEN 0 ELSE 1 END) AS mask FROM seg),
  rendered AS (SELECT conv_id, list_concat([256], flatten(list(ids ORDER BY turn)))[1:2048] AS ids,
                      list_concat([0], flatten(list(mask ORDER BY turn)))[1:2048] AS mask FROM seg2 GROUP BY conv_id)"""


def rendered(spark, sf):
    return cv.render(cv.gather_messages(turns(spark, sf)), TOK).select("conv_id", "ids", "mask")


@query(
    "render_conversation",
    f"""WITH {MERGED}, {sql_rendered('merged')}
    SELECT conv_id, len(ids) AS n_ids, md5({fx.sql_join('ids')}) AS ids, md5({fx.sql_join('mask')}) AS mask FROM rendered""",
)
def render_conversation(spark, sf):
    return rendered(spark, sf).select(
        "conv_id", F.size("ids").cast("long").alias("n_ids"), F.md5(fx.joined("ids")).alias("ids"), F.md5(fx.joined("mask")).alias("mask")
    )


_T1, _CALL, _T2 = (fx.sql_bytes(x) for x in ("q || ' times ' || n || ' is '", "q || '*' || n", "r || '.' || chr(10) || '#### ' || r"))
_OUT = fx.sql_bytes("CAST(r AS VARCHAR)")


@query(
    "render_tool_calls",
    f"""WITH {fx.MATH},
      seg AS (SELECT key, {fx.sql_bytes('question')} AS q, {_T1} AS t1, {_CALL} AS call, {_OUT} AS out, {_T2} AS t2 FROM math)
    SELECT key, {fx.sql_join("list_concat([256, 257], q, [258, 259], t1, [261], call, [262, 263], out, [264], t2, [260])")} AS ids,
      repeat('0', len(q) + 4) || repeat('1', len(t1) + len(call) + 2) || repeat('0', len(out) + 2) || repeat('1', len(t2) + 1) AS mask
    FROM seg""",
)
def render_tool_calls(spark, sf):
    parts = an.tool_call_parts(F.col("answer"))
    messages = F.array(cv.plain_message("user", "question"), cv.parts_message("assistant", parts))
    rows = cv.render(fx.math(spark, sf).select("key", messages.alias("messages")), TOK)
    return rows.select("key", fx.joined("ids").alias("ids"), F.array_join(F.col("mask").cast("array<string>"), "").alias("mask"))


@query(
    "render_for_completion",
    f"""WITH {MERGED}, tail AS (SELECT conv_id, max(turn) AS last FROM conversations GROUP BY conv_id),
      kept AS (SELECT m.* FROM merged m JOIN tail t USING (conv_id)
               WHERE m.turn < t.last AND conv_id IN (SELECT c.conv_id FROM conversations c JOIN tail t2 USING (conv_id)
                                                     WHERE c.turn = t2.last AND c.role = 'assistant')),
      {sql_rendered('kept')}
    SELECT conv_id, len(ids) + 1 AS n_ids, md5({fx.sql_join('list_concat(ids, [259])')}) AS ids FROM rendered""",
)
def render_for_completion(spark, sf):
    c = cv.gather_messages(turns(spark, sf)).filter(F.element_at("messages", -1)["role"] == "assistant")
    c = cv.render_for_completion(c, TOK)
    return c.select("conv_id", F.size("ids").cast("long").alias("n_ids"), F.md5(fx.joined("ids")).alias("ids"))


@query(
    "supervised_targets",
    f"""WITH {MERGED}, {sql_rendered('merged')}
    SELECT conv_id, md5({fx.sql_join('list_transform(range(2, len(ids) + 1), lambda i: CASE WHEN mask[i] = 0 THEN -1 ELSE ids[i] END)')})
      AS targets FROM rendered""",
)
def supervised_targets(spark, sf):
    return rendered(spark, sf).select("conv_id", F.md5(fx.joined(cv.supervised_targets())).alias("targets"))


@query(
    "next_token_targets",
    f"""SELECT doc_id, md5({fx.sql_join('list_concat([256], b[:-2])')}) AS inputs, md5({fx.sql_join('b')}) AS targets
        FROM (SELECT doc_id, {fx.sql_bytes('text')} AS b FROM documents)""",
)
def next_token_targets(spark, sf):
    ids = F.concat(F.array(F.lit(TOK.special(tx.BOS))), TOK.encode("text"))
    rows = scan.spread(table(spark, sf, "documents"), "doc_id").select("doc_id", ids.alias("ids"))
    inputs, targets = cv.next_token_targets()
    return rows.select("doc_id", F.md5(fx.joined(inputs)).alias("inputs"), F.md5(fx.joined(targets)).alias("targets"))


BATCHED = """numbered AS (SELECT conv_id, row_number() OVER (ORDER BY conv_id) - 1 AS idx FROM (SELECT DISTINCT conv_id FROM conversations)),
  batched AS (SELECT conv_id, idx % 3 AS worker, (idx // 3) // 8 AS batch_id FROM numbered)"""


def batched(spark, sf):
    ids = turns(spark, sf).select("conv_id").distinct()
    return cv.batch_assign(mix.index_rows(ids, "conv_id"), "idx", 8, 3).select("conv_id", "worker", "batch_id")


@query(
    "batch_assign",
    f"""WITH {BATCHED}, own AS (SELECT idx % 3 AS worker, count(*) AS n FROM numbered GROUP BY 1)
    SELECT conv_id, CAST(epoch AS INT) AS epoch, worker, (idx // 3 + (epoch - 1) * own.n) // 8 AS batch_id
    FROM (SELECT conv_id, idx, idx % 3 AS worker FROM numbered) JOIN own USING (worker) CROSS JOIN range(1, 4) e(epoch)""",
)
def batch_assign(spark, sf):
    ids = mix.index_rows(turns(spark, sf).select("conv_id").distinct(), "conv_id")
    return cv.batch_assign(ids, "idx", 8, 3, epochs=3).select("conv_id", "epoch", "worker", "batch_id")


@query(
    "pad_batch",
    f"""WITH {MERGED}, {sql_rendered('merged')}, {BATCHED},
      t AS (SELECT r.conv_id, worker, batch_id, ids, mask, ids[:-2] AS inputs,
                   list_transform(range(2, len(ids) + 1), lambda i: CASE WHEN mask[i] = 0 THEN -1 ELSE ids[i] END) AS targets
            FROM rendered r JOIN batched b USING (conv_id)),
      w AS (SELECT *, max(len(inputs)) OVER (PARTITION BY worker, batch_id) AS width, max(len(ids)) OVER (PARTITION BY worker, batch_id) AS wide FROM t)
    SELECT conv_id, worker, batch_id, width, CAST(len(ids) - 1 AS INT) AS answer_at,
      md5({fx.sql_join('list_concat(ids, list_transform(range(wide - len(ids)), lambda i: 256))')}) AS prompt,
      md5({fx.sql_join('list_concat(ids, list_transform(range(wide - len(ids)), lambda i: 260))')}) AS rollout,
      md5({fx.sql_join('list_concat(mask, list_transform(range(wide - len(mask)), lambda i: 0))')}) AS rollout_mask,
      md5({fx.sql_join('list_concat(inputs, list_transform(range(width - len(inputs)), lambda i: 260))')}) AS inputs,
      md5({fx.sql_join('list_concat(targets, list_transform(range(width - len(targets)), lambda i: -1))')}) AS targets FROM w""",
)
def pad_batch(spark, sf):
    rows = rendered(spark, sf).withColumn("targets", cv.supervised_targets()).withColumn("prompt", F.col("ids"))
    rows = rows.withColumn("inputs", cv.next_token_targets()[0]).join(batched(spark, sf), "conv_id")
    batch, end = ["worker", "batch_id"], TOK.special(tx.ASSISTANT_END)
    rows = cv.pad_batch(rows, batch, {"inputs": end, "targets": -1})
    rows = cv.pad_rollouts(cv.pad_prompts(rows, batch, "prompt", TOK.special(tx.BOS)), batch, "ids", "mask", end)
    return rows.select(
        "conv_id", "worker", "batch_id", F.size("inputs").cast("long").alias("width"), "answer_at",
        F.md5(fx.joined("prompt")).alias("prompt"), F.md5(fx.joined("ids")).alias("rollout"), F.md5(fx.joined("mask")).alias("rollout_mask"),
        F.md5(fx.joined("inputs")).alias("inputs"), F.md5(fx.joined("targets")).alias("targets"),
    )


@query(
    "supervised_token_count",
    f"""WITH {MERGED}, {sql_rendered('merged')}, {BATCHED}
    SELECT worker, batch_id, greatest(CAST(sum(list_sum(mask[2:])) AS BIGINT), 1) AS n_supervised
    FROM rendered JOIN batched USING (conv_id) GROUP BY worker, batch_id""",
)
def supervised_token_count(spark, sf):
    counts = rendered(spark, sf).select("conv_id", cv.supervised_count().alias("n"))
    sums = counts.join(batched(spark, sf), "conv_id").groupBy("worker", "batch_id").agg(F.sum("n").alias("n"))
    return sums.select("worker", "batch_id", F.greatest("n", F.lit(1)).alias("n_supervised"))


# --- tool calls ------------------------------------------------------------------------------------


@query(
    "tool_call_audit",
    f"""WITH {fx.MATH}, calls AS (SELECT flag, r AS value, CASE WHEN {sql_u('w', 'key')} < 0.1 THEN r + 1 ELSE r END AS recorded FROM math)
    SELECT flag, count(*) AS n_calls, count(*) FILTER (value = recorded) AS n_match, count(*) FILTER (value <> recorded) AS n_mismatch,
           CAST(0 AS BIGINT) AS n_refused FROM calls GROUP BY flag""",
)
def tool_call_audit(spark, sf):
    kind = lambda k: F.filter("parts", lambda p: p["type"] == k)[0]["text"]
    calls = fx.math(spark, sf).select("flag", "key", an.tool_call_parts(F.col("answer")).alias("parts"))
    calls = calls.select("flag", "key", kind("python").alias("expr"), kind("python_output").alias("out"))
    wrong = u("w", "key") < 0.1
    calls = calls.withColumn("out", F.when(wrong, (F.col("out").cast("long") + 1).cast("string")).otherwise(F.col("out")))
    return audit(calls, "flag")


def audit(calls, source):
    """Calls, agreeing, disagreeing and refused ones per source."""
    rows = calls.withColumn("value", an.calculator("expr"))
    return rows.groupBy(source).agg(
        F.count(F.lit(1)).alias("n_calls"),
        F.count_if(F.col("value") == F.col("out")).alias("n_match"),
        F.count_if(F.col("value") != F.col("out")).alias("n_mismatch"),
        F.count_if(F.col("value").isNull()).alias("n_refused"),
    )
