"""Conversations as arrays of messages: building, checking, rendering to ids with a supervision mask.

A message is ``struct<role, parts array<struct<type, text>>, is_plain>``. A plain string is one text part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import text as tx
from corpusloom.operators.mix import draw_from_pool
from corpusloom.operators.prefix import number_rows

# fixed values: limits of a conversation
MAX_MESSAGES = 500
MAX_MESSAGE_CHARS = 8000
MAX_CONVERSATION_CHARS = 32000
MAX_TOKENS = 2048


def plain_message(role: str | Column, text: Column | str) -> Column:
    role = F.lit(role) if isinstance(role, str) else role
    text = F.col(text) if isinstance(text, str) else text
    part = F.struct(F.lit("text").alias("type"), text.alias("text"))
    return F.struct(role.alias("role"), F.array(part).alias("parts"), F.lit(True).alias("is_plain"))


def parts_message(role: str, parts: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), parts.alias("parts"), F.lit(False).alias("is_plain"))


def part(kind: str | Column, text: Column) -> Column:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return F.struct(kind.alias("type"), text.alias("text"))


def tasks(df: DataFrame) -> int:
    """Tasks of a shuffle whose output is heavy to work on: never fewer than the cores."""
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def gather_messages(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per conversation with all its messages in the order of their turns, whatever these are numbered from."""
    m = plain_message(F.col(role), text)
    rows = turns.repartition(tasks(turns), conv).groupBy(conv).agg(
        F.array_sort(F.collect_list(F.struct(F.col(turn).alias("t"), m.alias("m")))).alias("_m")
    )
    return rows.select(conv, F.transform("_m", lambda x: x["m"]).alias("messages"))


def first_text(message: Column) -> Column:
    return F.element_at(message["parts"], 1)["text"]


def merge_system(messages: str | Column = "messages") -> Column:
    """A leading system message is put before the next one, which must come from the user."""
    m = F.col(messages) if isinstance(messages, str) else messages
    head, second = F.get(m, F.lit(0)), F.get(m, F.lit(1))
    merged = plain_message(second["role"], F.concat(first_text(head), F.lit("\n\n"), first_text(second)))
    ok = F.when(second["role"] == "user", merged).otherwise(
        F.raise_error(F.lit("a system message must be followed by a user message"))
    )
    rest = F.slice(m, 3, F.greatest(F.size(m) - 2, F.lit(0)))
    return F.when(head["role"] == "system", F.concat(F.array(ok), rest)).otherwise(m)


def role_alternation(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role") -> DataFrame:
    """Per conversation: is the order user, assistant, ... after an optional leading system message?

    One partial aggregation; turns are numbered from 0 without gaps, else ``dense`` is false.
    """
    odd = F.pmod(F.col(turn), F.lit(2)) == 1
    expected = lambda is_odd: F.when(is_odd, F.lit("assistant")).otherwise(F.lit("user"))
    flags = turns.groupBy(conv).agg(
        F.bool_or((F.col(turn) == 0) & (F.col(role) == "system")).alias("has_system"),
        F.bool_and(F.col(role) == expected(odd)).alias("_plain"),
        F.bool_and((F.col(turn) == 0) | (F.col(role) == expected(~odd))).alias("_shifted"),
        F.count(F.lit(1)).alias("n_messages"),
        (F.max(turn) + 1 == F.count(F.lit(1))).alias("dense"),
    )
    n = F.col("n_messages") - F.col("has_system").cast("int")
    alternates = F.when(F.col("has_system"), F.col("_shifted")).otherwise(F.col("_plain"))
    return flags.select(conv, "has_system", "n_messages", (F.col("dense") & alternates & (n >= 2)).alias("alternates"))


def conversation_limits(turns: DataFrame, conv: str = "conv_id", role: str = "role", text: str = "text") -> DataFrame:
    """Names of the limits every conversation breaks, by one partial aggregation."""
    n = F.length(text)
    sums = turns.groupBy(conv).agg(
        F.count(role).alias("n"),
        F.bool_or(F.col(text).isNull() | (F.col(text) == "")).alias("empty"),
        F.max(n).alias("longest"),
        F.sum(n).alias("total"),
        F.bool_or(~F.col(role).isin("user", "assistant")).alias("bad_role"),
    )
    checks = [
        ("no_messages", F.col("n") == 0),
        ("too_many_messages", F.col("n") > MAX_MESSAGES),
        ("empty_message", F.col("empty")),
        ("message_too_long", F.col("longest") > MAX_MESSAGE_CHARS),
        ("conversation_too_long", F.col("total") > MAX_CONVERSATION_CHARS),
        ("invalid_role", F.col("bad_role")),
    ]
    labels = F.filter(F.array(*[F.when(c, F.lit(name)) for name, c in checks]), lambda x: x.isNotNull())
    return sums.select(conv, labels.alias("violations"))


# --- adapters of question-answer tables ------------------------------------------------------------


def qa_conversation(question: Column, answer: Column) -> Column:
    return F.array(plain_message("user", question.cast("string")), plain_message("assistant", answer.cast("string")))


def coalesce_qa(df: DataFrame) -> DataFrame:
    """``question_text`` and ``answer_text`` from the first pair of columns that a row fills."""
    c = {n: F.col(n).cast("string") if n in df.columns else F.lit(None).cast("string")
         for n in ("question", "answer", "instruction", "input", "output", "response")}
    pairs = [("question", "answer"), ("instruction", "output"), ("input", "output")]
    any_q = F.coalesce(c["question"], c["input"], c["instruction"], F.lit(""))
    any_a = F.coalesce(c["answer"], c["output"], c["response"], F.lit(""))
    q, a = any_q, any_a
    for x, y in reversed(pairs):
        both = c[x].isNotNull() & c[y].isNotNull()
        q, a = F.when(both, c[x]).otherwise(q), F.when(both, c[y]).otherwise(a)
    return df.withColumns({"question_text": q, "answer_text": a})


def extract_messages(df: DataFrame) -> DataFrame:
    """``messages`` from whichever layout a row fills; rows with fewer than two messages are dropped."""
    kind = "array<struct<role:string,parts:array<struct<type:string,text:string>>,is_plain:boolean>>"
    have = lambda n: F.col(n) if n in df.columns else F.lit(None).cast("string")
    ready = [F.col(n).cast(kind) for n in ("messages", "conversation") if n in df.columns]
    given = F.when(have("input") != "", F.concat(have("input"), F.lit(" "), have("instruction")))
    told = tx.strip(F.coalesce(given, have("instruction")))
    pairs = [(told, have("output"), have("instruction")), (have("question"), have("answer"), have("question"))]
    built = [F.when(key.isNotNull() & a.isNotNull(), qa_conversation(q, a)) for q, a, key in pairs]
    messages = F.coalesce(*ready, *built)
    return df.withColumn("messages", messages).filter(F.size("messages") >= 2)


def unwrap_struct(df: DataFrame, wrapper: str) -> DataFrame:
    return df.select(f"{wrapper}.*")


# --- rendering -------------------------------------------------------------------------------------


def _when(cond: Column, value: int) -> Column:
    return F.when(cond, F.array(F.lit(value))).otherwise(F.array().cast("array<int>"))


def _parts(m: Column) -> Column:
    """All parts of all messages in order, with what the markers around them depend on."""

    def of_message(x: Column) -> Column:
        user = x["role"] == "user"
        last = F.size(x["parts"]) - 1
        return F.transform(
            x["parts"],
            lambda p, i: F.struct(
                user.alias("user"), (~user & (i == 0)).alias("opens"), (~user & (i == last)).alias("closes"),
                (~user & (p["type"] == "python")).alias("call"), (~user & (p["type"] == "python_output")).alias("output"),
            ),
        )

    return F.flatten(F.transform(m, of_message))


def render(df: DataFrame, tok, messages: str = "messages", max_tokens: int = MAX_TOKENS) -> DataFrame:
    """Add ``ids`` and ``mask`` of every conversation: bos, then every message between its markers.

    Supervised (mask 1) are assistant texts, tool calls with their markers and the assistant end marker.
    Each step is a column of its own, so it is worked out once per row.
    """
    s = tok.special
    m = F.col("_m")
    expected = lambda i: F.when(i % 2 == 0, "user").otherwise("assistant")
    wrong = F.exists(F.transform(m, lambda x, i: x["role"] != expected(i)), lambda w: w)
    known = lambda p: p["type"].isin("text", "python", "python_output")
    odd_part = F.exists(m, lambda x: F.exists(x["parts"], lambda p: ~F.coalesce(known(p), F.lit(False))))
    many_parts = F.exists(m, lambda x: (x["role"] == "user") & ~x["is_plain"])
    checked = (
        F.when(wrong, F.raise_error(F.lit("roles must alternate, starting with the user")))
        .when(many_parts, F.raise_error(F.lit("a user message must be plain text")))
        .when(odd_part, F.raise_error(F.lit("a part must be text, python or python_output")))
        .otherwise(_parts(m))
    )
    texts = F.flatten(F.transform(m, lambda x: F.transform(x["parts"], lambda p: p["text"])))

    def with_markers(k: Column, ids: Column) -> Column:
        return F.concat(
            _when(k["user"], s(tx.USER_START)), _when(k["opens"], s(tx.ASSISTANT_START)),
            _when(k["call"], s(tx.PYTHON_START)), _when(k["output"], s(tx.OUTPUT_START)),
            ids,
            _when(k["call"], s(tx.PYTHON_END)), _when(k["output"], s(tx.OUTPUT_END)),
            _when(k["user"], s(tx.USER_END)), _when(k["closes"], s(tx.ASSISTANT_END)),
        )

    def bits(k: Column, ids: Column) -> Column:
        bit = F.when(k["user"] | k["output"], 0).otherwise(1)
        inner = F.size(ids) + F.when(k["call"] | k["output"], 2).otherwise(0)
        return F.concat(
            _when(k["user"] | k["opens"], 0), F.array_repeat(bit, inner), _when(k["user"], 0), _when(k["closes"], 1)
        )

    whole = lambda first, segments: F.slice(F.concat(F.array(F.lit(first)), F.flatten(segments)), 1, max_tokens)
    rows = df.withColumn("_m", merge_system(messages))
    rows = rows.withColumns({"_k": checked, "_t": texts}).withColumn("_ids", tok.encode_each(F.col("_t")))
    rows = rows.withColumns(
        {
            "ids": whole(s(tx.BOS), F.zip_with("_k", "_ids", with_markers)),
            "mask": whole(0, F.zip_with("_k", "_ids", bits)),
        }
    )
    return rows.drop("_m", "_k", "_t", "_ids")


def render_for_completion(df: DataFrame, tok, messages: str = "messages", max_tokens: int = MAX_TOKENS) -> DataFrame:
    """Add ``ids`` that prime the assistant: its last message dropped, the assistant start appended."""
    m = F.col(messages)
    open_ = F.when(F.element_at(m, -1)["role"] == "assistant", F.slice(m, 1, F.size(m) - 1)).otherwise(
        F.raise_error(F.lit("the last message must come from the assistant"))
    )
    rows = render(df.withColumn("_open", open_), tok, "_open", max_tokens).drop("_open", "mask")
    return rows.withColumn("ids", F.concat("ids", F.array(F.lit(tok.special(tx.ASSISTANT_START)))))


def next_token_targets(ids: str = "ids") -> tuple[Column, Column]:
    n = F.greatest(F.size(ids) - 1, F.lit(0))
    return F.slice(ids, 1, n), F.slice(ids, 2, n)


def supervised_targets(ids: str = "ids", mask: str = "mask") -> Column:
    """Shifted ids, -1 where the target is not supervised."""
    n = F.greatest(F.size(ids) - 1, F.lit(0))
    return F.zip_with(F.slice(ids, 2, n), F.slice(mask, 2, n), lambda i, b: F.when(b == 0, -1).otherwise(i))


def supervised_count(mask: str = "mask") -> Column:
    """Supervised targets; the mask of the first id belongs to no target."""
    n = F.greatest(F.size(mask) - 1, F.lit(0))
    return F.aggregate(F.slice(mask, 2, n), F.lit(0), lambda a, b: a + b)


def batch_assign(rows: DataFrame, idx: str, batch_size: int, workers: int = 1, epochs: int = 1, n: int | None = None) -> DataFrame:
    """Worker and batch of every densely numbered row: rows are dealt round robin, then cut into batches.

    With several ``epochs`` every row comes once in each (column ``epoch``, from 1), and a short batch that ends a worker's epoch is
    filled up in the next one. ``n`` is the number of rows where it is known already.
    """
    dealt = rows.withColumn("worker", F.pmod(F.col(idx), F.lit(workers)).cast("long"))
    at = F.floor(F.col(idx) / workers)
    if epochs > 1:
        total = rows.count() if n is None else n
        own = F.floor((F.lit(total + workers - 1) - F.col("worker")) / workers)  # rows of the worker in an epoch
        dealt = dealt.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(epochs))))
        at = at + own * (F.col("epoch") - 1)
    return dealt.withColumn("batch_id", F.floor(at / batch_size).cast("long"))


def pad_prompts(rows: DataFrame, batch: list[str], ids: str, pad: int) -> DataFrame:
    """Prompts right-padded with ``pad``, and ``answer_at``, the place of the last id, whose scores give the answer."""
    return pad_batch(rows.withColumn("answer_at", F.size(ids) - 1), batch, {ids: pad})


def pad_rollouts(rows: DataFrame, batch: list[str], ids: str, mask: str, pad: int) -> DataFrame:
    """Sampled sequences right-padded with ``pad``; padding is not supervised."""
    return pad_batch(rows, batch, {ids: pad, mask: 0})


def pad_column(ids: str, width: Column, pad: int) -> Column:
    return F.concat(F.col(ids), F.array_repeat(F.lit(pad), (width - F.size(ids)).cast("int")))


def pad_batch(rows: DataFrame, batch: list[str], pads: dict[str, int]) -> DataFrame:
    """Right-pad array columns to the longest of their batch. Batches have a fixed number of rows."""
    w = Window.partitionBy(*batch)
    rows = rows.withColumns({f"_w_{c}": F.max(F.size(c)).over(w) for c in pads})
    return rows.withColumns({c: pad_column(c, F.col(f"_w_{c}"), p) for c, p in pads.items()}).drop(
        *[f"_w_{c}" for c in pads]
    )


def template_conversations(rows: DataFrame, templates: DataFrame, key: str, order: str, seed: int | str) -> DataFrame:
    """Every row with one of the template conversations, drawn by its key; ``templates`` (with ``messages``) may be any table."""
    pool = number_rows(templates, [order], "idx").withColumn("idx", F.col("idx") - 1)
    return draw_from_pool(rows, pool, templates.count(), seed, key)
