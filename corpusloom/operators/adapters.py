"""Task adapters: from the rows of a data set to conversations, and row mapping."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import answers as an
from corpusloom.operators import conversations as cv

Adapter = Callable[[DataFrame], DataFrame]


def map_rows(df: DataFrame, fn: Adapter, remove: list[str] | None = None) -> DataFrame:
    """Apply a function of columns and drop the columns it replaces."""
    return df.transform(fn).drop(*(remove or []))


def math_adapter(df: DataFrame) -> DataFrame:
    """(question, answer) with tool calls in the answer."""
    parts = an.tool_call_parts(F.col("answer"))
    return df.withColumn("messages", F.array(cv.plain_message("user", "question"), cv.parts_message("assistant", parts)))


def solution_adapter(df: DataFrame) -> DataFrame:
    """Worked solutions: (problem, generated_solution), else (question, solution), else a cleaned (question, answer)."""
    have = lambda n: F.col(n) if n in df.columns else F.lit(None).cast("string")
    question = F.coalesce(have("problem"), have("question"), F.lit(""))
    answer = F.coalesce(have("generated_solution"), have("solution"), an.cot_clean(have("answer")), F.lit(""))
    return df.withColumn("messages", cv.qa_conversation(question, answer))


def choice_adapter(df: DataFrame) -> DataFrame:
    """(question, choices, answer index): four choices, the answer is its letter."""
    prompt = an.render_mc(F.col("question"), an.strings(an.LETTERS), F.col("choices"))
    answer = an.mc_answer_by_index(F.col("choices"), F.col("answer"))
    return df.withColumns({"messages": cv.qa_conversation(prompt, answer), "letters": an.strings(an.LETTERS)})


def keyed_choice_adapter(df: DataFrame) -> DataFrame:
    """(question, choices struct of text and label, answerKey): letters come with the question."""
    prompt = an.render_mc(F.col("question"), F.col("choices.label"), F.col("choices.text"))
    answer = an.mc_answer_by_key(F.col("choices.label"), F.col("answerKey"))
    return df.withColumns({"messages": cv.qa_conversation(prompt, answer), "letters": F.col("choices.label")})


def code_adapter(df: DataFrame) -> DataFrame:
    """(prompt, canonical_solution, entry_point, test): the answer is the whole program."""
    whole = F.concat(F.col("prompt"), F.lit("\n"), F.col("canonical_solution"))
    return df.withColumn("messages", cv.qa_conversation(F.col("prompt"), whole))


ADAPTERS: dict[str, Adapter] = {
    "math": math_adapter,
    "solution": solution_adapter,
    "choice": choice_adapter,
    "keyed_choice": keyed_choice_adapter,
    "code": code_adapter,
    "qa": lambda df: cv.coalesce_qa(df).withColumn(
        "messages", cv.qa_conversation(F.col("question_text"), F.col("answer_text"))
    ),
    "any": cv.extract_messages,
}


def adapt(tasks: list[tuple[str, str, DataFrame]]) -> DataFrame:
    """(task, messages) of several data sets, each through its registered adapter."""
    parts = [ADAPTERS[kind](df).select(F.lit(name).alias("task"), "messages") for name, kind, df in tasks]
    return reduce(DataFrame.unionByName, parts)
