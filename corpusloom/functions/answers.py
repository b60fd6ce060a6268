"""Building task prompts and checking answers, as column expressions."""

from __future__ import annotations

import ast
import operator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.det import draw_index, u
from corpusloom.operators.conversations import part

LETTERS = ["A", "B", "C", "D"]
ALPHABET = "abcdefghijklmnopqrstuvwxyz"
TEST_SEED_OFFSET = 10_000_000  # fixed value: keeps train and test draws apart

# fixed values: the user message templates of the letter counting task, in order
LETTER_TEMPLATES = [
    "How many {letter} are in the word {word}",
    "How many {letter} are in {word}",
    "Count the number of {letter} in {word}",
    "How many times does {letter} appear in {word}",
    "What's the count of {letter} in {word}",
    "In the word {word}, how many {letter} are there",
    "How many letter {letter} are in the word {word}",
    "Count how many {letter} appear in {word}",
    "Tell me the number of {letter} in {word}",
    "How many occurrences of {letter} are in {word}",
    "Find the count of {letter} in {word}",
    "Can you count the {letter} letters in {word}",
    "What is the frequency of {letter} in {word}",
    "How many {letter}s are in {word}",
    "How many {letter}'s are in {word}",
    "Count all the {letter} in {word}",
    "How many times is {letter} in {word}",
    "Number of {letter} in {word}",
    "Total count of {letter} in {word}",
    "How many {letter} does {word} have",
    "How many {letter} does {word} contain",
    "What's the number of {letter} in {word}",
    "{word} has how many {letter}",
    "In {word}, count the {letter}",
    "How many {letter} appear in {word}",
    "Count the {letter} in {word}",
    "Give me the count of {letter} in {word}",
    "How many instances of {letter} in {word}",
    "Show me how many {letter} are in {word}",
    "Calculate the number of {letter} in {word}",
    "¿Cuántas {letter} hay en {word}?",
    "¿Cuántas veces aparece {letter} en {word}?",
    "Cuenta las {letter} en {word}",
    "¿Cuántas letras {letter} tiene {word}?",
    "{word}中有多少个{letter}",
    "{word}里有几个{letter}",
    "数一下{word}中的{letter}",
    "{word}这个词里有多少{letter}",
    "{word}에 {letter}가 몇 개 있나요",
    "{word}에서 {letter}의 개수는",
    "{word}에 {letter}가 몇 번 나오나요",
    "{word}라는 단어에 {letter}가 몇 개",
    "Combien de {letter} dans {word}",
    "Combien de fois {letter} apparaît dans {word}",
    "Compte les {letter} dans {word}",
    "Wie viele {letter} sind in {word}",
    "Wie oft kommt {letter} in {word} vor",
    "Zähle die {letter} in {word}",
    "{word}に{letter}は何個ありますか",
    "{word}の中に{letter}がいくつ",
    "{word}に{letter}が何回出てくる",
]
QUOTES = ["", "'", '"']


def strings(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


# --- multiple choice -------------------------------------------------------------------------------


def render_mc(question: Column, letters: Column, choices: Column) -> Column:
    """Question, one line per choice with its letter behind it, and the instruction; the shorter list wins."""
    n = F.least(F.size(letters), F.size(choices))
    lines = F.zip_with(
        F.slice(choices, 1, n), F.slice(letters, 1, n), lambda c, x: F.concat(F.lit("- "), c, F.lit("="), x, F.lit("\n"))
    )
    return F.concat(
        F.lit("Multiple Choice question: "), question, F.lit("\n"), F.array_join(lines, ""),
        F.lit("\nRespond only with the letter of the correct answer."),
    )


def mc_answer_by_index(choices: Column, answer: Column, letters: list[str] = LETTERS) -> Column:
    """Letter of the answer index; a question must have exactly one choice per letter."""
    return F.when(F.size(choices) == len(letters), F.element_at(strings(letters), answer.cast("int") + 1)).otherwise(
        F.raise_error(F.lit(f"expected {len(letters)} choices"))
    )


def mc_answer_by_key(letters: Column, key: Column) -> Column:
    return F.when(F.array_contains(letters, key), key).otherwise(
        F.raise_error(F.lit("the answer must be one of the letters"))
    )


def lettered_question(question: Column, options: dict[str, Column]) -> Column:
    """Question followed by a ``K. text`` line for every option that is there."""
    lines = F.array_compact(F.array(*[F.concat(F.lit(f"{k}. "), v) for k, v in options.items()]))
    return F.when(F.size(lines) == 0, question).otherwise(F.concat(question, F.lit("\n"), F.array_join(lines, "\n")))


def lettered_answer(answer: Column, options: dict[str, Column]) -> Column:
    """``K. text`` when the answer is the letter of a present option, else the raw answer."""
    out = F.coalesce(answer.cast("string"), F.lit(""))
    for k, v in options.items():
        out = F.when((answer == k) & v.isNotNull(), F.concat(F.lit(f"{k}. "), v)).otherwise(out)
    return out


def letter_correct(letters: Column, predicted: Column, reference: Column) -> Column:
    """Equality of the letters; a letter that was not offered is an error."""
    return F.when(F.array_contains(letters, predicted), predicted == reference).otherwise(
        F.raise_error(F.lit("the predicted letter was not offered")).cast("boolean")
    )


# --- math answers ----------------------------------------------------------------------------------


def tool_call_parts(answer: Column) -> Column:
    """Text, tool call and tool output parts of an answer with ``<<expression=result>>`` marks."""
    texts = F.transform(F.split(answer, "<<[^>]+>>", -1), lambda t: F.array(part("text", t)))

    def call(raw: Column) -> Column:
        inner = F.substring(raw, 3, F.length(raw) - 4)
        has = F.contains(inner, F.lit("="))
        result = F.when(has, F.substring_index(inner, "=", -1)).otherwise(F.lit(""))
        left = F.when(has, F.left(inner, F.length(inner) - F.length(result) - 1)).otherwise(inner)
        return F.array(part("python", left), part("python_output", result))

    calls = F.transform(F.regexp_extract_all(answer, F.lit("<<[^>]+>>"), F.lit(0)), call)
    return F.flatten(F.zip_with(texts, calls, lambda t, c: F.coalesce(F.concat(t, c), t)))


def cot_clean(answer: Column) -> Column:
    return F.regexp_replace(F.replace(answer, F.lit("####"), F.lit("The answer is")), "<<[^>]+>>", "")


def extract_answer(text: Column) -> Column:
    """The number behind the first ``####`` without commas; null if there is none."""
    found = F.nullif(F.regexp_extract(text, r"#### (-?[0-9.,]+)", 1), F.lit(""))
    return F.replace(found, F.lit(","), F.lit(""))


def answer_correct(predicted: Column, reference: Column) -> Column:
    """Equal as strings; two missing answers are equal."""
    return extract_answer(predicted).eqNullSafe(extract_answer(reference))


def reward(correct: Column) -> Column:
    return correct.cast("double")


# --- code answers ----------------------------------------------------------------------------------


def extract_imports(prompt: Column) -> Column:
    """Import lines before the first line of other code."""
    trimmed = F.transform(F.split(prompt, "\n"), lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+$", ""))
    is_import = lambda x: x.startswith("import ") | x.startswith("from ")
    other = F.transform(trimmed, lambda x: ~is_import(x) & (x != "") & ~x.startswith("#"))
    stop = F.array_position(other, True)
    head = F.when(stop > 0, F.slice(trimmed, 1, (stop - 1).cast("int"))).otherwise(trimmed)
    return F.array_join(F.filter(head, is_import), "\n")


def extract_program(completion: Column) -> Column:
    """The first fenced block, else the whole text; trimmed."""
    fenced = r"(?sU)```(?:python)?\s*\n(.*?)\n```"
    body = F.when(completion.rlike(fenced), F.regexp_extract(completion, fenced, 1)).otherwise(completion)
    return F.regexp_replace(body, r"(?U)^\s+|\s+$", "")


def check_program(prompt: Column, completion: Column, test: Column, entry_point: Column) -> Column:
    """The text handed to an external runner."""
    return F.concat(
        extract_imports(prompt), F.lit("\n\n"), extract_program(completion), F.lit("\n\n"), test,
        F.lit("\ncheck("), entry_point, F.lit(")"),
    )


# --- spelling --------------------------------------------------------------------------------------


def spelled(word: Column) -> Column:
    return F.array_join(F.split(word, ""), ",")


def letter_count(word: Column, letter: Column) -> Column:
    """Occurrences of a single character."""
    return F.length(word) - F.length(F.replace(word, letter, F.lit("")))


def drawn_letter(word: Column, seed: str, *keys: str) -> Column:
    """A letter of the word (90 %) or of the alphabet (10 %)."""
    own = F.substring(word, draw_index(F.length(word), f"{seed}-own", *keys).cast("int") + 1, F.lit(1))
    other = F.substring(F.lit(ALPHABET), draw_index(26, f"{seed}-any", *keys).cast("int") + 1, F.lit(1))
    return F.when(u(f"{seed}-pick", *keys) < 0.9, own).otherwise(other)


def letter_question(word: Column, letter: Column, seed: str, *keys: str, templates: list[str] = LETTER_TEMPLATES) -> Column:
    pick = lambda salt, values: F.element_at(
        strings(values), draw_index(len(values), f"{seed}-{salt}", *keys).cast("int") + 1
    )
    template = pick("template", templates)
    template = F.when(u(f"{seed}-lower", *keys) < 0.3, F.lower(template)).otherwise(template)
    lq, wq = pick("lq", QUOTES), pick("wq", QUOTES)
    text = F.replace(template, F.lit("{letter}"), F.concat(lq, letter, lq))
    text = F.replace(text, F.lit("{word}"), F.concat(wq, word, wq))
    return F.concat(text, F.when(u(f"{seed}-mark", *keys) < 0.5, F.lit("?")).otherwise(F.lit("")))


def letter_answer_parts(word: Column, letter: Column) -> Column:
    """Manual count, tool call, tool output and final answer."""
    count = letter_count(word, letter).cast("string")

    def line(i: Column) -> Column:
        c = F.substring(word, i, F.lit(1))
        seen = letter_count(F.substring(word, F.lit(1), i), letter).cast("string")
        base = F.concat(i.cast("string"), F.lit(":"), c)
        return F.when(c == letter, F.concat(base, F.lit(" hit! count="), seen, F.lit("\n"))).otherwise(F.concat(base, F.lit("\n")))

    lines = F.array_join(F.transform(F.sequence(F.lit(1), F.length(word)), line), "")
    # fixed texts of the worked answer
    manual = F.concat(
        F.lit("We are asked to find the number '"), letter, F.lit("' in the word '"), word,
        F.lit("'. Let me try a manual approach first.\n\nFirst spell the word out:\n"), word, F.lit(":"), spelled(word),
        F.lit("\n\nThen count the occurrences of '"), letter, F.lit("':\n"), lines, F.lit("\nThis gives us "), count, F.lit("."),
    )
    return F.array(
        part("text", manual),
        part("text", F.lit("\n\nLet me double check this using Python:\n\n")),
        part("python", F.concat(F.lit("'"), word, F.lit("'.count('"), letter, F.lit("')"))),
        part("python_output", count),
        part("text", F.concat(F.lit("\n\nPython gives us "), count, F.lit(".\n\nMy final answer is:\n\n#### "), count)),
    )


# --- calculator ------------------------------------------------------------------------------------

# fixed values: what an arithmetic and a text expression may contain, and what a text expression may not
MATH_CHARS = "0123456789*+-/.() "
TEXT_CHARS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789'\"()._ "
REFUSED = [
    "__", "import", "exec", "eval", "compile", "open", "file", "input", "raw_input", "globals",
    "locals", "vars", "dir", "getattr", "setattr", "delattr", "hasattr",
]

_OPS = {
    ast.Add: operator.add, ast.Sub: operator.sub, ast.Mult: operator.mul,
    ast.Div: operator.truediv, ast.FloorDiv: operator.floordiv,
    ast.UAdd: operator.pos, ast.USub: operator.neg,
}


def _value(node):
    if isinstance(node, ast.Expression):
        return _value(node.body)
    if isinstance(node, ast.Constant) and isinstance(node.value, (int, float, str)):
        return node.value
    if isinstance(node, ast.BinOp) and type(node.op) in _OPS:
        return _OPS[type(node.op)](_value(node.left), _value(node.right))
    if isinstance(node, ast.UnaryOp) and type(node.op) in _OPS:
        return _OPS[type(node.op)](_value(node.operand))
    if (
        isinstance(node, ast.Call) and isinstance(node.func, ast.Attribute) and node.func.attr == "count"
        and len(node.args) == 1 and not node.keywords
    ):
        text, what = _value(node.func.value), _value(node.args[0])
        if isinstance(text, str) and isinstance(what, str):
            return text.count(what)
    raise ValueError("not allowed")


def calculate(expr: str | None) -> str | None:
    """Value of a plain arithmetic expression or of ``'text'.count('x')``; None for anything else."""
    if expr is None:
        return None
    expr = expr.replace(",", "")
    if all(c in MATH_CHARS for c in expr):
        if "**" in expr:
            return None
    elif ".count(" not in expr or not all(c in TEXT_CHARS for c in expr) or any(w in expr.lower() for w in REFUSED):
        return None
    try:
        return str(_value(ast.parse(expr.strip(), mode="eval")))
    except (ValueError, SyntaxError, TypeError, ArithmeticError, MemoryError, RecursionError):
        return None


@F.arrow_udf(T.StringType())
def calculator(exprs: pa.Array) -> pa.Array:
    """Every distinct expression of a batch is worked out once."""
    codes = exprs.dictionary_encode()
    values = pa.array([calculate(e) for e in codes.dictionary.to_pylist()], pa.string())
    return values.take(codes.indices)
