"""Splitting text into pieces and byte symbols, with built-in functions only."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: the split pattern (digits in groups of one or two) and the special tokens, in id order
SPLIT_PATTERN = (
    r"""'(?i:[sdmt]|ll|ve|re)|[^\r\n\p{L}\p{N}]?+\p{L}+|\p{N}{1,2}| ?[^\s\p{L}\p{N}]++[\r\n]*|\s*[\r\n]|\s+(?!\S)|\s+"""
)
SPECIAL_TOKENS = [
    "<|bos|>",
    "<|user_start|>",
    "<|user_end|>",
    "<|assistant_start|>",
    "<|assistant_end|>",
    "<|python_start|>",
    "<|python_end|>",
    "<|output_start|>",
    "<|output_end|>",
]
BOS, USER_START, USER_END, ASSISTANT_START, ASSISTANT_END, PYTHON_START, PYTHON_END, OUTPUT_START, OUTPUT_END = range(9)


def strip(text: Column | str) -> Column:
    """The text without white space, as Unicode defines it, at its ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def split_pattern(digits: int = 2) -> str:
    """The split pattern with groups of up to ``digits`` digits."""
    if digits < 1:
        raise ValueError("a group has at least one digit")
    return SPLIT_PATTERN.replace(r"\p{N}{1,2}", rf"\p{{N}}{{1,{digits}}}")


def pieces(text: Column | str, pattern: str = SPLIT_PATTERN) -> Column:
    """The text cut by the split pattern; the pieces join back to the whole text, which any other pattern must see to.

    ``(?U)`` makes ``\\s`` cover all Unicode white space.
    """
    return F.regexp_extract_all(text, F.lit("(?U)" + pattern), F.lit(0))


def byte_symbols(text: Column | str) -> Column:
    """The UTF-8 bytes of the text as a string of code points 0-255."""
    return F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")


def _byte_list(data: pa.Array) -> pa.ListArray:
    """The bytes of every text as a list of ids, without a copy per text; null for null."""
    data = data.cast(pa.binary())
    offsets = np.frombuffer(data.buffers()[1], np.int32)[data.offset : data.offset + len(data) + 1]
    held = np.frombuffer(data.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    ends = pa.array(offsets - offsets[0])
    return pa.ListArray.from_arrays(ends, pa.array(held.astype(np.int32)), mask=data.is_null())


def _byte_lists(texts: pa.ListArray) -> pa.ListArray:
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    inner = _byte_list(texts.values.slice(int(offsets[0]), int(offsets[-1] - offsets[0])))
    return pa.ListArray.from_arrays(pa.array(offsets - offsets[0]), inner, mask=texts.is_null())


#: bytes of texts that a task encodes at once
SLICE_BYTES = 8 << 20


def _offsets(column: pa.Array) -> np.ndarray:
    return np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """An array of texts, or of lists of texts at any depth, in stretches of up to ``limit`` bytes, one row at least."""
    if not len(column):
        return
    ends, inner, start = _offsets(column), column, 0
    while pa.types.is_list(inner.type):
        inner = inner.values
        ends = _offsets(inner)[ends] if len(inner) else np.zeros_like(ends)
    while start < len(column):
        stop = max(start + 1, int(np.searchsorted(ends, int(ends[start]) + limit, "right")) - 1)
        yield column.slice(start, stop - start)
        start = stop


class ByteTokenizer:
    """One id per UTF-8 byte; special tokens follow the bytes. Texts are encoded by the batch."""

    n_base = 256

    def special(self, i: int) -> int:
        return self.n_base + i

    def encode(self, text: Column | str) -> Column:
        return F.arrow_udf(_arrow(_byte_list), "array<int>")(text)

    def encode_each(self, texts: Column) -> Column:
        return F.arrow_udf(_arrow(_byte_lists), "array<array<int>>")(texts)


def _arrow(fn):
    def encoded(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            for part in text_slices(column):
                yield fn(part)

    return encoded
