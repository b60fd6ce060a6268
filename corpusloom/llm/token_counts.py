"""Token counts that follow edits, without encoding a document again.

A document is held as segments of whole pre-tokens with a segment tree over them; a node sums the characters and the
tokens below it. An edit goes down the tree to its place, encodes anew only the pre-tokens that it touches
with the context up to the next white space on both sides (pre-tokens never reach over white space), and adds
the difference to the sums on the way up.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.bpe import SPACE, Encoder, load, white_split
from corpusloom.llm.common import sliced

# characters of a leaf, unless one pre-token is longer
SEGMENT_CHARS = 512
BREAK = re.compile(f"[{SPACE}]")

EDIT = "struct<at:long,removed:long,added:string>"


class SegmentTree:
    """Texts of leaves, and sums of characters and tokens over them."""

    def __init__(self, text: str, count):
        self.count = count
        self.encoded = 0
        self.leaves = segments(text) or [""]
        self.size = size = 1 << (len(self.leaves) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * size), [0] * (2 * size)
        for i, (leaf, tokens) in enumerate(zip(self.leaves, map(count, self.leaves))):
            self.chars[size + i], self.tokens[size + i] = len(leaf), tokens
        for p in range(size - 1, 0, -1):
            self.chars[p] = self.chars[2 * p] + self.chars[2 * p + 1]
            self.tokens[p] = self.tokens[2 * p] + self.tokens[2 * p + 1]

    def find(self, at: int) -> tuple[int, int]:
        """The leaf that holds character ``at`` (the last one for the end of the text) and the place in it."""
        p = 1
        if at >= self.chars[1]:
            i = len(self.leaves) - 1
            return i, len(self.leaves[i])
        while p < self.size:
            p *= 2
            if at >= self.chars[p]:
                at -= self.chars[p]
                p += 1
        return p - self.size, at

    def put(self, i: int, leaf: str, tokens: int) -> None:
        p = self.size + i
        chars, tokens = len(leaf) - self.chars[p], tokens - self.tokens[p]
        self.leaves[i] = leaf
        while p:
            self.chars[p] += chars
            self.tokens[p] += tokens
            p //= 2

    def edit(self, at: int, removed: int, added: str) -> None:
        """Replace ``removed`` characters from ``at`` on by ``added``; a place beyond the text counts as its end."""
        at = max(0, min(at, self.chars[1]))
        removed = max(0, min(removed, self.chars[1] - at))
        i, lo = self.find(at)
        j, hi = self.find(at + removed)
        # the context: up to the next white space on both sides, in these leaves or the ones beyond
        left = last_break(self.leaves[i], lo)
        while left < 0 and i:
            i -= 1
            left = last_break(self.leaves[i], len(self.leaves[i]))
        first, before = i, left + 1
        right = next_break(self.leaves[j], hi)
        while right < 0 and j + 1 < len(self.leaves):
            j += 1
            right = next_break(self.leaves[j], 0)
        end = right if right >= 0 else len(self.leaves[j])
        whole = "".join(self.leaves[first : j + 1])
        start = at - self.before(first)
        stop = len(whole) - len(self.leaves[j]) + end
        old, new = whole[before:stop], whole[before:start] + added + whole[start + removed : stop]
        was, now = self.count(old), self.count(new)
        self.encoded += len(new)
        tokens = sum(self.tokens[self.size + k] for k in range(first, j + 1))
        for k in range(first + 1, j + 1):
            self.put(k, "", 0)
        self.put(first, whole[:before] + new + whole[stop:], tokens - was + now)

    def before(self, i: int) -> int:
        """Characters before leaf ``i``."""
        p, total = self.size + i, 0
        while p > 1:
            if p & 1:
                total += self.chars[p - 1]
            p //= 2
        return total


def segments(text: str) -> list[str]:
    """The text cut before white space into leaves of about ``SEGMENT_CHARS``."""
    out, at = [], 0
    while at < len(text):
        cut = BREAK.search(text, at + SEGMENT_CHARS)
        end = cut.start() if cut else len(text)
        out.append(text[at:end])
        at = end
    return out


def last_break(text: str, end: int) -> int:
    """Where the last white space before ``end`` stands, or -1."""
    for k in range(end - 1, -1, -1):
        if BREAK.match(text, k):
            return k
    return -1


def next_break(text: str, start: int) -> int:
    found = BREAK.search(text, start)
    return found.start() if found else -1


def count_tokens(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", edits: str = "edits") -> DataFrame:
    """Token counts of every document before and after its edits.

    ``edits`` is an array of ``at, removed, added``, applied in order; places count characters of the text as the edits before
    left it. A null text counts as empty, a null list or entry as no edit, a null place or count as 0, a null
    ``added`` as empty. ``doc_id, n_edits, n_tokens, n_tokens_edited, n_chars_edited, n_chars_encoded``: the last one
    is how much text the edits had encoded anew. Repeated rows are counted each.
    """
    schema = "doc_id long, n_edits long, n_tokens long, n_tokens_edited long, n_chars_edited long, n_chars_encoded long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        coder = Encoder(bpe)
        known: dict[str, int] = {}

        def count(text: str) -> int:
            return sum(known[p] if p in known else len(bpe.encode_any(p)) // 4 for p in white_split(text))

        for batch in sliced(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            rows = []
            # the pieces of a batch are worked out together, those that edits make one by one
            pieces = pc.ascii_split_whitespace(pa.array(texts, pa.string())).flatten().unique()
            found, numbers = coder.distinct(pieces)
            known.clear()
            known.update(zip(pieces.to_numpy(zero_copy_only=False), found.sizes[numbers].tolist()))
            for text, doc, edits in zip(texts, batch.column("doc_id").to_pylist(), batch.column("edits").to_pylist()):
                tree = SegmentTree(text, count)
                n_tokens = tree.tokens[1]
                done = [e for e in edits or () if e is not None]
                for e in done:
                    tree.edit(e["at"] or 0, e["removed"] or 0, e["added"] or "")
                rows.append((doc, len(done), n_tokens, tree.tokens[1], tree.chars[1], tree.encoded))
            columns = list(zip(*rows))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], [x.split()[0] for x in schema.split(", ")])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), F.col(edits).cast(f"array<{EDIT}>").alias("edits"))
    return rows.mapInArrow(run, schema)
