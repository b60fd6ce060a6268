"""Byte-pair encoding with a segment tree over the ranks of adjacent pairs.

The tree holds, for every position, ``rank of the pair that starts here, position``; its root is the leftmost
pair of the lowest rank. A merge changes three leaves, each in logarithmic time, until the root is empty.
A word of n symbols so takes O(n log n), also where it has no white space for 100,000 characters.
Words of one length go through their trees in step, as columns of one array; very long words go through a tree each.

Words come from the public file's own normaliser and pre-tokeniser. They never reach over white space, so a text is
cut at white space first, and every distinct piece of a batch and word of a task is worked out once (a bounded memory).
"""

from __future__ import annotations

import gc
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from struct import pack

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import MIX, keyed_texts, sliced, text_bytes

# fixed values: the characters of Unicode's White_Space, at which words end
SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
SPACES = re.compile(f"[{SPACE}]+")
# str.split() also cuts at these four, which are not white space there
SEPARATORS = ("\x1c", "\x1d", "\x1e", "\x1f")

# words a task keeps, and their characters
CACHE_WORDS = 400_000
CACHE_CHARS = 1 << 24
# bytes of texts that are encoded at once where only sums of their ids go on
SLICE_TEXT = 16 << 20
# words of up to so many symbols go through their trees together, so many words at a time
PLACE_BITS = 6
TOGETHER = 1 << PLACE_BITS
COLUMNS = 8192
# children of a node of the tree of a longer word
FAN = 32
NONE = 1 << 62
FAR = np.int32(2**31 - 1)
# pieces of these letters, digits and signs need no look at Unicode's tables: composed already, one lower case each
PLAIN = "^[!-~À-ÖØ-öø-ÿ]+$"
# kinds of the bytes of such pieces in lower case
LETTER, DIGIT, BREAK, SIGN = 1, 2, 3, 4
KINDS = np.full(256, SIGN, np.uint8)
KINDS[ord("a") : ord("z") + 1] = KINDS[128:] = LETTER
KINDS[ord("0") : ord("9") + 1] = DIGIT
KINDS[ord("\n")] = BREAK
# fixed values: what the pre-tokeniser cuts off with an apostrophe before it
SHORT = [ord(c) for c in "stmd"]
SHORT_PAIRS = [(ord(a), ord(b)) for a, b in ("re", "ve", "ll")]


def plain_words(data: np.ndarray) -> np.ndarray:
    """Where words begin in plain pieces in lower case that end with line breaks: runs of letters or signs, single digits and breaks."""
    kind = KINDS[data]
    starts = np.ones(len(data), bool)
    starts[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT) | (kind[1:] == BREAK)
    # an apostrophe that begins a run of signs takes a short ending with it; a break follows any piece, so two bytes follow any but the last
    mark = np.flatnonzero(starts & (data == ord("'")))
    padded = np.concatenate([data, np.zeros(3, np.uint8)])
    one, two = padded[mark + 1], padded[mark + 2]
    short = np.isin(one, SHORT)
    pair = np.zeros(len(mark), bool)
    for a, b in SHORT_PAIRS:
        pair |= (one == a) & (two == b)
    starts[mark[short | pair] + 1] = False
    starts[mark[short] + 2] = True
    starts[mark[pair] + 3] = True
    return np.flatnonzero(starts)


def white_split(text: str) -> list[str]:
    """The pieces of a text between white space."""
    if any(c in text for c in SEPARATORS):
        return [x for x in SPACES.split(text) if x]
    return text.split()


class MinTree:
    """A segment tree of minima over ``leaves`` with ``FAN`` children per node; the caller changes leaves in place."""

    def __init__(self, leaves: list[int]):
        self.levels = [leaves]
        while len(below := self.levels[-1]) > 1:
            self.levels.append([min(below[i : i + FAN]) for i in range(0, len(below), FAN)])

    def root(self) -> int:
        return self.levels[-1][0]

    def update(self, i: int) -> None:
        """Work out anew the nodes above leaf ``i``, as far up as they change."""
        for below, level in zip(self.levels, self.levels[1:]):
            i //= FAN
            value = min(below[i * FAN : i * FAN + FAN])
            if level[i] == value:
                return
            level[i] = value


class PairTable:
    """Ranks of pairs for whole arrays: a hash table at most an eighth full, with linear probing."""

    EMPTY = np.iinfo(np.int64).min

    def __init__(self, pairs: dict[tuple[int, int], int]):
        bits = max(8 * len(pairs), 16).bit_length()
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.ranks = np.full(1 << bits, self.EMPTY), np.full(1 << bits, FAR)
        keys = np.array([a << 32 | b for a, b in pairs], np.int64)
        ranks = np.array(list(pairs.values()), np.int32)
        at = self.slots(keys)
        while len(keys):
            free = self.keys[at] == self.EMPTY
            self.keys[at[free]] = keys[free]
            put = self.keys[at] == keys
            self.ranks[at[put]] = ranks[put]
            keys, ranks, at = keys[~put], ranks[~put], at[~put] + 1 & self.mask

    def slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * MIX >> self.shift).astype(np.int64)

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The ranks of the pairs, ``FAR`` for what is no pair."""
        keys = a.astype(np.int64) << 32 | b
        at = self.slots(keys)
        held = self.keys[at]
        ranks = np.where(held == keys, self.ranks[at], FAR)
        others = np.flatnonzero((held != keys) & (held != self.EMPTY))
        at = at[others]
        while len(others):
            at = at + 1 & self.mask
            held, wanted = self.keys[at], keys[others]
            same = held == wanted
            ranks[others[same]] = self.ranks[at[same]]
            on = ~same & (held != self.EMPTY)
            others, at = others[on], at[on]
        return ranks


class Merges:
    """Merges by rank: ``pairs[left, right]`` is the rank, ``made[rank]`` the id of the merged symbol."""

    def __init__(self, pairs: dict[tuple[int, int], int], made: list[int]):
        self.pairs, self.made = pairs, made
        self.lookup = None

    def apply(self, ids: list[int]) -> list[int]:
        """The ids after all merges, lowest rank first, leftmost first among equal ranks."""
        n = len(ids)
        if n < 2:
            return ids
        rank, made, none = self.pairs.get, self.made, NONE
        # a leaf is rank * n + position, so that the least leaf is the leftmost pair of the lowest rank
        leaves = []
        for i in range(n - 1):
            r = rank((ids[i], ids[i + 1]))
            leaves.append(none if r is None else r * n + i)
        tree = MinTree(leaves)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while (least := tree.root()) < none:
            r, i = divmod(least, n)
            j = after[i]
            k = after[j]
            new = made[r]
            ids[i], ids[j] = new, -1
            after[i] = k
            changed = []
            if j < n - 1:
                leaves[j] = none
                changed.append(j)
            leaves[i] = none
            if k < n:
                before[k] = i
                r = rank((new, ids[k]))
                if r is not None:
                    leaves[i] = r * n + i
            h = before[i]
            if h >= 0:
                r = rank((ids[h], new))
                leaves[h] = none if r is None else r * n + h
                changed.append(h)
            tree.update(i)
            for p in changed:
                tree.update(p)
        return [x for x in ids if x >= 0]

    def apply_many(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for many words of one length, a column each: all their ids, word after word, and how many each has.

        Row ``size + i`` of the trees is leaf ``i`` and row 1 the root. Every step takes the root of all words that
        still have one, merges there and works out the three paths to the root anew that the merge touches.
        """
        if self.lookup is None:
            self.lookup = PairTable(self.pairs), np.array(self.made, np.int32)
        table, made = self.lookup

        def leaf(a: np.ndarray, b: np.ndarray, place: np.ndarray) -> np.ndarray:
            rank = table.find(a, b)
            return np.where(rank < FAR, rank << PLACE_BITS | place, FAR)

        n, w = ids.shape
        # one more row stands for what is beyond both ends; no pair has it
        ids = np.vstack([ids, np.full((1, w), -1, np.int32)])
        size = 1 << (n - 1).bit_length()
        tree = np.full((2 * size, w), FAR, np.int32)
        place = np.repeat(np.arange(n - 1, dtype=np.int32), w)
        tree[size : size + n - 1] = leaf(ids[: n - 1].ravel(), ids[1:n].ravel(), place).reshape(n - 1, w)
        for p in range(size - 1, 0, -1):
            np.minimum(tree[2 * p], tree[2 * p + 1], out=tree[p])
        after = np.repeat(np.arange(1, n + 2), w)
        before = np.repeat(np.array([n, *range(n)]), w)
        ids, tree = ids.ravel(), tree.ravel()
        word = np.flatnonzero(tree[w : 2 * w] < FAR)
        while len(word):
            root = tree[w + word]
            i, new = (root & (TOGETHER - 1)).astype(np.int64), made[root >> PLACE_BITS]
            at = i * w + word
            j = after[at]
            k = after[j * w + word]
            h = before[at]
            ids[at], ids[j * w + word] = new, -1
            after[at], before[k * w + word] = k, i
            left = np.minimum(h, n - 1)  # the last leaf is no pair and stays empty
            tree[(size + j) * w + word] = FAR
            tree[(size + left) * w + word] = leaf(ids[h * w + word], new, left)
            tree[(size + i) * w + word] = leaf(new, ids[k * w + word], i)
            for p in (left, j, i):
                node = (size + p) >> 1
                for _ in range(size.bit_length() - 1):
                    below = 2 * node * w + word
                    tree[node * w + word] = np.minimum(tree[below], tree[below + w])
                    node >>= 1
            word = word[tree[w + word] < FAR]
        columns = ids.reshape(n + 1, w)[:n].T
        kept = columns >= 0
        return columns[kept], kept.sum(axis=1)


# fixed value: the pre-tokeniser's pattern in the file
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def byte_alphabet() -> list[str]:
    """The characters that stand for the 256 bytes: printable ones for themselves, the others from U+0100 on, in order."""
    shown = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


def id_bytes(ids: list[int]) -> bytes:
    return pack(f"<{len(ids)}i", *ids)


class WordBpe:
    """A tokenizer file whose words end at white space and carry an end mark (``word_bpe_49k.json``)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        if model["type"] != "BPE" or not self.end or spec.get("decoder") or spec.get("post_processor"):
            raise ValueError("a BPE file with an end-of-word mark, no decoder and no post-processor is needed")
        self.vocab = vocab = model["vocab"]
        pairs, made = {}, []
        for rank, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            pairs.setdefault((vocab[a], vocab[b]), rank)
            made.append(vocab[a + b])
        self.merges = Merges(pairs, made)
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.special_cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.names = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        file = Tokenizer.from_file(path)
        if spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] != WORD_PATTERN:
            raise ValueError("the file cuts words by another pattern")
        alphabet = byte_alphabet()
        self.inner = np.array([vocab[c] for c in alphabet], np.int32)
        self.last = np.array([vocab[c + self.end] for c in alphabet], np.int32)
        self.normalize, self.cut = file.normalizer.normalize_str, file.pre_tokenizer.pre_tokenize_str

    def encode_words(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For plain words, some at a time: which ones, all their ids and how many each has."""
        coded = [w.encode() for w in words]
        sizes = np.array(list(map(len, coded)))
        starts = np.cumsum(sizes) - sizes
        flat = np.frombuffer(b"".join(coded), np.uint8)
        for n in np.unique(sizes).tolist():
            chosen = np.flatnonzero(sizes == n)
            if n > TOGETHER:
                for i in chosen.tolist():
                    found = self.merges.apply(self.inner[list(coded[i][:-1])].tolist() + [int(self.last[coded[i][-1]])])
                    yield np.array([i]), np.array(found, np.int32), np.array([len(found)])
                continue
            for at in range(0, len(chosen), COLUMNS):
                part = chosen[at : at + COLUMNS]
                ids = self.inner[flat[starts[part] + np.arange(n)[:, None]]]
                ids[-1] = self.last[flat[starts[part] + n - 1]]
                yield part, *(self.merges.apply_many(ids) if n > 1 else (ids[0], np.ones(len(part), np.int64)))

    def encode_any(self, piece: str) -> bytes:
        """The same for one text of any characters, by the file's own normaliser and pre-tokeniser."""
        out: list[int] = []
        for part in self.special_cut.split(piece) if self.special_cut else [piece]:
            if part in self.special:
                out.append(self.special[part])
            elif part:
                for word, _ in self.cut(self.normalize(part)):
                    symbols = [self.vocab[c] for c in word[:-1]] + [self.vocab[word[-1] + self.end]]
                    out += self.merges.apply(symbols)
        return id_bytes(out)


@lru_cache(1)
def load(path: str) -> WordBpe:
    """The tokenizer of a file, read once by each Python worker."""
    return WordBpe(path)


def calm_gc() -> None:
    """Millions of live strings and lists: look for cycles seldom."""
    gc.set_threshold(200_000, 50, 100)


class Lists:
    """Lists of ids, one after the other, by number."""

    def __init__(self):
        self.ids, self.starts, self.sizes = np.zeros(1 << 16, np.int32), np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)
        self.n_ids = self.n = 0

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> int:
        """Append lists of these sizes; the number of the first one."""
        first, n_ids = self.n, self.n_ids
        if n_ids + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids[:n_ids], np.zeros(n_ids + 2 * len(ids), np.int32)])
        if first + len(sizes) > len(self.sizes):
            more = np.zeros(first + 2 * len(sizes), np.int64)
            self.starts, self.sizes = np.concatenate([self.starts[:first], more]), np.concatenate([self.sizes[:first], more])
        self.ids[n_ids : n_ids + len(ids)] = ids
        self.sizes[first : first + len(sizes)] = sizes
        self.starts[first : first + len(sizes)] = n_ids + np.cumsum(sizes) - sizes
        self.n, self.n_ids = first + len(sizes), n_ids + len(ids)
        return first

    def take(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these lists, one after the other, and the size of each."""
        sizes = self.sizes[numbers]
        ends = np.cumsum(sizes)
        places = np.repeat(self.starts[numbers] - (ends - sizes), sizes)
        return self.ids[places + np.arange(len(places))], sizes


class Encoder:
    """Encodes columns of texts; keeps the words met so far, of bounded number and length beside those of the texts at hand."""

    def __init__(self, bpe: WordBpe):
        calm_gc()
        self.bpe = bpe
        self.forget()

    def forget(self) -> None:
        # a line break is the word without ids
        self.words, self.lists, self.chars = {"\n": 0}, Lists(), 0
        self.lists.add(np.zeros(0, np.int32), np.zeros(1, np.int64))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and where each text begins and the last one ends."""
        cut = pc.ascii_split_whitespace(texts)
        pieces = cut.flatten().dictionary_encode()
        found, numbers = self.distinct(pieces.dictionary)
        ids, sizes = found.take(numbers[pieces.indices.to_numpy()])
        ends = np.concatenate([[0], np.cumsum(sizes)])
        offsets = cut.offsets.to_numpy()
        return ids, ends[offsets - offsets[0]]

    def distinct(self, pieces: pa.Array) -> tuple[Lists, np.ndarray]:
        """The lists of ids of pieces without white space, and the number of each piece's list."""
        plain = pc.and_not(pc.match_substring_regex(pieces, PLAIN), pc.match_substring(pieces, "<|"))
        found, numbers = Lists(), np.zeros(len(pieces), np.int64)
        chosen = plain.to_numpy(zero_copy_only=False)
        found.add(*self.encode_plain(pieces.filter(plain)))
        others = [self.bpe.encode_any(p) for p in pieces.filter(pc.invert(plain)).to_pylist()]
        found.add(np.frombuffer(b"".join(others), "<i4"), np.array([len(x) // 4 for x in others], np.int64))
        numbers[chosen] = np.arange(n := int(chosen.sum()))
        numbers[~chosen] = np.arange(n, len(pieces))
        return found, numbers

    def encode_plain(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of plain pieces, one after the other, and how many each has."""
        if len(self.words) >= CACHE_WORDS or self.chars >= CACHE_CHARS:
            self.forget()
        words = self.words
        data, _ = text_bytes(pc.binary_join_element_wise(pc.utf8_lower(pieces), "", "\n"))
        ends = np.append(plain_words(data), len(data)).astype(np.int32)
        cut = pa.StringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends), pa.py_buffer(data)).dictionary_encode()
        met = cut.dictionary.to_numpy(zero_copy_only=False).tolist()
        new = [w for w in met if w not in words]
        for chosen, ids, sizes in self.bpe.encode_words(new) if new else ():
            first = self.lists.add(ids, sizes)
            words.update(zip(map(new.__getitem__, chosen.tolist()), range(first, first + len(chosen))))
        self.chars += sum(map(len, new))
        numbers = np.fromiter(map(words.__getitem__, met), np.int64, len(met))[cut.indices.to_numpy()]
        ids, sizes = self.lists.take(numbers)
        return ids, np.diff(np.cumsum(sizes)[numbers == 0], prepend=0)


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", decoded: bool = False) -> DataFrame:
    """``doc_id, ids array<int>`` and, if ``decoded``, the text that the ids decode to.

    One row per row of ``docs``; nulls count as empty texts, which have no ids and decode to the empty text. Repeated
    rows are encoded each. Whole texts are encoded, however long; no shuffle.
    """
    schema = "doc_id long, ids array<int>" + ", decoded string" * decoded

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        coder = Encoder(bpe)
        names = pa.array(map(bpe.names.get, range(max(bpe.names) + 1)), pa.string()) if decoded else None
        for batch in sliced(batches):
            ids, ends = coder.encode(batch.column("text"))
            ends = pa.array(ends.astype(np.int32))
            columns = [batch.column("doc_id"), pa.ListArray.from_arrays(ends, pa.array(ids))]
            if decoded:
                columns.append(pc.binary_join(pa.ListArray.from_arrays(ends, names.take(pa.array(ids))), " "))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded"][: len(columns)])

    return keyed_texts(docs, key, text).mapInArrow(run, schema)


def decode(rows: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``doc_id, text`` that the ids decode to; a null list counts as empty, a null id in a list is skipped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = load(path).names
        for batch in batches:
            texts = [" ".join(names[i] for i in x or () if i is not None) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return rows.select(F.col(key).cast("long").alias("doc_id"), F.col(ids).alias("ids")).mapInArrow(run, "doc_id long, text string")
