"""Byte-level BPE: counting pieces, learning merges, encoding and decoding.

A word in training is a string with one code point per symbol (ids 0-255 are bytes, merged symbols follow), so
a merge is a plain string replacement and pair counts are one aggregation. Only merges and vocabularies, which the
vocabulary size bounds, ever reach the driver.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions import text as tx
from corpusloom.session import materialize

MAX_VOCAB = 0x10FFFF - 0x800  # symbols are code points
CANDIDATES = 256
#: distinct segments of words that the driver learns merges on at once
SEGMENTS = 100_000
#: bytes of all tokens of a vocabulary, which goes to every task
VOCAB_BYTES = 256 << 20
#: bytes that the pieces a task remembers, and their ids, take
KNOWN_BYTES = 128 << 20
#: ids that a task decodes at once
SLICE_IDS = 2 << 20
VOCAB_SCHEMA = "token_id int, token binary, n_bytes int, n_bytes_ref int, is_special boolean, name string"
MERGE_SCHEMA = "rank int, left_id int, right_id int, new_id int"


def symbol(token_id: int) -> str:
    """Code point of a token id; the surrogate range is skipped."""
    return chr(token_id if token_id < 0xD800 else token_id + 0x800)


def symbol_id(s: str) -> int:
    return ord(s) if ord(s) < 0xD800 else ord(s) - 0x800


Pair = tuple[int, int]


# --- counting --------------------------------------------------------------------------------------


def piece_counts(docs: DataFrame, text: str | Column = "text", pattern: str = tx.SPLIT_PATTERN) -> DataFrame:
    """Occurrences of every distinct piece that ``pattern`` cuts; counted inside the map tasks first."""
    # for a plain explode Spark also filters on the list being non-empty, and cuts the text twice for it
    pieces = docs.select(F.explode_outer(tx.pieces(text, pattern)).alias("piece")).filter("piece IS NOT NULL")
    return pieces.groupBy("piece").agg(F.count(F.lit(1)).alias("n"))


def to_words(counts: DataFrame) -> DataFrame:
    return counts.select(tx.byte_symbols("piece").alias("word"), "n")


LONG_WORD = 256


def has_long_words(words: DataFrame) -> bool:
    return not words.filter(F.length("word") > LONG_WORD).isEmpty()


def _runs(words: DataFrame, k: int, long_words: bool) -> DataFrame:
    """All runs of ``k`` adjacent symbols as (run, n).

    Cutting a run out of a short word is cheap. In a long word its cost grows with the position, so long
    words, if there are any, are split once into symbols instead.
    """
    size = F.length("word")
    short = words.filter((size >= k) & (size <= LONG_WORD))
    short = short.select("word", "n", F.explode(F.sequence(F.lit(1), size - (k - 1))).alias("i"))
    short = short.select(F.substring("word", F.col("i"), F.lit(k)).alias("run"), "n")
    if not long_words:
        return short
    long = words.filter(size > LONG_WORD)
    chars = F.split("word", "")
    runs = F.slice(chars, 1, size - (k - 1))
    for i in range(1, k):
        runs = F.zip_with(runs, F.slice(chars, i + 1, size - (k - 1)), lambda a, b: F.concat(a, b))
    return short.unionByName(
        long.select(F.explode_outer(runs).alias("run"), "n").filter("run IS NOT NULL")
    )


def pair_counts(words: DataFrame, long_words: bool = True) -> DataFrame:
    """Adjacent symbol pairs weighted by word frequency."""
    return _runs(words, 2, long_words).groupBy(F.col("run").alias("pair")).agg(F.sum("n").alias("n"))


# --- training --------------------------------------------------------------------------------------


def _around(words: DataFrame, pairs: list[str], long_words: bool) -> dict[str, int]:
    """For every candidate pair the count of the most frequent triple that holds it.

    A symbol pair made by merging the candidate cannot be more frequent than that.
    """
    triples = _runs(words, 3, long_words).withColumnRenamed("run", "t")
    left, right = F.substring("t", 1, 2), F.substring("t", 2, 2)
    held = triples.filter(left.isin(pairs) | right.isin(pairs)).groupBy("t").agg(F.sum("n").alias("n"))
    both = held.select(F.explode(F.array(left, right)).alias("pair"), "n").filter(F.col("pair").isin(pairs))
    return {r[0]: r[1] for r in both.groupBy("pair").agg(F.max("n")).collect()}  # at most CANDIDATES rows


def _undisturbed(top: list[str]) -> list[str]:
    """The longest run of top pairs in which no merge takes away an occurrence of a later pair."""
    lefts, rights, run = set(), set(), []
    for pair in top:
        if pair[0] in rights or pair[1] in lefts:
            break
        run.append(pair)
        lefts.add(pair[0])
        rights.add(pair[1])
    return run


def _next_merges(words: DataFrame, want: int, long_words: bool) -> list[str]:
    """The next merges of step-by-step training, as many as one look at the words can prove.

    A pair follows the ones before it when they leave all its occurrences and no pair that they create can
    reach its count.
    """
    top = [(r[0], r[1]) for r in pair_counts(words, long_words).orderBy(F.desc("n"), "pair").limit(want).collect()]
    run = _undisturbed([p for p, _ in top])
    if len(run) < 2:
        return run
    around = _around(words, run, long_words)
    bound = 0
    for i, (_, n) in enumerate(top[: len(run)]):
        if i and n <= bound:
            return run[:i]
        bound = max(bound, around.get(run[i], 0))
    return run


class Segments:
    """Distinct runs of symbols with their counts, on which merges are learned one at a time."""

    def __init__(self, segments: Iterable[tuple[str, int]]):
        self.words, self.weights = [], []
        self.counts: dict[Pair, int] = {}
        self.held: dict[Pair, set[int]] = {}  # the segments that hold a pair, or held it once
        for segment, n in segments:
            ids = [symbol_id(c) for c in segment]
            self._add(len(self.words), ids, n)
            self.words.append(ids)
            self.weights.append(n)

    def _add(self, at: int, ids: list[int], n: int) -> None:
        for pair in zip(ids, ids[1:]):
            self.counts[pair] = self.counts.get(pair, 0) + n
            self.held.setdefault(pair, set()).add(at)

    def learn(self, floor: int, want: int, first: int) -> list[Pair]:
        """Up to ``want`` merges of pairs that occur more than ``floor`` times; new symbols are numbered from ``first``."""
        queue = [(-n, pair) for pair, n in self.counts.items() if n > floor]
        heapify(queue)
        merges: list[Pair] = []
        while queue and len(merges) < want:
            n, pair = heappop(queue)
            if -n != self.counts.get(pair, 0):
                continue  # pushed again with its new count when that changed
            new = first + len(merges)
            merges.append(pair)
            changed: set[Pair] = set()
            for at in self.held.pop(pair):
                ids, weight = self.words[at], self.weights[at]
                after = replace_pair(ids, pair, new)
                if len(after) == len(ids):
                    continue
                for old in zip(ids, ids[1:]):
                    self.counts[old] -= weight
                    changed.add(old)
                self._add(at, after, weight)
                changed.update(zip(after, after[1:]))
                self.words[at] = after
            for p in changed:
                if self.counts[p] > floor:
                    heappush(queue, (-self.counts[p], p))
                elif not self.counts[p]:
                    del self.counts[p]
        return merges


def replace_pair(ids: list[int], pair: Pair, new: int) -> list[int]:
    out, i, last = [], 0, len(ids) - 1
    while i <= last:
        if i < last and ids[i] == pair[0] and ids[i + 1] == pair[1]:
            out.append(new)
            i += 2
        else:
            out.append(ids[i])
            i += 1
    return out


def _segments(words: DataFrame, pairs: list[str]) -> DataFrame:
    """``segment, n``: the longest runs of symbols in which all adjacent pairs are among ``pairs``."""
    wanted = frozenset(pairs)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter[str] = Counter()
            for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()):
                start = 0
                for i in range(1, len(word)):
                    if word[i - 1 : i + 1] not in wanted:
                        if i - start > 1:
                            found[word[start:i]] += n
                        start = i
                if len(word) - start > 1:
                    found[word[start:]] += n
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["segment", "n"])

    return words.mapInArrow(cut, "segment string, n long").groupBy("segment").agg(F.sum("n").alias("n"))


def _merged(words: DataFrame, merges: list[Pair], first: int) -> DataFrame:
    """The words after the merges, the first of which makes the symbol ``first``."""
    ranks = {pair: first - 256 + i for i, pair in enumerate(merges)}

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for word in batch.column("word").to_pylist():
                ids = [symbol_id(c) for c in word]
                after = merge_ids(ids, ranks)
                out.append(word if len(after) == len(ids) else "".join(map(symbol, after)))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()), batch.column("n")], ["word", "n"])

    return words.mapInArrow(apply, "word string, n long")


def train_merges(
    counts: DataFrame, vocab_size: int, keep_every: int = 64, segments: int = SEGMENTS, rounds: list[int] | None = None
) -> list[Pair]:
    """Merges in rank order: most frequent pair first, ties by the smaller symbols.

    ``vocab_size`` includes the special tokens. Every round counts the pairs of the distinct words and looks at all pairs above some
    count, the floor. Words are cut between all other pairs; the distinct segments that are left come to the driver, ``segments`` of them
    at most, and merges are learned on them while their counts are above the floor. That is exact: all places
    where two symbols meet lie inside segments or none does, and whatever pair comes to stand at a cut is not more frequent than
    the pair that was cut. The floor goes up until the segments are few enough; where the distinct words are, there is a single round. Merged words are written to the shared folder once
    ``keep_every`` merges are due. ``rounds`` gets the number of merges of every round.
    """
    target = vocab_size - len(tx.SPECIAL_TOKENS) - 256
    if target < 0:
        raise ValueError(f"vocab_size must be at least {256 + len(tx.SPECIAL_TOKENS)}")
    if vocab_size > MAX_VOCAB:
        raise ValueError(f"vocab_size must be at most {MAX_VOCAB}")
    spark = counts.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)

    def keep(words: DataFrame) -> DataFrame:
        return materialize(words.filter(F.length("word") > 1).repartition(tasks, "word"), "bpe-words")

    words = keep(to_words(counts))
    size = F.length("word")
    n, symbols, longest = words.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0)), F.coalesce(F.max(size), F.lit(0))).first()
    long_words = longest > LONG_WORD
    merges: list[Pair] = []
    pending: list[Pair] = []
    if n <= segments and symbols <= 16 * segments:  # the words as they are can be learned on
        merges = Segments((r[0], r[1]) for r in words.collect()).learn(0, target, 256)
        if rounds is not None and merges:
            rounds.append(len(merges))
        return merges
    look = max(2, segments // 400)
    while len(merges) < target:
        now = _merged(words, pending, 256 + len(merges) - len(pending)) if pending else words
        want = target - len(merges)
        top = [(r[0], r[1]) for r in pair_counts(now, long_words).orderBy(F.desc("n"), "pair").limit(look + 1).collect()]
        if not top:
            break
        chosen: list[Pair] = []
        while not chosen and look > 1:
            floor = top[look][1] if len(top) > look else 0
            above = [p for p, n in top[:look] if n > floor]
            if not above:
                break
            found = materialize(_segments(now, above), "bpe-segments")
            n, symbols = found.agg(F.count("*"), F.sum(F.length("segment"))).first()
            if n <= segments and symbols <= 16 * segments:
                chosen = Segments((r[0], r[1]) for r in found.collect()).learn(floor, want, 256 + len(merges))
                look = min(segments, int(look * min(4, max(1, 0.5 * segments / n))))
            else:
                look = int(look * min(0.5, 0.7 * segments / n))
        if not chosen:  # more pairs share the highest count than one look takes, or a single pair fills one
            pairs = _next_merges(now, min(CANDIDATES, want), long_words)
            chosen, look = [(symbol_id(p[0]), symbol_id(p[1])) for p in pairs], max(look, 2)
        merges += chosen
        pending += chosen
        if rounds is not None:
            rounds.append(len(chosen))
        if len(pending) >= keep_every:
            words = keep(_merged(words, pending, 256 + len(merges) - len(pending)))
            pending = []
            long_words = long_words and has_long_words(words)
    return merges


# --- vocabulary ------------------------------------------------------------------------------------


def token_bytes(merges: list[tuple[int, int]]) -> list[bytes]:
    out = [bytes([i]) for i in range(256)]
    for a, b in merges:
        out.append(out[a] + out[b])
    return out


def token_sizes(merges: list[tuple[int, int]]) -> list[int]:
    out = [1] * 256
    for a, b in merges:
        out.append(out[a] + out[b])
    return out


def vocab_table(spark: SparkSession, merges: list[tuple[int, int]]) -> DataFrame:
    """One row per token. ``n_bytes_ref`` counts the token decoded alone, with replacement characters.

    Special tokens have zero bytes.
    """
    rows = [
        (i, b, len(b), len(b.decode("utf-8", errors="replace").encode()), False, None)
        for i, b in enumerate(token_bytes(merges))
    ]
    n = len(rows)
    rows += [(n + i, name.encode(), 0, 0, True, name) for i, name in enumerate(tx.SPECIAL_TOKENS)]
    return spark.createDataFrame(rows, VOCAB_SCHEMA)


def merge_table(spark: SparkSession, merges: list[tuple[int, int]]) -> DataFrame:
    return spark.createDataFrame([(i, a, b, 256 + i) for i, (a, b) in enumerate(merges)], MERGE_SCHEMA)


def save_tokenizer(spark: SparkSession, merges: list[tuple[int, int]], path: str, mode: str = "errorifexists", pattern: str = tx.SPLIT_PATTERN) -> None:
    vocab_table(spark, merges).coalesce(1).write.mode(mode).parquet(f"{path}/vocab")
    merge_table(spark, merges).coalesce(1).write.mode(mode).parquet(f"{path}/merges")
    config = json.dumps({"pattern": pattern})
    spark.createDataFrame([(config,)], "value string").coalesce(1).write.mode(mode).text(f"{path}/config")


def load_merges(spark: SparkSession, path: str) -> list[tuple[int, int]]:
    rows = spark.read.schema(MERGE_SCHEMA).parquet(f"{path}/merges").orderBy("rank").collect()  # at most MAX_VOCAB
    return [(r["left_id"], r["right_id"]) for r in rows]


def load_tokenizer(spark: SparkSession, path: str) -> BpeTokenizer:
    """The tokenizer that :func:`save_tokenizer` wrote, with its split pattern."""
    (config,) = spark.read.text(f"{path}/config").collect()
    return BpeTokenizer(load_merges(spark, path), pattern=json.loads(config["value"])["pattern"])


def special_id(vocab: DataFrame, name: str) -> int:
    row = vocab.filter(F.col("is_special") & (F.col("name") == name)).first()
    if row is None:
        raise KeyError(f"no special token {name!r}")
    return row["token_id"]


def bos_id(vocab: DataFrame) -> int:
    """The document start token; vocabularies of other makes call it ``<|endoftext|>``."""
    try:
        return special_id(vocab, "<|bos|>")
    except KeyError:
        return special_id(vocab, "<|endoftext|>")


# --- encoding --------------------------------------------------------------------------------------


def merge_ids(ids: list[int], ranks: dict[Pair, int]) -> list[int]:
    """Apply the lowest ranked merge, the leftmost first, until none is left; a merge of rank r makes the id 256 + r.

    Pairs that can merge wait in a queue; one that is gone when its turn comes is passed over.
    """
    queue = [(rank, i) for i, pair in enumerate(zip(ids, ids[1:])) if (rank := ranks.get(pair)) is not None]
    if not queue:
        return ids
    heapify(queue)
    ids, n = list(ids), len(ids)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    while queue:
        rank, i = heappop(queue)
        j = after[i]
        if j >= n or ranks.get((ids[i], ids[j])) != rank:
            continue
        ids[i], ids[j] = 256 + rank, -1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            if (r := ranks.get((ids[i], ids[k]))) is not None:
                heappush(queue, (r, i))
        if (h := before[i]) >= 0 and (r := ranks.get((ids[h], ids[i]))) is not None:
            heappush(queue, (r, h))
    return [x for x in ids if x >= 0]


def merge_piece(data: bytes, ranks: dict[Pair, int]) -> list[int]:
    return merge_ids(list(data), ranks)


def _id_slices(lists: pa.Array) -> Iterator[pa.Array]:
    """Lists of ids in stretches of up to ``SLICE_IDS`` ids, one list at least."""
    ends, start = _bounds(lists), 0
    while start < len(lists):
        stop = max(start + 1, int(np.searchsorted(ends, ends[start] + SLICE_IDS, "right")) - 1)
        yield lists.slice(start, stop - start)
        start = stop


def _bounds(lists: pa.Array) -> np.ndarray:
    offsets = np.asarray(lists.offsets)
    return offsets - offsets[0] if len(offsets) else np.zeros(1, "int64")


class Known(dict):
    """The ids of pieces met so far, as bytes; it starts anew when it holds too many."""

    def __init__(self, pieces: int, size: int = KNOWN_BYTES):
        super().__init__()
        self.pieces, self.size, self.held = pieces, size, 0

    def add(self, piece: str, ids: bytes) -> bytes:
        if len(self) >= self.pieces or self.held > self.size:
            self.clear()
            self.held = 0
        self[piece] = ids
        self.held += 200 + 4 * len(piece) + len(ids)  # with what the entry and the two objects take
        return ids


def encode_lists(lists: pa.Array, ranks: dict, known: Known) -> pa.Array:
    """Lists of pieces to lists of ids; every distinct piece is encoded once and remembered in ``known``."""
    codes = lists.flatten().dictionary_encode()
    ids = []
    for p in codes.dictionary.to_pylist():
        got = known.get(p)
        if got is None:
            got = known.add(p, np.array(merge_piece(p.encode(), ranks), "int32").tobytes())
        ids.append(got)
    sizes = np.fromiter(map(len, ids), "int64", len(ids)) // 4
    flat = np.frombuffer(b"".join(ids), "int32")
    starts = np.concatenate([[0], np.cumsum(sizes)])
    at = codes.indices.to_numpy(zero_copy_only=False)
    n = sizes[at]
    ends = np.concatenate([[0], np.cumsum(n)])
    take = np.arange(ends[-1]) + np.repeat(starts[at] - ends[:-1], n)
    return pa.ListArray.from_arrays(pa.array(ends[_bounds(lists)], pa.int32()), pa.array(flat[take], pa.int32()))


class BpeTokenizer:
    """Encodes with learned merges. Usable wherever :class:`~corpusloom.functions.text.ByteTokenizer` is.

    Encoding needs no shuffle: Spark cuts the pieces, a task encodes every distinct piece once and puts the
    ids together by array operations. Merges and tokens go to the tasks with the function; their size is checked.
    """

    def __init__(self, merges: list[tuple[int, int]], memory: int = 1 << 20, pattern: str = tx.SPLIT_PATTERN):
        self.pattern = pattern
        self.merges = [tuple(m) for m in merges]
        self.n_base = 256 + len(self.merges)
        if (size := sum(token_sizes(self.merges))) > VOCAB_BYTES:
            raise ValueError(f"the tokens have {size} bytes, more than the {VOCAB_BYTES} that go to every task")
        ranks = {m: i for i, m in enumerate(self.merges)}
        vocab = token_bytes(self.merges) + [s.encode() for s in tx.SPECIAL_TOKENS]

        def encode_pieces(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            known = Known(memory)
            for column in batches:
                for lists in tx.text_slices(column):
                    yield encode_lists(lists, ranks, known)

        def encode_nested(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            known = Known(memory)
            for column in batches:
                for lists in tx.text_slices(column):
                    inner = encode_lists(lists.flatten(), ranks, known)
                    yield pa.ListArray.from_arrays(pa.array(_bounds(lists), pa.int32()), inner)

        def decode_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            tokens = pa.array(vocab, pa.large_binary())
            for column in batches:
                for lists in _id_slices(column):
                    yield decode_ids(lists, tokens)

        def decode_ids(lists: pa.Array, tokens: pa.Array) -> pa.Array:
            flat = tokens.take(lists.flatten())
            rows = pa.LargeListArray.from_arrays(pa.array(_bounds(lists), pa.int64()), flat)
            joined = pc.binary_join(rows, pa.scalar(b"", pa.large_binary()))
            try:
                return joined.cast(pa.large_string()).cast(pa.string())
            except pa.ArrowInvalid:  # broken sequences become replacement characters
                return pa.array([b.decode("utf-8", errors="replace") for b in joined.to_pylist()], pa.string())

        ints = T.ArrayType(T.IntegerType())
        self._encode = F.arrow_udf(encode_pieces, ints)
        self._encode_nested = F.arrow_udf(encode_nested, T.ArrayType(ints))
        self._decode = F.arrow_udf(decode_batches, T.StringType())

    def special(self, i: int) -> int:
        return self.n_base + i

    def encode(self, text: Column | str, prepend: int | None = None, append: int | None = None) -> Column:
        """Ids of the text; special token strings in it are plain text."""
        ids = self._encode(tx.pieces(text, self.pattern))
        parts = [F.array(F.lit(prepend))] if prepend is not None else []
        parts.append(ids)
        if append is not None:
            parts.append(F.array(F.lit(append)))
        return F.concat(*parts) if len(parts) > 1 else ids

    def encode_each(self, texts: Column) -> Column:
        return self._encode_nested(F.transform(texts, lambda t: tx.pieces(t, self.pattern)))

    def decode(self, ids: Column | str) -> Column:
        return self._decode(ids)

    def register(self, spark: SparkSession, name: str) -> None:
        """Make ``name(text)`` callable from SQL, and ``name_each(texts)`` for lists of texts."""
        spark.udf.register(f"{name}_pieces", self._encode)
        spark.udf.register(f"{name}_nested", self._encode_nested)
        cut = f'regexp_extract_all(t, r"(?U){self.pattern}", 0)'
        made = "CREATE OR REPLACE TEMPORARY FUNCTION"
        spark.sql(f"{made} {name}(t STRING) RETURNS ARRAY<INT> RETURN {name}_pieces({cut})")
        spark.sql(f"{made} {name}_each(ts ARRAY<STRING>) RETURNS ARRAY<ARRAY<INT>> RETURN {name}_nested(transform(ts, t -> {cut}))")
