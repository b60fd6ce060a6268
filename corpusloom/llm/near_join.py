"""Similarity join of documents by the Jaccard index of their word n-grams.

Documents with the same set of n-grams are one class, joined once whatever their number. MinHash banding finds candidates: the number
of bands and rows follows from the recall wanted at the threshold, and Spark shuffles on the band hashes. Classes that share a
band, directly or through others, form a candidate group. Groups are cut into chunks of bounded size; each pair of
chunks is a tile, a task loads two chunks of full n-gram sets and verifies every pair in them exactly. Tiles return
the number of links of each class and a spanning forest, never the pairs, so a group of n copies costs no n^2 rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import keyed_texts, sliced, stream_groups
from corpusloom.llm.components import connected_components
from corpusloom.session import materialize

WORDS = 5
#: the similarity as a fraction, so that the comparison is exact
THRESHOLD = (4, 5)
RECALL = 0.9999
MAX_HASHES = 128
#: n-grams of a chunk on average; a tile holds two chunks
CHUNK_GRAMS = 32_000
SEED = 50
SLICE_GRAMS = 100_000
CACHE_WORDS = 200_000
COLUMNS = 4096


def choose_bands(threshold: float, recall: float = RECALL, most: int = MAX_HASHES) -> tuple[int, int]:
    """Bands and rows: the most rows with which pairs at the threshold are found with the recall wanted."""
    best = (1, 1)
    for rows in range(1, most + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))
        if bands * rows > most:
            break
        best = bands, rows
    return best


class WordHashes(dict):
    def __missing__(self, word: str) -> int:
        value = int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "little")
        if len(word) <= 48:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = value
        return value


def grams(text: str, hashes: WordHashes, n: int = WORDS) -> np.ndarray:
    """The set of hashes of the text's n-grams of lower-case words, sorted; a shorter text is one n-gram, an empty one has none."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    one = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = min(n, len(words))
    out = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + one[k : k + len(out)]
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    return np.unique(out)


def set_id(found: np.ndarray) -> bytes:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()


class Signatures:
    """Band hashes of n-gram sets, many sets at a time."""

    def __init__(self, bands: int, rows: int):
        rng = np.random.default_rng(SEED)
        self.bands, self.rows = bands, rows
        self.factor = rng.integers(0, 2**32, bands * rows, dtype=np.uint32) | np.uint32(1)
        self.term = rng.integers(0, 2**32, bands * rows, dtype=np.uint32)

    def of(self, sets: list[np.ndarray]) -> np.ndarray:
        """A row of band hashes for every set; no set may be empty."""
        flat = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
        starts = np.cumsum([0, *map(len, sets[:-1])])
        out = np.empty((len(sets), self.bands), np.uint64)
        for band in range(self.bands):
            key = np.full(len(sets), band + 1, np.uint64)
            for k in range(band * self.rows, (band + 1) * self.rows):
                least = np.minimum.reduceat(flat * self.factor[k] + self.term[k], starts)
                key = (key ^ least) * np.uint64(0x9E3779B97F4A7C15)
                key ^= key >> np.uint64(31)
            out[:, band] = key
        return out.view(np.int64)


def sets_and_bands(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """``doc_id, n, set_id, bands`` (and ``row`` if there) of every row; null set and bands for a text without words."""
    carried = [c for c in docs.columns if c == "row"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, signatures = WordHashes(), Signatures(bands, rows)
        for batch in sliced(batches):
            sizes, ids, keys, held = [], [], [], []
            for t in batch.column("text").to_pylist():
                found = grams(t, hashes)
                sizes.append(len(found))
                ids.append(set_id(found) if len(found) else None)
                if len(found):
                    held.append(found)
                if sum(map(len, held[-1:])) and sum(map(len, held)) > SLICE_GRAMS:
                    keys.append(signatures.of(held))
                    held = []
            if held:
                keys.append(signatures.of(held))
            flat = np.concatenate(keys).ravel() if keys else np.zeros(0, np.int64)
            there = np.array(sizes) > 0
            ends = pa.array(np.concatenate([[0], np.cumsum(there * bands)]).astype(np.int32))
            lists = pa.ListArray.from_arrays(ends, pa.array(flat), mask=pa.array(~there))
            columns = [batch.column("doc_id"), pa.array(sizes, pa.int32()), pa.array(ids, pa.binary()), lists]
            yield pa.RecordBatch.from_arrays(columns + [batch.column(c) for c in carried], ["doc_id", "n", "set_id", "bands", *carried])

    return docs.mapInArrow(run, "doc_id long, n int, set_id binary, bands array<long>" + ", row long" * len(carried))


def candidate_groups(classes: DataFrame) -> DataFrame:
    """``node, root``: the classes that share a band with another one, and their group."""
    members = classes.select("cid", F.explode("bands").alias("band"))
    heads = members.groupBy("band").agg(F.min("cid").alias("head"), F.count("*").alias("_n")).filter("_n > 1").drop("_n")
    edges = members.join(heads, "band").filter("cid <> head").select(F.col("cid").alias("a"), F.col("head").alias("b")).distinct()
    return connected_components(edges)


def shared(sets: list[np.ndarray]) -> np.ndarray:
    """How many n-grams each two sets have in common."""
    sizes = [len(s) for s in sets]
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), sizes)
    often = count[column] > 1
    row, column = row[often], column[often]
    out = np.zeros((len(sets), len(sets)), np.int64)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    new = np.concatenate([[True], column[1:] != column[:-1]]) if len(column) else np.zeros(0, bool)
    column = np.cumsum(new) - 1
    last = int(column[-1]) + 1 if len(column) else 0
    for at in range(0, last, COLUMNS):
        lo, hi = np.searchsorted(column, [at, at + COLUMNS])
        part = np.zeros((len(sets), min(COLUMNS, last - at)), np.float32)
        part[row[lo:hi], column[lo:hi] - at] = 1
        out += (part @ part.T).astype(np.int64)
    return out


def verify(tile: pa.Table) -> pa.RecordBatch | None:
    """``cid, root, links`` of the classes of one tile that have links in it: the least class they are connected
    with in the tile, and the documents in the classes linked to them."""
    a, b = tile.column("i")[0].as_py(), tile.column("j")[0].as_py()
    sets = [np.frombuffer(x, np.uint64) for x in tile.column("grams").to_pylist()]
    cid = tile.column("cid").to_numpy()
    chunk, copies = tile.column("chunk").to_numpy(), tile.column("copies").to_numpy()
    n = np.array([len(s) for s in sets], np.int64)
    common = shared(sets)
    num, den = THRESHOLD
    linked = common * den >= (n[:, None] + n[None] - common) * num
    np.fill_diagonal(linked, False)
    if a != b:
        linked &= chunk[:, None] != chunk[None]
    if not linked.any():
        return None
    links = linked @ copies
    root = cid.copy()
    while True:  # least label of the neighbours, until nothing changes
        least = np.minimum(root, np.where(linked, root[None], np.iinfo(np.int64).max).min(axis=1))
        if (least == root).all():
            break
        root = least
    there = links > 0
    return pa.RecordBatch.from_arrays([pa.array(cid[there]), pa.array(root[there]), pa.array(links[there])], ["cid", "root", "links"])


def near_join(docs: DataFrame, key: str = "doc_id", text: str = "text", row: str | None = None) -> DataFrame:
    """``doc_id, class_id, copy_id, n_copies, n_links`` of every row of ``docs``; the column that ``row`` names is carried along as ``row``.

    ``copy_id`` is the least id among the documents with the same n-gram set and ``n_copies`` their number; ``n_links`` counts the
    other documents whose similarity reaches the threshold, equal ones included; ``class_id`` is the least id among all that
    are connected by links. A null or empty text has no n-grams, no links and a class of its own; texts shorter than an n-gram count as
    one n-gram. A null id stays null and never names a class unless all members' ids are null. Repeated
    rows are copies of each other. An empty table gives no rows.
    """
    spark = docs.sparkSession
    num, den = THRESHOLD
    bands, rows = choose_bands(num / den)
    texts = keyed_texts(docs, key, text)
    signed = materialize(sets_and_bands(keyed_texts(docs, key, text, row), bands, rows), "near-signatures")
    classes = signed.filter("set_id is not null").groupBy("set_id").agg(
        F.count("*").alias("copies"), F.min("doc_id").alias("copy_id"), F.any_value("n").alias("n"), F.any_value("bands").alias("bands")
    )
    classes = materialize(classes.withColumn("cid", F.monotonically_increasing_id()), "near-classes")
    groups = materialize(candidate_groups(classes), "near-candidates")
    members = classes.select("cid", "set_id", "copies", "copy_id", "n").join(groups, classes["cid"] == groups["node"]).drop("node")
    sizes = members.groupBy("root").agg(F.ceil(F.sum("n") / CHUNK_GRAMS).cast("int").alias("chunks"))
    members = members.join(sizes, "root").withColumn("chunk", F.pmod(F.xxhash64("cid"), F.col("chunks")).cast("int"))
    members = materialize(members.select("root", "cid", "set_id", "copies", "copy_id", "chunk", "chunks"), "near-members")

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in sliced(batches):
            found = [grams(t, hashes) for t in batch.column("text").to_pylist()]
            right = [set_id(g) == s for g, s in zip(found, batch.column("set_id").to_pylist())]
            columns = [batch.column(c) for c in ("root", "cid", "copies", "chunk", "chunks")]
            columns.append(pa.array([g.tobytes() if r else None for g, r in zip(found, right)], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, ["root", "cid", "copies", "chunk", "chunks", "grams"])

    # one document of each class; rows that only share its id are told apart by their sets. The members grow with the corpus, so they
    # are not sent to every task, however few there may be
    chosen = members.hint("merge").join(texts, members["copy_id"].eqNullSafe(texts["doc_id"])).select("root", "cid", "set_id", "copies", "chunk", "chunks", "text")
    loaded = chosen.mapInArrow(load, "root long, cid long, copies long, chunk int, chunks int, grams binary").filter("grams is not null")
    other = F.sequence(F.lit(0), F.col("chunks") - 1)
    tiles = loaded.withColumn("_o", F.explode(other)).select(
        "root", "cid", "copies", "chunk", F.least("chunk", "_o").alias("i"), F.greatest("chunk", "_o").alias("j"), "grams"
    )
    tiles = tiles.withColumn("tile", F.xxhash64("root", "i", "j"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in stream_groups(batches, "tile"):
            # two tiles whose hashes are equal, and rows of equal documents, are kept apart here
            for part in split_tiles(tile):
                if (out := verify(part)) is not None:
                    yield out

    checked = tiles.repartition("tile").sortWithinPartitions("tile").mapInArrow(check, "cid long, root long, links long")
    checked = materialize(checked, "near-links")
    links = checked.groupBy("cid").agg(F.sum("links").alias("links"))
    roots = connected_components(checked.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    named = classes.select("cid", "set_id", "copies", "copy_id").join(links, "cid", "left").join(roots, classes["cid"] == roots["node"], "left")
    named = named.select("set_id", "copies", "copy_id", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "cid").alias("root"))
    named = materialize(named, "near-named")
    least = named.groupBy("root").agg(F.min("copy_id").alias("class_id"))
    named = named.join(least, "root").select("set_id", "copies", "copy_id", "links", "class_id")
    carried = ["row"] if row else []
    out = signed.select("doc_id", "set_id", *carried).join(named, "set_id", "left")
    own = F.col("set_id").isNull()
    return out.select(
        "doc_id", F.when(own, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), F.when(own, F.col("doc_id")).otherwise(F.col("copy_id")).alias("copy_id"),
        F.coalesce("copies", F.lit(1)).alias("n_copies"), F.coalesce(F.col("links") + F.col("copies") - 1, F.lit(0)).alias("n_links"), *carried,
    )


def split_tiles(tile: pa.Table) -> Iterator[pa.Table]:
    """One table per group and pair of chunks, each class once."""
    keys = list(zip(*(tile.column(c).to_pylist() for c in ("root", "i", "j", "cid"))))
    seen: set[tuple] = set()
    parts: dict[tuple, list[int]] = {}
    for at, k in enumerate(keys):
        if k not in seen:
            seen.add(k)
            parts.setdefault(k[:3], []).append(at)
    for rows in parts.values():
        if len(rows) > 1:
            yield tile.take(pa.array(rows)).combine_chunks()
