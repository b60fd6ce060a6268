"""The trie of the prefixes that conversations share, over sorted shards with a skeleton of splitter paths.

A conversation is a path of turn hashes. Conversations are sorted by path and id and dealt to shards by splitters from a sample, so that even
equal conversations spread over shards. All members of a node stand together in that order; a node can reach over two shards only if the splitter
between them starts with its path. So the trie of the splitters, the skeleton, is sent to all tasks; each shard finishes
every other node by itself, with a stack over its sorted paths, and returns partial sums for the skeleton's nodes it meets, which are added up.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import sliced, stream_groups
from corpusloom.session import materialize

#: a white-space class of six characters, as everywhere in this package
WORD = r"[^\x20\x09-\x0D]+"
#: bytes of a turn's hash
SYMBOL = 16
TURNS_PER_SHARD = 100_000
#: sampled conversations for each shard, and turns of all of them together: the bound of the skeleton, which is sent to every task
SAMPLES = 4
SKELETON_TURNS = 1 << 20
LEAST = -(2**63)

NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
FOUND = (
    "node int, shard int, conv_id long, depth long, parent_conv_id long, parent int, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "ends_sha256 string, ends string, inner_children long, inner_words long, above array<int>"
)
KINDS = {"node": pa.int32(), "shard": pa.int32(), "parent": pa.int32(), "ends_sha256": pa.string(), "ends": pa.string(), "above": pa.list_(pa.int32())}
NAMES = [x.split()[0] for x in FOUND.split(", ")]


def conversation_turns(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, turns`` with an array of each conversation's turns in order: ``place``, the hash ``symbol`` of role and text, and ``words``.

    Null turns come first; equal ones go by their hash. A null role or text counts as empty. Rows without an id belong to no conversation. A
    conversation is one row of 24 bytes per turn; its texts are never gathered.
    """
    r, t = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    symbol = F.unhex(F.md5(F.concat(F.length(r).cast("string"), F.lit(":"), r, t)))
    one = F.struct(F.col(turn).alias("place"), symbol.alias("symbol"), F.regexp_count(t, F.lit(WORD)).alias("words"))
    rows = turns.filter(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("conv_id"), one.alias("one"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("one")).alias("turns"))


class Skeleton:
    """The trie of the splitters; node 0 is the root."""

    def __init__(self, splitters: list[tuple[bytes, int, list[int]]]):
        self.child: dict[tuple[int, bytes], int] = {}
        self.parent, self.words, self.children = [-1], [0], [0]
        for path, _, words in splitters:
            at = 0
            for d, w in enumerate(words):
                symbol = path[d * SYMBOL : (d + 1) * SYMBOL]
                after = self.child.get((at, symbol))
                if after is None:
                    after = self.child[at, symbol] = len(self.parent)
                    self.parent.append(at)
                    self.words.append(w)
                    self.children.append(0)
                    self.children[at] += 1
                at = after
        self.below = list(self.words)  # words of all skeleton nodes of the subtree
        for v in range(len(self.parent) - 1, 0, -1):
            self.below[self.parent[v]] += self.below[v]

    def above(self, v: int) -> list[int]:
        """The node and all nodes over it."""
        out = []
        while v >= 0:
            out.append(v)
            v = self.parent[v]
        return out


def common_turns(a: bytes, b: bytes) -> int:
    """How many turns two paths share at their start."""
    most = min(len(a), len(b)) // SYMBOL
    low, step = 0, 1
    while low < most:  # doubling steps, then halving ones
        n = min(step, most - low)
        if a[low * SYMBOL : (low + n) * SYMBOL] == b[low * SYMBOL : (low + n) * SYMBOL]:
            low, step = low + n, step * 2
        elif n == 1:
            break
        else:
            most, step = low + n - 1, 1
    return low


def grow(shard: int, ids: list[int], paths: list[bytes], words: list[list[int]], skeleton: Skeleton) -> pa.RecordBatch:
    """The nodes of one shard, whose conversations are sorted by path and id; those of the skeleton with the sums of this shard only.

    The sums over a subtree leave out, for the skeleton's nodes, what more than one shard would count: the one occurrence of each that is
    not saved, and whether it is childless.
    """
    parent, depth, word, inner = [-1], [0], [0], [0]
    first, n, children, leaves, saved = [2**63 - 1], [0], [0], [0], [0]
    ends: dict[int, list[int]] = {}

    def close(v: int) -> None:
        local = inner[v] < 0
        leaves[v] += local and not children[v]
        saved[v] += (n[v] - local) * word[v]
        if (up := parent[v]) >= 0:
            children[up] += local
            n[up] += n[v]
            leaves[up] += leaves[v]
            saved[up] += saved[v]
            first[up] = min(first[up], first[v])

    stack, before = [0], b""
    for c, path, ws in zip(ids, paths, words):
        shared = common_turns(before, path)
        for v in reversed(stack[shared + 1 :]):
            close(v)
        del stack[shared + 1 :]
        for d in range(shared, len(ws)):
            up, v = stack[-1], len(parent)
            inner.append(skeleton.child.get((inner[up], path[d * SYMBOL : (d + 1) * SYMBOL]), -1) if inner[up] >= 0 else -1)
            parent.append(up)
            depth.append(d + 1)
            word.append(ws[d])
            first.append(2**63 - 1)
            for held in (n, children, leaves, saved):
                held.append(0)
            stack.append(v)
        v, before = stack[-1], path
        n[v] += 1
        first[v] = min(first[v], c)
        ends.setdefault(v, []).append(c)
    for v in reversed(stack):
        close(v)
    none = hashlib.sha256().hexdigest()
    rows = []
    for v in range(len(parent)):
        joined = ",".join(map(str, ends.get(v, ())))
        sums = (n[v], children[v], leaves[v], saved[v])
        k, up = inner[v], parent[v]
        if k < 0:
            over = (first[up], None) if inner[up] < 0 else (None, inner[up])
            rows.append((None, shard, first[v], depth[v], *over, *sums, hashlib.sha256(joined.encode()).hexdigest() if joined else none, None, None, None, None))
        else:
            above = None if skeleton.children[k] else skeleton.above(k)
            over = (None, skeleton.parent[k] if k else None)
            rows.append((k, shard, first[v], depth[v], *over, *sums, None, joined or None, skeleton.children[k], skeleton.below[k], above))
    return pa.RecordBatch.from_arrays([pa.array(c, KINDS.get(name, pa.int64())) for name, c in zip(NAMES, zip(*rows))], NAMES)


def choose_splitters(paths: DataFrame, convs: int, shards: int) -> list[tuple[bytes, int, list[int]]]:
    """Path, id and words of conversations of a sample that cut it into equal parts.

    Conversations are drawn by a hash of their id. Of very long ones only as many turns come along as keep the sample within
    ``SKELETON_TURNS``; a path that is cut stands before all that start with it.
    """
    wanted = SAMPLES * shards
    most = max(1, SKELETON_TURNS // (2 * wanted))
    draw = F.pmod(F.xxhash64(F.lit(11), "conv_id"), F.lit(1 << 40)) < int(min(1.0, wanted / max(convs, 1)) * (1 << 40))
    whole = F.size("words") <= most
    sample = paths.filter(draw).select(
        F.substring("path", 1, most * SYMBOL).alias("path"), F.when(whole, F.col("conv_id")).otherwise(LEAST).alias("conv_id"), F.slice("words", 1, most).alias("words")
    )
    rows = sorted((bytes(r.path), r.conv_id, r.words) for r in sample.collect())  # about SAMPLES for each shard
    cuts = [rows[i * len(rows) // shards] for i in range(1, shards)] if rows else []
    return [x for i, x in enumerate(cuts) if i == 0 or x[:2] != cuts[i - 1][:2]]


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row for every distinct prefix of the turns of ``conversations`` (``conv_id, turns`` as from :func:`conversation_turns`), the empty one included.

    ``conv_id`` is the least member's, ``parent_conv_id`` that of the prefix shorter by a turn (null at the root); ``n_convs`` counts members,
    ``n_children`` prefixes longer by a turn, ``n_leaves`` those without any in the subtree; ``saved_tokens`` is the sum over the subtree of the words
    of a prefix's last turn times its members less one; ``ends_sha256`` hashes the sorted ids of the members that end there. Repeated rows are
    members each. A conversation without turns is a member of the root alone. No conversations give no rows.
    """
    spark = conversations.sparkSession
    joined = F.array_join(F.transform("turns", lambda t: F.hex(t["symbol"])), "")
    paths = conversations.select("conv_id", F.unhex(joined).alias("path"), F.transform("turns", lambda t: t["words"]).alias("words"))
    paths = materialize(paths, "trie-paths")
    convs, turns = paths.agg(F.count("*"), F.coalesce(F.sum(F.size("words")), F.lit(0))).first()
    shards = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // TURNS_PER_SHARD))
    splitters = choose_splitters(paths, convs, shards)
    bounds, skeleton = [(p, c) for p, c, _ in splitters], Skeleton(splitters)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            shard = [bisect_right(bounds, x) for x in zip(batch.column("path").to_pylist(), batch.column("conv_id").to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), *batch.columns], ["shard", *batch.schema.names])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in stream_groups(batches, "shard"):
            yield grow(rows.column("shard")[0].as_py(), *(rows.column(c).to_pylist() for c in ("conv_id", "path", "words")), skeleton)

    dealt = paths.mapInArrow(deal, "shard int, conv_id long, path binary, words array<int>").repartition("shard")
    found = materialize(dealt.sortWithinPartitions("shard", "path", "conv_id").mapInArrow(finish, FOUND), "trie-found")
    inner = found.filter("node IS NOT NULL")
    sums = inner.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("parent").alias("parent"), F.sum("n_convs").alias("n_convs"),
        (F.sum("n_children") + F.max("inner_children")).alias("n_children"), F.sum("n_leaves").alias("n_leaves"),
        (F.sum("saved_tokens") - F.max("inner_words")).alias("saved_tokens"), F.any_value("above", ignoreNulls=True).alias("above"),
    )
    sums = materialize(sums, "trie-skeleton")
    # all that is sent to every task below has at most a row for each node of the skeleton
    bare = sums.filter("n_children = 0").select(F.explode("above").alias("node")).groupBy("node").agg(F.count("*").alias("_bare"))
    hashes = inner.filter("ends IS NOT NULL").select("node", "shard", "ends").repartition("node").sortWithinPartitions("node", "shard")
    hashes = hashes.mapInArrow(hash_ends, "node int, ends_sha256 string")
    nodes = sums.join(F.broadcast(bare), "node", "left").join(F.broadcast(hashes), "node", "left")
    nodes = nodes.withColumn("n_leaves", F.col("n_leaves") + F.coalesce("_bare", F.lit(0)))
    nodes = nodes.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest()))).withColumn("parent_conv_id", F.lit(None).cast("long"))
    columns = [x.split()[0] for x in NODE.split(", ")]
    local = found.filter("node IS NULL").select(*columns, "parent")
    parents = sums.select(F.col("node").alias("parent"), F.col("conv_id").alias("_parent"))
    out = local.unionByName(nodes.select(*columns, "parent")).join(F.broadcast(parents), "parent", "left")
    return out.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_parent")).select(*columns)


def hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of the comma-joined ids of each node, whose parts come in order; one part is held at a time."""
    last, state, nodes, found = None, hashlib.sha256(), [], []
    for batch in batches:
        for node, ends in zip(batch.column("node").to_pylist(), batch.column("ends").to_pylist()):
            if node != last:
                if last is not None:
                    nodes.append(last)
                    found.append(state.hexdigest())
                last, state = node, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ends.encode())
    if last is not None:
        nodes.append(last)
        found.append(state.hexdigest())
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int32()), pa.array(found, pa.string())], ["node", "ends_sha256"])
