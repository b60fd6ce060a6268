"""Removal of byte strings that occur more than once in a corpus, by suffix arrays.

A window is any so many bytes of a text, ``LENGTH`` if not told otherwise. Equal windows hold the same least hash of their ``GRAM``-byte strings at the same
place, their anchor; consecutive windows with one anchor form a neighbourhood. So windows need comparing only where two
neighbourhoods have an anchor of the same hash. Equal neighbourhoods are counted first, which settles copies whatever
their number. The different texts that share an anchor come together in groups, and there their windows go by ``BLOCK``
places: windows of a block have all but ``2 * BLOCK - 2`` bytes in common, the core, which stands as one symbol in
the text of the block, and a suffix array of that text (:mod:`corpusloom.llm.suffix_array`) puts equal windows side by side.
Groups of more than ``GROUP`` texts are split by their cores; where more than that share a core, equal blocks count as one and the others go by
single windows. Hashes that very many windows have are joined apart from the others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import join_by_share, map_batches, sliced, stream_groups, text_bytes
from corpusloom.llm.suffix_array import suffix_array
from corpusloom.session import materialize

LENGTH = 400
GRAM = 24
#: window places of a block
BLOCK = 16
SIDE = BLOCK - 1
#: texts that a task compares at once
GROUP = 128
#: bytes of text whose anchors are worked out together
SLICE = 1 << 20

FACTOR = 0x9E3779B97F4A7C15
TAG_BITS = 14


def powers(factor: int, n: int) -> np.ndarray:
    """The first ``n`` powers of an odd number from 0 on, modulo 2^64."""
    out = np.full(n, factor, np.uint64)
    out[0] = 1
    return np.cumprod(out)


class Anchors:
    """Neighbourhoods of the windows of texts."""

    def __init__(self, length: int = LENGTH):
        self.length, self.window = length, length - GRAM + 1
        self.power, self.inverse = (powers(x, SLICE + 2 * length) for x in (FACTOR, pow(FACTOR, -1, 2**64)))

    def find(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For each neighbourhood the first and last start of its windows, its anchor and the anchor's hash.

        ``data`` has at most ``SLICE + length`` bytes; no window reaches over one of ``ends``.
        """
        length, window = self.length, self.window
        none = (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
        if len(data) < length:
            return none
        n = len(data)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.power[:n], out=sums[1:])
        h = (sums[GRAM:] - sums[:-GRAM]) * self.inverse[: n - GRAM + 1]
        for shift in (32, 29):
            h ^= h >> np.uint64(shift)
            h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        key = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
        rows = np.concatenate([key, np.full(-len(key) % window, 2**64 - 1, np.uint64)]).reshape(-1, window)
        starts = n - length + 1  # the least key of a window is that of the rest of its row or that of the begun next one
        before = np.minimum.accumulate(rows, axis=1).ravel()[window - 1 : window - 1 + starts]
        after = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()[:starts]
        anchor = (np.minimum(before, after) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        whole = np.ones(starts, bool)
        for end in ends.tolist():
            whole[max(0, end - length + 1) : end] = False
        at = np.flatnonzero(whole)
        if not len(at):
            return none
        anchor = anchor[at]
        first = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)]))
        last = np.concatenate([first[1:], [len(at)]]) - 1
        return at[first], at[last], anchor[first], h[anchor[first]]


def text_tag(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=2).digest(), "little") >> (16 - TAG_BITS)


def keyed(docs: DataFrame, key: str, text: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """``k``: the document's key or, where that is null, a hash of its text."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    own = F.col(key).cast("long")
    columns = [F.coalesce(own, F.xxhash64(t)).alias("k"), own.alias("doc_id"), t.alias("text")]
    return docs.select(*columns, *([F.struct(*keep).alias("kept_columns")] if keep else []))


def occurrences(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """``h, c, k, pos``: every neighbourhood's anchor hash and a hash of its text, and where it is.

    ``pos`` packs the first window start, the number of starts less one, the anchor's place after the first start and a tag of the document's text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors(length)
        for batch in sliced(batches):
            keys = batch.column("k").to_numpy()
            data, ends = text_bytes(batch.column("text"))
            tags = np.array([text_tag(data[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())], np.int64)
            raw = memoryview(np.ascontiguousarray(data))
            at = 0
            while at < len(data):
                # many whole texts, or a part of a long one that overlaps with the next
                stop = int(ends[np.searchsorted(ends, at + SLICE, side="right") - 1])
                long = stop <= at
                upto = min(at + SLICE + length - 1, len(data)) if long else stop
                inside = ends[(ends > at) & (ends <= upto)]
                lo, hi, anchor, h = anchors.find(data[at:upto], inside - at)
                if long:  # starts from at + SLICE on belong to the next part
                    hi = np.minimum(hi, SLICE - 1)
                    there = lo < SLICE
                    lo, hi, anchor, h = lo[there], hi[there], anchor[there], h[there]
                if len(lo):
                    doc = np.searchsorted(ends, lo + at, side="right") - 1
                    pieces = zip((lo + at).tolist(), (hi + at + length).tolist())
                    c = np.frombuffer(b"".join(hashlib.blake2b(raw[a:b], digest_size=8).digest() for a, b in pieces), "<i8")
                    pos = (lo + at - ends[doc]) << 32 | (hi - lo) << 23 | (anchor - lo) << TAG_BITS | tags[doc]
                    columns = [pa.array(h.view(np.int64)), pa.array(c), pa.array(keys[doc]), pa.array(pos)]
                    yield pa.RecordBatch.from_arrays(columns, ["h", "c", "k", "pos"])
                at = at + SLICE if long and at + SLICE < upto else upto
                if long and upto == len(data) and at >= upto:
                    break

    return texts.select("k", "text").mapInArrow(run, "h long, c long, k long, pos long")


def unpack(pos: int) -> tuple[int, int, int]:
    """First start, last start and anchor."""
    lo = pos >> 32
    return lo, lo + (pos >> 23 & 511), lo + (pos >> TAG_BITS & 511)


def packed(texts: DataFrame) -> DataFrame:
    """The texts compressed, for the shuffle, with their tags."""
    others = [c for c in texts.columns if c != "text"]
    types = dict(texts.dtypes)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        press = zstandard.ZstdCompressor(level=1)
        data = [t.encode() for t in batch.column("text").to_pylist()]
        columns = [batch.column(c) for c in others] + [pa.array([text_tag(d) for d in data], pa.int32()), pa.array([press.compress(d) for d in data], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, [*others, "tag", "data"])

    return map_batches(texts, run, ", ".join(f"`{c}` {types[c]}" for c in others) + ", tag int, data binary")


def blocks(text: bytes, lead: int, starts: int, length: int) -> Iterator[tuple[int, bytes, bytes, bytes, int, int]]:
    """The blocks of a neighbourhood: number, core, bytes before and after it, first and last window in the block.

    ``lead`` is the anchor's place in ``text``, ``starts`` the number of windows. Bytes that lie outside
    are zeros; no window of the block reaches there.
    """
    for g in range(-lead // BLOCK, (starts - 1 - lead) // BLOCK + 1):
        at = lead + g * BLOCK  # where the block's window 0 starts
        before, after = text[max(0, at) : at + SIDE], text[at + length : at + length + SIDE]
        core = text[at + SIDE : at + length]
        yield g, core, before.rjust(SIDE, b"\0"), after.ljust(SIDE, b"\0"), max(0, -at), min(BLOCK - 1, starts - 1 - at)


def repeated(members: list[tuple[bytes, bytes, int, int, int]]) -> list[int]:
    """For members of one core, a bit set of the block's windows that occur more than once.

    A member is the bytes before and after the core, its first and last window, and how often it occurs.
    """
    whole = [(2 << last) - (1 << first) for _, _, first, last, _ in members]
    out = [w if m[4] > 1 else 0 for w, m in zip(whole, members)]
    if len(members) < 2 or all(m[4] > 1 for m in members):
        return out
    # the core is one symbol; every member ends with a mark that no window reaches
    width = 2 * SIDE + 2
    text = "".join("".join(chr(b + 2) for b in before) + "\1" + "".join(chr(b + 2) for b in after) + "\0" for before, after, *_ in members)
    last, owner = "", -1
    for i in suffix_array(text):
        member, t = divmod(i, width)
        if t > SIDE or not whole[member] >> t & 1:
            continue
        window = text[i : i + BLOCK]
        if window == last:
            out[member] |= 1 << t
            out[owner] |= 1 << t
        last, owner = window, member
    return out


def runs(bits: int) -> Iterator[tuple[int, int]]:
    """First and last of the runs of set bits."""
    at = 0
    while bits:
        skip = (bits & -bits).bit_length() - 1
        bits >>= skip
        at += skip
        n = (~bits & (bits + 1)).bit_length() - 1
        yield at, at + n - 1
        bits >>= n
        at += n


SPAN = "k long, tag int, start long, stop long"


def spans_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64()]
    columns = [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 4, kinds)]
    return pa.RecordBatch.from_arrays(columns, ["k", "tag", "start", "stop"])


def compare_texts(group: pa.Table, length: int) -> list[tuple]:
    """The repeated spans of the texts (that occur once each) among those of one anchor hash."""
    rows = list(zip(*(group.column(c).to_pylist() for c in ("k", "pos", "n", "body"))))
    by_core: dict[tuple[int, bytes], list[tuple]] = {}
    for i, (_, pos, n, body) in enumerate(rows):
        lo, hi, anchor = unpack(pos)
        for g, core, before, after, first, last in blocks(body, anchor - lo, hi - lo + 1, length):
            by_core.setdefault((g, core), []).append((i, (before, after, first, last, n)))
    out = []
    for (g, _), held in by_core.items():
        if len(held) > 1:
            for (i, member), bits in zip(held, repeated([m for _, m in held])):
                if bits and member[4] == 1:
                    k, pos, _, _ = rows[i]
                    at = unpack(pos)[2] + g * BLOCK
                    out += [(k, pos & (1 << TAG_BITS) - 1, at + a, at + b + length) for a, b in runs(bits)]
    return out


def compare_sides(group: pa.Table, length: int) -> list[tuple]:
    """The same for the blocks of one core."""
    rows = list(zip(*(group.column(c).to_pylist() for c in ("k", "pos", "n", "at", "before", "after", "first", "last"))))
    found = repeated([(r[4], r[5], r[6], r[7], r[2]) for r in rows])
    return [
        (r[0], r[1] & (1 << TAG_BITS) - 1, r[3] + a, r[3] + b + length) for r, bits in zip(rows, found) if r[2] == 1 for a, b in runs(bits)
    ]


def by_group(rows: DataFrame, key: str, compare, length: int) -> DataFrame:
    """Spans that ``compare`` finds in the rows of each ``key``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for group in stream_groups(batches, key):
            held += compare(group, length)
            if len(held) > 50_000:
                yield spans_batch(held)
                held = []
        if held:
            yield spans_batch(held)

    return rows.repartition(key).sortWithinPartitions(key).mapInArrow(run, SPAN)


CUT = (
    "hot boolean, h long, k long, pos long, n long, body binary, core long, core2 long, at long, before binary, after binary, first int, last int"
)


def cut(texts: DataFrame, length: int) -> DataFrame:
    """The texts of neighbourhoods; those whose anchor more than ``GROUP`` texts have, as blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in CUT.split(", ")]
        kinds = {"hot": pa.bool_(), "body": pa.binary(), "before": pa.binary(), "after": pa.binary(), "first": pa.int32(), "last": pa.int32()}

        def flush(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, kinds.get(n, pa.int64())) for n, c in zip(names, zip(*out))], names)

        for batch in sliced(batches, SLICE):
            open_ = zstandard.ZstdDecompressor()
            out: list[tuple] = []
            for k, data, parts in zip(*(batch.column(c).to_pylist() for c in ("k", "data", "parts"))):
                text = open_.decompress(data)
                for part in parts:
                    lo, hi, anchor = unpack(part["pos"])
                    body = text[lo : hi + length]
                    head = (part["h"], k, part["pos"], part["n"])
                    if part["m"] <= GROUP:
                        out.append((False, *head, body, None, None, None, None, None, None, None))
                        continue
                    for g, core, before, after, first, last in blocks(body, anchor - lo, hi - lo + 1, length):
                        name = hashlib.blake2b(part["h"].to_bytes(8, "little", signed=True) + g.to_bytes(4, "little", signed=True) + core, digest_size=16).digest()
                        one, two = np.frombuffer(name, "<i8").tolist()
                        out.append((True, *head, None, one, two, anchor + g * BLOCK, before, after, first, last))
                if len(out) > 20_000:
                    yield flush(out)
                    out = []
            if out:
                yield flush(out)

    return texts.mapInArrow(run, CUT)


def hot_spans(rows: DataFrame, length: int) -> DataFrame:
    """The repeated spans of blocks, whose cores any number of texts may share."""
    core = ["core", "core2"]
    rows = materialize(rows, "suffix-blocks")
    counts = rows.groupBy(*core).agg(F.count("*").alias("m"), F.min("n").alias("_least")).filter("m > 1 and _least = 1")
    counts = materialize(counts.select(*core, "m", F.col("m").alias("_share")), "suffix-cores")
    rows = materialize(join_by_share(rows, counts, core, "_share"), "suffix-shared-blocks")
    few = by_group(rows.filter(F.col("m") <= GROUP).withColumn("group", F.xxhash64(*core)), "group", split_cores, length)
    # beyond that, equal blocks count as one: where there are several all their windows are repeated
    tag = F.col("pos").bitwiseAND(F.lit((1 << TAG_BITS) - 1)).cast("int")
    block = [*core, "before", "after", "first", "last"]
    many = rows.filter(F.col("m") > GROUP)
    kinds = many.groupBy(*block).agg(F.sum("n").alias("n"), F.count("*").alias("_share"), F.min(F.struct("k", "pos", "at")).alias("one"))
    kinds = materialize(kinds, "suffix-block-kinds")
    same = join_by_share(many.filter("n = 1"), kinds.filter("n > 1").select(*block, "_share"), block, "_share")
    same = same.select("k", tag.alias("tag"), (F.col("at") + F.col("first")).alias("start"), (F.col("at") + F.col("last") + length).alias("stop"))
    # and the others go by single windows: equal ones have equal bytes on both sides of the core
    windows = kinds.select("n", "one", *core, "before", "after", F.explode(F.sequence("first", "last")).alias("t"))
    sides = F.concat(F.expr("substring(before, t + 1)"), F.lit(b"|"), F.expr("substring(after, 1, t)"))
    windows = windows.select("n", "one.*", "t", F.md5(F.concat(F.encode(F.concat_ws(":", *core, "t"), "utf-8"), sides)).alias("w"))
    again = windows.groupBy("w").agg(F.sum("n").alias("_n")).filter("_n > 1").drop("_n")
    single = windows.filter("n = 1").join(again.hint("merge"), "w")
    start = F.col("at") + F.col("t")
    single = single.select("k", tag.alias("tag"), start.alias("start"), (start + length).alias("stop"))
    return few.unionByName(same).unionByName(single)


def split_cores(group: pa.Table, length: int) -> list[tuple]:
    cores: dict[tuple[int, int], list[int]] = {}
    for i, core in enumerate(zip(group.column("core").to_pylist(), group.column("core2").to_pylist())):
        cores.setdefault(core, []).append(i)
    return [x for rows in cores.values() for x in compare_sides(group if len(cores) == 1 else group.take(pa.array(rows)), length)]


def repeated_spans(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """``k, tag, start, stop``: byte ranges of texts that are covered by repeated windows; they may overlap."""
    found = materialize(occurrences(texts, length), "suffix-occurrences")
    stats = found.groupBy("h").agg(F.count("*").alias("_n"), F.min("c").alias("_a"), F.max("c").alias("_b")).filter("_n > 1")
    # only hashes that very many neighbourhoods have are sent to every task; the rest are merge joins, since all these tables grow with the corpus
    stats = materialize(stats.select("h", (F.col("_a") != F.col("_b")).alias("mixed"), "_n"), "suffix-shared")
    live = materialize(join_by_share(found, stats, ["h"], "_n"), "suffix-live")
    tag = F.col("pos").bitwiseAND(F.lit((1 << TAG_BITS) - 1)).cast("int")
    first = F.shiftright("pos", 32)
    whole = [F.col("k"), tag.alias("tag"), first.alias("start"), (first + F.shiftright("pos", 23).bitwiseAND(F.lit(511)) + length).alias("stop")]
    kinds = live.filter("mixed").groupBy("h", "c").agg(F.count("*").alias("n"), F.min(F.struct("k", "pos")).alias("one"))
    kinds = materialize(kinds, "suffix-kinds")
    copies = join_by_share(live.filter("mixed"), kinds.filter("n > 1").select("h", "c", "n"), ["h", "c"], "n")
    parts = [live.filter("not mixed").select(*whole), copies.select(*whole)]
    sizes = kinds.groupBy("h").agg(F.count("*").alias("m"), F.min("n").alias("_least")).filter("_least = 1").drop("_least")
    sizes = materialize(sizes, "suffix-sizes").hint("merge")
    todo = kinds.join(sizes, "h").select("h", "n", "m", "one.k", "one.pos").withColumn("tag", tag)
    todo = todo.groupBy("k", "tag").agg(F.collect_list(F.struct("h", "n", "m", "pos")).alias("parts"))
    chosen = packed(texts.select("k", "text")).join(todo.hint("merge"), ["k", "tag"]).select("k", "data", "parts")
    bodies = materialize(cut(chosen, length), "suffix-texts")
    parts.append(by_group(bodies.filter("not hot").select("h", "k", "pos", "n", "body"), "h", compare_texts, length))
    parts.append(hot_spans(bodies.filter("hot").drop("hot", "h", "body"), length))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return materialize(out, "suffix-spans")


def union_of(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of the bytes covered."""
    out: list[list[int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return [tuple(x) for x in out]


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = (), length: int = LENGTH) -> DataFrame:
    """``doc_id, n_bytes, spans, kept, text`` (and a struct of the columns ``keep``) of every row of ``docs``.

    ``spans`` are the maximal byte ranges, ``start`` and exclusive ``stop``, that windows of ``length`` bytes cover which also start anywhere
    else in the table, in the same document too; ``kept`` holds the other bytes and ``text`` the whole characters among them. Windows are judged
    on the input. A null text counts as empty. Repeated rows are each other's copies; a null key stays null. A document shorter than a window is
    kept whole. No rows give no rows.
    """
    if not GRAM + BLOCK <= length < GRAM + (1 << 9):
        raise ValueError(f"windows have {GRAM + BLOCK} to {GRAM + (1 << 9) - 1} bytes")
    texts = keyed(docs, key, text, keep)
    spans = repeated_spans(texts.select("k", "text"), length).groupBy("k", "tag").agg(F.collect_list(F.struct("start", "stop")).alias("found"))
    rows = packed(texts).join(spans.hint("merge"), ["k", "tag"], "left")
    kept = [("kept_columns", dict(texts.dtypes).get("kept_columns"))] if keep else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor()
        for batch in sliced(batches, SLICE):
            sizes, spans, rest = [], [], []
            for data, found in zip(batch.column("data").to_pylist(), batch.column("found").to_pylist()):
                whole = open_.decompress(data)
                gone = union_of([(s["start"], s["stop"]) for s in found or ()])
                edges = [0, *(e for span in gone for e in span), len(whole)]
                sizes.append(len(whole))
                spans.append([{"start": a, "stop": b} for a, b in gone])
                rest.append(b"".join(whole[a:b] for a, b in zip(edges[::2], edges[1::2])))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
            columns = [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(spans, kind), pa.array(rest, pa.binary())]
            columns.append(pa.array([x.decode("utf-8", "ignore") for x in rest], pa.string()))
            yield pa.RecordBatch.from_arrays(columns + [batch.column(c) for c, _ in kept], ["doc_id", "n_bytes", "spans", "kept", "text", *(c for c, _ in kept)])

    schema = "doc_id long, n_bytes long, spans array<struct<start:long,stop:long>>, kept binary, text string" + "".join(f", {c} {t}" for c, t in kept)
    return rows.mapInArrow(run, schema)
