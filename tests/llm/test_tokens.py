"""Encoding, edit-aware counts and packing against the tokenizers library and plain models."""

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF
from tokenizers import Tokenizer

from corpusloom.llm import bpe, packing, queries, token_counts

ODD = [
    None, "", " \n\t ", "Hello  WORLD's it'S they'LL", "x<|endoftext|>y <|startoftext|> <|ENDOFTEXT|>", "a\x1cb \x1f c\x85d　e", "é é ÅÅ ǅ İ ẞ ΣΑΣ ²½ ª µ ×÷",
    "日本語 한국어 \U0001f600\U0001f600", "ab" * 3000, "!" * 500 + "?" * 33, "abcdefghijklmnop" * 2, "'s't 're 've'm", "<| <|endoftext| >",
]


@pytest.fixture(scope="module")
def lib():
    return Tokenizer.from_file(queries.vocabulary())


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(rows)], "doc_id long, text string, ids string, piece int")


def test_encode_odd_texts(spark, lib):
    rows = {r.doc_id: r for r in bpe.encode(frame(spark, ODD), queries.vocabulary(), decoded=True).collect()}
    for i, text in enumerate(ODD):
        want = lib.encode(text or "", add_special_tokens=False).ids
        assert rows[i].ids == want
        assert rows[i].decoded == lib.decode(want, skip_special_tokens=False)
    back = bpe.decode(bpe.encode(frame(spark, ODD), queries.vocabulary()), queries.vocabulary())
    assert {r.doc_id: r.text for r in back.collect()} == {i: r.decoded for i, r in rows.items()}


def test_op4(spark, lib, texts):
    rows = queries.op4(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = lib.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_merge_tree_of_a_long_word(lib):
    coder = bpe.WordBpe(queries.vocabulary())
    for word in ("ab" * 5000, "the" * 4000 + "aaaa" * 1000):
        assert np.frombuffer(coder.encode_any(word), "<i4").tolist() == lib.encode(word, add_special_tokens=False).ids
        (_, ids, sizes), *more = coder.encode_words([word])
        assert not more and len(ids) == sizes[0] and ids.tolist() == lib.encode(word, add_special_tokens=False).ids


def test_trees_in_step(lib):
    """Words of every length up to that of the long ones, many that repeat few symbols, in one column each."""
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("abeth'nrs!e"[: 2 + n % 9]), n)).replace("'", "i") for n in range(1, 2 * bpe.TOGETHER) for _ in range(12)]
    words = sorted({w for w in words if w.isalpha()})
    coder = bpe.WordBpe(queries.vocabulary())
    found = {}
    for chosen, ids, sizes in coder.encode_words(words):
        ends = np.cumsum(sizes)
        found |= {words[i]: ids[end - size : end].tolist() for i, end, size in zip(chosen.tolist(), ends, sizes)}
    assert found == {w: lib.encode(w, add_special_tokens=False).ids for w in words}


def test_words_beyond_the_memory(lib, monkeypatch):
    """What a task forgets it works out again; texts of few and of many new pieces, cut columns and empty ones."""
    monkeypatch.setattr(bpe, "CACHE_WORDS", 50)
    coder = bpe.Encoder(bpe.WordBpe(queries.vocabulary()))
    rng = np.random.default_rng(9)
    marks = ["".join(rng.choice(list("''sStTmdrevl1!éÀÿ "), 60)) for _ in range(300)]
    texts = [*(x or "" for x in ODD), *marks, " ".join(f"Word{i}'s e{i}, {i}%" for i in range(200)), "", "again Word7's"]
    for column in (pa.array(texts), pa.array(texts).slice(3), pa.array(texts[-1:]), pa.array([], pa.string())):
        ids, ends = coder.encode(column)
        want = [lib.encode(t, add_special_tokens=False).ids for t in column.to_pylist()]
        assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == want


def plain_edit(text, edits):
    for e in edits or ():
        if e is not None:
            at = max(0, min(e["at"] or 0, len(text)))
            text = text[:at] + (e["added"] or "") + text[at + max(0, e["removed"] or 0) :]
    return text


def test_edits_of_odd_documents(spark, lib):
    long = "word " * 400 + "x" * 2000 + " tail"
    cases = [
        (None, [(0, 0, "new text")]), ("", [(5, 5, "a"), (0, 1, "")]), ("one two", None), ("one two", []), ("one two three", [(3, 1, "")]),
        ("one two three", [(0, 100, "")]), ("one two", [(7, 0, "s more"), (0, 0, "pre")]), ("a b", [None, (None, None, None)]),
        (long, [(1990, 30, ""), (0, 600, "q"), (500, 1200, " z "), (10**9, 0, "end")]), (long, [(2100, 1, " ")] * 3), (long, [(0, len(long), ""), (0, 0, "it's back")]),
    ]
    rows = [(i, t, e, "clash") for i, (t, e) in enumerate(cases)]
    df = spark.createDataFrame(rows, "doc_id long, text string, edits array<struct<at:long,removed:long,added:string>>, n_tokens string")
    got = {r.doc_id: r for r in token_counts.count_tokens(df, queries.vocabulary()).collect()}
    for i, (text, edits) in enumerate(cases):
        after = plain_edit(text or "", [e and dict(zip(("at", "removed", "added"), e)) for e in edits or ()])
        assert got[i].n_tokens == len(lib.encode(text or "", add_special_tokens=False).ids)
        assert (got[i].n_chars_edited, got[i].n_tokens_edited) == (len(after), len(lib.encode(after, add_special_tokens=False).ids)), i
    assert token_counts.count_tokens(df.limit(0), queries.vocabulary()).count() == 0


def test_op8(spark, lib, texts):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    edits = {r.doc_id: [e.asDict() for e in r.edits] for r in queries.with_edits(docs).collect()}
    rows = queries.op8(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        after = plain_edit(texts[r.doc_id], edits[r.doc_id])
        assert r.n_edits == len(edits[r.doc_id])
        assert r.n_tokens == len(lib.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert r.n_tokens_edited == len(lib.encode(after, add_special_tokens=False).ids)
        assert r.n_chars_edited == len(after)


def check_packing(rows, docs, lib, capacity):
    """Every piece once, none out of place, no overlap; returns the number of sequences and their sum."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert by_doc.keys() == docs.keys()
    for doc, pieces in by_doc.items():
        ids = [*lib.encode(docs[doc] or "", add_special_tokens=False).ids, 1]
        pieces.sort(key=lambda r: r.piece)
        assert [(r.piece, r.start, r.length) for r in pieces] == [(k, a, min(capacity, len(ids) - a)) for k, a in enumerate(range(0, len(ids), capacity))]
        for r in pieces:
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return len(by_sequence), sum(r.length for r in rows)


def test_op10(spark, lib, texts):
    n, total = check_packing(queries.op10(spark, SF).collect(), texts, lib, 4096)
    assert n <= -(-total // 4096) + 1


def test_packing_over_blocks_and_rounds(spark, lib, texts):
    pieces = packing.token_pieces(spark.read.parquet(f"{SF}/documents.parquet"), queries.vocabulary(), 512, 1)
    n, total = check_packing(packing.pack(pieces, 512, block_pieces=40).collect(), texts, lib, 512)
    assert n <= 1.02 * total / 512 + 2


def test_packing_odd_rows(spark, lib):
    docs = dict(enumerate(ODD))
    n, _ = check_packing(packing.pack(packing.token_pieces(frame(spark, ODD), queries.vocabulary(), 64, 1), 64).collect(), docs, lib, 64)
    assert n
    twice = frame(spark, ["a b"]).unionByName(frame(spark, ["a b"]))
    rows = packing.pack(packing.token_pieces(twice, queries.vocabulary(), 64, 1), 64).collect()
    assert sorted(r.offset for r in rows) == [0, 3]
    assert packing.pack(packing.token_pieces(twice.limit(0), queries.vocabulary(), 64, 1), 64).collect() == []


def test_evolution_beats_its_first_solutions():
    sizes = [34, 33, 33, 50, 25, 25, 60, 40, 70, 30, 20, 80, 10, 45, 55, 51, 49, 62, 38] * 3
    found = packing.evolve(sizes, [list(range(len(sizes)))] * 4, 100, "seed")
    assert max(found[0]) + 1 < len(sizes)
    for labels in found:
        fill = {}
        for size, b in zip(sizes, labels):
            fill[b] = fill.get(b, 0) + size
        assert max(fill.values()) <= 100
