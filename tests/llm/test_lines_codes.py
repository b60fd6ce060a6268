"""Line dedup and vector codes against plain models, on odd rows."""

import hashlib
import math
import random

import numpy as np
import pytest

from corpusloom.llm import common, line_dedup, vector_codes


def plain_lines(rows, min_docs=3, min_chars=20):
    strip = lambda line: "".join(c.lower() if c.isascii() else c for c in line.strip(" \t\n\v\f\r"))
    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            holders.setdefault(strip(line), set()).add(-math.inf if i is None else i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        own = -math.inf if i is None else i
        gone = [n for n, x in enumerate(lines) if len(strip(x)) >= min_chars and len(holders[strip(x)]) >= min_docs and own != max(holders[strip(x)])]
        out.append((i, len(lines), len(gone), "\n".join(x for n, x in enumerate(lines) if n not in gone)))
    return sorted(out, key=str)


@pytest.mark.parametrize("shares", [4096, 5])
def test_lines(spark, monkeypatch, shares):
    monkeypatch.setattr(common, "SHARES", shares)
    rng = random.Random(4)
    pool = ["A line that MANY documents have, no. %d" % i for i in range(6)] + ["short", "", " \t ", "ÄÖÜ Äöü äöü äöü äöü ÄÖ", "a line with 20 chars", "a line of 19 chars.", " wide space is no space "]
    dress = ["{}", " {}", "{}\r", "\t{}\v\f", "{}\x1c"]
    rows = [(i, "\n".join(rng.choice(dress).format(rng.choice(pool)) for _ in range(rng.randrange(12)))) for i in range(40)]
    rows += [(None, pool[0] + "\n" + pool[1]), (None, pool[0]), (7, pool[2]), (7, pool[2]), (90, None), (91, ""), (92, "\n\n"), (93, pool[0] + "\n"), (94, "\n".join([pool[3], "x" * 50] * 3000))]
    df = spark.createDataFrame([(i, t, "a", 1) for i, t in rows], "doc_id long, text string, line string, place int")
    got = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in line_dedup.dedup_lines(df).collect()), key=str)
    assert got == plain_lines(rows)
    assert line_dedup.dedup_lines(df.limit(0)).collect() == []
    got = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in line_dedup.dedup_lines(df, min_docs=2, min_chars=1).collect()), key=str)
    assert got == plain_lines(rows, 2, 1)


def test_lines_run_no_python(spark):
    df = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    plan = line_dedup.dedup_lines(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def plain_codes(rows, parts, entries, rounds, scale):
    """``rows`` of id, vector, label; whole numbers throughout."""
    whole = lambda x: math.floor(x * scale) if abs(x) < 1e290 else int(x) * scale
    good = [(i, [whole(x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    good.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    good = [r for r in good if len(r[1]) == len(good[0][1])]
    dim = len(good[0][1]) if good else 0
    cut = lambda v: [v[p * dim // parts : (p + 1) * dim // parts] for p in range(parts)]
    books = [list(b) for b in zip(*(cut(v) for _, v, _ in good[:entries]))]

    def near(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        held = [[[] for _ in b] for b in books]
        for _, v, _ in good:
            for p, x in enumerate(cut(v)):
                held[p][near(x, books[p])[1]].append(x)
        books = [[[sum(c) // len(h) for c in zip(*h)] if h else e for h, e in zip(hs, b)] for hs, b in zip(held, books)]
    found = [(i, [near(x, books[p]) for p, x in enumerate(cut(v))], label) for i, v, label in good]
    total = {}
    for _, n, label in found:
        total[label] = total.get(label, 0) + sum(d for d, _ in n)
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    most = 2**63 - 1
    rows = [(i, "".join(f"{k:02x}" for _, k in n), min(sum(d for d, _ in n), most), min(total[label], most), digest) for i, n, label in found]
    return sorted(rows, key=str)


def coded(df, **kw):
    return sorted(((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in vector_codes.compress(df, **kw).collect()), key=str)


@pytest.mark.parametrize("shares", [4096, 2])
def test_codes(spark, monkeypatch, shares):
    monkeypatch.setattr(common, "SHARES", shares)
    nan, inf = math.nan, math.inf
    rng = np.random.default_rng(8)
    rows = [(int(i), [float(np.float32(x)) for x in rng.normal(size=12)], int(i % 3) or None) for i in rng.permutation(400)]
    rows += [(5, [0.0] * 12, 1), (5, [0.0] * 12, 1), (None, [1.0] * 12, None), (900, None, 2), (901, [nan] * 12, 2), (902, [None] + [0.0] * 11, 2), (903, [inf] + [0.0] * 11, 2), (904, [1.0] * 3, 2), (905, [], 2)]
    rows += [(i, [float(x) for x in rng.integers(-1, 2, 12)], 7) for i in range(1000, 1300)]  # many ties
    df = spark.createDataFrame([(i, v, label, 0, "c") for i, v, label in rows], "vec_id long, embedding array<float>, label int, error int, code string").repartition(5)
    assert coded(df, parts=5) == plain_codes(rows, 5, 16, 6, 4096)
    assert coded(df, parts=4, entries=3, rounds=2) == plain_codes(rows, 4, 3, 2, 4096)
    few = df.filter("vec_id between 20 and 24")
    assert coded(few) == plain_codes([r for r in rows if r[0] is not None and 20 <= r[0] <= 24], 8, 16, 6, 4096)
    assert coded(df.limit(0)) == [] and coded(df.filter("vec_id = 905")) == plain_codes([rows[-301]], 8, 16, 6, 4096)


def test_codes_of_large_numbers(spark):
    rng = np.random.default_rng(9)
    rows = [(i, [float(x) for x in rng.normal(size=8) * 10.0 ** rng.choice([0, 5, 9, 14, 30, 150])], 1) for i in range(60)] + [(60, [1.7e308] * 8, 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert coded(df, parts=2, entries=5) == plain_codes(rows, 2, 5, 6, 4096)


def test_search_leaves_entries_out():
    """On clusters most entries are never measured, and the nearest one is found all the same."""
    rng = np.random.default_rng(10)
    entries = rng.integers(-10_000, 10_000, (64, 8))
    x = entries[rng.integers(0, 64, 5000)] + rng.integers(-300, 300, (5000, 8))
    code, d, measured = vector_codes.Codebook(entries).nearest(x)
    every = ((x[:, None] - entries[None]) ** 2).sum(axis=2)
    assert (code == every.argmin(axis=1)).all() and (d == every.min(axis=1)).all()
    assert measured.mean() < 32
