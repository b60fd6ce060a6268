"""The prefix trie against a plain one, on odd rows, with few and many shards and a cut skeleton."""

import hashlib
import random
import re
import zlib

import pytest

from corpusloom.llm import prefix_trie, queries


def symbol(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()


def plain_trie(convs):
    """``convs``: pairs of id and list of (role, text)."""
    members = {}
    for c, turns in convs:
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append((c, len(turns)))
    out = []
    for path, held in members.items():
        below = [p for p in members if p[: len(path)] == path]
        words = lambda p: len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        ends = ",".join(str(c) for c in sorted(c for c, n in held if n == len(path)))
        out.append(
            (
                min(held)[0], len(path), min(members[path[:-1]])[0] if path else None, len(held), sum(len(p) == len(path) + 1 for p in below),
                sum(all(len(q) <= len(p) or q[: len(p)] != p for q in members) for p in below), sum((len(members[p]) - 1) * words(p) for p in below),
                hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(out, key=str)


def plain_convs(rows):
    held = {}
    for c, turn, role, text in rows:
        if c is not None:
            held.setdefault(c, []).append((turn is not None, turn or 0, symbol(role or "", text or ""), (role or "", text or "")))
    return {c: [x[3] for x in sorted(v)] for c, v in held.items()}


def plain_rebuilt(convs):
    out = []
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        out.append((c, convs.get(c - c % 20, [])[:h] + own[h:]))
    return out


def rows_of(seed, n):
    rng = random.Random(seed)
    texts = ["yes", "no  no", " \t ", "", "three words\nhere", "Ä ö"]
    rows = []
    for c in range(n):
        for t in range(rng.choice([1, 2, 2, 3, 3, 5])):
            rows.append((c, t, rng.choice(["user", "bot"]) if rng.random() < 0.2 else "user", rng.choice(texts[: 2 + t])))
    same = [(c, t, "user", f"turn {t}") for c in range(1000, 1400) for t in range(4)]
    long = [(c, t, "user", "again" if t < 150 else str(c + t)) for c in (2000, 2001, 2040) for t in range(160 + c % 3)]
    odd = [(None, 0, "user", "lost"), (3000, None, None, None), (3000, None, "user", "x"), (3000, 1, "user", "a"), (3000, 1, "user", "b"), (3000, 1, "user", "a"), (3001, 0, "user", ""), (3001, 0, "use", "r")]
    return rows + same + long + odd


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn int, role string, text string, node int, path string").repartition(6)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("per_shard, most", [(100_000, 1 << 20), (40, 1 << 20), (40, 2000), (100_000, 0)])
def test_trie(spark, monkeypatch, per_shard, most):
    monkeypatch.setattr(prefix_trie, "TURNS_PER_SHARD", per_shard)
    monkeypatch.setattr(prefix_trie, "SKELETON_TURNS", most)
    rows = rows_of(per_shard, 150)
    turns = prefix_trie.conversation_turns(table(spark, rows))
    assert found(prefix_trie.prefix_trie(queries.rebuilt(turns))) == plain_trie(plain_rebuilt(plain_convs(rows)))


def test_trie_without_rows(spark):
    df = table(spark, rows_of(1, 5))
    turns = prefix_trie.conversation_turns(df.limit(0))
    assert found(prefix_trie.prefix_trie(turns)) == []
    turns = prefix_trie.conversation_turns(df.filter("conv_id = 3001"))
    assert found(prefix_trie.prefix_trie(turns)) == plain_trie(plain_convs([(3001, 0, "user", ""), (3001, 0, "use", "r")]).items())
    bare = turns.selectExpr("conv_id", "slice(turns, 1, 0) AS turns")
    assert found(prefix_trie.prefix_trie(bare.unionByName(bare))) == plain_trie([(3001, []), (3001, [])])


def test_equal_conversations_spread_over_shards(spark, monkeypatch):
    """The one conversation of most rows is counted in parts."""
    monkeypatch.setattr(prefix_trie, "TURNS_PER_SHARD", 40)
    rows = [(c, t, "user", f"turn {t}") for c in range(1000) for t in range(2)] + [(5000, 0, "user", "other")]
    paths = prefix_trie.conversation_turns(table(spark, rows)).selectExpr("conv_id", "unhex(array_join(transform(turns, t -> hex(t.symbol)), '')) AS path", "transform(turns, t -> t.words) AS words")
    cuts = prefix_trie.choose_splitters(paths, 1001, 50)
    assert len(cuts) > 40
    assert found(prefix_trie.prefix_trie(prefix_trie.conversation_turns(table(spark, rows)))) == plain_trie(plain_convs(rows).items())


def test_common_turns():
    rng = random.Random(2)
    for _ in range(300):
        a = [rng.randbytes(16) for _ in range(rng.randrange(40))]
        n = rng.randrange(len(a) + 1)
        b = a[:n] + [rng.randbytes(16) for _ in range(rng.randrange(5))]
        assert prefix_trie.common_turns(b"".join(a), b"".join(b)) == n
