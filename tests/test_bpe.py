import random
from collections import Counter

import pytest
from conftest import SF
from pyspark.sql import functions as F

from corpusloom import plans
from corpusloom.functions import text as tx
from corpusloom.operators import bpe
from corpusloom.plans import tokens

TEXTS = [
    "Hello world! This is a test.\nNumbers: 123, 4567, 89\nI'm, you're, it's @#$%^&*()\n你好世界 🌍",
    "안녕하세요! 오늘 날씨가 좋네요. 한국어 테스트입니다.\n숫자: 123, 4567",
    "aaaa aaaaaaa abababab bababa aab",
    "   \t　x y  \n\n ",
    "x",
    "",
    "é \U0001f468‍\U0001f469‍\U0001f467 <|bos|>",
]


def train(counts, n):
    """Step by step, on lists of ids."""
    words = {w: list(w.encode()) for w in counts}
    merges = []
    for new in range(256, 256 + n):
        pairs = Counter()
        for w, s in words.items():
            for p in zip(s, s[1:]):
                pairs[p] += counts[w]
        if not pairs:
            break
        best = min(pairs, key=lambda p: (-pairs[p], p))
        merges.append(best)
        for w, s in words.items():
            out, i = [], 0
            while i < len(s):
                if tuple(s[i : i + 2]) == best:
                    out.append(new)
                    i += 2
                else:
                    out.append(s[i])
                    i += 1
            words[w] = out
    return merges


def corpus(seed):
    rng = random.Random(seed)
    letters = "abc" if seed % 2 else "abcdefgh é"
    return {"".join(rng.choice(letters) for _ in range(rng.randrange(1, 12))): rng.randrange(1, 6) for _ in range(60)}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_training_equals_one_merge_at_a_time(spark, seed):
    counts = corpus(seed)
    df = spark.createDataFrame(list(counts.items()), "piece string, n long")
    assert bpe.train_merges(df, 256 + 9 + 40, keep_every=7) == train(counts, 40)


def big_corpus(seed, n_words):
    """Words of syllables that grow rarer."""
    rng = random.Random(seed)
    syllables = ["".join(rng.choice("abcdefghijklmnopqrstuvwé") for _ in range(rng.randrange(1, 4))) for _ in range(400)]
    pick = lambda: syllables[min(int(rng.expovariate(1 / 60)), 399)]
    out = Counter()
    while len(out) < n_words:
        out[" " * rng.randrange(2) + "".join(pick() for _ in range(rng.randrange(1, 5)))] += rng.randrange(1, 400)
    return dict(out)


@pytest.mark.parametrize("segments", [100_000, 3000])
def test_training_of_1024_merges(spark, segments):
    """One look takes in the whole corpus, or every round a part of the pairs; both give the merges of one at a time."""
    counts = big_corpus(5, 4000)
    df = spark.createDataFrame(list(counts.items()), "piece string, n long").repartition(4)
    rounds = []
    assert bpe.train_merges(df, 256 + 9 + 1024, segments=segments, rounds=rounds) == train(counts, 1024)
    assert sum(rounds) == 1024 and (len(rounds) == 1 if segments > 4000 else 3 < len(rounds) < 120)


def test_training_when_pairs_tie(spark):
    """More pairs share the highest count than a look takes in."""
    rng = random.Random(6)
    counts = {"".join(rng.sample("abcdefghijklmnopqrstuvwxyz", 4)): 1 for _ in range(300)}
    df = spark.createDataFrame(list(counts.items()), "piece string, n long")
    assert bpe.train_merges(df, 256 + 9 + 60, segments=64) == train(counts, 60)


def test_merge_queue(spark):
    rng = random.Random(7)
    for seed in range(30):
        merges = train(corpus(seed), 60)
        ranks = {m: i for i, m in enumerate(merges)}
        for _ in range(30):
            ids = list("".join(rng.choice("abc") for _ in range(rng.randrange(40))).encode())
            want = ids
            for i, pair in enumerate(merges):
                want = bpe.replace_pair(want, pair, 256 + i)
            assert bpe.merge_ids(ids, ranks) == want


def test_vocabulary_size_is_checked():
    merges = [(97, 97)] + [(256 + i, 256 + i) for i in range(28)]
    with pytest.raises(ValueError, match="every task"):
        bpe.BpeTokenizer(merges)


def test_training_of_self_pairs_and_long_words(spark):
    counts = {"a" * 700: 2, "ab" * 300: 1, "aaab": 3, " aaa": 5}
    df = spark.createDataFrame(list(counts.items()), "piece string, n long")
    assert bpe.train_merges(df, 256 + 9 + 25) == train(counts, 25)


def test_training_stops_when_nothing_is_left(spark):
    df = spark.createDataFrame([("ab", 1)], "piece string, n long")
    assert bpe.train_merges(df, 1000) == [(97, 98)]
    with pytest.raises(ValueError, match="at least"):
        bpe.train_merges(df, 200)


def test_encoding_equals_a_rank_by_rank_encoder(spark):
    tiktoken = pytest.importorskip("tiktoken")
    counts = corpus(2) | {w: 3 for t in TEXTS for w in t.split()}
    merges = train(counts, 120)
    tok = bpe.BpeTokenizer(merges)
    enc = tiktoken.Encoding("t", pat_str=tx.SPLIT_PATTERN, mergeable_ranks={b: i for i, b in enumerate(bpe.token_bytes(merges))}, special_tokens={})
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, text string").repartition(3)
    rows = df.select("i", "text", tok.encode("text").alias("ids"), tok.encode("text", prepend=7, append=8).alias("more"))
    rows = rows.withColumn("back", tok.decode("ids"))
    for r in rows.collect():
        assert r["ids"] == enc.encode_ordinary(r["text"])
        assert r["more"] == [7, *r["ids"], 8]
        assert r["back"] == r["text"]
    each = df.groupBy().agg(F.array_sort(F.collect_list("text")).alias("t")).select("t", tok.encode_each(F.col("t")).alias("ids")).first()
    assert each["ids"] == [enc.encode_ordinary(t) for t in each["t"]]


def test_pieces_join_back(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    for r in df.select("text", tx.pieces("text").alias("p")).collect():
        assert "".join(r["p"]) == r["text"]
        assert all(len(p) <= 2 for p in r["p"] if p.isnumeric())


def test_broken_sequences_decode_to_replacement(spark):
    tok = bpe.BpeTokenizer([])
    df = spark.createDataFrame([([0xC3],), ([0x61, 0xE4, 0xBD],), ([],), ([0xC3, 0xA9],)], "ids array<int>")
    assert [r[0] for r in df.coalesce(1).select(tok.decode("ids")).collect()] == ["�", "a�", "", "é"]


def test_vocabulary(spark):
    merges = [(0xC3, 0xA9), (97, 98), (257, 0xE4)]
    vocab = {r["token_id"]: r for r in bpe.vocab_table(spark, merges).collect()}
    assert (vocab[0xC3]["n_bytes"], vocab[0xC3]["n_bytes_ref"]) == (1, 3)
    assert (vocab[256]["n_bytes"], vocab[256]["n_bytes_ref"]) == (2, 2)
    assert (vocab[258]["n_bytes"], vocab[258]["n_bytes_ref"]) == (3, 5)
    assert vocab[259]["name"] == "<|bos|>" and vocab[267]["n_bytes"] == 0 and len(vocab) == 268


def test_store(spark, tmp_path):
    merges = [(97, 98), (256, 99)]
    bpe.save_tokenizer(spark, merges, str(tmp_path / "t"))
    assert bpe.load_merges(spark, str(tmp_path / "t")) == merges
    vocab = spark.read.parquet(str(tmp_path / "t" / "vocab"))
    assert bpe.special_id(vocab, "<|output_end|>") == 258 + 8 and bpe.bos_id(vocab) == 258
    other = vocab.filter("NOT is_special").unionByName(vocab.filter("name = '<|bos|>'").withColumn("name", F.lit("<|endoftext|>")))
    assert bpe.bos_id(other) == 258
    with pytest.raises(KeyError):
        bpe.bos_id(vocab.filter("NOT is_special"))


def test_symbols_skip_surrogates():
    for i in (0, 255, 0xD7FF, 0xD800, 0xFFFF, 0x10000):
        assert bpe.symbol_id(bpe.symbol(i)) == i and not 0xD800 <= ord(bpe.symbol(i)) <= 0xDFFF


def test_large_vocabulary(spark):
    """The merges of all documents against one merge at a time, and the ids against another encoder."""
    tiktoken = pytest.importorskip("tiktoken")
    rows = plans.QUERIES["vocab_train"](spark, SF).orderBy("rank").collect()
    merges = [(r["left_id"], r["right_id"]) for r in rows]
    assert len(merges) == 4096 - 256 - 9 and [r["new_id"] for r in rows] == [256 + i for i in range(len(rows))]
    counts = dict(map(tuple, bpe.piece_counts(tokens.collapsed(spark, SF)).collect()))
    assert merges[:150] == train(counts, 150)
    plain = bpe.Segments((("".join(map(chr, w.encode())), n) for w, n in counts.items())).learn(0, len(merges), 256)
    assert merges == plain
    enc = tiktoken.Encoding("t", pat_str=tx.SPLIT_PATTERN, mergeable_ranks={b: i for i, b in enumerate(bpe.token_bytes(merges))}, special_tokens={})
    tok = tokens.tokenizer(spark, SF, tokens.LARGE_VOCAB)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    n_tokens, n_bytes = Counter(), Counter()
    for r in docs.select("lang", "text", tok.encode("text").alias("ids")).collect():
        assert r["ids"] == enc.encode_ordinary(r["text"])
        n_tokens[r["lang"]] += len(r["ids"])
        n_bytes[r["lang"]] += len(r["text"].encode())
    encoded = plans.QUERIES["vocab_encode"](spark, SF).collect()
    assert all(r["is_whole"] for r in encoded) and sum(r["n_tokens"] for r in encoded) == sum(n_tokens.values()) + docs.count()
    for r in plans.QUERIES["vocab_compression"](spark, SF).collect():
        assert (r["n_tokens"], r["n_bytes"], r["n_broken"]) == (n_tokens[r["lang"]], n_bytes[r["lang"]], 0)


@pytest.mark.parametrize("digits", [1, 3])
def test_digit_groups_are_a_choice(spark, tmp_path, digits):
    """The pattern goes through counting, encoding, SQL and the store."""
    tiktoken = pytest.importorskip("tiktoken")
    pattern = tx.split_pattern(digits)
    df = spark.createDataFrame([(i, t + " 1234567 89") for i, t in enumerate(TEXTS)], "i int, text string")
    counts = dict(map(tuple, bpe.piece_counts(df, pattern=pattern).collect()))
    assert max(len(p) for p in counts if p.isnumeric()) == digits
    merges = train(counts, 40)
    bpe.save_tokenizer(spark, merges, str(tmp_path / "t"), pattern=pattern)
    tok = bpe.load_tokenizer(spark, str(tmp_path / "t"))
    enc = tiktoken.Encoding("t", pat_str=pattern, mergeable_ranks={b: i for i, b in enumerate(bpe.token_bytes(merges))}, special_tokens={})
    tok.register(spark, "digit_encode")
    df.createOrReplaceTempView("digit_texts")
    for r in spark.sql("SELECT text, digit_encode(text) AS by_sql FROM digit_texts").select("text", "by_sql", tok.encode("text").alias("ids")).collect():
        assert r["ids"] == r["by_sql"] == enc.encode_ordinary(r["text"])
    assert tx.split_pattern(2) == tx.SPLIT_PATTERN
    with pytest.raises(ValueError, match="digit"):
        tx.split_pattern(0)


def test_texts_are_encoded_in_slices(spark, monkeypatch):
    """Batches are cut by bytes, so a task's memory does not depend on how many texts, or how long ones, a batch holds."""
    import pyarrow as pa

    for texts in (["aaa", None, "bb", "", "cccc"] * 3, [["a", "bb"], [], None, ["ccc"], ["", ""]] * 2, [[["a"], ["bb", "c"]], [], [["ddd"]], [[]]]):
        whole = pa.array(texts).slice(1)
        parts = list(tx.text_slices(whole, 2))
        assert [x for part in parts for x in part.to_pylist()] == texts[1:] and len(parts) > 1
    lists = pa.array([[1, 2], None, [], [3] * 9, [4]]).slice(1)
    monkeypatch.setattr(bpe, "SLICE_IDS", 2)
    assert [x.to_pylist() for x in bpe._id_slices(lists)] == [[None, []], [[3] * 9], [[4]]]
    monkeypatch.setattr(tx, "SLICE_BYTES", 2)
    known = bpe.Known(3, 10_000)
    for piece in "abcde":
        known.add(piece, b"1234")
    assert list(known) == ["d", "e"] and known.held == 2 * 208


def test_comparison_takes_a_whole_vocabulary(spark, tmp_path):
    """Merges go on until every piece of a small corpus is one token, as they do one at a time."""
    texts = [" ".join(corpus(seed)) for seed in (1, 2, 3)]
    spark.createDataFrame([(i, f"l{i}", t) for i, t in enumerate(texts)], "doc_id long, lang string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    counts = dict(map(tuple, bpe.piece_counts(tokens.collapsed(spark, str(tmp_path))).collect()))
    ranks = {m: i for i, m in enumerate(train(counts, tokens.FULL_VOCAB))}
    assert 200 < len(ranks) and all(len(bpe.merge_piece(p.encode(), ranks)) == 1 for p in counts)
    found = {r["lang"]: r for r in plans.QUERIES["tokenizer_compare"](spark, str(tmp_path)).collect()}
    assert sum(r["our_tokens"] for r in found.values()) == sum(counts.values()) and len(found) == 3
    assert all(r["baseline_tokens"] > r["our_tokens"] and r["better"] == "ours" for r in found.values())


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_statement_of_training_equals_one_merge_at_a_time(seed):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, lang VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, 'x', ?)", [(i, " ".join([w] * n)) for i, (w, n) in enumerate(corpus(seed).items())])
    for n in (7, 40, 5000):
        words = con.execute(f"WITH RECURSIVE {tokens.sql_trained(256 + 9 + n)} SELECT piece, n, w FROM words").fetchall()
        merges = train({p: k for p, k, _ in words if p}, n)
        ranks = {m: i for i, m in enumerate(merges)}
        assert ("", len(merges), "") in words and (len(merges) == n or n == 5000)
        assert all([ord(c) for c in w] == bpe.merge_piece(p.encode(), ranks) for p, _, w in words if p)
