"""Document operators against plain models: repeats, rules, near copies, licences, quality."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SF

from corpusloom.llm import common, components, license_scan, near_join, quality_classifier, quality_rules, queries, suffix_array, suffix_dedup

CLASH = "doc_id long, text string, lang string, source string, n_chars long, n int, tag string, h long, k long, bands string, words int"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


def frame(spark, rows, ids=None):
    """Texts with columns whose names the operators use inside."""
    rows = [(i if ids is None else ids[i], t, None, "s", 0, 1, "x", 2, 3, "y", 4) for i, t in enumerate(rows)]
    return spark.createDataFrame(rows, CLASH)


# --- suffix arrays ---------------------------------------------------------------------------------


@pytest.mark.parametrize("letters", ["a", "ab", "abc", "\0\1\2", "abcdefghijkl"])
def test_suffix_array(letters):
    rng = np.random.default_rng(len(letters))
    for n in list(range(12)) * 8 + [60, 200]:
        s = "".join(rng.choice(list(letters), n)) * 2
        assert suffix_array.suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])


def plain_spans(texts, size=suffix_dedup.LENGTH):
    """All windows in a table."""
    seen = Counter(t[i : i + size] for t in texts for i in range(len(t) - size + 1))
    out = []
    for t in texts:
        covered = np.zeros(len(t) + 1, np.int64)
        for i in range(len(t) - size + 1):
            if seen[t[i : i + size]] > 1:
                covered[i] += 1
                covered[i + size] -= 1
        on = np.cumsum(covered[:-1]) > 0
        edges = np.flatnonzero(np.diff(np.concatenate([[False], on, [False]])))
        out.append(list(zip(edges[::2].tolist(), edges[1::2].tolist())))
    return out


def check_dedup(spark, rows, ids=None):
    want = plain_spans([(t or "").encode() for t in rows])
    got = suffix_dedup.dedup(frame(spark, rows, ids), keep=("lang", "n_chars")).collect()
    assert len(got) == len(rows)
    found = sorted((r.doc_id or -1, [(s.start, s.stop) for s in r.spans], r.n_bytes, bytes(r.kept)) for r in got)
    model = []
    for i, (t, spans) in enumerate(zip(rows, want)):
        data = (t or "").encode()
        keep = b"".join(data[a:b] for a, b in zip([0, *(s[1] for s in spans)], [*(s[0] for s in spans), len(data)]))
        model.append(((i if ids is None else ids[i]) or -1, spans, len(data), keep))
    assert found == sorted(model)


def noise(seed, n, letters="abcdefghijklmnop  é"):
    return "".join(np.random.default_rng(seed).choice(list(letters), n))


def repeat_cases():
    passage, other = noise(1, 900), noise(2, 450)
    return [
        None, "", "x" * 399, noise(3, 600), passage, noise(4, 50) + passage, passage + noise(5, 300) + passage, noise(6, 333) + other[:420] + noise(7, 100),
        noise(8, 10) + other + noise(9, 700) + passage[100:700], "ab" * 700, "ab" * 300 + "c", "é" * 500, passage[:399] + "?" + passage[400:], passage, noise(10, 30000) + passage[300:],
        passage[5:405], passage[6:405], "\0" * 450, "\0" * 401 + "a",
    ]


def test_dedup_odd_rows(spark):
    check_dedup(spark, repeat_cases())
    assert suffix_dedup.dedup(frame(spark, ["a"]).limit(0)).collect() == []


def test_dedup_repeated_and_null_keys(spark):
    one, two = noise(20, 700), noise(21, 800)
    check_dedup(spark, [one, one, two, two[:500], "short"], ids=[7, 7, 7, None, None])


@pytest.mark.parametrize("group, shares", [(1, 4096), (3, 4096), (1, 8), (3, 3)])
def test_dedup_of_hot_passages(spark, monkeypatch, group, shares):
    """Few texts per group, so that cores and windows are split too; hot hashes are joined apart from the others."""
    monkeypatch.setattr(suffix_dedup, "GROUP", group)
    monkeypatch.setattr(common, "SHARES", shares)
    passage = noise(30, 470)
    check_dedup(spark, repeat_cases() + [noise(100 + i, 20 + 11 * i % 90) + passage[i % 3 :] + noise(200 + i // 2, 300) for i in range(14)])


@pytest.mark.parametrize("length", [40, 200, 535])
def test_dedup_of_other_lengths(spark, length):
    passage = " ".join(noise(60, 400).split())[:300]
    rows = repeat_cases() + [noise(61, 90) + passage, passage[7:] + noise(62, 33), noise(63, 50) + passage[:199], noise(64, 10) + passage[:200] + "ä", None, ""]
    want = plain_spans([(t or "").encode() for t in rows], length)
    got = {r.doc_id: r for r in suffix_dedup.dedup(frame(spark, rows), length=length).collect()}
    assert [[tuple(x) for x in got[i].spans] for i in sorted(got)] == want
    assert all(r.text == r.kept.decode("utf-8", "ignore") for r in got.values())


def test_dedup_of_lengths_that_do_not_fit(spark):
    for length in (39, 536):
        with pytest.raises(ValueError):
            suffix_dedup.dedup(frame(spark, ["a"]), length=length)


def test_dedup_of_long_texts(spark, monkeypatch):
    """Slices shorter than the texts."""
    monkeypatch.setattr(suffix_dedup, "SLICE", 1000)
    check_dedup(spark, repeat_cases() + [noise(40, 5000), noise(41, 100) + noise(40, 5000)[900:4100] + noise(42, 2200)])


def test_op2(spark, texts):
    ids = sorted(texts)
    want = dict(zip(ids, plain_spans([(texts[i] or "").encode() for i in ids])))
    rows = queries.op2(spark, SF).collect()
    assert len(rows) == len(ids)
    for r in rows:
        data, spans = texts[r.doc_id].encode(), want[r.doc_id]
        assert (r.n_bytes, r.n_spans, r.n_removed) == (len(data), len(spans), sum(b - a for a, b in spans))
        keep = b"".join(data[a:b] for a, b in zip([0, *(s[1] for s in spans)], [*(s[0] for s in spans), len(data)]))
        assert r.kept_sha256 == hashlib.sha256(keep).hexdigest()


# --- quality rules ---------------------------------------------------------------------------------


def plain_measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen = Counter(windows)
    covered = {j for i, w in enumerate(windows) if seen[w] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


ODD = [
    None, "", " \n\t\n", "a b c d e f g h " * 3, "a b c d e f g h i", "x\n\nx\n x\nx ", "é b \x1c c\x85d", "#*$ %&|<>#", "w " * 5000,
    "one two three four five six seven eight nine ten " * 2 + "other words follow here to the end of it all now", " ".join(f"w{i}" for i in range(100)), "a b c d e f g h a b c d e f g",
]


def test_measures(spark):
    rows = {r.doc_id: r for r in quality_rules.quality_rules(frame(spark, ODD)).collect()}
    for i, text in enumerate(ODD):
        want = plain_measures(text)
        r = rows[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, i
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r.base_failed and r.kept)
    assert quality_rules.quality_rules(frame(spark, ["a"]).limit(0)).collect() == []


def plain_rates(text):
    n, chars, symbols, dup, rep = plain_measures(text)
    n_lines = len([x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)])
    return {
        "word_size": chars * 1000 // max(n, 1), "symbol_rate": symbols * 1000 // max(chars, 1), "dup_line_rate": dup * 1000 // max(n_lines, 1), "repeat_rate": rep * 1000 // max(n, 1)
    }


def plain_fence(values, low):
    """The bounds that a list of values gives: three interquartile ranges, of the tail where the quartiles are equal, and a bucket's width at least."""
    width = lambda v: 1 << max(0, v.bit_length() - quality_rules.BUCKET_BITS)
    values = sorted(v // width(v) * width(v) for v in values)
    part = lambda vs, k: vs[-(-len(vs) * k // 4) - 1]
    q1, q3 = part(values, 1), part(values, 3)
    top, spread = q3, q3 - q1
    if q1 == q3 and (tail := [v for v in values if v > q3]):
        top, spread = part(tail, 3), part(tail, 3) - part(tail, 1)
    return q1 - max(quality_rules.FENCE * (q3 - q1), width(q1)) if low else -1, top + max(quality_rules.FENCE * spread, width(top))


def check_rules(rows, info):
    """``info``: id to row with text, lang and source."""
    rates = {i: plain_rates(r.text) for i, r in info.items()}
    failed = {i: (m := plain_measures(r.text))[0] < 20 or 100 * m[4] > 30 * m[0] for i, r in info.items()}
    groups = defaultdict(list)
    for i, r in info.items():
        if not failed[i]:
            for key in ((r.lang, r.source), (r.lang,), ()):
                groups[key].append(rates[i])
    for r in rows:
        doc = info[r.doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain_measures(doc.text)
        inside = True
        if groups[doc.lang, doc.source]:
            key = next((k for k in ((doc.lang, doc.source), (doc.lang,)) if len(groups[k]) >= quality_rules.MIN_GROUP), ())
            for name, low in quality_rules.MEASURES.items():
                least, most = plain_fence([x[name] for x in groups[key]], low)
                inside &= least <= rates[r.doc_id][name] <= most
        assert r.base_failed == failed[r.doc_id]
        assert r.kept == (inside and not r.base_failed)


def test_op3_against_plain_fences(spark, docs):
    check_rules(queries.op3(spark, SF).collect(), {r.doc_id: r for r in docs.collect()})


def test_fences_follow_their_group(spark):
    """Two sources with fences of their own: what one keeps the other rejects, repeated words below the base rule's share included."""
    rng = np.random.default_rng(3)
    vocabulary = [f"word{i:04d}" for i in range(3000)]

    def text(n_repeats, size=200):
        words = list(rng.choice(vocabulary, size))
        words[:8] = words[8:16] = vocabulary[:8]  # eight words twice: 80 of a thousand
        for k in range(n_repeats - 1):
            words[16 + 8 * k : 24 + 8 * k] = vocabulary[:8]
        return " ".join(words)

    rows = [(i, " ".join(rng.choice(vocabulary, 200)), "en", "tidy") for i in range(80)] + [(100 + i, text(1 + i % 2, 300), "en", "tidy") for i in range(10)]
    rows += [(200 + i, text(1 + i % 6), "en", "loose") for i in range(90)]
    rows += [(400, text(5), "en", "tidy"), (401, text(5), "en", "loose"), (402, text(1), "en", "rare"), (403, "x y", "en", "tidy"), (404, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in quality_rules.quality_rules(df).collect()}
    check_rules(got.values(), {r.doc_id: r for r in df.collect()})
    limits = {r.source: r for r in quality_rules.thresholds(quality_rules.sketch(quality_rules.measure(df))).collect()}
    assert limits["tidy"].repeat_rate_high < 300 and limits["tidy"].repeat_rate_high != limits["loose"].repeat_rate_high
    assert not got[400].base_failed and not got[400].kept and got[401].kept


# --- near copies -----------------------------------------------------------------------------------


def plain_sets(text):
    w = (text or "").lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def plain_links(rows):
    """Pairs (of places in ``rows``) whose similarity is at least 0.8."""
    sets = [plain_sets(t) for t in rows]
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            holders[g].append(i)
    links = defaultdict(set)
    for i, s in enumerate(sets):
        for j, n in Counter(j for g in s for j in holders[g] if j != i).items():
            if 5 * n >= 4 * (len(s) + len(sets[j]) - n):
                links[i].add(j)
    return links


def check_near(got, rows, ids):
    links = plain_links(rows)
    root = list(range(len(rows)))
    for _ in rows:
        new = [min([root[i], *(root[j] for j in links[i])]) for i in range(len(rows))]
        if new == root:
            break
        root = new
    members = defaultdict(list)
    for i, r in enumerate(root):
        members[r].append(ids[i])
    want = sorted((ids[i], min(members[root[i]]), len(links[i])) for i in range(len(rows)))
    assert sorted((r.doc_id, r.class_id, r.n_links) for r in got) == want


def words(seed, n):
    return " ".join(np.random.default_rng(seed).choice([f"w{i}" for i in range(400)], n))


def changed(text, seed, n):
    rng, w = np.random.default_rng(seed), text.split()
    for k in rng.choice(len(w), n, replace=False):
        w[k] = f"z{seed}x{k}"
    return " ".join(w)


def near_cases():
    base, other = words(1, 200), words(2, 300)
    return [
        None, "", "  ", "one", "One", "one two", "a b c d e", base, base.upper(), base + " end", *(changed(base, s, 1 + s % 4) for s in range(30)), other, other, changed(other, 50, 3),
        changed(other, 51, 40), words(3, 6000), changed(words(3, 6000), 4, 20), "same " * 500, "same " * 300,
    ]


def test_near_join_odd_rows(spark):
    rows = near_cases()
    check_near(near_join.near_join(frame(spark, rows)).collect(), rows, list(range(len(rows))))
    assert near_join.near_join(frame(spark, ["a"]).limit(0)).collect() == []


def test_near_join_over_tiles(spark, monkeypatch):
    monkeypatch.setattr(near_join, "CHUNK_GRAMS", 900)
    rows = near_cases()
    check_near(near_join.near_join(frame(spark, rows)).collect(), rows, list(range(len(rows))))


def test_near_join_repeated_keys(spark):
    rows = [words(5, 90), words(5, 90), words(6, 90)]
    got = near_join.near_join(frame(spark, rows, ids=[4, 4, 9])).collect()
    assert sorted((r.doc_id, r.class_id, r.n_copies, r.n_links) for r in got) == [(4, 4, 2, 1), (4, 4, 2, 1), (9, 9, 1, 0)]


def test_bands_reach_the_recall():
    bands, rows = near_join.choose_bands(0.8)
    assert 1 - (1 - 0.8**rows) ** bands >= near_join.RECALL and bands * rows <= near_join.MAX_HASHES


def test_op5(spark, texts):
    ids = sorted(texts)
    check_near(queries.op5(spark, SF).collect(), [texts[i] for i in ids], ids)


def test_components(spark):
    rng = np.random.default_rng(0)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(1000 + i, 1001 + i) for i in range(40)] + [(2000, 2000 + i) for i in range(1, 60)]
    root = {x: x for e in edges for x in e}
    for _ in range(60):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = components.connected_components(spark.createDataFrame([*edges, (None, 5)], "a long, b long")).collect()
    assert {r.node: r.root for r in got} == {x: r for x, r in root.items() if any(x in e and e[0] != e[1] for e in edges)}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


# --- licences --------------------------------------------------------------------------------------


def plain_license(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = [(i, label) for i in range(len(w)) for phrase, label in license_scan.PHRASES.items() if w[i : i + len(phrase.split())] == phrase.split()]
    return len(w), [p for p, _ in places], sorted({label for _, label in places})


def test_licenses(spark):
    mit, gpl = license_scan.TEMPLATES["mit"][1], license_scan.TEMPLATES["gpl"][1]
    broken = mit.replace("free of charge, ", "free, quite free, of any charge, ").replace("without restriction, ", "")
    rows = [
        None, "", "MIT License mit license. The Apache-License", "General Public License, mit\xa0license MIT\x1flicense", "x " * 50 + mit + " y" * 20, "x " * 9 + broken,
        gpl + "\n" + mit, "free of charge to any person", "Licensed under CC BY-NC 4.0.", "mit", license_scan.TEMPLATES["bsd"][0].upper(), "license " * 3000,
    ]
    got = {r.doc_id: r for r in license_scan.scan(frame(spark, rows)).collect()}
    for i, text in enumerate(rows):
        n, places, labels = plain_license(text)
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base) == (n, len(places), min(places, default=None), max(places, default=None), labels), i
        assert set(labels) <= set(r.labels) and 0 <= r.score <= 1
    assert got[4].labels == ["mit"] and [(s.start, s.stop) for s in got[4].spans] == [(50, 50 + len(license_scan.words_of(mit)))]
    assert got[5].labels == ["mit"] and got[6].labels == ["gpl", "mit"] and got[7].labels == [] and got[8].labels == ["cc-by-nc"] and got[10].labels == ["bsd"]
    assert license_scan.scan(frame(spark, ["a"]).limit(0)).collect() == []
    twice = license_scan.scan(frame(spark, [mit, mit], ids=[1, 1])).collect()
    assert [(r.labels, len(r.spans), r.score) for r in twice] == [(["mit"], 1, 1.0)] * 2


def plain_spans_of_template(text, body):
    """The diagonals that vote, merged, by brute force."""
    k, w, t = license_scan.GRAM, license_scan.words_of(text), license_scan.words_of(body)
    lines = defaultdict(set)
    for i in range(len(w) - k + 1):
        for j in range(len(t) - k + 1):
            if w[i : i + k] == t[j : j + k]:
                lines[i - j].add(j)
    clusters, last = [], None
    for d in sorted(lines):
        if last is None or d - last > max(license_scan.DIAGONAL_GAP, license_scan.GAP_PART * len(t)):
            clusters.append((set(), set()))
        clusters[-1][0].update(j + x for j in lines[d] for x in range(k))
        clusters[-1][1].update(j + d + x for j in lines[d] for x in range(k))
        last = d
    return [(min(a), max(a) + 1, len(c) / len(t)) for c, a in clusters if len(c) >= max(license_scan.MIN_TEMPLATE * len(t), min(len(t), license_scan.MIN_MATCH)) and len(a) / (max(a) + 1 - min(a)) >= license_scan.MIN_SPAN]


def test_op6(spark, docs, texts):
    want = {}
    for i, text in texts.items():
        want[i] = sorted((a, b, label) for label, bodies in license_scan.TEMPLATES.items() for body in bodies for a, b, _ in plain_spans_of_template(text, body)) if "icense" in text.lower() else []
    got = {r.doc_id: r for r in license_scan.scan(docs).collect()}
    rows = {r.doc_id: r for r in queries.op6(spark, SF).collect()}
    assert rows.keys() == got.keys() == texts.keys()
    for i, text in texts.items():
        n, places, labels = plain_license(text)
        r = rows[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (n, len(places), min(places, default=None), max(places, default=None), ",".join(labels))
        assert sorted((s.start, s.stop, s.label) for s in got[i].spans or []) == want[i]
        assert r.labels == ",".join(sorted({*labels, *(x[2] for x in want[i])}))


# --- quality ---------------------------------------------------------------------------------------


@pytest.mark.parametrize("tokens", [1, 2, 3, 5, 7, 200_000])
def test_context_sums(spark, monkeypatch, tokens):
    monkeypatch.setattr(quality_classifier, "SLICE_TOKENS", tokens)
    rows = ["the cat sat on the mat", None, "THE end.", "a" * 300, "the"]
    got = {r.bucket: np.array(r[1:]) for r in quality_classifier.context_sums(frame(spark, rows)).collect()}
    index, want = quality_classifier.index_vectors(), defaultdict(lambda: np.zeros(quality_classifier.DIM, np.int64))
    for t in rows:
        ids = quality_classifier.Tokens().of(t or "").tolist()
        for i, b in enumerate(ids):
            want[b] += sum((index[ids[j]] for j in range(max(0, i - 2), min(len(ids), i + 3)) if j != i), np.zeros(quality_classifier.DIM, np.int64))
    assert got.keys() == want.keys()
    assert all((got[b] == want[b]).all() for b in want)


def test_scores_of_odd_rows(spark):
    rows = [None, "", "good words here", "### $$$ ***", "x" * 10000]
    labels = spark.createDataFrame([(i, i % 2) for i in range(5)] + [(None, 1), (3, None)], "doc_id long, quality int")
    got = quality_classifier.quality_scores(frame(spark, rows), labels).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert {r.doc_id: r.held_out for r in got} == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in range(5)}
    empty = quality_classifier.quality_scores(frame(spark, rows).limit(0), labels)
    assert empty.collect() == []
    assert {r.score for r in quality_classifier.quality_scores(frame(spark, rows), labels.limit(0)).collect()} == {0.5}


def test_op9_on_held_out_rows(spark):
    sf = SF.replace("0.001", "0.01")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = queries.op9(spark, sf).filter("held_out").join(labels, "doc_id").collect()
    y, score = np.array([r.quality for r in rows]), np.array([r.score for r in rows])
    order = score.argsort().argsort()
    auc = (order[y == 1].mean() - (y.sum() - 1) / 2) / (y == 0).sum()
    assert auc > 0.9, auc
    assert np.mean([r.predicted for r in rows if r.quality == 1]) > 0.95


def test_whole_licences_and_names(spark):
    """Sections alone, names without and with versions, and a section that ten words were put into."""
    mit, bsd = license_scan.SECTIONS["mit"], license_scan.SECTIONS["bsd"]
    permission = mit[1].split()
    widened = " ".join([*permission[:30], *(f"added{i}" for i in range(10)), *permission[30:]])
    rows = [
        "Licensed under CC BY-NC 3.0.", "CC BY-SA 4.0", "Mozilla Public License 2.0", "before " * 40 + mit[3] + " after" * 40, bsd[1], widened,
        "the GNU Lesser General Public License", "Apache License, Version 2.0", "released under the mozilla public license", "Creative Commons Attribution-ShareAlike 2.5",
        " ".join(bsd), "cc by", "a public license of ours", "in no event shall the authors be there",
    ]
    got = {r.doc_id: r for r in license_scan.scan(frame(spark, rows)).collect()}
    assert [got[i].labels for i in range(len(rows))] == [
        ["cc-by-nc"], ["cc-by-sa"], ["mpl"], ["mit"], ["bsd"], ["mit"], ["gpl", "lgpl"], ["apache"], ["mpl"], ["cc-by-sa"], ["bsd"], [], [], [],
    ]
    assert [(s.start, s.stop) for s in got[3].spans] == [(40, 40 + len(license_scan.words_of(mit[3])))]
    assert (got[5].spans[0].start, got[5].spans[0].stop) == (0, len(license_scan.words_of(widened)))
    # the section on source code is also found, in part, in that on binary forms
    assert len(license_scan.TEMPLATES) > 15 and sum(s.coverage == 1 for s in got[10].spans) == 5
