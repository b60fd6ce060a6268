"""URL filters and exact search against plain models, and the pipeline against its stages' rules."""

import math
import re

import numpy as np
import pytest
from conftest import SF

import corpus_pipeline
from corpusloom.llm import queries, topk_search, url_filters


def plain_rules(url):
    m = re.match(r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)([^?#]*)", url or "")
    if not m:
        return set()
    host = re.sub(r":[0-9]*$", "", re.sub(r"^.*@", "", m[1])).lower()
    labels, parts = [x for x in host.split(".") if x], [x for x in m[2].split("/") if x]
    out = {("domain", ".".join(labels[-k:])) for k in range(min(2, len(labels)) or 1, len(labels) + 1)}
    if host:
        out |= {("prefix", "/".join([host, *parts[:k]])) for k in range(1, len(parts) + 1)}
    return out


def plain_active(entries, day):
    """Rules active on a day: the last entry up to it, additions first."""
    last = {}
    for name, kind, rule, added, on in entries:
        if None not in (name, kind, rule, added, on) and on <= day:
            key, value = (name, kind, rule), (on, added)
            last[key] = max(last.get(key, value), value)
    return {key for key, (_, added) in last.items() if added}


ENTRIES = [
    ("bad", "domain", "example.com", True, 10), ("bad", "domain", "example.com", False, 20), ("bad", "domain", "example.com", True, 70), ("bad", "domain", "example.com", True, 75),
    ("bad", "prefix", "a.example.com/x", True, 5), ("worse", "domain", "a.example.com", False, 1), ("worse", "domain", "a.example.com", True, 300), ("bad", "domain", "same.org", True, 8),
    ("bad", "domain", "same.org", False, 8), (None, "domain", "example.com", True, 1), ("bad", "domain", None, True, 1), ("bad", "prefix", "localhost/p/q", True, 33),
]
URLS = [None, "", "no url", "http://a.example.com/x/y?q#f", "HTTPS://User@A.Example.COM:80/x/", "http://example.com", "http://notexample.com/x", "ftp://same.org/z", "http://localhost/p/q/r", "http://.././"]


def test_filters(spark):
    captures = [(i * 1000 + d, u, d, "rule", "x") for i, u in enumerate(URLS) for d in (0, 9, 10, 19, 20, 33, 70, 74, 80, 299, 300, 400)] + [(99999, URLS[3], None, "rule", "x")]
    df = spark.createDataFrame(captures, "page_id long, url string, day int, kind string, since string")
    lists = spark.createDataFrame(ENTRIES, "list string, kind string, rule string, added boolean, day int")
    got = {r.page_id: r for r in url_filters.filter_urls(df, lists).collect()}
    assert len(got) == len(captures)
    for page, url, day, *_ in captures:
        active = {x for x in plain_active(ENTRIES, day) if x[1:] in plain_rules(url)} if day is not None else set()
        assert (got[page].n_active, got[page].lists, got[page].blocked) == (len(active), ",".join(sorted({x[0] for x in active})), bool(active)), (url, day)
    assert url_filters.filter_urls(df.limit(0), lists).collect() == []
    assert not any(r.blocked for r in url_filters.filter_urls(df, lists.limit(0)).collect())


def test_op1(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    entries = [(r.list, r.kind, r.rule, r.added, r.day) for r in queries.list_entries(pages.select("page_id", "url")).collect()]
    urls = {r.page_id: r.url for r in pages.collect()}
    rows = queries.op1(spark, SF).collect()
    assert len(rows) == len(urls) and any(r.blocked for r in rows)
    for r in rows:
        active = {x for x in plain_active(entries, r.day) if x[1:] in plain_rules(urls[r.page_id])}
        assert (r.n_active, r.lists, r.blocked) == (len(active), ",".join(sorted({x[0] for x in active})), bool(active))


def test_op1_runs_no_python(spark):
    plan = queries.op1(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def plain_top(vectors, k, scale=1024):
    good = {}
    for i, v in vectors:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            good.setdefault(i, []).append(np.array([math.floor(scale * x) for x in v], np.int64))
    out = []
    for q in good:
        if q % 100 == 0:
            x = min(good[q], key=list)
            found = sorted((-int(x @ y), i) for i, ys in good.items() if i != q for y in ys if len(y) == len(x))
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found[:k])]
    return sorted(out)


def test_top_k_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=4).astype(np.float32)]) for i in range(1, 60)] + [(100, [0.5, 0.5, -0.25, 1.0]), (200, [0.5, 0.5, -0.25, 1.0]), (300, [0.0] * 4)]
    rows += [(400, None), (500, [nan, 0.0, 0.0, 0.0]), (600, [1.0, None, 0.0, 0.0]), (700, [inf, 0.0, 0.0, 0.0]), (None, [1.0] * 4), (800, [1.0, 2.0]), (801, [2.0, 1.0]), (900, [0.5, 0.5, -0.25, 1.0])]
    rows += [(1000, [1.0, -2.0, 0.5, 0.0]), (1000, [1.0, -2.5, 3.0, 0.0]), (1000, [1.0, -2.0, 0.0, 9.0])]  # one id, several vectors
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, rank int, dim string")
    from pyspark.sql import functions as F

    got = topk_search.top_k(df, F.col("vec_id") % 100 == 0, 5)
    assert sorted(tuple(r) for r in got.collect()) == plain_top([(i, v and [x if x is None else float(np.float32(x)) for x in v]) for i, v in rows], 5)
    assert topk_search.top_k(df.limit(0), F.col("vec_id") % 100 == 0, 5).collect() == []


def test_top_k_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "QUERY_BLOCK", 2)
    monkeypatch.setattr(topk_search, "BATCH", 50)
    test_op7(spark)


def test_op7(spark):
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = queries.op7(spark, SF).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == plain_top(rows, 10)


def test_elimination_leaves_candidates_out():
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.integers(-10, 10, (4000, 8)), rng.integers(900, 1000, (50, 8))])
    ids, pivots = np.arange(len(x)), x[-30:-6]
    best = topk_search.Best(np.array([4040]), x[4040:4041], pivots, 5)
    for at in range(len(x) - 50, -1, -500):
        part = slice(at, at + 500) if at < 4000 else slice(4000, 4050)
        best.offer(ids[part], x[part], topk_search.distances(x[part], pivots))
    assert best.evaluated < len(x) / 4


def test_pivots_and_first_limits_on_clusters():
    """Twenty clusters: the pivots reach all of them, the first limits hold, and under half of the candidates are evaluated."""
    rng = np.random.default_rng(6)
    centres = rng.integers(-1000, 1000, (20, 16))
    x = centres[rng.integers(0, 20, 6000)] + rng.integers(-20, 21, (6000, 16))
    ids = np.arange(len(x))
    pivots = topk_search.far_apart(x[:1000], 48)
    nearest = topk_search.distances(pivots, centres).argmin(axis=1)
    assert len(pivots) == 48 and len(set(nearest.tolist())) == 20
    assert len(topk_search.far_apart(np.array([[1, 2], [1, 2], [3, 4]]), 5)) == 2 and len(topk_search.far_apart(x[:0], 5)) == 0
    asked = ids[::100]
    limits = topk_search.first_limits(asked, x[asked], ids[:1000], x[:1000], 10)
    assert np.isneginf(topk_search.first_limits(asked, x[asked], ids[:5], x[:5], 10)).all()
    best = topk_search.Best(asked, x[asked], pivots, 10, limits)
    for at in range(0, len(x), 1500):
        part = slice(at, at + 1500)
        best.offer(ids[part], x[part], topk_search.distances(x[part], pivots))
    for query, limit, found in zip(asked, limits, best.found):
        want = sorted((-s, i) for i, s in enumerate((x @ x[query]).tolist()) if i != query)[:10]
        assert found == want and limit <= -want[-1][0]
    assert best.evaluated < 0.5 * len(asked) * len(x)


@pytest.fixture(scope="module")
def stages(spark):
    docs = queries.table(spark, SF, "documents")
    out = [docs.collect()]
    from corpusloom.session import materialize

    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), name)
        out.append(docs.collect())
        if name != "bestfit_packing":
            assert docs.columns == corpus_pipeline.COLUMNS
    return out


def test_pipeline_stages(spark, stages):
    first, quality, rules, near, repeats, packed = stages
    scores = {r.doc_id: r.predicted for r in queries.op9(spark, SF).collect()}
    assert {r.doc_id for r in quality} == {i for i, p in scores.items() if p == 1}
    texts = {r.doc_id: r.text for r in first}
    assert all(texts[r.doc_id] == r.text for r in near)
    assert len(packed) and {r.doc_id for r in packed} == {r.doc_id for r in repeats} == {r.doc_id for r in near}
    assert {r.doc_id for r in near} <= {r.doc_id for r in rules} <= {r.doc_id for r in quality}
    assert all(r.n_chars == len(r.text) <= len(texts[r.doc_id]) for r in repeats)


def test_pipeline_run(spark, stages):
    assert corpus_pipeline.run(spark, SF).count() == len(stages[-1])
