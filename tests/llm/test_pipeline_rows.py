"""The pipeline's decisions on rows without an id and on different texts that share one."""

import numpy as np
import pytest
from conftest import SF

import corpus_pipeline
from corpusloom.llm import queries


def words(seed, n):
    return " ".join(np.random.default_rng(seed).choice([f"word{i}" for i in range(400)], n))


def changed(text, place):
    w = text.split()
    return " ".join([*w[:place], "other", *w[place + 1 :]])


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")


def kept(docs):
    assert docs.columns == corpus_pipeline.COLUMNS
    return sorted(((r.doc_id, r.text) for r in docs.collect()), key=str)


def test_rules_judge_rows(spark):
    one, two, three = words(1, 90), words(2, 90), words(3, 90)
    good = [(None, one), (7, two), (8, three), (8, three)]
    bad = [(None, "too short"), (None, None), (7, "too short too"), (7, "same words again and again " * 30), (9, "")]
    assert kept(corpus_pipeline.keep_rules(spark, table(spark, good + bad), SF)) == sorted(good, key=str)


def test_near_copies_are_rows(spark):
    a, b, c, d, e = (words(s, 120) for s in range(10, 15))
    rows = [
        (5, a), (5, b),  # different texts under one id both stay
        (9, changed(a, 60)), (4, changed(b, 60)),  # near copies of them: the least id stays
        (None, c), (6, changed(c, 50)), (None, d), (None, changed(d, 50)), (None, d), (1, e), (1, e), (None, None), (3, ""),
    ]
    got = kept(corpus_pipeline.keep_one_of_near_copies(spark, table(spark, rows), SF))
    without = [t for i, t in got if i is None]
    assert len(without) == 2 and None in without and {*without} - {None} <= {d, changed(d, 50)}
    assert [x for x in got if x[0] is not None] == sorted([(5, a), (4, changed(b, 60)), (6, changed(c, 50)), (1, e), (3, "")], key=str)


def test_classifier_judges_rows(spark):
    """Rows held out take no part in learning, so other ids that are held out too leave all predictions as they are."""
    docs = queries.table(spark, SF, "documents").collect()
    scores = {r.doc_id: r for r in queries.op9(spark, SF).collect()}
    apart = lambda predicted: sorted(i for i, r in scores.items() if r.held_out and r.predicted == predicted)
    good, bad = apart(1), apart(0)
    if len(good) < 3 or not bad:
        pytest.skip("too few rows held out")
    new = {good[0]: None, bad[-1]: good[1], good[2]: bad[0] if len(bad) > 1 else good[2]}
    rows = [(new.get(r.doc_id, r.doc_id), r.text, r.lang, r.source, r.n_chars) for r in docs]
    got = kept(corpus_pipeline.keep_quality(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), SF))
    assert got == sorted(((new.get(r.doc_id, r.doc_id), r.text) for r in docs if scores[r.doc_id].predicted == 1), key=str)


def short_words(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(list("abcdefgh"), rng.integers(2, 6))) for _ in range(n))


def test_repeated_passages_go(spark):
    """A passage of 55 short words in unlike documents, and one that starts and ends inside longer words."""
    passage, other = short_words(30, 55), short_words(31, 60)
    assert corpus_pipeline.REPEAT < len(passage) < 400
    alone = [short_words(40 + i, 120) for i in range(6)]
    rows = [
        (1, f"{alone[0]} {passage} {alone[1]}"), (2, f"{alone[2]} {passage}"), (3, alone[3]), (None, f"{other} {alone[4]}"), (4, f"{alone[5]} {other}"),
        (5, other), (6, None), (7, ""), (8, short_words(50, 30)), (9, short_words(50, 30)),
    ]
    got = dict(kept(corpus_pipeline.remove_repeats(spark, table(spark, rows), SF)))
    assert set(got) == {i for i, _ in rows}
    assert not any(p[k : k + 150] in got[i] for i in (1, 2, None, 4) for p in (passage, other) for k in range(0, len(p) - 150, 10))
    assert got[5] == "" and got[6] == "" and got[7] == ""
    assert got[3] == alone[3] and all(a[1:-1] in got[i] for a, i in zip(alone[4:], (None, 4)))
    assert alone[0][:-1] in got[1] and alone[1][1:] in got[1] and alone[2][:-1] in got[2]
    assert got[8] == got[9] == short_words(50, 30)  # 30 words are no passage
    for r in corpus_pipeline.remove_repeats(spark, table(spark, rows), SF).collect():
        assert r.n_chars == len(r.text)


def test_stages_without_rows_and_with_extra_columns(spark):
    docs = queries.table(spark, SF, "documents")
    odd = docs.selectExpr("*", "doc_id AS row", "text AS h", "lang AS kept", "1 AS k", "2 AS tag", "3 AS n_bytes")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).collect() == [], name
    few = odd.filter("doc_id < 60")
    for name, stage in corpus_pipeline.STAGES[1:4]:
        assert kept(stage(spark, few, SF)) == kept(stage(spark, few.select(*corpus_pipeline.COLUMNS), SF)), name
