"""The operator queries that SQL can state, against it."""

import pytest
from conftest import SF
from harness import difference, duck, duck_rows, spark_rows

import corpus_pipeline
from corpusloom.llm import queries


@pytest.mark.parametrize("sf", [SF, SF.replace("0.001", "0.01")])
@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query(spark, sf, name):
    assert difference(spark_rows(queries.QUERIES[name](spark, sf)), duck_rows(duck(sf), queries.ORACLE[name])) is None


def test_names():
    import __spark_entry__ as entry

    found = entry.queries()
    assert {n for n in found if n.startswith("op")} == {n for n in queries.QUERIES} and "pipeline" in found
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(entry.oracle_sql()) <= set(found)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "quality_rules", "near_join", "suffix_dedup", "bestfit_packing"]
