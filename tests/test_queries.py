"""Every registered query against its SQL statement, on small key ranges."""

import pytest
from conftest import SF
from harness import difference, duck, duck_rows, spark_rows

from corpusloom import plans


@pytest.fixture(scope="module")
def con():
    return duck(SF)


#: queries that SQL is too slow for, compared with plain models in other tests
WITHOUT_SQL = {"vocab_train": "test_bpe.py", "vocab_encode": "test_bpe.py", "vocab_compression": "test_bpe.py"}


@pytest.mark.parametrize("name", sorted(set(plans.QUERIES) - set(WITHOUT_SQL)))
def test_query(spark, con, small_buckets, name):
    df = plans.QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    got = spark_rows(df)
    assert name in plans.ORACLE
    assert difference(got, duck_rows(con, plans.ORACLE[name])) is None


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
