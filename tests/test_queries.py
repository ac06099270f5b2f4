"""Every registered query of the engine against its SQL, and the entry points."""

import pytest

from sparktel.plans import queries as Q

from conftest import SF, same_rows


@pytest.mark.parametrize("name", sorted(Q.queries()))
def test_query(name, spark, duck):
    df = Q.queries()[name](spark, SF)
    if name in Q.oracle_sql():
        same_rows(df, duck, Q.oracle_sql()[name])
    else:
        assert df.count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries()) and set(Q.queries()) <= set(e.queries())
