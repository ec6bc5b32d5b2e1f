"""Every registered query of the library itself against its SQL."""

import pytest

from clipfeat.queries import registered

from .oracle import rows_of, sql_rows

QUERIES, ORACLES = registered()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, name):
    got = rows_of(QUERIES[name](spark, sf_dir).toPandas())
    if name not in ORACLES:
        assert got[1]
        return
    want = sql_rows(ORACLES[name], sf_dir)
    assert got[0] == want[0]
    assert got[1] == want[1]


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 1
    assert set(e.oracle_sql()) <= set(e.queries())
