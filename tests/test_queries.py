"""Every query of the library against its SQL twin, or at least that it runs."""

from __future__ import annotations

import pytest

from corpusloom import catalog

from .oracle import connect, rows_of, rows_of_sql


@pytest.fixture(scope="module")
def duck(data):
    return connect(data)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, data, duck, name):
    got = rows_of(catalog.QUERIES[name](spark, data))
    if name in catalog.ORACLE_SQL:
        assert got == rows_of_sql(duck, catalog.ORACLE_SQL[name])
    else:
        assert got[1]


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
