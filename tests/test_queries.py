"""Every registered query of the library against its SQL in DuckDB."""

import pytest

from ledgerloom.plans.files import QUERIES, SQL

from .conftest import DATA, rows_of

SCALE = "sf0.001"
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no shared tables here")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    found = QUERIES[name](spark, f"{DATA}/{SCALE}")
    rows = found.collect()
    assert name in SQL, "every query has its SQL"
    want = duck(SCALE).sql(SQL[name])
    assert sorted(found.columns) == sorted(want.columns)
    assert rows_of(found.columns, rows) == rows_of(want.columns, want.fetchall())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(SQL) <= set(__spark_entry__.queries())
