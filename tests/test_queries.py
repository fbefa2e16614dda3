"""Every registered query gives the rows of its SQL on the smallest scale, by a plan without pairing or Python."""

from __future__ import annotations

import pytest

from stratalake.plans import registry
from verify import check, connect

FOLDER = "/root/testdata/sf0.001"
registry.load_all()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_matches_sql(spark, duck, name):
    status, detail, _ = check(spark, duck, FOLDER, name)
    assert status == ("ok" if name in registry.SQL else "rows"), detail


def test_entry_point(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
