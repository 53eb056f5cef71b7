"""Every registered query against its SQL, on whole tables."""

import oracle
import pytest

import __spark_entry__ as entry_point

QUERIES, ORACLES = entry_point.queries(), entry_point.oracle_sql()


@pytest.fixture(scope="module")
def duck(request):
    return oracle.connect("/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, duck, sf, name):
    assert oracle.compare(duck, ORACLES[name], QUERIES[name](spark, sf)) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_entry(spark):
    assert entry_point.entry(spark).columns == ["p_brand", "net", "lines"]


def test_every_sql_has_its_query():
    assert set(ORACLES) <= set(QUERIES)
