"""Every registered query against its DuckDB statement (sf0.001)."""

import pytest

import __spark_entry__ as E
from compare import assert_same
from conftest import SF_SMALL

ORACLE = E.oracle_sql()
QUERIES = E.queries()


def test_every_query_of_the_library_has_an_oracle():
    from pomelo.plans.queries import QUERIES as OWN
    assert sorted(set(OWN) - set(ORACLE)) == []


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck_small, name):
    assert_same(QUERIES[name](spark, SF_SMALL), duck_small, ORACLE[name])


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["entity_id", "feature"]
    assert df.count() > 0
