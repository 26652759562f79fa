"""Every registered query of the core against its SQL on the smallest tables."""

import pytest

from lodeweave.plans import registry

QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(name, agree, spark, sf_dir):
    if name in SQL:
        agree(QUERIES[name], SQL[name])
    else:
        assert QUERIES[name](spark, sf_dir).count() >= 0


def test_names_are_the_same_on_both_sides():
    assert set(SQL) <= set(QUERIES)


def test_flagship(spark, sf_dir):
    assert registry.flagship(spark, sf_dir).count() > 0
