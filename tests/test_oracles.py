"""Every registered query against its SQL in a second engine."""

import compare
import pytest

from tallyriver.plans.catalogue import QUERIES
from tallyriver.plans.oracles import ORACLES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return compare.duck(sf_dir)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, sf_dir, duck):
    mine = compare.spark_rows(QUERIES[name](spark, sf_dir))
    if name in ORACLES:
        assert compare.difference(mine, compare.duck_rows(duck, ORACLES[name])) is None
    else:
        assert mine[1]


def test_entry(spark):
    import __spark_entry__ as driver

    assert driver.entry(spark).columns[:3] == ["event_id", "timestamp", "user_id"]
    assert set(QUERIES) <= set(driver.queries())
    assert set(ORACLES) <= set(driver.oracle_sql()) <= set(driver.queries())
