import os

import pytest

from oracle_check import compare, duck, tables_at
from tillroll.oracle import ORACLE
from tillroll.queries import QUERIES

SF_DIR = tables_at("0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()


@pytest.mark.parametrize("key", QUERIES)
def test_same_result(spark, con, key):
    assert compare(spark, con, key, QUERIES[key], ORACLE[key], SF_DIR) is None


def test_known_totals(spark):
    rows = QUERIES["segment_summary"](spark, SF_DIR).collect()
    assert {r.segment: r.customers for r in rows} == {
        "Champions": 6,
        "Loyal": 37,
        "New Customers": 10,
        "Lost": 16,
        "At Risk": 17,
        "Other": 41,
    }
    assert QUERIES["clean_orders"](spark, SF_DIR).count() == 2489


def test_entry(spark):
    import __spark_entry__ as driver

    assert driver.entry(spark).count() == 127
    assert QUERIES.keys() <= driver.queries().keys()
    assert driver.oracle_sql().keys() <= driver.queries().keys()
