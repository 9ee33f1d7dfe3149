import pytest

import __spark_entry__ as entry
import check
from linkloom.registry import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    assert check.compare(spark, con, name, SF_DIR) is None


# SQL cannot fit weights; test_learnt.py has a dense solver instead.
NO_TWIN = {"lid_learnt"}


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES) | NO_TWIN and not NO_TWIN & set(ORACLES)


def test_all_are_offered():
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
