"""Every registered query against its oracle on the small tables."""

import pytest

import gleaner.catalog.all  # noqa: F401
from gleaner.catalog.check import compare, oracle_connection
from gleaner.catalog.registry import ORACLES, QUERIES

from conftest import SMALL

# A case that the small tables do not contain; the larger ones do.
MAY_BE_EMPTY = {"select_more_batches", "fetch_plan"}


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    fault = compare(spark, con, SMALL, name)
    assert fault == "" or (fault == "both empty" and name in MAY_BE_EMPTY)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
