"""Every registered query with an SQL twin gives the twin's rows; the others give rows."""

from __future__ import annotations

import os

import pytest
from twins import compare, connect

from demandspark.catalog import QUERIES, SQL_TWINS

SF_DIR = os.environ.get("TWIN_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(SQL_TWINS))
def test_twin(spark, con, name):
    # Results have six or more decimals; a tie may round apart by one in the last place.
    _, problems = compare(QUERIES[name](spark, SF_DIR), SQL_TWINS[name], con, tolerance=1.1e-6)
    assert not problems


def test_every_twin_has_a_query():
    assert set(SQL_TWINS) <= set(QUERIES)
