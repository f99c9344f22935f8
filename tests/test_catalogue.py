"""Every registered query against its SQL in a second engine."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry
from catalogue.oracle import ORACLE
from catalogue.registered import QUERIES
from check_oracle import differences, oracle_connection
from tests.conftest import plan_of

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, oracle, name):
    frame = QUERIES[name](spark, SF_DIR)
    assert "Python" not in plan_of(frame)
    found = differences(frame.toPandas(), oracle.execute(ORACLE[name]).df())
    assert found is None or found.startswith("equal"), found


def test_entry_has_a_stable_schema(spark):
    assert entry(spark).schema == entry(spark).schema
