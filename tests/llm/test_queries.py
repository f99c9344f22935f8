"""The registered queries of the subpackage against their SQL."""

from __future__ import annotations

import pytest

from __spark_entry__ import oracle_sql, queries
from check_oracle import differences, oracle_connection
from tests.test_catalogue import SF_DIR
from tierflow.llm.oracle import LLM_ORACLE
from tierflow.llm.queries import LLM_QUERIES


@pytest.mark.parametrize("name", list(LLM_ORACLE))
def test_query_equals_its_sql(spark, name):
    found = queries()[name](spark, SF_DIR).toPandas()
    want = oracle_connection(SF_DIR).execute(oracle_sql()[name]).df()
    assert (differences(found, want) or "equal").startswith("equal")


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in LLM_QUERIES) == list(range(1, 14))
    assert set(LLM_QUERIES) | {"pipeline"} <= set(queries())
