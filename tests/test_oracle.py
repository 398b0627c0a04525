"""Every registered query against its SQL twin, whole results."""

import pytest

import __spark_entry__ as contract
from checks.compare import difference, duck
from checks.oracle import ORACLE
from checks.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    df = contract.queries()[name](spark, SF)
    relation = con.sql(contract.oracle_sql()[name])
    widths = {"BIGINT": "bigint", "VARCHAR": "string", "DOUBLE": "double"}
    sql_types = {c: widths[str(t)] for c, t in zip(relation.columns, relation.types)}
    assert dict(df.dtypes) == sql_types
    assert difference(df, relation) is None


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert [r["session_count"] for r in rows] == [189]
