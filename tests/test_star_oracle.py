"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as entry
from oracle_harness import compare, duckdb_con

from registrar.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duckdb_con(SF)


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, SF)
    assert r["status"] == "match", r


def test_every_query_has_oracle():
    missing = set(registry.QUERIES) - set(registry.ORACLE)
    assert not missing


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["o_orderkey", "o_custkey", "start_date", "end_date", "reason"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_output_types_are_portable(spark, con, name):
    df = entry.queries()[name](spark, SF)
    assert all(t in ("bigint", "double", "string", "boolean") for _, t in df.dtypes), df.dtypes
    sql = entry.oracle_sql()[name]
    kinds = {r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    assert kinds <= {"BIGINT", "DOUBLE", "VARCHAR", "BOOLEAN"}, kinds
