"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as contract
from check import TABLES, canonical
from cutgrid.plans.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '/root/testdata/sf0.001/{table}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, oracle, name):
    ours = canonical(contract.queries()[name](spark, sf_dir).toPandas())
    theirs = canonical(oracle.execute(contract.oracle_sql()[name]).df())
    pd.testing.assert_frame_equal(ours, theirs, check_exact=True, check_dtype=False)


def test_entry(spark):
    assert contract.entry(spark).columns == ["libid", "chrom", "site", "pre_n", "counts"]
