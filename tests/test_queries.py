"""Every registered query against its SQL, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from conftest import plan
from shoplens.plans import catalog, oracle

TABLES = "/root/testdata/sf0.001"
NAMES = ["nation", "customer", "part", "orders", "events"]

pytestmark = pytest.mark.skipif(not os.path.isdir(TABLES), reason="driver tables not present")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in NAMES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{TABLES}/{name}.parquet'")
    return connection


def as_sorted(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in data), key=repr)


# What DuckDB calls the types of Spark.
KINDS = {
    "bigint": {"BIGINT", "HUGEINT", "INTEGER"},
    "double": {"DOUBLE"},
    "string": {"VARCHAR"},
    "boolean": {"BOOLEAN"},
    "timestamp_ntz": {"TIMESTAMP"},
}


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_equals_sql(spark, database, name):
    found = catalog.queries()[name](spark, TABLES)
    result = database.execute(oracle.oracle_sql()[name])
    columns = [column[0] for column in result.description]
    assert sorted(found.columns) == sorted(columns)
    kinds = {column[0]: str(column[1]) for column in result.description}
    assert {c: kinds[c] in KINDS[kind] for c, kind in found.dtypes} == dict.fromkeys(columns, True)
    assert as_sorted(found.columns, found.collect()) == as_sorted(columns, result.fetchall())


def test_every_query_has_its_sql():
    assert set(catalog.queries()) == set(oracle.oracle_sql())


def test_all_queries_are_registered():
    assert set(catalog.queries()) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_flagship_query(spark):
    result = contract.entry(spark)
    assert result.dtypes == [("hour", "bigint"), ("count", "bigint")]
    assert result.count() == 24


JOINED = {
    "customers_in_country",
    "enterprise_upper",
    "null_counts_customers",
    "people_avg_salary",
    "people_over_30",
    "top_countries",
    "top_credit_country",
}
SCANS = {"row_counts": 3, "ecommerce_summary": 3}


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_plan_reads_each_table_once(spark, name):
    text = plan(catalog.queries()[name](spark, TABLES))
    assert ("Join" in text) == (name in JOINED)
    assert text.count("FileScan") == SCANS.get(name, 2 if name in JOINED else 1)
    assert ("Expand" in text) == (name == "log_summary")


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_plan_suits_large_tables(spark, name):
    text = plan(catalog.queries()[name](spark, TABLES))
    for operator in ("Python", "CartesianProduct", "NestedLoopJoin", "SortAggregate"):
        assert operator not in text
    assert "collect_" not in text
    # Whatever a grouping sends over the network was added up per task before.
    steps = [line for line in text.splitlines() if "Project [" not in line]
    for step, below in zip(steps, steps[1:]):
        assert "Exchange hashpartitioning" not in step or "HashAggregate" in below
