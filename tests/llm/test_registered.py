"""The registered queries: their SQL, their names, and the pipeline against its parts."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from shoplens.llm import queries

TABLES = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(TABLES), reason="driver tables not present")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in ("documents", "benchmark", "pages", "embeddings"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{TABLES}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, database, name):
    found = contract.queries()[name](spark, TABLES)
    result = database.execute(contract.oracle_sql()[name])
    columns = sorted(c[0] for c in result.description)
    assert sorted(found.columns) == columns
    order = [[c[0] for c in result.description].index(c) for c in columns]
    expected = sorted((tuple(row[i] for i in order) for row in result.fetchall()), key=repr)
    assert sorted((tuple(row) for row in found.select(*columns).collect()), key=repr) == expected


def test_all_operators_are_registered():
    names = set(contract.queries())
    assert {n.split("_")[0] for n in queries.queries()} == {f"op{i}" for i in range(1, 14)} | {
        "pipeline"
    }
    assert set(queries.queries()) <= names


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    before, columns = docs.count(), docs.columns
    kept = [before]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, TABLES).write.parquet(str(tmp_path / str(number)))
        docs = spark.read.parquet(str(tmp_path / str(number)))
        if number < 4:
            assert docs.columns == columns
            kept.append(docs.count())
    assert kept[0] > kept[1] > kept[2] >= kept[3] == kept[4] > 0
    run = corpus_pipeline.run(spark, TABLES)
    keys = ["doc_id", "start", "length", "ids_crc32", "sequence_id"]
    assert sorted(map(tuple, run.select(keys).collect())) == sorted(
        map(tuple, docs.select(keys).collect())
    )


def test_pipeline_of_an_empty_table(spark, tmp_path):
    for name in ("documents", "benchmark"):
        table = spark.read.parquet(f"{TABLES}/{name}.parquet")
        table.limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
