"""Type inference, records with line breaks, and results that replace others."""

import csv
import datetime
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from conftest import plan, rows
from fixtures import log_line
from shoplens import schemas, sinks
from shoplens.operators import profile, reports, traffic, visitors
from shoplens.operators.weblogs import parse_weblogs
from shoplens.plans import weblog_report
from shoplens.sources import (
    column_types,
    infer_schema,
    inference,
    read_records,
    read_table,
    read_table_of_records,
)

HEADER = "productCode,productName,productCategory,quantityInStock,buyPrice,MSRP"


def write(path, text):
    path.write_bytes(text.encode())
    return str(path)


# ---- types --------------------------------------------------------------------


def test_types_of_products(spark, tmp_path):
    lines = [f'P_{100 + i},"Name, {i}",Tools,{i * 40},{i}.25,{2 * i}' for i in range(50)]
    path = write(tmp_path / "p.csv", "\n".join([HEADER, *lines, 'P_1,x,Tools,,,7.5']) + "\n")
    found = infer_schema(spark, path)
    assert found.simpleString() == (
        "struct<productCode:string,productName:string,productCategory:string,"
        "quantityInStock:int,buyPrice:double,MSRP:double>"
    )
    assert read_table(spark, path, found).where("MSRP = 7.5 and buyPrice is null").count() == 1


@pytest.mark.parametrize(
    "values, kind",
    [
        ([], "string"),
        ([None, ""], "string"),
        (["1", None, "-7", "+3"], "int"),
        (["1", "3000000000"], "bigint"),
        (["1", "3000000000", "1.5"], "double"),
        (["9" * 30], "double"),
        (["1e5", ".5", "7.", "NaN"], "double"),
        (["2024-02-29", ""], "date"),
        (["2023-02-29"], "string"),
        (["2024-01-01", "2024-01-01 10:00:00"], "timestamp"),
        (["2024-01-01T10:00:00.123456"], "timestamp"),
        (["2024-01-01 25:00:00"], "string"),
        (["2024-01-01", "5"], "string"),
        (["true", "FALSE"], "boolean"),
        (["true", "1"], "string"),
        ([" 1"], "string"),
        (["1", "x"], "string"),
        (["1d"], "string"),
    ],
)
def test_lattice(spark, values, kind):
    table = spark.createDataFrame([(v,) for v in values], "`a.b` STRING").repartition(3)
    given = sum(1 for v in values if v)
    assert rows(column_types(table)) == [(0, "a.b", kind, given)]


def test_any_split_gives_the_same_types(spark):
    """The join of what two tasks saw is the type of both together."""
    kinds = [0, *(1 << k for k in range(7))]
    for a in kinds:
        for b in kinds:
            both = inference.type_of(a | b)
            for c in kinds:
                assert inference.type_of((a | b) | c) == inference.type_of(a | (b | c))
            assert a & inference.TEXT == 0 or both.simpleString() == "string"


def test_inference_reads_once(spark, tmp_path):
    path = write(tmp_path / "t.csv", "a,b\n1,x\n")
    text = spark.read.option("header", True).csv(path)
    assert plan(column_types(text)).count("FileScan") == 1
    assert infer_schema(spark, path).simpleString() == "struct<a:int,b:string>"
    assert infer_schema(spark, path, header=False).simpleString() == "struct<_c0:string,_c1:string>"
    empty = write(tmp_path / "e.csv", "a;b\n")
    assert infer_schema(spark, empty, sep=";").simpleString() == "struct<a:string,b:string>"


# ---- records ------------------------------------------------------------------


@pytest.fixture
def small_splits(spark):
    kept = {
        key: spark.conf.get(key)
        for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    }
    yield lambda size: (
        spark.conf.set("spark.sql.files.maxPartitionBytes", size),
        spark.conf.set("spark.sql.files.openCostInBytes", 0),
    )
    for key, value in kept.items():
        spark.conf.set(key, value)


VALUES = [["1", "plain"], ["2", 'two\nlines, and "quotes"'], ["3", ""], ["4", "a\n\n\nb\n"], ["5", "é"]]


@pytest.mark.parametrize("offset", range(0, 40, 3))
def test_line_break_at_every_offset_of_a_split(spark, tmp_path, small_splits, offset):
    """Splits of 40 bytes, so one value goes over several; the file moves along under them."""
    path = tmp_path / "t.csv"
    with open(path, "w", newline="", encoding="utf-8") as file:
        writer = csv.writer(file, lineterminator="\n")
        writer.writerow(["id", "text"])
        writer.writerow(["0", "x" * offset])
        writer.writerows(VALUES)
        writer.writerow(["6", "long\n" * 30])
        writer.writerow(["7", "end"])
    small_splits(40)
    schema = StructType.fromDDL("id INT, text STRING")
    found = read_table_of_records(spark, str(path), schema)
    expected = [["0", "x" * offset], *VALUES, ["6", "long\n" * 30], ["7", "end"]]
    assert sorted(rows(found)) == [(int(i), t or None) for i, t in expected]
    assert spark.read.text(str(path)).rdd.getNumPartitions() > 4


def test_records_of_several_files(spark, tmp_path, small_splits):
    chance = random.Random(3)
    expected = []
    for n in range(3):
        with open(tmp_path / f"{n}.csv", "w", newline="", encoding="utf-8") as file:
            writer = csv.writer(file)  # records end with \r\n
            writer.writerow(["id", "text"])
            for k in range(60):
                text = "".join(chance.choice(["a", ",", '"', "\n", " b", "c"]) for _ in range(9))
                expected.append((100 * n + k, "x" + text + "x"))
                writer.writerow([100 * n + k, expected[-1][1]])
    small_splits(200)
    schema = StructType.fromDDL("id INT, text STRING")
    found = read_table_of_records(spark, str(tmp_path), schema)
    assert sorted(rows(found)) == expected


def test_records_without_line_breaks(spark, tmp_path):
    path = write(tmp_path / "p.csv", f'{HEADER}\nP_1,"a, b",Tools,1,2.5,3\n\nP_2,c,Tools,x,1,1\n')
    found = read_table_of_records(spark, path, schemas.PRODUCTS)
    assert sorted(rows(found)) == sorted(rows(read_table(spark, path, schemas.PRODUCTS)))
    assert rows(read_records(spark, write(tmp_path / "none.csv", ""))) == []
    unclosed = write(tmp_path / "open.csv", 'a,b\n1,"x\ny\n')
    assert sorted(rows(read_records(spark, unclosed))) == [('1,"x\ny',), ("a,b",)]


# ---- results that replace others ------------------------------------------------


def failing(spark):
    late = F.when(F.col("id") == 99, F.raise_error(F.lit("halfway"))).otherwise(F.col("id"))
    return spark.range(0, 100, numPartitions=4).select(late.cast("bigint").alias("id"))


def test_a_write_that_fails_leaves_the_old_result(spark, tmp_path):
    path = str(tmp_path / "data")
    sinks.write_dataset(spark.range(5), path)
    with pytest.raises(Exception, match="halfway"):
        sinks.write_dataset(failing(spark), path)
    with pytest.raises(Exception, match="halfway"):
        sinks.write_report(failing(spark), path)
    assert spark.read.parquet(path).count() == 5
    assert os.listdir(tmp_path) == ["data"]
    with pytest.raises(Exception, match="halfway"):
        sinks.write_dataset(failing(spark), str(tmp_path / "never"))
    assert os.listdir(tmp_path) == ["data"]


def test_a_driver_that_dies_between_the_renames(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "data")
    sinks.write_dataset(spark.range(5), path)

    class Died(BaseException):
        pass

    rename, calls = sinks._Place.rename, []

    def dying(self, source, target):
        calls.append(source)
        if len(calls) == 2:
            raise Died
        rename(self, source, target)

    monkeypatch.setattr(sinks._Place, "rename", dying)
    monkeypatch.setattr(sinks, "recover", lambda *_: False)  # the dead recover nothing
    with pytest.raises(Died):
        sinks.write_dataset(spark.range(9), path)
    monkeypatch.undo()
    assert not os.path.exists(path)
    assert sinks.recover(spark, path)
    assert spark.read.parquet(path).count() == 5
    assert os.listdir(tmp_path) == ["data"]
    assert not sinks.recover(spark, path)


def test_a_result_made_from_the_one_it_replaces(spark, tmp_path):
    path = str(tmp_path / "data")
    sinks.write_dataset(spark.range(10), path)
    sinks.write_dataset(spark.read.parquet(path).where("id < 4"), path)
    assert spark.read.parquet(path).count() == 4
    assert os.listdir(tmp_path) == ["data"]


# ---- sums -----------------------------------------------------------------------


@pytest.mark.parametrize(
    "amounts, total, odd",
    [
        ([0.1, 0.2, None], 0.3, 0),
        ([0.1, float("nan")], "nan", 1),
        ([1.0, float("inf")], float("inf"), 1),
        ([1.0, float("-inf"), float("inf")], "nan", 2),
        ([1e300, 1.0], 1e300, 0),
        ([None], None, 0),
        ([], None, 0),
    ],
)
def test_sums_of_odd_amounts(spark, amounts, total, odd):
    table = spark.createDataFrame([(a,) for a in amounts], "a DOUBLE").repartition(3)
    (found,) = rows(profile.numeric_stats(table, ["a"], odd=True).select("a_sum", "a_odd"))
    assert found[1] == odd
    assert (str(found[0]) if total == "nan" else found[0]) == total


def test_whole_numbers_stay_exact(spark):
    table = spark.createDataFrame([(2**53 + 1,), (-(2**53),)], "a BIGINT")
    assert rows(profile.numeric_stats(table, ["a"]).select("a_sum")) == [(1.0,)]


def test_one_bad_amount_does_not_end_the_report(spark):
    orders = spark.createDataFrame(
        [(1, float("nan")), (2, 5.0)], "orderNumber BIGINT, totalAmount DOUBLE"
    )
    found = dict(rows(reports.ecommerce_summary(orders, orders, orders)))
    assert found["Total Orders"] == "2" and found["Total Revenue"] == "NaN"


# ---- totals ---------------------------------------------------------------------


def requests(spark):
    lines = [
        log_line(ip, page, status=status, ms=ms)
        for ip, page, status, ms in [
            ("a", "/home", 200, 10),
            ("a", "/home", 404, 30),
            ("b", "/cart", 500, 70),
            ("c", "/home", 200, 20),
        ]
    ]
    return parse_weblogs(spark.createDataFrame([(x,) for x in lines], "value STRING"))


ANALYSES = [
    traffic.status_distribution,
    traffic.method_distribution,
    traffic.top_endpoints,
    traffic.error_counts,
    traffic.top_404_pages,
    traffic.pages_5xx,
    traffic.latency_summary,
    traffic.traffic_by_hour,
    traffic.traffic_share,
    traffic.peak_hour,
    traffic.latency_by_hour,
    lambda logs: traffic.slowest_endpoints(logs, min_requests=0),
    lambda logs: traffic.slow_endpoints(logs, min_hits=0, min_avg_ms=0),
    lambda logs: traffic.slow_endpoint_status_latency(logs, min_hits=0, min_avg_ms=0),
    lambda logs: traffic.hour_totals(logs).table.orderBy("hour", "status"),
    lambda logs: visitors.requests_per_ip(logs).orderBy("ip"),
]


@pytest.mark.parametrize("number", range(len(ANALYSES)))
def test_columns_named_like_totals_change_nothing(spark, number):
    logs = requests(spark)
    named = logs.withColumns(
        {
            c: F.lit(1000).cast("bigint")
            for c in ("requests", "hour", "timed", "total_ms", "min_ms", "max_ms", "request_count")
        }
    )
    found = ANALYSES[number](named)
    assert rows(found) == rows(ANALYSES[number](logs))


def test_address_analyses_take_kept_totals(spark, tmp_path):
    """The report asks the kept table, not the requests, about addresses."""
    path = str(tmp_path / "requests")
    requests(spark).write.parquet(path)
    logs = spark.read.schema(schemas.REQUESTS).parquet(path)
    other = logs.where(F.lit(True)).select("*")  # another plan for the same rows
    kept = weblog_report.KeptTotals.of(logs)
    kept.persist()
    tables = weblog_report.log_figures(other, kept) | weblog_report.log_findings(other, kept)
    for name in ("top_ips", "requests_per_ip_stats", "bounce_rate", "bot_ips", "high_404_ips"):
        text = plan(tables[name])
        assert "InMemoryTableScan" in text
        # the scan below the kept table is the only one
        assert text.split("InMemoryTableScan")[0].count("FileScan") == 0
    kept.unpersist()
    assert rows(visitors.bounce_rate(kept.by_ip)) == rows(visitors.bounce_rate(logs))


def test_first_day(spark, tmp_path):
    path = write(tmp_path / "t.csv", "day\n2024-06-01\n")
    table = read_table(spark, path, infer_schema(spark, path))
    assert rows(table) == [(datetime.date(2024, 6, 1),)]
