import datetime
import glob
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from conftest import plan, rows
from fixtures import customers, lines, log_line, orders
from shoplens import __main__ as command
from shoplens import schemas
from shoplens.operators.weblogs import parse_weblogs, weblog_quality
from shoplens.plans import weblog_report
from shoplens.sinks import write_dataset, write_report
from shoplens.sources import load_table, read_lines, read_table, table_quality

PRODUCT_LINES = [
    "P_100,Managed function,Services,5983,392.18,510.69",
    'P_101,"Face, to face",Apparel,many,600.36,1078.15',
]
PRODUCT_ROWS = [
    ("P_100", "Managed function", "Services", 5983, 392.18, 510.69),
    ("P_101", "Face, to face", "Apparel", None, 600.36, 1078.15),
]


def write(path, *text_lines):
    path.write_text("\n".join(text_lines) + "\n", encoding="utf-8")
    return str(path)


def part_files(path, kind):
    return sorted(glob.glob(os.path.join(path, f"part-*.{kind}*")))


def test_csv_goes_by_position(spark, tmp_path):
    # A damaged first column name changes nothing; a bad number is null.
    header = "lsproductCode,productName,productCategory,quantityInStock,buyPrice,MSRP"
    path = write(tmp_path / "products.csv", header, *PRODUCT_LINES)
    table = read_table(spark, path, schemas.PRODUCTS)
    assert table.columns == schemas.PRODUCTS.names
    assert rows(table) == PRODUCT_ROWS


def test_csv_separator_and_several_files(spark, tmp_path):
    header = ";".join(schemas.PRODUCTS.names)
    paths = [
        write(tmp_path / f"{i}.csv", header, f"P_{i};Name;Books;1;2.5;3.5") for i in range(2)
    ]
    table = read_table(spark, paths, schemas.PRODUCTS, sep=";")
    assert sorted(rows(table.select("productCode", "MSRP"))) == [("P_0", 3.5), ("P_1", 3.5)]


def test_load_table_renames_and_caches(spark, tmp_path):
    path = write(tmp_path / "p.csv", ",".join(schemas.PRODUCTS.names), *PRODUCT_LINES)
    table = load_table(
        spark, path, schemas.PRODUCTS, rename=schemas.UNDERSCORE_NAMES, cache=True
    )
    assert table.columns == [
        "product_Code",
        "productName",
        "product_Category",
        "quantityInStock",
        "buy_Price",
        "MSRP",
    ]
    assert table.is_cached and table.count() == 2
    table.unpersist()
    assert not load_table(spark, path, schemas.PRODUCTS).is_cached


def test_read_lines(spark, tmp_path):
    path = write(tmp_path / "log.txt", log_line("a", "/x"), "", "bad")
    table = read_lines(spark, path, cache=True)
    assert table.is_cached
    assert rows(weblog_quality(table)) == [(3, 1, 2)]
    table.unpersist()


def test_report_is_one_file_with_a_header(spark, tmp_path):
    path = str(tmp_path / "report")
    write_report(spark.range(5).repartition(3), path)
    write_report(spark.createDataFrame([("a,b", 1)], "Metric STRING, Value INT"), path)
    (file,) = part_files(path, "csv")
    with open(file, encoding="utf-8") as f:
        assert f.read() == 'Metric,Value\n"a,b",1\n'


def test_empty_report_keeps_its_header(spark, tmp_path):
    path = str(tmp_path / "report")
    write_report(customers(spark).where("country = 'Nowhere'").select("city", "state"), path)
    (file,) = part_files(path, "csv")
    with open(file, encoding="utf-8") as f:
        assert f.read().strip() == "city,state"


def test_dataset_keeps_its_partitions(spark, tmp_path):
    path = str(tmp_path / "data")
    write_dataset(spark.range(0, 100, numPartitions=4), path)
    assert len(part_files(path, "parquet")) == 4
    assert spark.read.parquet(path).count() == 100
    write_dataset(orders(spark), path, partition_by=["status"])
    stored = spark.read.parquet(path)
    assert sorted(stored.columns) == sorted(schemas.ORDERS.names)
    assert stored.where("status = 'Shipped'").count() == 3


def test_csv_dataset_round_trip(spark, tmp_path):
    path = str(tmp_path / "data")
    write_dataset(customers(spark), path, format="csv")
    assert sorted(rows(read_table(spark, path, schemas.CUSTOMERS))) == sorted(
        rows(customers(spark))
    )


def test_write_errors_reach_the_caller(spark, tmp_path):
    twice = spark.range(1).select(F.col("id").alias("a"), F.col("id").alias("a"))
    with pytest.raises(AnalysisException):
        write_dataset(twice, str(tmp_path / "data"))


def test_parsed_logs_round_trip(spark, tmp_path):
    path = str(tmp_path / "logs")
    table = lines(
        spark, log_line("a", "/x"), log_line("b", "/y", time="31/Feb/2025:13:01:02 +0000"), "bad"
    ).repartition(3)
    assert weblog_report.save_parsed(table, path) == {"total": 3, "valid": 2, "invalid": 1}
    stored = spark.read.schema(schemas.REQUESTS).parquet(path)
    assert sorted(rows(stored)) == sorted(rows(parse_weblogs(table)))


def test_no_lines_at_all(spark, tmp_path):
    none = {"total": 0, "valid": 0, "invalid": 0}
    empty = write(tmp_path / "empty.log")
    assert weblog_report.save_parsed(lines(spark).coalesce(1), str(tmp_path / "a")) == none
    (tmp_path / "empty.log").write_text("")
    assert weblog_report.save_parsed(read_lines(spark, empty), str(tmp_path / "b")) == none
    assert spark.read.schema(schemas.REQUESTS).parquet(str(tmp_path / "b")).count() == 0


def read_report(spark, path):
    return rows(spark.read.option("header", True).csv(path))


def test_table_quality_counts_what_is_lost(spark, tmp_path):
    schema = StructType.fromDDL("number INT, day DATE, amount DOUBLE")
    path = write(
        tmp_path / "t.csv",
        "a,b,c",
        "1,2024-01-05,2.5",
        "x,2024-01-06,",
        "3,2024-13-01,1",
        "4,2024-01-07",
    )
    found = table_quality(spark, path, schema)
    assert found.columns == ["rows", "damaged_rows", "number", "day", "amount"]
    assert plan(found).count("FileScan") == 1
    assert rows(found) == [(4, 1, 1, 1, 0)]


def test_weblog_report(spark, tmp_path):
    log = write(tmp_path / "web.log", *[log_line("a", "/home")] * 3, log_line("b", "/cart"), "?")
    output = str(tmp_path / "out")
    names = weblog_report.run_weblog_report(spark, log, output)
    assert sorted(names) == sorted(set(os.listdir(output)) - {"processed_logs"})
    assert read_report(spark, f"{output}/weblog_quality") == [("5", "4", "1")]
    assert read_report(spark, f"{output}/bounce_rate") == [("2", "1", "50.0")]
    assert read_report(spark, f"{output}/log_summary")[0] == ("Total Requests", "4")
    assert read_report(spark, f"{output}/status_distribution") == [("200", "4")]
    assert spark.read.parquet(f"{output}/processed_logs").count() == 4


def test_shop_report_from_the_command_line(spark, tmp_path, monkeypatch, capsys):
    inputs = {}
    for name, table in [("customers", customers(spark)), ("orders", orders(spark))]:
        inputs[name] = str(tmp_path / name)
        table.write.option("header", True).csv(inputs[name])
    inputs["products"] = write(
        tmp_path / "products.csv", ",".join(schemas.PRODUCTS.names), *PRODUCT_LINES
    )
    output = str(tmp_path / "out")
    monkeypatch.setattr(command, "create_session", lambda *_: spark)
    command.main(["shop", inputs["customers"], inputs["products"], inputs["orders"], output])
    names = capsys.readouterr().out.split()
    stored = {"customers.parquet", "products.parquet", "orders.parquet"}
    assert sorted(names) == sorted(set(os.listdir(output)) - stored)
    assert read_report(spark, f"{output}/summary") == [
        ("Total Customers", "4"),
        ("Total Products", "2"),
        ("Total Orders", "6"),
        ("Total Revenue", "16000.50"),
        ("Average Order Value", "3200.10"),
    ]
    assert read_report(spark, f"{output}/usa_customers")[0][1] == "Gamma"
    assert len(read_report(spark, f"{output}/shipped_orders")) == 3


def test_ids_beyond_an_int(spark, tmp_path):
    path = write(
        tmp_path / "orders.csv",
        ",".join(schemas.ORDERS.names),
        "3000000000,2024-06-01,2024-06-05,Shipped,5000000000,12.50,COD",
    )
    found = read_table(spark, path, schemas.ORDERS).select("orderNumber", "customerNumber")
    assert rows(found) == [(3000000000, 5000000000)]


def test_first_date_in_csv(spark, tmp_path):
    path = write(
        tmp_path / "orders.csv",
        ",".join(schemas.ORDERS.names),
        "200000,2024-06-01,2024-06-05,Shipped,10000,12.50,",
    )
    assert rows(read_table(spark, path, schemas.ORDERS)) == [
        (200000, datetime.date(2024, 6, 1), datetime.date(2024, 6, 5), "Shipped", 10000, 12.5, None)
    ]
