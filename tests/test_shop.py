import datetime

import pytest

from conftest import plan, rows
from fixtures import customers, orders, people
from pyspark.sql import functions as F
from shoplens import schemas
from shoplens.functions import amount_text
from shoplens.operators import customers as customer_ops
from shoplens.operators import orders as order_ops
from shoplens.operators import people as people_ops
from shoplens.operators import profile, reports, shop
from shoplens.sources import bindings

D = datetime.date


def products(spark):
    return spark.createDataFrame(
        [
            ("P_100", "One", "Books", 5, 10.0, 20.125),
            ("P_101", "Two", "Tools", 7, 20.0, 40.25),
            ("P_102", "Three", "Books", 2, 0.5, 1.0),
        ],
        schemas.PRODUCTS,
    )


# ---- profile ----------------------------------------------------------------


def test_row_counts(spark):
    counted = profile.row_counts({"people": people(spark), "orders": orders(spark)})
    assert rows(counted) == [("people", 4), ("orders", 6)]


def test_null_counts(spark):
    counted = profile.null_counts(orders(spark))
    assert counted.columns == schemas.ORDERS.names
    assert rows(counted) == [(0, 1, 1, 0, 2, 1, 2)]
    assert rows(profile.null_counts(orders(spark), ["status", "totalAmount"])) == [(0, 1)]


def test_odd_column_names(spark):
    odd = spark.createDataFrame([(1, None), (2, 5), (2, None)], "`a.b` INT, `c ``d` INT")
    assert rows(profile.null_counts(odd)) == [(0, 2)]
    assert rows(profile.value_counts(odd, "a.b")) == [(2, 2), (1, 1)]
    assert rows(profile.duplicate_keys(odd, "a.b")) == [(3, 2, 1)]
    assert rows(profile.numeric_stats(odd, ["c `d"])) == [(1, 5, 5, 5, 5.0)]


def test_null_is_an_id_when_counting_duplicates(spark):
    assert rows(profile.duplicate_keys(orders(spark), "customerNumber")) == [(6, 4, 2)]
    assert rows(profile.duplicate_keys(orders(spark).where("false"), "status")) == [(0, 0, 0)]


def test_duplicate_check_sends_one_row_per_id(spark):
    text = plan(profile.duplicate_keys(orders(spark), "customerNumber"))
    assert "partial_count" in text and "Expand" not in text


def test_value_counts(spark):
    assert rows(shop.orders_by_status(orders(spark))) == [
        ("Shipped", 3),
        ("Cancelled", 1),
        ("Delivered", 1),
        ("Processing", 1),
    ]
    assert rows(shop.orders_by_payment(orders(spark))) == [
        ("COD", 3),
        (None, 2),
        ("Invoice", 1),
    ]
    assert rows(profile.value_counts(orders(spark), "status", "paymentMethod", top=2)) == [
        ("Shipped", None, 2),
        ("Cancelled", "Invoice", 1),
    ]
    assert rows(shop.top_order_status(orders(spark))) == [("Shipped", 3)]


def test_top_lists_do_not_sort_everything(spark):
    for df in (
        shop.top_countries(customers(spark)),
        shop.top_credit_country(customers(spark)),
        order_ops.top_orders(orders(spark)),
    ):
        text = plan(df)
        assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_distinct_values(spark):
    found = {v for (v,) in rows(profile.distinct_values(orders(spark), "paymentMethod"))}
    assert found == {None, "COD", "Invoice"}


def test_numeric_stats_by_group(spark):
    stats = profile.numeric_stats(customers(spark), ["creditLimit"], by=["customerSegment"])
    assert stats.columns == [
        "customerSegment",
        *[f"creditLimit_{s}" for s in ("count", "sum", "min", "max", "avg")],
    ]
    assert sorted(rows(stats)) == [
        ("Enterprise", 1, 100.25, 100.25, 100.25, 100.25),
        ("SMB", 2, 500.75, 200.25, 300.5, 250.38),
    ]


def test_top_groups_tie(spark):
    tied = spark.createDataFrame([("b", 1.0), ("a", 0.4), ("a", 0.6)], "k STRING, v DOUBLE")
    assert rows(profile.top_groups(tied, "k", "v", "total")) == [("a", 1.0)]
    assert rows(profile.top_groups(tied, "k", "v", "total", k=5)) == [("a", 1.0), ("b", 1.0)]


def test_partition_sizes(spark):
    sizes = profile.partition_sizes(spark.range(0, 100, numPartitions=4))
    assert sorted(rows(sizes)) == [(0, 25), (1, 25), (2, 25), (3, 25)]


# ---- shop -------------------------------------------------------------------


def test_amount_statistics(spark):
    assert rows(shop.order_amount_stats(orders(spark))) == [
        (5, 16000.5, 999.99, 6000.5, 3200.1)
    ]
    assert rows(shop.product_price_stats(products(spark))) == [
        (0.5, 20.0, 10.17, 1.0, 40.25, 20.46)
    ]


def test_credit_by_segment(spark):
    found = [("SMB", 2, 250.38, 300.5), ("Enterprise", 1, 100.25, 100.25)]
    assert rows(shop.credit_by_segment(customers(spark))) == found
    by_row = rows(shop.credit_by_segment(customers(spark), count_rows=True))
    assert [r[:2] for r in by_row] == [("SMB", 2), ("Enterprise", 2)]


def test_questions(spark):
    # A tie of 300.5 between France and Italy goes to the first name.
    assert rows(shop.top_credit_country(customers(spark))) == [("France", 300.5)]
    assert rows(shop.top_stock_category(products(spark))) == [("Books", 7)]
    assert rows(shop.products_by_category(products(spark))) == [("Books", 2), ("Tools", 1)]
    assert rows(shop.top_countries(customers(spark), 2)) == [("France", 2), ("Italy", 1)]
    assert rows(shop.customers_by_segment(customers(spark))) == [("Enterprise", 2), ("SMB", 2)]


def test_segment_share(spark):
    assert rows(shop.segment_share(customers(spark))) == [(2, 4, 50.0)]
    assert rows(shop.segment_share(customers(spark).where("false"))) == [(0, 0, 0.0)]


def test_customer_selections(spark):
    upper = customer_ops.segment_customers(customers(spark))
    assert upper.columns == ["customerName", "phone", "city", "country", "customerNameUpper"]
    assert rows(upper.select("customerNameUpper")) == [("ALPHA, INC",), ("GAMMA",)]
    assert rows(customer_ops.customers_in_country(customers(spark)).select("city")) == [
        ("Boston",)
    ]


def test_ecommerce_summary(spark):
    tables = customers(spark), products(spark), orders(spark)
    sizes = [("Total Customers", "4"), ("Total Products", "3"), ("Total Orders", "6")]
    assert rows(reports.ecommerce_summary(*tables)) == sizes + [
        ("Total Revenue", "16000.50"),
        ("Average Order Value", "3200.10"),
    ]
    assert rows(reports.ecommerce_summary(*tables, currency="USD")) == sizes + [
        ("Total Revenue", "16,000.50 USD"),
        ("Average Order Value", "3,200.10 USD"),
    ]
    empty = reports.ecommerce_summary(*[t.where("false") for t in tables])
    assert [value for _, value in rows(empty)] == ["0", "0", "0", None, None]


@pytest.mark.parametrize("amount", [2.675, 0.125, 0.135, 1e12 + 0.005, -0.004, 18855750.59, 0.0])
def test_amount_text_rounds_like_a_format_string(spark, amount):
    table = spark.createDataFrame([(amount,)], "x DOUBLE")
    texts = table.select(amount_text(F.col("x")), amount_text(F.col("x"), "USD"))
    assert rows(texts) == [(f"{amount:.2f}", f"{amount:,.2f} USD")]


# ---- orders -----------------------------------------------------------------


def numbers(df, column="orderNumber"):
    return [row[column] for row in df.collect()]


def test_orders_by_month(spark):
    assert rows(order_ops.orders_by_month(orders(spark))) == [(None, 1), (1, 2), (5, 1), (6, 2)]


def test_dates_may_be_text(spark):
    as_text = orders(spark).withColumn("orderDate", F.col("orderDate").cast("string"))
    damaged = as_text.withColumn(
        "orderDate", F.when(F.col("orderNumber") == 200000, "soon").otherwise(F.col("orderDate"))
    )
    assert rows(order_ops.orders_by_month(damaged)) == [(None, 2), (1, 1), (5, 1), (6, 2)]
    assert numbers(order_ops.orders_from_date(damaged)) == [200002, 200003]


def test_order_filters(spark):
    table = orders(spark)
    assert numbers(order_ops.high_value_orders(table)) == [200000]
    assert numbers(order_ops.orders_from_date(table)) == [200002, 200003]
    assert numbers(order_ops.orders_from_date(table, D(2024, 5, 31))) == [200002, 200003, 200004]
    assert numbers(order_ops.orders_in_status_list(table)) == [200000, 200001, 200004, 200005]
    assert numbers(order_ops.orders_in_status_list(table, ["Delivered"])) == [200003]


def test_order_size(spark):
    sizes = order_ops.order_size(orders(spark)).select("orderSize")
    assert [s for (s,) in rows(sizes)] == [
        "Large",
        "Medium",
        "Small",
        "Large",
        "Medium",
        "Large",
    ]
    assert rows(order_ops.order_size_distribution(orders(spark))) == [
        ("Large", 3),
        ("Medium", 2),
        ("Small", 1),
    ]


def test_shipped_orders(spark):
    assert rows(order_ops.shipped_orders(orders(spark))) == [
        (200000, D(2024, 1, 5), 6001.0, "High", "Shipped"),
        (200001, D(2024, 1, 6), 2000.0, "Low", "Shipped"),
        (200004, D(2024, 5, 31), 2000.0, "Medium", "Shipped"),
    ]


def test_order_columns(spark):
    table = orders(spark)
    assert order_ops.order_projection(table).columns == ["id", "date", "amount", "status"]
    assert order_ops.orders_reduced(table).columns == [
        "orderNumber",
        "orderDate",
        "status",
        "customerNumber",
        "totalAmount",
    ]
    flags = order_ops.large_order_flag(table).select("isLargeOrder")
    assert [f for (f,) in rows(flags)] == [True, False, False, True, False, None]


def test_order_code_pads_and_never_cuts(spark):
    table = spark.createDataFrame([(7,), (200001,), (None,)], "orderNumber INT")
    codes = order_ops.order_code(table).select("orderCode")
    assert rows(codes) == [("ORDER-00007",), ("ORDER-200001",), (None,)]
    wide = order_ops.order_code(table, width=8).select("orderCode")
    assert rows(wide) == [("ORDER-00000007",), ("ORDER-00200001",), (None,)]
    many = spark.range(200000, 215000).withColumnRenamed("id", "orderNumber")
    assert order_ops.order_code(many).select("orderCode").distinct().count() == 15000


def test_money_adds_up_alike_from_any_partitions(spark):
    amount = (F.col("id") * 7919 % 1000003 * 99.99 + 0.01).alias("amount")
    found = set()
    for n in (3, 7, 16, 64):
        table = spark.range(0, 2_000_000, 1, n).select(F.lit("a").alias("key"), amount)
        stats = profile.numeric_stats(table, ["amount"]).select("amount_sum", "amount_avg")
        found.add(rows(stats)[0] + rows(profile.top_groups(table, "key", "amount", "total"))[0])
    assert len(found) == 1


def test_customers_of_unknown_nations_stay(spark, tmp_path):
    customer = [(1, "a", 5, 1.0, "X"), (2, "b", 77, 2.0, "X"), (3, "c", None, 3.0, "Y")]
    spark.createDataFrame(customer, bindings.TABLE_SCHEMAS["customer"]).write.parquet(
        str(tmp_path / "customer.parquet")
    )
    spark.createDataFrame([(5, "N", 1)], bindings.TABLE_SCHEMAS["nation"]).write.parquet(
        str(tmp_path / "nation.parquet")
    )
    located = bindings.bind_customers_with_country(spark, str(tmp_path))
    assert sorted(r.country or "" for r in located.collect()) == ["", "", "N"]
    assert bindings.bind_customers(spark, str(tmp_path)).count() == 3
    assert bindings.bind_people(spark, str(tmp_path)).count() == 3


def test_top_orders(spark):
    assert numbers(order_ops.top_orders(orders(spark), 3)) == [200000, 200003, 200004]


def test_order_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "orders")
    orders(spark).write.parquet(path)
    stored = spark.read.schema(schemas.ORDERS).parquet(path)
    dated = plan(order_ops.orders_from_date(stored).select("orderNumber"))
    assert "GreaterThanOrEqual(orderDate,2024-06-01)" in dated
    assert "ReadSchema: struct<orderNumber:bigint,orderDate:date>" in dated
    assert "GreaterThan(totalAmount,5000.0)" in plan(order_ops.high_value_orders(stored))
    assert "In(status, [Processing,Shipped])" in plan(order_ops.orders_in_status_list(stored))


# ---- people -----------------------------------------------------------------


def test_people(spark):
    table = people(spark)
    assert rows(people_ops.people_over(table)) == [
        ("Bob", 35, "London", 4500.0),
        ("Dina", 40, "Berlin", 6000.0),
    ]
    assert sorted(rows(people_ops.average_salary_by_city(table))) == [
        ("Berlin", 6000.0),
        ("London", 4500.0),
        ("Paris", 4000.0),
    ]
    assert rows(profile.row_counts({"people": table})) == [("people", 4)]
