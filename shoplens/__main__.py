"""Run a whole report: ``python -m shoplens shop|weblogs ...``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from shoplens.plans.shop_report import run_shop_report
from shoplens.plans.weblog_report import run_weblog_report
from shoplens.session import create_session


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="shoplens")
    parser.add_argument("--master", help="left to spark-submit if not given")
    parser.add_argument(
        "--shuffle-partitions", type=int, help="tasks of the widest grouping, before merging"
    )
    reports = parser.add_subparsers(dest="report", required=True)

    shop = reports.add_parser("shop", help="explore customers, products and orders")
    for table in ("customers", "products", "orders"):
        shop.add_argument(table, help="CSV file or directory")
    shop.add_argument("output", help="directory that all machines share")
    shop.add_argument("--sep", default=",")

    weblogs = reports.add_parser("weblogs", help="analyse access logs")
    weblogs.add_argument("lines", help="text file or directory")
    weblogs.add_argument("output", help="directory that all machines share")

    options = parser.parse_args(arguments)
    config = {}
    if options.shuffle_partitions:
        config["spark.sql.shuffle.partitions"] = str(options.shuffle_partitions)
    spark = create_session(f"shoplens-{options.report}", options.master, config)
    if options.report == "shop":
        written = run_shop_report(
            spark,
            options.customers,
            options.products,
            options.orders,
            options.output,
            options.sep,
        )
    else:
        written = run_weblog_report(spark, options.lines, options.output)
    print("\n".join(written))


if __name__ == "__main__":
    main()
