"""Parse access logs once, analyse the parsed requests and write the results."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shoplens import schemas
from shoplens.operators import reports, traffic, visitors, weblogs
from shoplens.sinks import write_dataset, write_report
from shoplens.sources import read_lines


@dataclass
class KeptTotals:
    """Totals of the requests from which most analyses follow."""

    by_hour: traffic.RequestTotals
    by_page: traffic.RequestTotals
    by_ip: visitors.AddressTotals

    @classmethod
    def of(cls, logs: DataFrame) -> KeptTotals:
        return cls(traffic.hour_totals(logs), traffic.page_totals(logs), visitors.ip_totals(logs))

    def persist(self) -> None:
        for table in (self.by_hour, self.by_page, self.by_ip):
            table.persist()

    def unpersist(self) -> None:
        for table in (self.by_hour, self.by_page, self.by_ip):
            table.unpersist()


def log_figures(logs: DataFrame, kept: KeptTotals) -> dict[str, DataFrame]:
    """The analyses of a fixed number of rows, by name: metrics, top lists, hours."""
    return {
        "top_endpoints": traffic.top_endpoints(kept.by_page),
        "error_counts": traffic.error_counts(kept.by_hour),
        "top_404_pages": traffic.top_404_pages(kept.by_page),
        "latency_summary": traffic.latency_summary(kept.by_hour),
        "slowest_endpoints": traffic.slowest_endpoints(kept.by_page),
        "slowest_requests": traffic.slowest_requests(logs),
        "traffic_by_hour": traffic.traffic_by_hour(kept.by_hour),
        "traffic_share_by_hour": traffic.traffic_share(kept.by_hour),
        "peak_hour": traffic.peak_hour(kept.by_hour),
        "latency_by_hour": traffic.latency_by_hour(kept.by_hour),
        "top_ips": visitors.top_ips(kept.by_ip),
        "requests_per_ip_stats": visitors.requests_per_ip_stats(kept.by_ip),
        "bounce_rate": visitors.bounce_rate(kept.by_ip),
        "funnel": visitors.funnel(logs),
        "log_summary": reports.log_summary_of_totals(kept.by_hour, kept.by_page, kept.by_ip),
    }


def log_findings(logs: DataFrame, kept: KeptTotals) -> dict[str, DataFrame]:
    """The analyses with a row per key found in the logs, by name."""
    return {
        "status_distribution": traffic.status_distribution(kept.by_hour),
        "method_distribution": traffic.method_distribution(kept.by_hour),
        "pages_5xx": traffic.pages_5xx(kept.by_page),
        "bot_ips": visitors.bot_ips(kept.by_ip),
        "abusive_ips_per_minute": visitors.abusive_ips(logs),
        "high_404_ips": visitors.high_404_ips(kept.by_ip),
        "slow_endpoints": traffic.slow_endpoints(kept.by_page),
        "slow_endpoint_status_latency": traffic.slow_endpoint_status_latency(kept.by_page),
    }


def save_parsed(lines: DataFrame, path: str) -> dict[str, int]:
    """Parse ``lines`` into a Parquet dataset; return total, valid and invalid lines.

    The counts come from the writing job itself, not from another pass over
    the text. That job has no shuffle, so no task's count can enter twice.
    """
    total, valid = Observation(), Observation()
    counted = lines.observe(total, F.count(F.lit(1)).alias("n"))
    parsed = weblogs.parse_weblogs(counted).observe(valid, F.count(F.lit(1)).alias("n"))
    write_dataset(parsed, path)
    lines_total, lines_valid = total.get["n"], valid.get["n"]
    return {
        "total": lines_total,
        "valid": lines_valid,
        "invalid": lines_total - lines_valid,
    }


def run_weblog_report(spark: SparkSession, lines_path: str, output: str) -> list[str]:
    """Write the parsed requests and every analysis below ``output``.

    ``output`` must be storage that all machines share: the requests are written there and
    read again. They are read six times, each time some columns: for totals per hour, page and
    address, which are kept and from which most analyses follow, and for the slowest requests,
    the funnel and the abusive addresses.
    """
    dataset = f"{output}/processed_logs"
    quality = save_parsed(read_lines(spark, lines_path), dataset)
    logs = spark.read.schema(schemas.REQUESTS).parquet(dataset)

    kept = KeptTotals.of(logs)
    kept.persist()
    figures = log_figures(logs, kept)
    figures["weblog_quality"] = spark.createDataFrame(
        [tuple(quality.values())], "total BIGINT, valid BIGINT, invalid BIGINT"
    )
    findings = log_findings(logs, kept)
    try:
        for name, figure in figures.items():
            write_report(figure, f"{output}/{name}")
        for name, finding in findings.items():
            write_dataset(finding, f"{output}/{name}", format="csv")
    finally:
        kept.unpersist()
    return [*figures, *findings]
