"""From raw access-log lines to a table of requests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.functions import LINE_PATTERN, TIME_FORMAT, line_fields


def parse_weblogs(lines: DataFrame, column: str = "value") -> DataFrame:
    """One row per line that has the log format; other lines are dropped.

    A number too long for an int, or a day or time that does not exist, becomes
    null and its row stays. ``parsed_timestamp`` is an instant: the offset in
    the line counts, and the session time zone decides how it shows.
    """
    line = F.col(column)
    fields = line_fields(line)
    matching = lines.where(line.rlike(LINE_PATTERN))
    return matching.select(
        fields["ip"].alias("ip"),
        fields["timestamp"].alias("timestamp"),
        fields["method"].alias("method"),
        fields["endpoint"].alias("endpoint"),
        fields["status"].try_cast("int").alias("status"),
        fields["response_time_ms"].try_cast("int").alias("response_time_ms"),
        F.try_to_timestamp(fields["timestamp"], F.lit(TIME_FORMAT)).alias("parsed_timestamp"),
    )


def weblog_quality(lines: DataFrame, column: str = "value") -> DataFrame:
    """(total, valid, invalid) lines, in one pass."""
    counted = lines.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col(column).rlike(LINE_PATTERN)).alias("valid"),
    )
    return counted.withColumn("invalid", F.col("total") - F.col("valid"))
