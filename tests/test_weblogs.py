import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import plan, rows
from fixtures import lines, log_line
from shoplens import schemas
from shoplens.functions import LINE_PATTERN, TIME_FORMAT
from shoplens.operators.weblogs import parse_weblogs, weblog_quality


def by_groups(text_lines):
    """The same table with one pattern match per field."""
    value = F.col("value")
    fields = text_lines.where(F.regexp_extract(value, LINE_PATTERN, 1) != "").select(
        *[
            F.regexp_extract(value, LINE_PATTERN, group).alias(name)
            for name, group in [
                ("ip", 1),
                ("timestamp", 2),
                ("method", 3),
                ("endpoint", 4),
                ("status", 6),
                ("response_time_ms", 7),
            ]
        ]
    )
    return fields.withColumns(
        {
            "status": F.col("status").try_cast("int"),
            "response_time_ms": F.col("response_time_ms").try_cast("int"),
            "parsed_timestamp": F.try_to_timestamp("timestamp", F.lit(TIME_FORMAT)),
        }
    )


def test_fields_of_a_line(spark):
    parsed = parse_weblogs(lines(spark, log_line("192.168.1.7", "/products/123", 200, 417)))
    assert rows(parsed) == [
        (
            "192.168.1.7",
            "05/Nov/2025:13:01:02 +0000",
            "GET",
            "/products/123",
            200,
            417,
            datetime.datetime(2025, 11, 5, 13, 1, 2),
        )
    ]
    assert parsed.schema == schemas.REQUESTS


def test_other_lines_are_dropped(spark):
    bad = [
        "",
        "corrupt line 5",
        " " + log_line("1.1.1.1", "/a"),
        log_line("1.1.1.1", "/a") + " ",
        log_line("1.1.1.1", "/a b"),
        log_line("1.1.1.1", "/a", status="2x0"),
        log_line("1.1.1.1", "/a", time="05/Nov/2025:13:01:02"),
        None,
    ]
    table = lines(spark, *bad, log_line("1.1.1.1", "/a"))
    assert parse_weblogs(table).count() == 1
    assert rows(weblog_quality(table)) == [(9, 1, 8)]


def test_bad_numbers_and_times_become_null(spark):
    parsed = parse_weblogs(
        lines(
            spark,
            log_line("a", "/x", status="99999999999", ms=5),
            log_line("b", "/x", ms="12345678901"),
            log_line("c", "/x", time="31/Feb/2025:13:01:02 +0000"),
            log_line("d", "/x", time="05/Nov/2025:25:01:02 +0000"),
            log_line("e", "/x", time="5:1 +0000"),
        )
    )
    found = rows(parsed.select("ip", "status", "response_time_ms", "parsed_timestamp"))
    at = datetime.datetime(2025, 11, 5, 13, 1, 2)
    assert found == [
        ("a", None, 5, at),
        ("b", 200, None, at),
        ("c", 200, 100, None),
        ("d", 200, 100, None),
        ("e", 200, 100, None),
    ]


@pytest.mark.parametrize(
    ("time", "utc"),
    [
        ("05/Nov/2025:13:01:02 +0200", datetime.datetime(2025, 11, 5, 11, 1, 2)),
        ("05/Nov/2025:23:30:00 -0130", datetime.datetime(2025, 11, 6, 1, 0, 0)),
        ("01/Jan/2024:00:00:00 +0530", datetime.datetime(2023, 12, 31, 18, 30, 0)),
    ],
)
def test_offset_counts(spark, time, utc):
    parsed = parse_weblogs(lines(spark, log_line("a", "/x", time=time)))
    assert rows(parsed.select(F.col("parsed_timestamp").cast("timestamp_ntz"))) == [(utc,)]


def test_line_end_after_the_last_number(spark):
    ends = ["\n", "\r", "\r\n", "\u0085", "\u2028", "\u2029", "\n\n"]
    table = lines(spark, *[log_line("a", "/x", ms=7) + end for end in ends])
    assert rows(parse_weblogs(table)) == rows(by_groups(table))
    assert parse_weblogs(table).where("response_time_ms = 7").count() == 6


# Texts near the format: blanks, brackets and quotes where they may or may not go.
_word = st.text(st.sampled_from(list('ab1]["/:.é\t \u2028')), min_size=1, max_size=4)
_time = st.one_of(
    st.sampled_from(
        ["05/Nov/2025:13:01:02 +0000", "05/nov/2025:13:01:02\t-0900", "31/Feb/2025:1:2:3 +0000"]
    ),
    _word,
)
_number = st.one_of(st.sampled_from(["0", "007", "404", "99999999999"]), _word)
_near_line = st.builds(
    lambda ip, t, m, e, p, s, n, end: f'{ip} [{t}] "{m} {e} {p}" {s} {n}{end}',
    *[_word, _time, _word, _word, _word, _number, _number],
    st.sampled_from(["", "", " ", "\n", "\u0085"]),
)


@settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(_near_line, min_size=60, max_size=120))
def test_equals_one_match_per_field(spark, texts):
    table = lines(spark, *texts)
    assert rows(parse_weblogs(table)) == rows(by_groups(table))


def test_one_pattern_match_per_line(spark, tmp_path):
    path = str(tmp_path / "log.txt")
    lines(spark, log_line("a", "/x")).write.text(path)
    text = plan(parse_weblogs(spark.read.text(path)))
    assert text.count("RLIKE(") == 1 + text.count("DataFilters: [isnotnull(value")
    assert "regexp_extract" not in text and "PythonUDF" not in text
