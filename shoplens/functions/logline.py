"""Fields of one access-log line."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The line format (address, time, method, endpoint, protocol,
# status, response time in ms) and the form of its time stamp.
LINE_PATTERN = r'^(\S+) \[([\w:/]+\s[+\-]\d{4})\] "(\S+) (\S+) (\S+)" (\d+) (\d+)$'
TIME_FORMAT = "dd/MMM/yyyy:HH:mm:ss Z"

# What "$" in a pattern lets follow the last digit.
_LINE_ENDS = "\n\r\u0085\u2028\u2029"


def _word_from_end(line: Column, position: int) -> Column:
    return F.substring_index(F.substring_index(line, " ", -position), " ", 1)


def line_fields(line: Column) -> dict[str, Column]:
    """The text fields of a line **known to match** ``LINE_PATTERN``.

    A field of a matching line holds no blank, except one inside the brackets,
    so each is found by counting blanks or brackets. Extracting them by group
    number would run the pattern once per field.
    """
    address = F.substring_index(line, " ", 1)
    after_bracket = F.substr(line, F.length(address) + 3)
    return {
        "ip": address,
        "timestamp": F.substring_index(after_bracket, "]", 1),
        "method": F.substr(_word_from_end(line, 5), F.lit(2)),
        "endpoint": _word_from_end(line, 4),
        "status": _word_from_end(line, 2),
        "response_time_ms": F.rtrim(F.substring_index(line, " ", -1), F.lit(_LINE_ENDS)),
    }
