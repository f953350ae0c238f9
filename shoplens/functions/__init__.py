"""Column expressions shared by the operators."""

from shoplens.functions.amounts import (
    amount_text,
    exact_average,
    exact_sum,
    not_finite,
    percentage,
)
from shoplens.functions.logline import LINE_PATTERN, TIME_FORMAT, line_fields

__all__ = [
    "LINE_PATTERN",
    "TIME_FORMAT",
    "amount_text",
    "exact_average",
    "exact_sum",
    "not_finite",
    "line_fields",
    "percentage",
]
