"""Ratios and printed amounts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percentage(part: Column, whole: Column, digits: int = 2) -> Column:
    """``part`` of ``whole`` in percent, rounded; 0 where ``whole`` is 0."""
    return F.round(F.coalesce(F.try_divide(part, whole), F.lit(0.0)) * 100, digits)


def _countable(amount: Column, scale: int) -> Column:
    """Whether an amount fits a decimal with ``scale`` digits after the point; NaN does not."""
    return F.abs(amount) < F.lit(10.0 ** (28 - scale))


def not_finite(amount: Column) -> Column:
    """How many amounts are NaN or infinite."""
    double = amount.cast("double")
    return F.count_if(F.isnan(double) | (F.abs(double) == F.lit(float("inf"))))


def exact_sum(amount: Column, scale: int = 6, digits: int | None = None) -> Column:
    """The sum of a double column, the same whatever the order of adding; null for none.

    Amounts are added as decimals with ``scale`` digits after the point, the sum rounded to
    ``digits`` and given as a double. Amounts with more than ``28 - scale`` digits before the
    point do not fit and are added as doubles to it. What is not finite decides as in any sum of
    doubles: NaN if there is a NaN or infinities of both signs, else the infinity. See
    ``not_finite`` for their number.
    """
    fits = _countable(amount.cast("double"), scale)
    exact = F.sum(F.when(fits, amount).cast(f"decimal(28,{scale})"))
    if digits is not None:
        exact = F.round(exact, digits)
    beyond = F.sum(F.when(~fits, amount.cast("double")))
    return F.when(beyond.isNull(), exact.cast("double")).otherwise(
        beyond + F.coalesce(exact.cast("double"), F.lit(0.0))
    )


def exact_average(amount: Column, scale: int = 6) -> Column:
    """``exact_sum`` over the number of amounts, as a double; null for none."""
    return F.try_divide(exact_sum(amount, scale), F.count(amount))


def amount_text(amount: Column, currency: str | None = None) -> Column:
    """An amount with two decimals: ``1234.50``, or ``1,234.50 USD`` with a currency.

    ``format_number`` rounds the exact binary value half-even; ``format_string``
    would round the shortest decimal form half-up and print 2.675 as 2.68.
    """
    grouped = F.format_number(amount, 2)
    if currency is None:
        return F.translate(grouped, ",", "")
    return F.concat(grouped, F.lit(f" {currency}"))
