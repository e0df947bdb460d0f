"""Derived rates and their averages."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Holds any 64-bit sum.
_SUM = "decimal(20,0)"


def like_ratio(likes: Column, views: Column) -> Column:
    """Likes per 100 views, 4 decimals, half up; 0 where there are no views."""
    return F.when(views > 0, F.round(likes / views * 100, 4)).otherwise(F.lit(0.0))


def engagement_rate(likes: Column, dislikes: Column, comments: Column, views: Column) -> Column:
    """Likes, dislikes and comments per 100 views, 4 decimals, half up; 0 where there are no views."""
    return F.when(views > 0, F.round((likes + dislikes + comments) / views * 100, 4)).otherwise(F.lit(0.0))


def average_of_rates(col: Column) -> Column:
    """Mean of 4-decimal rates from an exact sum.

    A sum of doubles depends on the order in which partial results meet, so two runs, or a retried
    task, could differ in the last digits. Here whole parts and ten-thousandths are summed as integers,
    which is exact in any order and cheaper than summing decimals row by row; the two sums become one
    decimal only once per group.
    """
    return average_from_rate_sums(*rate_sums(col))


def rate_sums(col: Column) -> tuple[Column, Column, Column]:
    """Aggregates a mean of 4-decimal rates is made of: whole parts, ten-thousandths, number. They can be summed again."""
    whole = F.floor(col)
    return F.sum(whole), F.sum(F.floor((col - whole) * 10_000 + 0.5)), F.count(col)


def average_from_rate_sums(whole: Column, parts: Column, n: Column) -> Column:
    total = (whole.cast(_SUM) * 10_000 + parts.cast(_SUM)) * F.lit(Decimal("0.0001"))
    return F.try_divide(total.cast("double"), n)


def average_of_counts(col: Column) -> Column:
    """Mean of a 64-bit counter from its exact sum; overflow raises (ANSI mode)."""
    return F.try_divide(F.sum(col), F.count(col))
