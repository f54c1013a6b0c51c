"""KPI building blocks: filtered sums and ratio-of-sums (never mean of ratios)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sum_where(value: Column, cond: Column) -> Column:
    """``SUM(value) FILTER (WHERE cond)``."""
    return F.sum(F.when(cond, value))


def count_where(cond: Column) -> Column:
    return F.count_if(cond).cast("bigint")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Safe ratio of two aggregates (NULL on zero), exact as far as decimals go."""
    return F.try_divide(numerator, denominator)
