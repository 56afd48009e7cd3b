"""Aggregate expressions shared by the marts, the checks and the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY_SUM = "decimal(38,2)"


def count_where(flag: Column) -> Column:
    """Rows where ``flag`` holds; NULL over no rows at all, like any sum."""
    return F.sum(F.when(flag, 1).otherwise(0)).cast("bigint")


def money_where(flag: Column, amount: Column) -> Column:
    return F.sum(F.when(flag, amount).otherwise(0)).cast(MONEY_SUM)


def rounded(value: Column, digits: int) -> Column:
    """Round a double half away from zero on the scaled value."""
    scale = float(10**digits)
    return F.round(value * scale) / F.lit(scale)


def percent(part: Column, whole: Column, digits: int | None = None) -> Column:
    """``part`` as a double percentage of ``whole``; NULL when there is no whole."""
    pct = part * F.lit(100.0) / F.nullif(whole, F.lit(0))
    return pct if digits is None else rounded(pct, digits)


def mean_money(amount: Column) -> Column:
    """Mean of a decimal column as a double.

    The sum stays decimal, so the result does not depend on how rows were
    spread over tasks.
    """
    return F.sum(amount).cast("double") / F.nullif(F.count(amount), F.lit(0))


def mean_of_percents(pct: Column) -> Column:
    """Unweighted mean of percentages that carry two decimals, summed exactly."""
    return mean_money(pct.cast("decimal(9,2)"))
