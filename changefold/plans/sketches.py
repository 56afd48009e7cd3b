"""Distinct customers of any range of days, estimated from mergeable sketches.

A day and country has one HyperLogLog sketch of its customers, a few kilobytes whatever
their number. Sketches are united when they are read, so a question about any days and
countries reads them and not the fact. Exact counts stay the default of the reports.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Log of a sketch's buckets: 4,096 buckets of six bits.
PRECISION = 12
SKETCHES = "order_date date, country string, customers binary"


def standard_error(precision: int = PRECISION) -> float:
    """Relative standard error of an estimate."""
    return 1.04 / math.sqrt(2**precision)


def daily_sketches(fact: DataFrame, precision: int = PRECISION) -> DataFrame:
    """The customers of each day and country (NULL is a country) as a sketch.

    Sketches are made in the map tasks and united after the shuffle. Orders without a time
    are in no day; orders without a customer make a sketch of nobody.
    """
    return fact.filter(F.col("created_at").isNotNull()).groupBy(
        F.to_date("created_at").alias("order_date"), "country").agg(
        F.hll_sketch_agg("customer_id", F.lit(precision)).alias("customers"))


def united(sketches: DataFrame, more: DataFrame) -> DataFrame:
    """Stored sketches with those of added orders.

    A sketch cannot forget: a day whose orders left or moved has to be made anew from them,
    see ``remade``.
    """
    return sketches.unionByName(more).groupBy("order_date", "country").agg(
        F.hll_union_agg("customers").alias("customers"))


def remade(sketches: DataFrame, fact: DataFrame, days: DataFrame, precision: int = PRECISION) -> DataFrame:
    """Sketches with those of ``days`` (order_date) made anew from the fact's rows there."""
    asked = days.select(F.col("order_date").alias("_day")).distinct()
    kept = sketches.join(asked, F.col("order_date") == F.col("_day"), "left_anti")
    rows = fact.join(asked, F.to_date("created_at") == F.col("_day"), "left_semi")
    return kept.unionByName(daily_sketches(rows, precision))


def distinct_customers(
    sketches: DataFrame, first: date | None = None, last: date | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """The estimated number of customers between two days, both included, for each of ``by``
    (``country``, ``order_date``)."""
    if first is not None:
        sketches = sketches.filter(F.col("order_date") >= F.lit(first))
    if last is not None:
        sketches = sketches.filter(F.col("order_date") <= F.lit(last))
    estimate = F.hll_sketch_estimate(F.hll_union_agg("customers"))
    return sketches.groupBy(*by).agg(F.coalesce(estimate, F.lit(0)).cast("bigint").alias("customers"))
