"""The checks declared on the tables, the gate and the scorecard."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changefold.config import CUSTOMER_TIERS, DEFAULT_CURRENCY, MAX_ORPHAN_PCT, ORDER_STATUSES
from changefold.functions.measures import count_where, percent
from changefold.functions.times import wall_clock
from changefold.operators.quality import (
    ERROR, WARN, Check, as_count, check_report, traffic_light,
)

STATUSES, TIERS = tuple(ORDER_STATUSES), tuple(CUSTOMER_TIERS)

# The declared rules and their severities.
CHECKS = (
    Check("raw_orders_cdc", "event_id", "not_null"),
    Check("raw_orders_cdc", "event_id", "unique"),
    Check("raw_customers_cdc", "event_id", "not_null"),
    Check("raw_customers_cdc", "event_id", "unique"),
    Check("stg_orders", "order_id", "not_null"),
    Check("stg_orders", "order_id", "unique"),
    Check("stg_orders", "customer_id", "not_null"),
    Check("stg_orders", "customer_id", "relationships", parent="stg_customers"),
    Check("stg_orders", "status", "not_null"),
    Check("stg_orders", "status", "accepted_values", values=STATUSES),
    Check("stg_orders", "amount", "accepted_range", WARN, low=0),
    Check("stg_customers", "customer_id", "not_null"),
    Check("stg_customers", "customer_id", "unique"),
    Check("stg_customers", "email", "not_null", WARN),
    Check("stg_customers", "tier", "accepted_values", values=TIERS),
    Check("fct_orders", "order_id", "not_null"),
    Check("fct_orders", "order_id", "unique"),
    Check("fct_orders", "amount", "accepted_range", WARN, low=0),
    Check("fct_orders", "status", "accepted_values", values=STATUSES),
    Check("dim_customers", "customer_id", "not_null"),
    Check("dim_customers", "customer_id", "unique"),
    Check("dim_customers", "lifetime_gmv", "accepted_range", low=0),
    Check("agg_daily_revenue", "cancellation_rate_pct", "accepted_range", low=0, high=100),
)
ORPHAN_RATE, FUTURE_ORDERS = "orphan_rate_under_threshold", "no_future_orders"


def orphan_rate(fact: DataFrame, max_pct: float = MAX_ORPHAN_PCT) -> DataFrame:
    """One row if the share of orphan orders is above ``max_pct``, else none."""
    stats = fact.agg(
        count_where(F.col("is_orphan_order")).alias("orphans"), F.count("*").alias("total")
    )
    exact = percent(F.col("orphans"), F.col("total"))
    shown = percent(F.col("orphans"), F.col("total"), 2)
    return stats.withColumn("orphan_pct", shown).filter(exact > max_pct)


def future_orders(fact: DataFrame, as_of: datetime) -> DataFrame:
    return fact.filter(F.col("created_at") > wall_clock(as_of)).select("order_id", "created_at")


def gate_report(
    tables: Mapping[str, DataFrame],
    as_of: datetime,
    checks: Sequence[Check] = CHECKS,
    max_orphan_pct: float = MAX_ORPHAN_PCT,
) -> DataFrame:
    """All declared checks over the named tables, one row each."""
    fact = tables["fct_orders"]
    extra = [
        as_count(ORPHAN_RATE, "fct_orders", ERROR, F.count("*"), orphan_rate(fact, max_orphan_pct)),
        as_count(FUTURE_ORDERS, "fct_orders", ERROR, F.count("*"), future_orders(fact, as_of)),
    ]
    return check_report(tables, checks, extra)


def scorecard(fact: DataFrame, customers: DataFrame, as_of: datetime) -> DataFrame:
    """The four health figures with their traffic light, from one pass per table."""
    of_fact = fact.agg(
        percent(count_where(F.col("is_orphan_order")), F.count("*"), 2).alias("orphan_rate"),
        F.count_if(F.col("created_at") > wall_clock(as_of)).cast("double").alias("future_orders"),
        percent(count_where(F.col("currency") != DEFAULT_CURRENCY), F.count("*"), 1)
        .alias("drift_coverage"),
    )
    of_customers = customers.agg(
        percent(count_where(F.col("email").isNull()), F.count("*"), 2).alias("null_email_rate")
    )

    def line(name: str, threshold: float, low_is_good: bool = True) -> Column:
        value = F.col(name)
        return F.struct(
            F.lit(name).alias("metric"),
            value.alias("value"),
            F.lit(float(threshold)).alias("threshold"),
            traffic_light(value, threshold, low_is_good).alias("light"),
        )

    fact_lines = F.array(
        line("orphan_rate", 5), line("future_orders", 0), line("drift_coverage", 1, False)
    )
    return of_fact.select(F.inline(fact_lines)).unionByName(
        of_customers.select(F.inline(F.array(line("null_email_rate", 5))))
    )
