"""Enriched orders, order fact, customer dimension and daily aggregate."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changefold.config import COMPLETED_STATUS, LOST_STATUSES
from changefold.functions.measures import MONEY_SUM, count_where, money_where, percent
from changefold.functions.times import instant
from changefold.operators.joins import parent_join


def is_lost() -> Column:
    return F.col("status").isin(*LOST_STATUSES)


def is_completed() -> Column:
    return F.col("status") == COMPLETED_STATUS


def int_orders_enriched(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders with their customer's country and tier; orphans are kept and flagged."""
    parents = customers.select("customer_id", "country", "tier")
    joined = parent_join(orders, parents, "customer_id")
    return joined.select(
        "order_id",
        orders["customer_id"],
        parents["customer_id"].isNull().alias("is_orphan_order"),
        "country",
        "tier",
        "status",
        "amount",
        "currency",
        is_lost().alias("is_lost"),
        is_completed().alias("is_completed"),
        orders["created_at"],
        orders["updated_at"],
        orders["_cdc_ts"],
    )


def fct_orders(enriched: DataFrame, run_ts: datetime) -> DataFrame:
    return enriched.withColumn("_processed_at", instant(run_ts))


def dim_customers(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Customers with their lifetime figures.

    The figures need order columns only, so ``orders`` may be the staged orders:
    they are summed per customer (map-side first, so a hot customer is one row
    per task) and meet the customers on a partitioning both already have.
    """
    per_customer = orders.groupBy("customer_id").agg(
        F.count("*").alias("lifetime_orders"),
        money_where(is_completed(), F.col("amount")).alias("lifetime_gmv"),
        count_where(is_lost()).alias("lost_orders"),
        F.max("_cdc_ts").alias("last_order_event_at"),
    )
    return customers.join(per_customer, "customer_id", "left").select(
        "customer_id", "full_name", "email", "country", "tier",
        F.coalesce("lifetime_orders", F.lit(0)).alias("lifetime_orders"),
        F.coalesce("lifetime_gmv", F.lit(0).cast(MONEY_SUM)).alias("lifetime_gmv"),
        F.coalesce("lost_orders", F.lit(0)).alias("lost_orders"),
        "created_at",
        "last_order_event_at",
    )


def agg_daily_revenue(fact: DataFrame) -> DataFrame:
    """Orders, revenue and cancellation rate per day and country (NULL is a country)."""
    return (
        fact.filter(F.col("created_at").isNotNull())
        .groupBy(F.to_date("created_at").alias("order_date"), "country")
        .agg(
            F.count("*").alias("total_orders"),
            count_where(F.col("is_completed")).alias("completed_orders"),
            count_where(F.col("is_lost")).alias("lost_orders"),
            money_where(F.col("is_completed"), F.col("amount")).alias("gmv"),
            percent(count_where(F.col("is_lost")), F.count("*"), 2).alias("cancellation_rate_pct"),
        )
    )
