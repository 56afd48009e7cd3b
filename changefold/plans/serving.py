"""Serving queries over the marts and the raw log.

Each function takes the relations it reads and returns a small result frame;
sorted where readers see an order. Drawing is left to the caller.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from changefold.config import DEFAULT_CURRENCY
from changefold.functions.lookups import flag, iso3, op_label, status_rank
from changefold.functions.measures import (
    MONEY_SUM, count_where, mean_money, mean_of_percents, money_where, percent, rounded,
)
from changefold.functions.payload import event_date, json_text
from changefold.plans.gates import future_orders, scorecard

TOP_CUSTOMERS = 10
# The lineage between the layers.
LINEAGE = [
    ("raw.orders", "stg_orders"),
    ("raw.customers", "stg_customers"),
    ("stg_orders", "int_orders"),
    ("stg_customers", "int_orders"),
    ("int_orders", "fct_orders"),
    ("stg_customers", "dim_customers"),
    ("int_orders", "dim_customers"),
    ("fct_orders", "agg_daily"),
]


def headline_kpis(fact: DataFrame) -> DataFrame:
    return fact.agg(
        F.count("*").alias("orders"),
        F.count_distinct("customer_id").alias("customers"),
        F.round(money_where(F.col("is_completed"), F.col("amount")), 0)
        .cast("decimal(38,0)").alias("gmv"),
        percent(count_where(F.col("is_lost")), F.count("*"), 1).alias("cancel_rate"),
        rounded(mean_money(F.col("amount")), 0).alias("aov"),
    )


def raw_event_counts(raw_orders: DataFrame, raw_customers: DataFrame) -> DataFrame:
    """Events per log and over both."""
    per_log = _counts({"orders": raw_orders, "customers": raw_customers}, "log", "events")
    total = per_log.agg(F.sum("events").cast("bigint").alias("events"))
    return per_log.unionByName(total.select(F.lit("total").alias("log"), "events"))


def orphan_rate(fact: DataFrame) -> DataFrame:
    return fact.agg(
        percent(count_where(F.col("is_orphan_order")), F.count("*"), 2).alias("orphan_pct")
    )


def null_email_rate(customers: DataFrame) -> DataFrame:
    return customers.agg(
        percent(count_where(F.col("email").isNull()), F.count("*"), 2).alias("null_email_pct")
    )


def future_order_count(fact: DataFrame, as_of: datetime) -> DataFrame:
    return future_orders(fact, as_of).agg(F.count("*").alias("future_orders"))


def daily_totals(daily: DataFrame) -> DataFrame:
    """The daily aggregate once more, over all countries."""
    return (
        daily.groupBy("order_date")
        .agg(
            F.sum("gmv").cast(MONEY_SUM).alias("gmv"),
            F.sum("total_orders").alias("orders"),
            F.sum("completed_orders").alias("completed"),
            F.sum("lost_orders").alias("lost"),
        )
        .orderBy(F.asc_nulls_last("order_date"))
    )


def orders_by_status(fact: DataFrame) -> DataFrame:
    """Orders per status in lifecycle order; unknown statuses come last."""
    return (
        fact.groupBy("status").agg(F.count("*").alias("n"))
        .withColumn("lifecycle_rank", status_rank(F.col("status")))
        .orderBy(F.asc_nulls_last("lifecycle_rank"), F.asc_nulls_last("status"))
    )


def customers_by_tier(customers: DataFrame) -> DataFrame:
    """Customers per tier and each tier's share.

    The total is a window over the grouped rows, one per tier, not over customers.
    """
    tiers = customers.groupBy("tier").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    return tiers.withColumn("share_pct", percent(F.col("n"), total, 2))


def by_country(daily: DataFrame) -> DataFrame:
    return (
        daily.filter(F.col("country").isNotNull())
        .groupBy("country")
        .agg(
            F.sum("gmv").cast(MONEY_SUM).alias("gmv"),
            F.sum("total_orders").alias("orders"),
        )
        .orderBy(F.desc("gmv"), "country")
    )


def country_labels(countries: DataFrame) -> DataFrame:
    return countries.withColumn("iso3", iso3(F.col("country"))).withColumn(
        "flag", flag(F.col("country"))
    )


def country_map(daily: DataFrame) -> DataFrame:
    """Countries that can be placed on a map: those with a known ISO3 code."""
    return country_labels(by_country(daily)).filter(F.col("iso3").isNotNull())


def cancellation_trend(daily: DataFrame) -> DataFrame:
    """Mean of the countries' rates per day, every country weighing the same."""
    rate = rounded(mean_of_percents(F.col("cancellation_rate_pct")), 1)
    return daily.groupBy("order_date").agg(rate.alias("rate")).orderBy(
        F.asc_nulls_last("order_date")
    )


def top_customers(customers: DataFrame, k: int = TOP_CUSTOMERS) -> DataFrame:
    best = customers.orderBy(F.desc("lifetime_gmv"), F.asc("customer_id")).limit(k)
    return best.select(
        "full_name", "tier", "lifetime_orders",
        F.round("lifetime_gmv", 0).cast("decimal(38,0)").alias("gmv"),
    )


def drift_coverage(fact: DataFrame) -> DataFrame:
    """Share of orders in another than the default currency."""
    other = F.col("currency") != DEFAULT_CURRENCY
    return fact.agg(percent(count_where(other), F.count("*"), 1).alias("drift_pct"))


def events_by_op(raw_orders: DataFrame, raw_customers: DataFrame) -> DataFrame:
    both = raw_orders.select("op").unionByName(raw_customers.select("op"))
    return (
        both.groupBy("op").agg(F.count("*").alias("n"))
        .withColumn("label", op_label(F.col("op")))
    )


def drift_onset(raw_orders: DataFrame) -> DataFrame:
    """Daily percentage of creates that carry the late attribute ``currency``."""
    carries = json_text("after_json", "currency").isNotNull()
    # Sum of 0/1 in bigint: exact, whatever the order of the rows.
    share = count_where(carries) / F.count("*")
    return (
        raw_orders.filter(F.col("op") == "c")
        .groupBy(event_date().alias("event_day"))
        .agg(rounded(share * 100.0, 1).alias("pct"))
        .orderBy(F.asc_nulls_last("event_day"))
    )


def daily_event_volume(raw_orders: DataFrame) -> DataFrame:
    return (
        raw_orders.groupBy(event_date().alias("event_day")).agg(F.count("*").alias("n"))
        .orderBy(F.asc_nulls_last("event_day"))
    )


def _counts(tables: Mapping[str, DataFrame], name: str, value: str) -> DataFrame:
    parts = [
        df.agg(F.count("*").alias(value)).select(F.lit(t).alias(name), value)
        for t, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def layer_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per layer. ``tables`` maps the shown names to the relations."""
    return _counts(tables, "layer", "n_rows")


def lineage_edges(counts: DataFrame) -> DataFrame:
    """The lineage, each edge weighted by the rows of the layer it starts from."""
    edges = counts.sparkSession.createDataFrame(LINEAGE, "source string, target string")
    # Eight edges and one count per layer.
    return edges.join(
        F.broadcast(counts.select(F.col("layer").alias("source"), F.col("n_rows").alias("weight"))),
        "source", "left",
    )


def reports(tables: Mapping[str, DataFrame], as_of: datetime) -> dict[str, DataFrame]:
    """All reports over the named relations; each is computed when it is read."""
    fact, dim, daily = (tables[t] for t in ("fct_orders", "dim_customers", "agg_daily_revenue"))
    raw_orders, raw_customers = tables["raw_orders_cdc"], tables["raw_customers_cdc"]
    counts = layer_counts({
        "raw.orders": raw_orders,
        "raw.customers": raw_customers,
        "stg_orders": tables["stg_orders"],
        "stg_customers": tables["stg_customers"],
        "int_orders": tables["int_orders_enriched"],
        "fct_orders": fact,
        "dim_customers": dim,
        "agg_daily": daily,
    })
    return {
        "headline_kpis": headline_kpis(fact),
        "raw_event_counts": raw_event_counts(raw_orders, raw_customers),
        "orphan_rate": orphan_rate(fact),
        "null_email_rate": null_email_rate(dim),
        "future_orders": future_order_count(fact, as_of),
        "daily_totals": daily_totals(daily),
        "orders_by_status": orders_by_status(fact),
        "customers_by_tier": customers_by_tier(dim),
        "countries": country_labels(by_country(daily)),
        "country_map": country_map(daily),
        "cancellation_trend": cancellation_trend(daily),
        "top_customers": top_customers(dim),
        "drift_coverage": drift_coverage(fact),
        "events_by_op": events_by_op(raw_orders, raw_customers),
        "drift_onset": drift_onset(raw_orders),
        "daily_event_volume": daily_event_volume(raw_orders),
        "layer_counts": counts,
        "lineage": lineage_edges(counts),
        "scorecard": scorecard(fact, dim, as_of),
    }


def ad_hoc(spark: SparkSession, tables: Mapping[str, DataFrame], sql: str) -> DataFrame:
    """Run a query over the named relations, registered as temporary views.

    The text is taken as a subquery, so only a query that reads can be parsed: a
    statement that would write, define or drop anything is refused before it is run.
    """
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return spark.sql(f"SELECT * FROM (\n{sql.strip().removesuffix(';')}\n)")
