from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.errors import ParseException
from pyspark.sql import functions as F

from changefold.plans import serving
from tests.conftest import event, raw, rows


@pytest.fixture(scope="module")
def daily(spark):
    return spark.createDataFrame([
        (date(2026, 1, 2), "IN", 4, 2, 1, Decimal("10.50"), 25.0),
        (date(2026, 1, 2), "US", 1, 1, 0, Decimal("99.00"), 0.0),
        (date(2026, 1, 1), "ZZ", 2, 1, 1, Decimal("5.00"), 50.0),
        (date(2026, 1, 1), None, 3, 0, 3, Decimal("0.00"), 100.0),
    ], "order_date date, country string, total_orders bigint, completed_orders bigint, "
       "lost_orders bigint, gmv decimal(38,2), cancellation_rate_pct double")


def test_daily_totals_and_trend_are_sorted(daily):
    got = [(str(r.order_date), float(r.gmv), r.orders, r.completed, r.lost)
           for r in serving.daily_totals(daily).collect()]
    assert got == [("2026-01-01", 5.0, 5, 1, 4), ("2026-01-02", 109.5, 5, 3, 1)]
    assert [r.rate for r in serving.cancellation_trend(daily).collect()] == [75.0, 12.5]


def test_countries_are_ranked_labelled_and_mapped(daily):
    labelled = serving.country_labels(serving.by_country(daily)).collect()
    assert [(r.country, float(r.gmv), r.iso3, r.flag) for r in labelled] == [
        ("US", 99.0, "USA", "🇺🇸"), ("IN", 10.5, "IND", "🇮🇳"), ("ZZ", 5.0, None, "")]
    assert [r.country for r in serving.country_map(daily).collect()] == ["US", "IN"]


def test_statuses_follow_the_lifecycle_and_unknown_ones_come_last(spark):
    fact = spark.createDataFrame(
        [(s,) for s in ("refunded", "pending", "odd", "pending", None, "shipped")], "status string")
    got = [(r.status, r.n) for r in serving.orders_by_status(fact).collect()]
    assert got == [("pending", 2), ("shipped", 1), ("refunded", 1), ("odd", 1), (None, 1)]


def test_operations_are_labelled_or_shown_as_they_are(spark):
    orders = raw(spark, [event(1, op, i) for i, op in enumerate("ccudrx")])
    got = rows(serving.events_by_op(orders, raw(spark, [event(1, "u", 1, table="customers")])))
    assert got == [("c", 2, "Create"), ("d", 1, "Delete"), ("r", 1, "Snapshot"), ("u", 2, "Update"), ("x", 1, "x")]


def test_top_customers_break_ties_by_id(spark):
    dim = spark.range(30).select(
        F.col("id").alias("customer_id"), F.concat(F.lit("n"), "id").alias("full_name"),
        F.lit("gold").alias("tier"), F.lit(1).alias("lifetime_orders"),
        (F.col("id") % 3).cast("decimal(38,2)").alias("lifetime_gmv"))
    got = [r.full_name for r in serving.top_customers(dim).collect()]
    assert got == [f"n{i}" for i in range(2, 30, 3)]


def test_shares_add_up(spark):
    dim = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "tier string")
    assert rows(serving.customers_by_tier(dim)) == [("a", 2, 50.0), ("b", 1, 25.0), (None, 1, 25.0)]


def test_drift_onset_counts_creates_only(spark):
    day = 86_400_000
    log = raw(spark, [event(1, "c", 0), event(2, "c", 1, currency="INR"), event(3, "c", day, currency="USD"),
                      event(1, "u", 2, currency="INR"), event(4, "c", day + 1, currency=None)])
    assert [r.pct for r in serving.drift_onset(log).collect()] == [50.0, 50.0]
    assert [r.n for r in serving.daily_event_volume(log).collect()] == [3, 2]


def test_kpis_of_an_empty_fact(spark):
    empty = spark.createDataFrame([], "customer_id bigint, is_completed boolean, is_lost boolean, amount decimal(12,2)")
    r = serving.headline_kpis(empty).first()
    assert (r.orders, r.customers, r.gmv, r.cancel_rate, r.aov) == (0, 0, None, None, None)


def test_lineage_weights_and_ad_hoc_queries(spark):
    counts = serving.layer_counts({"raw.orders": spark.range(5), "stg_orders": spark.range(3)})
    got = {(r.source, r.target): r.weight for r in serving.lineage_edges(counts).collect()}
    assert len(got) == 8 and got["raw.orders", "stg_orders"] == 5 and got["stg_orders", "int_orders"] == 3
    out = serving.ad_hoc(spark, {"t": spark.range(4)}, "SELECT sum(id) AS s FROM t")
    assert out.first().s == 6


@pytest.mark.parametrize("sql", [
    "INSERT OVERWRITE DIRECTORY '/tmp/never' USING parquet SELECT 1",
    "CREATE TABLE never AS SELECT 1", "DROP VIEW t", "SELECT 1; SELECT 2",
])
def test_ad_hoc_refuses_what_does_not_read(spark, sql):
    with pytest.raises(ParseException):
        serving.ad_hoc(spark, {"t": spark.range(3)}, sql)


def test_ad_hoc_takes_one_query(spark):
    found = serving.ad_hoc(spark, {"t": spark.range(3)}, "WITH x AS (SELECT max(id) AS m FROM t) SELECT m FROM x;")
    assert [r.m for r in found.collect()] == [2]
