"""Two batches, and what each way to maintain the fact makes of the second."""

from __future__ import annotations

import pytest

from changefold.plans import incremental
from changefold.plans.marts import agg_daily_revenue, dim_customers, int_orders_enriched
from changefold.plans.staging import stg_customers, stg_orders
from tests.conftest import event, raw, rows

SHOWN = ("order_id", "customer_id", "status", "tier", "is_orphan_order")


def customer(key, op, ts, **attrs):
    return event(key, op, ts, table="customers", **attrs)


FIRST = [
    event(1, "c", 100, customer_id=1, status="pending"),
    event(2, "c", 200, customer_id=1, status="pending"),
    event(3, "c", 300, customer_id=2, status="pending"),
    event(4, "c", 400, customer_id=9, status="pending"),
]
FIRST_CUSTOMERS = [customer(1, "c", 10, tier="bronze"), customer(2, "c", 10, tier="bronze")]
SECOND = [
    event(1, "u", 150, customer_id=1, status="late"),      # older than the watermark
    event(2, "d", 500),                                    # deleted
    event(5, "c", 600, customer_id=1, status="pending"),   # new
]
SECOND_CUSTOMERS = [customer(2, "u", 20, tier="gold"), customer(9, "c", 30, tier="silver")]


def enriched(spark, orders, customers):
    return int_orders_enriched(stg_orders(raw(spark, orders)), stg_customers(raw(spark, customers)))


@pytest.fixture(scope="module")
def before(spark):
    return enriched(spark, FIRST, FIRST_CUSTOMERS)


@pytest.fixture(scope="module")
def now(spark):
    return enriched(spark, FIRST + SECOND, FIRST_CUSTOMERS + SECOND_CUSTOMERS)


def test_watermark_mode_takes_only_what_is_newer(spark, before, now):
    fact = incremental.upsert_by_watermark(before, now)
    assert rows(fact, *SHOWN) == [
        (1, 1, "pending", "bronze", False),  # the late update is lost
        (2, 1, "pending", "bronze", False),  # the delete is lost
        (3, 2, "pending", "bronze", False),  # the new tier is lost
        (4, 9, "pending", None, True),       # the late parent is lost
        (5, 1, "pending", "bronze", False),
    ]


def test_affected_keys_mode_equals_a_full_rebuild(spark, before, now):
    affected = incremental.affected_orders(
        spark.createDataFrame([(1,), (2,), (5,)], "order_id bigint"),
        spark.createDataFrame([(2,), (9,), (2,)], "customer_id bigint"),
        now, before,
    )
    assert rows(affected) == [(1,), (2,), (3,), (4,), (5,)]
    fact = incremental.upsert_affected(before, now, affected)
    assert rows(fact, *SHOWN) == rows(now, *SHOWN) == [
        (1, 1, "late", "bronze", False), (3, 2, "pending", "gold", False),
        (4, 9, "pending", "silver", False), (5, 1, "pending", "bronze", False),
    ]


def test_untouched_orders_are_left_alone(spark, before, now):
    affected = spark.createDataFrame([(5,)], "order_id bigint")
    fact = incremental.upsert_affected(before, now, affected)
    assert rows(fact, "order_id", "status")[:3] == [(1, "pending"), (2, "pending"), (3, "pending")]
    assert fact.count() == 5


def test_watermark_of_an_empty_fact_takes_all(spark, now):
    empty = now.limit(0)
    assert str(incremental.loaded_watermark(empty).first().watermark) == "1900-01-01 00:00:00"
    assert rows(incremental.upsert_by_watermark(empty, now), *SHOWN) == rows(now, *SHOWN)


def test_a_batch_at_the_watermark_is_not_taken_again(spark, now):
    assert incremental.past_watermark(now, now).count() == 0


def test_null_order_key_is_kept_once(spark):
    keyless = [event(None, "u", ts, after={"status": "x"}, before={"x": 1}) for ts in (1, 2)]
    now = enriched(spark, keyless, FIRST_CUSTOMERS)
    affected = spark.createDataFrame([(None,)], "order_id bigint")
    assert incremental.upsert_affected(now, now, affected).count() == 1


def test_dimension_counts_and_defaults(spark):
    orders = stg_orders(raw(spark, [
        event(1, "c", 5, customer_id=1, status="delivered", amount=10.5),
        event(2, "c", 6, customer_id=1, status="cancelled", amount=3),
        event(3, "c", 7, customer_id=1, status="delivered", amount="4.50"),
        event(4, "c", 8, customer_id=None, status="delivered", amount=1),
    ]))
    customers = stg_customers(raw(spark, FIRST_CUSTOMERS))
    dim = dim_customers(customers, orders)
    got = [(r.customer_id, r.lifetime_orders, float(r.lifetime_gmv), r.lost_orders) for r in dim.collect()]
    assert sorted(got) == [(1, 3, 15.0, 1), (2, 0, 0.0, 0)]
    # Summing the enriched rows gives the same as summing the staged ones.
    assert rows(dim) == rows(dim_customers(customers, int_orders_enriched(orders, customers)))


def test_daily_aggregate_keeps_null_countries_and_drops_undated_orders(spark):
    orders = [
        event(1, "c", 1, customer_id=1, status="delivered", amount=10, created_at="2026-01-01T10:00:00+00:00"),
        event(2, "c", 1, customer_id=8, status="refunded", amount=10, created_at="2026-01-01T11:00:00+00:00"),
        event(3, "c", 1, customer_id=8, status="delivered", amount="n/a", created_at="2026-01-02T11:00:00+00:00"),
        event(4, "c", 1, customer_id=1, status="delivered", amount=10, created_at="bad"),
    ]
    daily = agg_daily_revenue(enriched(spark, orders, [customer(1, "c", 1, country="IN")]))
    got = [(str(r.order_date), r.country, r.total_orders, r.completed_orders, r.lost_orders,
            None if r.gmv is None else float(r.gmv), r.cancellation_rate_pct) for r in daily.collect()]
    assert sorted(got, key=repr) == sorted([
        ("2026-01-01", "IN", 1, 1, 0, 10.0, 0.0),
        ("2026-01-01", None, 1, 0, 1, 0.0, 100.0),
        ("2026-01-02", None, 1, 1, 0, None, 0.0),
    ], key=repr)
