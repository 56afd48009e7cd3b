"""Marts kept up to date by signed rows, in runs and in the stream of both logs."""

from __future__ import annotations

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from changefold.config import CUSTOMERS, ORDERS
from changefold.plans import pipeline, running
from changefold.sources.tables import Warehouse
from changefold.streaming import fact
from tests.conftest import event, raw, rows
from tests.test_pipeline import Chain, built, customer, expected, order

NOW = datetime(2026, 1, 1)


@pytest.fixture
def chain(spark, tmp_path):
    return Chain(spark, tmp_path)


def random_events(seed, n=60):
    """Orders that move between customers and days, change state, go and come back, late
    events and null attributes among them; customers that come, change country and go."""
    rng = random.Random(seed)
    orders, customers = [], []
    for k in range(n):
        ts = rng.randint(1, 400)
        orders.append(order(
            rng.randint(0, 14), rng.choice("cuuudr"), ts, lsn=1000 * seed + k, customer_id=rng.choice([None, 0, 1, 2, 9]),
            status=rng.choice(["pending", "delivered", "delivered", "cancelled", None]),
            amount=rng.choice([None, "n/a", 3, "7.25"]),
            created_at=rng.choice([None, "2025-06-01T01:00:00", "2025-06-02T23:59:59"])))
        if k % 3 == 0:
            customers.append(customer(rng.randint(0, 3), rng.choice("cuud"), ts, lsn=1000 * seed + k,
                                      country=rng.choice(["IN", "US", None])))
    return orders, customers


@pytest.mark.parametrize("seed", [1, 2])
def test_runs_equal_the_rebuild_after_each_batch(spark, chain, seed):
    orders, customers = [], []
    for n in range(4):
        more = random_events(10 * seed + n) if n != 2 else ([order(k, "d", 900, lsn=10**6) for k in range(0, 15, 2)], [])
        chain.run(n, *more, max_orphan_pct=100)
        orders, customers = orders + more[0], customers + more[1]
        assert built(chain) == expected(spark, orders, customers)


def test_a_newest_time_that_left_is_read_again(spark, chain):
    first = [order(k, "c", 100 * k, customer_id=1, status="delivered", amount=1) for k in range(1, 6)]
    chain.run(0, first, [customer(1, "c", 1)], max_orphan_pct=100)
    moved = [order(5, "u", 600, customer_id=2, status="delivered", amount=1), order(4, "d", 700)]
    chain.run(1, moved, [], max_orphan_pct=100)
    at = {r.customer_id: r.last_order_event_at for r in chain.table("dim_customers").collect()}
    assert at[1].timestamp() == 0.3
    assert spark.read.parquet(f"{chain.wh.base}/interim/run={pipeline.run_number(datetime(2026, 1, 2))}/reread_customers").count() == 1
    # Customer 2 is unknown so far; its sums are there when it turns up.
    chain.run(2, [], [customer(2, "c", 2)])
    found = chain.table("dim_customers").filter("customer_id = 2").first()
    assert (found.lifetime_orders, float(found.lifetime_gmv)) == (1, 1.0)


def test_a_run_reads_touched_buckets_only(spark, chain):
    """Neither states nor fact nor marts are opened beyond the buckets of the batch."""
    first = [order(k, "c", 1000 + k, customer_id=k % 7, status="delivered", amount=1) for k in range(40)]
    chain.run(0, first, [customer(k, "c", k) for k in range(7)])
    wh = Warehouse(spark, chain.wh.base, buckets=4)
    run = 2 * wh.last_run()
    opened = []
    wh.read = lambda table, schema, buckets=None, real=wh.read: (opened.append((table, buckets)), real(table, schema, buckets))[1]
    batch = raw(spark, [order(1, "u", 9000, customer_id=1, status="cancelled", amount=1)])
    running.advance(wh, run, NOW, batch, raw(spark, []))
    assert {t for t, _ in opened} == set(pipeline.SCHEMAS) - {"customers_snapshot"}
    assert all(b is not None and len(set(b)) < 4 for _, b in opened)


def test_tables_published_without_sums_are_taken_over(spark, chain, monkeypatch):
    orders, customers = random_events(5)
    chain.run(0, orders, customers, max_orphan_pct=100)
    # As an earlier version left it: whole marts in bucket 0, no sums.
    wh = Warehouse(spark, chain.wh.base, buckets=4)
    run = wh.last_run() + 1
    for name in ("dim_customers", "agg_daily_revenue"):
        wh.write_whole(name, pipeline.table(wh, name), run)
    none = {n: [] for n in pipeline.SCHEMAS if n in ("state_customer_orders", "state_customer_totals", "state_daily_totals")}
    wh.publish(run, {"dim_customers": None, "agg_daily_revenue": None, **{n: list(range(4)) for n in none}})
    assert not wh.has("state_daily_totals") and built(chain) == expected(spark, orders, customers)
    chain.wh.refresh()
    more = random_events(6)
    chain.run(1, *more, max_orphan_pct=100)
    assert built(chain) == expected(spark, orders + more[0], customers + more[1])


def land(spark, wh, load, orders, customers):
    for config, events in ((ORDERS, orders), (CUSTOMERS, customers)):
        if events:
            raw(spark, events).withColumn("_loaded_at", F.lit(NOW)).coalesce(1).write.parquet(
                f"{wh.raw_path(config.raw_table)}/load_id={load}")


def of_stream(wh):
    wh.refresh()
    return {n: rows(pipeline.table(wh, n).drop("_processed_at"))
            for n in ("fct_orders", "dim_customers", "agg_daily_revenue")}


@pytest.mark.parametrize("files", [None, 1])
def test_the_stream_equals_the_batch(spark, tmp_path, files):
    wh = Warehouse(spark, str(tmp_path / "tables"), buckets=3)
    orders, customers = [], []
    late = ([order(1, "d", 5000)], [customer(2, "u", 1, lsn=10**7, country="SG")])
    for load, more in enumerate([random_events(7), random_events(8), late, random_events(9)]):
        land(spark, wh, load, *more)
        orders, customers = orders + more[0], customers + more[1]
        if load % 2:
            changes = fact.stream_changes(spark, wh, files)
            fact.start_fact(changes, wh, str(tmp_path / "offsets")).awaitTermination()
            assert of_stream(wh) == expected(spark, orders, customers)
    epochs = wh.last_run()
    assert epochs == (2 if files is None else 4)
    fact.start_fact(fact.stream_changes(spark, wh, files), wh, str(tmp_path / "offsets")).awaitTermination()
    assert wh.last_run() == epochs


def test_a_replayed_epoch_changes_nothing(spark, tmp_path, monkeypatch):
    wh = Warehouse(spark, str(tmp_path / "tables"), buckets=3)
    take_in = fact.take_epoch(wh)
    batches = []
    for seed in (3, 4):
        orders, customers = random_events(seed)
        batches.append(raw(spark, orders + customers).withColumn("_loaded_at", F.lit(NOW)).withColumn("load_id", F.lit(1)))
    take_in(batches[0], 0)
    before = of_stream(wh)
    with monkeypatch.context() as m:  # the driver is lost before the publication
        m.setattr(wh, "publish", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            take_in(batches[1], 1)
    assert of_stream(wh) == before
    for number in (1, 0, 1):
        take_in(batches[number], number)
    (o1, c1), (o2, c2) = random_events(3), random_events(4)
    assert of_stream(wh) == expected(spark, o1 + o2, c1 + c2)
    processed = rows(pipeline.table(wh, "fct_orders"), "order_id", "_processed_at")
    take_in(batches[1], 1)
    assert rows(pipeline.table(wh, "fct_orders"), "order_id", "_processed_at") == processed


def test_signed_rows_cancel(spark):
    old = raw(spark, [event(1, "c", 1, customer_id=1)]).select("event_id")
    assert running.signed(old, old, ["event_id"]).count() == 0
    assert rows(running.signed(old, old.limit(0), ["event_id"]), "sign") == [(-1,)]


def test_the_first_run_takes_all_orders_as_they_come(spark, chain, monkeypatch):
    """Nothing was there before, so nothing has to be met, grouped or looked up."""
    def asked(*args):
        raise AssertionError("asked for the orders of changed customers")

    seen, signed = [], running.signed
    monkeypatch.setattr(pipeline, "affected_orders", asked)
    monkeypatch.setattr(running, "signed", lambda old, new, columns: seen.append(old) or signed(old, new, columns))
    orders, customers = random_events(7)
    chain.run(0, orders, customers, max_orphan_pct=100)
    assert seen == [None, None]
    assert built(chain) == expected(spark, orders, customers)
    more = random_events(8)
    chain.run(1, *more, max_orphan_pct=100)
    assert len(seen) == 4 and None not in seen[2:]
    assert built(chain) == expected(spark, orders + more[0], customers + more[1])
