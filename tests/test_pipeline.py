from __future__ import annotations

from datetime import datetime

import pytest

from changefold.operators.history import SCD_TO
from changefold.operators.quality import QualityGateError
from changefold.operators import quality
from changefold.plans import incremental, pipeline, serving
from changefold.plans.marts import agg_daily_revenue, dim_customers, int_orders_enriched
from changefold.plans.staging import stg_customers, stg_orders
from changefold.sources import tables
from changefold.sources.tables import Warehouse
from changefold.streaming import landing
from tests.conftest import event, line, raw, rows, write_lines

RUNS = [datetime(2026, 1, d) for d in range(1, 5)]
CREATED = "2025-06-01T00:00:00+00:00"


def order(key, op, ts, **attrs):
    attrs.setdefault("created_at", CREATED)
    return event(key, op, ts, **({} if op == "d" else attrs))


def customer(key, op, ts, **attrs):
    attrs = {"email": f"{key}@x", "country": "IN", "tier": "bronze", **attrs}
    return event(key, op, ts, table="customers", **({} if op == "d" else attrs))


ORDERS_1 = [order(k, "c", 1000 + k, customer_id=k % 5, status="pending", amount=k) for k in range(40)]
CUSTOMERS_1 = [customer(k, "c", k) for k in range(5)]
ORDERS_2 = [
    order(1, "u", 1001, lsn=5000, customer_id=1, status="delivered", amount=1),  # late
    order(2, "d", 2000),
    order(50, "c", 3000, customer_id=0, status="delivered", amount="7.25"),
]
CUSTOMERS_2 = [customer(3, "u", 500, tier="gold")]


# Enough of a gate for tests that are not about the gate.
UNIQUE = [c for c in pipeline.CHECKS if c.name == "unique_fct_orders_order_id"]


class Chain:
    def __init__(self, spark, tmp_path):
        self.spark, self.tmp = spark, tmp_path
        self.wh = Warehouse(spark, str(tmp_path / "tables"), buckets=4)

    def run(self, n, orders, customers, **kwargs):
        logs = {
            t: write_lines(self.tmp / f"log{n}" / f"{t}.jsonl", [line(e) for e in events])
            for t, events in (("orders", orders), ("customers", customers))
        }
        kwargs.setdefault("checks", UNIQUE)
        return pipeline.run(self.spark, self.wh, logs, RUNS[n], **kwargs)

    def table(self, name):
        # A reader of its own sees what is published.
        return pipeline.table(Warehouse(self.spark, self.wh.base, buckets=4), name)


@pytest.fixture
def chain(spark, tmp_path):
    return Chain(spark, tmp_path)


def expected(spark, orders, customers):
    so, sc = stg_orders(raw(spark, orders)), stg_customers(raw(spark, customers))
    fact = int_orders_enriched(so, sc)
    return {
        "fct_orders": rows(fact),
        "dim_customers": rows(dim_customers(sc, so)),
        "agg_daily_revenue": rows(agg_daily_revenue(fact)),
    }


def built(chain):
    return {
        "fct_orders": rows(chain.table("fct_orders").drop("_processed_at")),
        "dim_customers": rows(chain.table("dim_customers")),
        "agg_daily_revenue": rows(chain.table("agg_daily_revenue")),
    }


def test_two_runs_equal_one_rebuild(spark, chain):
    first = chain.run(0, ORDERS_1, CUSTOMERS_1)
    assert first.published and [r.inserted for r in first.loads] == [40, 5]
    assert built(chain) == expected(spark, ORDERS_1, CUSTOMERS_1)
    chain.run(1, ORDERS_1[:3] + ORDERS_2, CUSTOMERS_2)
    assert built(chain) == expected(spark, ORDERS_1 + ORDERS_2, CUSTOMERS_1 + CUSTOMERS_2)
    history = chain.table("customers_snapshot")
    assert history.count() == 6 and history.filter(f"{SCD_TO} IS NOT NULL").count() == 1


def test_a_read_lists_current_folders_only(spark, chain):
    chain.run(0, ORDERS_1, CUSTOMERS_1)
    chain.run(1, ORDERS_1[:3] + ORDERS_2, CUSTOMERS_2)
    wh = Warehouse(spark, chain.wh.base, 4)
    # A folder that is no bucket of any run would stop a scan of the whole table.
    broken = chain.tmp / "tables" / "marts" / "fct_orders" / f"run={wh.last_run() - 1}" / "bucket=0"
    broken.mkdir(parents=True)
    (broken / "part-0.parquet").write_text("no Parquet")
    wanted = {f"run={r}/bucket={b}" for t, b, r in wh.current_map() if t == "fct_orders"}
    files = pipeline.table(wh, "fct_orders").inputFiles()
    assert {"/".join(f.split("/")[-3:-1]) for f in files} == wanted
    assert built(chain) == expected(spark, ORDERS_1 + ORDERS_2, CUSTOMERS_1 + CUSTOMERS_2)


def test_a_bucket_that_lost_its_rows_reads_empty(spark, chain):
    chain.run(0, ORDERS_1[:2], CUSTOMERS_1)
    chain.run(1, [order(k, "d", 9000) for k in (0, 1)], [])
    assert chain.table("fct_orders").count() == 0
    chain.run(2, ORDERS_2[2:], [])
    assert [r.order_id for r in chain.table("fct_orders").collect()] == [50]


def test_few_keys_leave_the_stored_rows_where_they_are(spark, chain, monkeypatch):
    chain.run(0, ORDERS_1, CUSTOMERS_1)
    schema = pipeline.SCHEMAS["fct_orders"]
    keys = spark.createDataFrame([(1,), (None,)], "order_id bigint")
    rows_in = chain.table("fct_orders").filter("order_id = 1")
    for run, limit in ((1, 10), (2, 0)):
        monkeypatch.setattr(tables, "BROADCAST_KEYS", limit)
        touched = chain.wh.replace_keys("fct_orders", schema, rows_in, keys, "order_id", run)
        written = chain.wh.written("fct_orders", schema, run)
        assert rows(written) == rows(chain.wh.read("fct_orders", schema, touched))


def test_many_keys_give_the_same_tables(spark, chain, monkeypatch):
    monkeypatch.setattr(tables, "BROADCAST_KEYS", 0)
    chain.run(0, ORDERS_1, CUSTOMERS_1)
    chain.run(1, ORDERS_1[:3] + ORDERS_2, CUSTOMERS_2)
    assert built(chain) == expected(spark, ORDERS_1 + ORDERS_2, CUSTOMERS_1 + CUSTOMERS_2)


def test_only_touched_buckets_are_written(spark, chain):
    chain.run(0, ORDERS_1, CUSTOMERS_1)
    chain.run(1, [order(1, "u", 9000, customer_id=1, status="shipped", amount=1)], [])
    at_run = {(t, b): r for t, b, r in Warehouse(spark, chain.wh.base, 4).current_map()}
    runs = [r for (t, _), r in at_run.items() if t == "fct_orders"]
    assert sorted(runs).count(pipeline.run_number(RUNS[1])) == 1 and len(runs) == 4


def test_the_same_log_again_changes_nothing(spark, chain):
    chain.run(0, ORDERS_1, CUSTOMERS_1)
    before = built(chain)
    again = chain.run(1, ORDERS_1, CUSTOMERS_1)
    assert [(r.inserted, r.skipped) for r in again.loads] == [(0, 40), (0, 5)]
    assert built(chain) == before
    assert chain.table("customers_snapshot").count() == 5


def test_a_published_run_is_not_run_twice(chain):
    assert chain.run(0, ORDERS_1, CUSTOMERS_1).published
    assert not chain.run(0, ORDERS_1, CUSTOMERS_1).published


def test_a_failed_gate_keeps_the_old_version_and_the_next_run_catches_up(spark, chain):
    chain.run(0, ORDERS_1, CUSTOMERS_1)
    good = built(chain)
    bad = [order(60, "c", 4000, customer_id=1, status="unheard of", amount=1)]
    with pytest.raises(QualityGateError, match="accepted_values_stg_orders_status"):
        chain.run(1, ORDERS_2 + bad, CUSTOMERS_2, checks=pipeline.CHECKS)
    assert built(chain) == good
    audit = spark.read.parquet(f"{chain.wh.base}/audit/run={pipeline.run_number(RUNS[1])}")
    assert audit.filter("status = 'fail'").count() == 2 and audit.count() == 25
    # The events of the failed run were landed; the repair brings them all in.
    repair = [order(60, "u", 5000, customer_id=1, status="delivered", amount=1)]
    chain.run(2, repair, [])
    assert built(chain) == expected(spark, ORDERS_1 + ORDERS_2 + bad + repair, CUSTOMERS_1 + CUSTOMERS_2)


def test_a_run_repeated_after_a_crash_adds_nothing_twice(spark, chain, monkeypatch):
    chain.run(0, ORDERS_1, CUSTOMERS_1)
    good = built(chain)

    def crash(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(chain.wh, "publish", crash)
        with pytest.raises(OSError, match="lost"):
            chain.run(1, ORDERS_2, CUSTOMERS_2)
    assert built(chain) == good
    assert chain.run(1, ORDERS_2, CUSTOMERS_2).published
    assert built(chain) == expected(spark, ORDERS_1 + ORDERS_2, CUSTOMERS_1 + CUSTOMERS_2)


def test_orphans_block_and_severity_can_be_lowered(chain):
    orphan = [order(70, "c", 1, customer_id=77, status="pending", amount=1)]
    with pytest.raises(QualityGateError, match="relationships_stg_orders_customer_id"):
        chain.run(0, ORDERS_1 + orphan, CUSTOMERS_1, checks=pipeline.CHECKS)
    tolerant = [c for c in pipeline.CHECKS if c.kind != "relationships"]
    assert chain.run(1, [], [], checks=tolerant).published
    assert chain.table("fct_orders").filter("is_orphan_order").count() == 1


def test_watermark_mode_misses_late_events(chain):
    chain.run(0, ORDERS_1, CUSTOMERS_1, mode=incremental.EVENT_WATERMARK)
    chain.run(1, ORDERS_2, CUSTOMERS_2, mode=incremental.EVENT_WATERMARK)
    got = dict(rows(chain.table("fct_orders"), "order_id", "status"))
    assert (got[1], got[2], got[50], len(got)) == ("pending", "pending", "delivered", 41)


def test_a_reader_keeps_its_run_until_it_refreshes(spark, chain):
    chain.run(0, ORDERS_1, CUSTOMERS_1)
    reader = Warehouse(spark, chain.wh.base, buckets=4)
    assert pipeline.table(reader, "fct_orders").count() == 40
    chain.run(1, ORDERS_2, CUSTOMERS_2)
    assert pipeline.table(reader, "fct_orders").count() == 40
    reader.refresh()
    assert pipeline.table(reader, "fct_orders").count() == 40  # one deleted, one new
    assert pipeline.table(reader, "fct_orders").filter("order_id = 50").count() == 1


def test_raw_checks_see_a_repeated_id_of_a_new_load(spark, chain):
    chain.run(0, ORDERS_1, CUSTOMERS_1)
    # A load that went past the landing rules: one known id, one id twice.
    raw_path = chain.wh.raw_path("raw_orders_cdc")
    rogue = raw(spark, [ORDERS_1[0], ORDERS_2[2], ORDERS_2[2], ORDERS_2[0]])
    number = pipeline.run_number(RUNS[1])
    rogue.selectExpr("*", "current_timestamp() AS _loaded_at").write.parquet(f"{raw_path}/load_id={number}")
    ids = pipeline.checked_ids(chain.wh, pipeline.ORDERS)
    assert ids.count() == 5
    repeated = {r.event_id: r.n_rows for r in quality.repeated_values(ids, "event_id").collect()}
    assert repeated == {ORDERS_1[0]["event_id"]: 2, ORDERS_2[2]["event_id"]: 2}


def test_loads_of_a_stream_are_taken_in_once(spark, chain, tmp_path):
    chain.run(0, ORDERS_1, CUSTOMERS_1)
    write_lines(tmp_path / "stream" / "orders.jsonl", [line(e) for e in ORDERS_2])
    lines = landing.stream_lines(spark, str(tmp_path / "stream"))
    raw_path = chain.wh.raw_path("raw_orders_cdc")
    # The stream numbers its loads from 0, so below every run that was published.
    landing.start_landing(lines, raw_path, pipeline.ORDERS, str(tmp_path / "offsets")).awaitTermination()
    assert chain.wh.open_loads("raw_orders_cdc") == [0]
    chain.run(1, [], CUSTOMERS_2)
    assert built(chain) == expected(spark, ORDERS_1 + ORDERS_2, CUSTOMERS_1 + CUSTOMERS_2)
    reader = Warehouse(spark, chain.wh.base, buckets=4)
    assert reader.open_loads("raw_orders_cdc") == []
    assert reader.taken_loads("raw_orders_cdc") == [0, pipeline.run_number(RUNS[0])]


def test_loads_of_a_refused_run_stay_open(spark, chain):
    chain.run(0, ORDERS_1, CUSTOMERS_1)
    orphan = order(60, "c", 9000, customer_id=77, status="pending", amount=3)
    with pytest.raises(QualityGateError):
        chain.run(1, [orphan], [], checks=[c for c in pipeline.CHECKS if c.kind == "relationships"])
    assert Warehouse(spark, chain.wh.base, buckets=4).open_loads("raw_orders_cdc") == [
        pipeline.run_number(RUNS[1])]
    chain.run(2, [], [])
    assert built(chain) == expected(spark, [*ORDERS_1, orphan], CUSTOMERS_1)


def test_reports_over_the_published_tables(spark, chain):
    chain.run(0, ORDERS_1, CUSTOMERS_1)
    published = pipeline.published_tables(Warehouse(spark, chain.wh.base, buckets=4))
    reports = serving.reports(published, RUNS[0])
    assert reports["headline_kpis"].first().orders == 40
    layers = {r.layer: r.n_rows for r in reports["layer_counts"].collect()}
    assert layers["int_orders"] == layers["fct_orders"] == 40 and layers["dim_customers"] == 5
    assert {r.light for r in reports["scorecard"].collect()} == {"green", "red"}
    joined = "SELECT count(*) AS n FROM fct_orders JOIN dim_customers USING (customer_id)"
    got = serving.ad_hoc(spark, published, joined)
    assert got.first().n == 40


def test_deleting_a_whole_bucket_leaves_it_empty(chain):
    chain.run(0, ORDERS_1, CUSTOMERS_1)
    chain.run(1, [order(k, "d", 9000 + k) for k in range(40)], [])
    assert chain.table("fct_orders").count() == 0
    assert chain.table("state_orders").count() == 40


def test_another_number_of_buckets_is_refused(spark, chain):
    chain.run(0, ORDERS_1, CUSTOMERS_1)
    with pytest.raises(ValueError, match="4 buckets"):
        Warehouse(spark, chain.wh.base, buckets=7).last_run()


@pytest.mark.parametrize("mode", [pipeline.AFFECTED_KEYS, pipeline.EVENT_WATERMARK])
def test_rows_without_a_key_are_published(chain, mode):
    nameless = order(None, "c", 9000, customer_id=1, status="pending", amount=3)
    chain.run(0, ORDERS_1, CUSTOMERS_1, mode=mode)
    chain.run(1, [*ORDERS_1, nameless], CUSTOMERS_1, mode=mode)
    found = [r.order_id for r in chain.table("fct_orders").collect()]
    assert len(found) == 41 and found.count(None) == 1
