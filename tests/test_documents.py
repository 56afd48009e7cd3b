"""Payloads as variants, drift found in them, customers from sketches, one pass landing."""

from __future__ import annotations

import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from changefold.config import CUSTOMERS, ORDERS
from changefold.plans import drift, sketches, staging
from changefold.sources import events, routing, variants
from tests.conftest import event, line, raw, rows

T0 = datetime(2026, 1, 1)
LOG = [event(k % 9, "ccuuurd"[k % 7], 100 + k, customer_id=[k, str(k)][k % 2], status=["pending", None][k % 2],
             amount=[12.5, "7.25", "n/a", None, 1e3, 3][k % 6], created_at="2025-06-01T00:00:00+00:00") for k in range(60)]


def test_staging_from_documents_equals_the_text_form(spark, tmp_path):
    variants.write_documents(raw(spark, LOG[:40]), str(tmp_path), 1)
    variants.write_documents(raw(spark, LOG[40:]), str(tmp_path), 2)
    docs = variants.read_documents(spark, str(tmp_path))
    assert rows(staging.staged_documents(docs, ORDERS)) == rows(staging.stg_orders(raw(spark, LOG)))
    variants.write_documents(raw(spark, LOG[40:]), str(tmp_path), 2)
    assert variants.read_documents(spark, str(tmp_path)).count() == len(LOG)
    assert rows(staging.staged_documents(docs.limit(0), ORDERS)) == []


def test_documents_are_not_parsed_again(spark, tmp_path):
    def parsers(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        return sum(plan.count(x) for x in ("get_json_object", "json_tuple", "parse_json", "from_json"))

    variants.write_documents(raw(spark, LOG), str(tmp_path), 1)
    assert parsers(staging.staged_documents(variants.read_documents(spark, str(tmp_path)), ORDERS)) == 0
    assert parsers(staging.stg_orders(raw(spark, LOG))) > 0


def test_drift_is_told_without_knowing_the_fields(spark):
    def payloads(*texts):
        return spark.createDataFrame([(t,) for t in texts], "after_json string")

    known = drift.profile(payloads('{"a":1,"b":"x","c":null,"old":true}', '{"a":2.5,"b":null}', "null", None))
    found = drift.profile(payloads('{"a":"1","b":"y","c":[1],"new":{"x":1}}', "[1]", '{"a":3}'))
    told = {r.field: (r.change, r.kinds_before, r.kinds_found, r.events) for r in drift.drift(known, found).collect()}
    assert told == {
        "a": ("retyped", "number", "number,string", 2), "b": ("same", "string", "string", 1),
        "c": ("retyped", "", "array", 1), "old": ("gone", "boolean", "", 0), "new": ("added", "", "object", 1)}
    after = drift.drift(drift.accepted(known, found), found)
    assert {r.change for r in after.collect()} == {"same", "gone"}
    assert drift.drift(known.limit(0), known.limit(0)).count() == 0


@pytest.fixture(scope="module")
def fact(spark):
    rng = random.Random(1)
    made = [(datetime(2025, 1, rng.randint(1, 9)) if k % 50 else None, rng.choice(["IN", "US", None]),
             rng.randint(0, 3000) if k % 40 else None) for k in range(20000)]
    return spark.createDataFrame(made, "created_at timestamp_ntz, country string, customer_id bigint")


@pytest.mark.parametrize(("first", "last"), [(None, None), (2, 4), (9, 9)])
@pytest.mark.parametrize("by", [[], ["country"], ["order_date"]])
def test_estimates_of_any_range_are_near(spark, fact, first, last, by):
    days = [None if d is None else date(2025, 1, d) for d in (first, last)]
    told = {tuple(r)[:-1]: r.customers for r in sketches.distinct_customers(
        sketches.daily_sketches(fact), *days, by=by).collect()}
    real = fact.withColumn("order_date", F.to_date("created_at")).filter("order_date IS NOT NULL")
    real = real.filter(F.dayofmonth("order_date").between(first or 1, last or 9)).groupBy(*by).agg(
        F.count_distinct("customer_id").alias("n"))
    exact = {tuple(r)[:-1]: r.n for r in real.collect()}
    assert told.keys() == exact.keys()
    assert all(abs(told[k] - n) <= 4 * sketches.standard_error() * n + 1 for k, n in exact.items())


def test_sketches_grow_and_are_made_anew(spark, fact):
    early, late = fact.filter("customer_id % 2 = 0"), fact.filter("customer_id % 2 = 1")
    both = sketches.united(sketches.daily_sketches(early), sketches.daily_sketches(late))
    whole = sketches.daily_sketches(fact.filter("customer_id IS NOT NULL"))
    assert rows(sketches.distinct_customers(both, by=["order_date"])) == rows(sketches.distinct_customers(whole, by=["order_date"]))
    moved = fact.filter("NOT (day(created_at) = 3 AND customer_id < 2000)")
    days = spark.createDataFrame([(date(2025, 1, 3),)], "order_date date")
    again = sketches.remade(sketches.daily_sketches(fact), moved, days)
    assert rows(sketches.distinct_customers(again, by=["order_date", "country"])) == rows(
        sketches.distinct_customers(sketches.daily_sketches(moved), by=["order_date", "country"]))
    assert sketches.distinct_customers(again.limit(0)).first().customers == 0


def mixed(spark, *parts):
    lines = [line(e) for part in parts for e in part]
    return spark.createDataFrame([(x, "f", 0, i) for i, x in enumerate(lines)],
                                 "value string, _file string, _offset long, _row long").repartition(3)


def test_a_mixed_log_is_landed_in_one_pass(spark, tmp_path):
    orders = [event(k, "c", k, event_id=f"o{k % 8}") for k in range(10)]
    customers = [event(k, "c", k, table="customers", event_id=f"o{k}") for k in range(4)]  # ids of their own
    strange = [{**event(1, "c", 1), "source_table": "audit", "event_id": "x"}] * 2
    base = str(tmp_path / "raw")
    first = routing.land_mixed(spark, mixed(spark, orders, customers, strange), base, [ORDERS, CUSTOMERS], 1, T0)
    assert [(r.table, r.read, r.inserted) for r in first] == [
        ("raw_orders_cdc", 10, 8), ("raw_customers_cdc", 4, 4), ("dead_letters", 2, 1)]
    more = [event(7, "u", 9, event_id="new")]
    again = routing.land_mixed(spark, mixed(spark, orders, more), base, [ORDERS, CUSTOMERS], 2, T0)
    assert [(r.read, r.inserted) for r in again] == [(11, 1), (0, 0), (0, 0)]
    landed = events.read_raw(spark, routing.table_path(base, "raw_orders_cdc"))
    assert rows(landed, "event_id", "load_id") == sorted([(f"o{k}", 1) for k in range(8)] + [("new", 2)], key=repr)
    # A repeated load rewrites its own folders, and those only.
    repeated = routing.land_mixed(spark, mixed(spark, orders, customers, strange), base, [ORDERS, CUSTOMERS], 1, T0)
    assert [r.inserted for r in repeated] == [8, 4, 1]
    assert events.read_raw(spark, routing.table_path(base, "raw_orders_cdc")).count() == 9
    assert staging.stg_customers(events.read_raw(spark, routing.table_path(base, "raw_customers_cdc"))).count() == 4


def test_the_lines_are_scanned_once_for_all_tables(spark, tmp_path, monkeypatch):
    """One write, whose plan has one scan of the text however many tables there are."""
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "a.jsonl").write_text("".join(line(e) + "\n" for e in LOG))
    plans = []
    real = routing.parse_events

    def spying(*a, **k):
        out = real(*a, **k)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(routing, "parse_events", spying)
    many = [ORDERS, CUSTOMERS, *(type(ORDERS)(f"t{k}", f"raw_{k}", "k", ()) for k in range(4))]
    routing.land_mixed(spark, events.read_lines(spark, str(tmp_path / "log")), str(tmp_path / "raw"), many, 1, T0)
    assert len(plans) == 1 and plans[0].count("FileScan text") == 1
