from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from changefold.config import CUSTOMERS, ORDERS
from changefold.functions.payload import event_id
from changefold.plans.staging import stg_orders
from changefold.sources import derived, events, routing
from checks.queries import QUERIES
from tests.conftest import event, line, rows, write_lines

T0 = datetime(2026, 1, 1)


def load(spark, tmp_path, lines, load_id=1, name="in"):
    path = write_lines(tmp_path / name / "orders.jsonl", lines)
    result = events.land(
        spark, events.read_lines(spark, path), str(tmp_path / "raw"), ORDERS, load_id, T0
    )
    return result, events.read_raw(spark, str(tmp_path / "raw"))


def test_blank_lines_are_skipped(spark, tmp_path):
    result, raw = load(spark, tmp_path, ["", line(event(1, "c", 1)), "   ", "\t", line(event(2, "c", 2))])
    assert (result.read, result.inserted, result.skipped) == (2, 2, 0)
    assert raw.count() == 2


def test_missing_and_empty_files_give_no_rows(spark, tmp_path):
    for lines in (events.read_lines(spark, str(tmp_path / "nowhere")),
                  events.read_lines(spark, write_lines(tmp_path / "empty.jsonl", []))):
        r = events.land(spark, lines, str(tmp_path / "raw"), ORDERS, 1, T0)
        assert (r.read, r.inserted, r.skipped) == (0, 0, 0)
    assert events.read_raw(spark, str(tmp_path / "raw")).count() == 0


@pytest.mark.parametrize("bad", [
    "{bad",
    "not json at all",
    '{"event_id":null,"op":"c","ts_ms":1,"source":{"table":"orders","lsn":1},"after":{}}',
    '{"op":"c","ts_ms":1,"source":{"table":"orders","lsn":1},"after":{}}',
    '{"event_id":"x","ts_ms":1,"source":{"table":"orders","lsn":1},"after":{}}',
    '{"event_id":"x","op":"c","source":{"table":"orders","lsn":1},"after":{}}',
    '{"event_id":"x","op":"c","ts_ms":1,"after":{}}',
    '{"event_id":"x","op":"c","ts_ms":1,"source":{"table":"orders"},"after":{}}',
    '{"event_id":"x","op":"c","ts_ms":"soon","source":{"table":"orders","lsn":1},"after":{}}',
])
def test_a_line_that_is_no_event_stops_the_load(spark, tmp_path, bad):
    with pytest.raises(Exception, match="(?i)malformed|without|FAILED_READ|WRITE"):
        load(spark, tmp_path, [line(event(1, "c", 1)), bad])
    assert events.read_raw(spark, str(tmp_path / "raw")).count() == 0


def test_explicit_nulls_and_missing_payloads_are_allowed(spark, tmp_path):
    _, raw = load(spark, tmp_path, [
        '{"event_id":"x","op":null,"ts_ms":null,"source":{"table":"orders","lsn":null}}'
    ])
    r = raw.first()
    assert (r.op, r.ts_ms, r.lsn, r.before_json, r.after_json) == (None, None, None, "null", "null")


def test_first_copy_wins_in_the_batch_and_across_loads(spark, tmp_path):
    a = line(event(1, "c", 1, event_id="same", status="first"))
    b = line(event(1, "c", 1, event_id="same", status="second"))
    r1, raw = load(spark, tmp_path, [a, b, a])
    assert (r1.read, r1.inserted, r1.skipped) == (3, 1, 2)
    r2, raw = load(spark, tmp_path, [b, line(event(2, "c", 2))], load_id=2, name="again")
    assert (r2.inserted, r2.skipped) == (1, 1)
    assert '"first"' in raw.filter("event_id = 'same'").first().after_json


def test_first_copy_is_told_by_file_order_over_many_splits(spark, tmp_path):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        lines = [line(event(k % 50, "c", k, event_id=f"e{k % 50}", nth=k)) for k in range(1000)]
        _, raw = load(spark, tmp_path, lines)
        got = raw.select(F.get_json_object("after_json", "$.nth").cast("int").alias("nth"))
        assert sorted(r.nth for r in got.collect()) == list(range(50))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_reload_adds_nothing_and_a_repeated_load_rewrites_itself(spark, tmp_path):
    lines = [line(event(k, "c", k)) for k in range(20)]
    load(spark, tmp_path, lines, load_id=1)
    again, raw = load(spark, tmp_path, lines, load_id=2)
    assert (again.inserted, again.skipped) == (0, 20)
    repeated, raw = load(spark, tmp_path, lines, load_id=1)
    assert repeated.inserted == 20
    assert raw.count() == 20 and raw.select("event_id").distinct().count() == 20


def test_both_ways_to_compare_with_history_agree(spark, tmp_path):
    batch = spark.range(100).selectExpr("string(id % 60) AS event_id", "id AS _row")
    history = spark.range(40, 200).selectExpr("string(id) AS event_id")
    sent = events.new_events(batch, history, ["_row"], batch_bytes=1000)
    shuffled = events.new_events(batch, history, ["_row"], batch_bytes=None)
    assert rows(sent) == rows(shuffled) == sorted((str(i),) for i in range(40))


def test_unknown_attributes_are_kept_and_missing_ones_defaulted(spark, tmp_path):
    _, raw = load(spark, tmp_path, [
        line(event(1, "c", 1, status="pending", colour={"r": 1})),
        line(event(2, "c", 2, status="pending", currency="GBP")),
    ])
    assert raw.filter("after_json LIKE '%colour%'").count() == 1
    assert rows(stg_orders(raw), "order_id", "currency") == [(1, "INR"), (2, "GBP")]


def test_routing_by_source_table(spark):
    lines = [line(event(1, "c", 1)), line(event(9, "c", 2, table="customers"))]
    df = events.parse_events(spark.createDataFrame([(x,) for x in lines], "value string"))
    got = {c.raw_table: part.count() for c, part in events.route(df, [ORDERS, CUSTOMERS])}
    assert got == {"raw_orders_cdc": 1, "raw_customers_cdc": 1}


def test_load_report_totals(spark):
    loads = [events.LoadResult("a", 10, 7), events.LoadResult("b", 5, 5)]
    assert rows(events.load_report(spark, loads)) == [
        ("a", 10, 7, 3), ("b", 5, 5, 0), ("total", 15, 12, 3)
    ]


def test_event_id_is_the_hash_of_its_parts(spark):
    import hashlib

    df = spark.range(1).select(
        event_id("orders", F.lit(7), F.lit("u"), F.lit(1234), F.lit(99)).alias("id")
    )
    assert df.first().id == hashlib.sha1(b"orders|7|u|1234|99").hexdigest()[:16]


def test_written_lines_land_again(spark, tmp_path):
    log = derived.customer_log(spark, "/root/testdata/sf0.001")
    events.write_lines(derived.log_lines(log), str(tmp_path / "log"))
    lines = events.read_lines(spark, str(tmp_path / "log" / "source_table=customers"))
    r = events.land(spark, lines, str(tmp_path / "raw"), CUSTOMERS, 1, T0)
    assert r.inserted == log.select("event_id").distinct().count() and r.skipped > 0


def test_ids_are_read_as_whole_events_are(spark):
    made = [event(k, "u", 5, lsn=k, table=t, n="x" * k) for k in range(1, 5) for t in ("orders", "customers")]
    lines = spark.createDataFrame([(line(e),) for e in made], "value string")
    whole = events.parse_events(lines)
    assert rows(events.parse_ids(lines)) == rows(whole, "event_id")
    assert rows(events.parse_ids(lines, source_table=True)) == rows(whole, "event_id", "source_table")
    # The images are not read for them.
    fields = events.parse_ids(lines)._jdf.queryExecution().optimizedPlan().toString()
    assert "lsn" not in fields and "before" not in fields
    for bad in ('{"op":"c"}', '{"event_id":'):
        with pytest.raises(Exception, match="event_id|MALFORMED_RECORD"):
            events.parse_ids(spark.createDataFrame([(bad,)], "value string")).collect()


@pytest.fixture
def no_merging(spark):
    """Partitions of a shuffle stay as they were asked for."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    yield
    spark.conf.unset(key)


def test_what_a_task_sorts_is_bounded(spark, tmp_path, monkeypatch, no_merging):
    """The session asks for two shuffle partitions; a load asks for as many as its lines need."""
    lines = [line(event(k, "c", k)) for k in range(40)]
    monkeypatch.setattr(events, "TASK_LINES", 5)
    result, raw = load(spark, tmp_path, lines)
    assert result.inserted == raw.count() == 40 and len(raw.inputFiles()) > 2
    monkeypatch.setattr(routing, "TASK_LINES", 5)
    text = events.read_lines(spark, str(tmp_path / "in" / "orders.jsonl"))
    routing.land_mixed(spark, text, str(tmp_path / "mixed"), [ORDERS, CUSTOMERS], 1, T0)
    mixed = events.read_raw(spark, routing.table_path(str(tmp_path / "mixed"), ORDERS.raw_table))
    assert mixed.count() == 40 and len(mixed.inputFiles()) > 2
    assert spark.conf.get("spark.sql.shuffle.partitions") == "2"


@pytest.mark.parametrize("name", ["landing_orders_raw", "landing_ids_assigned"])
def test_first_copies_are_sorted_by_as_many_tasks_as_there_are_orders(spark, tmp_path, monkeypatch, no_merging, name):
    monkeypatch.setattr(derived, "TASK_ROWS", 10)
    spark.range(80).selectExpr(
        "id AS o_orderkey", "id % 7 AS o_custkey", "double(id) AS o_totalprice",
        "TIMESTAMP_NTZ '1997-01-01 00:00:00' AS o_orderdate").coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    found = QUERIES[name](spark, str(tmp_path))
    assert len(found.inputFiles()) > 2
    assert found.select("event_id").distinct().count() == found.count() > 80


def refuse_images(monkeypatch):
    """Whoever reads whole events from now on fails; to plan for them is allowed."""
    parse = events.parse_events

    def refused(lines, extra=()):
        found = parse(lines, extra)
        return found.withColumn("after_json", F.raise_error(F.concat(F.lit("read: "), "event_id")).cast("string"))

    monkeypatch.setattr(events, "parse_events", refused)
    monkeypatch.setattr(routing, "parse_events", refused)


def test_a_batch_without_news_is_told_by_its_ids(spark, tmp_path, monkeypatch):
    lines = [line(event(k, "c", k)) for k in range(20)]
    load(spark, tmp_path, lines + lines[:3])
    text = events.read_lines(spark, str(tmp_path / "in" / "orders.jsonl"))
    routing.land_mixed(spark, text, str(tmp_path / "mixed"), [ORDERS], 1, T0)
    refuse_images(monkeypatch)
    again, raw = load(spark, tmp_path, lines + lines[:3], load_id=2)
    assert (again.read, again.inserted, again.skipped) == (23, 0, 23) and raw.count() == 20
    mixed = routing.land_mixed(spark, text, str(tmp_path / "mixed"), [ORDERS], 2, T0)
    assert [(r.read, r.inserted) for r in mixed] == [(23, 0), (0, 0)]
    with pytest.raises(Exception, match="read: "):
        load(spark, tmp_path, [*lines, line(event(99, "c", 99))], load_id=3)


@pytest.mark.parametrize("bad", [
    '{"event_id":"orders-1-c-1-1","ts_ms":1,"source":{"table":"orders","lsn":1},"after":{}}',
    '{"event_id":"orders-1-c-1-1","op":"c","source":{"table":"orders","lsn":1},"after":{}}',
    '{"event_id":"orders-1-c-1-1","op":"c","ts_ms":1,"after":{}}',
    '{"event_id":"orders-1-c-1-1","op":"c","ts_ms":1,"source":{"table":"orders"},"after":{}}',
    '{"event_id":"orders-1-c-1-1","op":"c","ts_ms":"soon","source":{"table":"orders","lsn":1},"after":{}}',
    '{"event_id":"orders-1-c-1-1","op":"c","ts_ms":1,"source":{"table":"orders","lsn":1},"after":{',
])
def test_a_known_id_does_not_excuse_a_line_that_is_no_event(spark, tmp_path, bad):
    known = line(event(1, "c", 1))
    load(spark, tmp_path, [known])
    with pytest.raises(Exception, match="(?i)malformed|without|FAILED_READ|WRITE"):
        load(spark, tmp_path, [known, bad], load_id=2, name="again")


@pytest.mark.parametrize("most", [0, 1_000_000])
def test_first_copies_of_new_ids_are_landed_by_broadcast_and_by_shuffle(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(events, "BROADCAST_BATCH_BYTES", most)
    copies = [line(event(k % 30, "c", 1, event_id=f"e{k % 30}", nth=k)) for k in range(90)]
    load(spark, tmp_path, copies[:10])
    result, raw = load(spark, tmp_path, copies, load_id=2, name="all")
    assert (result.read, result.inserted) == (90, 20)
    nth = F.get_json_object("after_json", "$.nth").cast("int").alias("nth")
    assert rows(raw.select("load_id", nth)) == [(1, k) for k in range(10)] + [(2, k) for k in range(10, 30)]


@pytest.mark.parametrize("most", [0, 1_000_000])
def test_lines_are_parsed_once_for_the_events_of_new_ids(spark, tmp_path, monkeypatch, most):
    """No test of an id is pushed below the parser, where it would parse each line again."""
    monkeypatch.setattr(events, "BROADCAST_BATCH_BYTES", most)
    parsed = events.parse_events(events.read_lines(spark, write_lines(tmp_path / "x.jsonl", [line(event(1, "c", 1))])),
                                 events.ARRIVAL)
    ids = spark.createDataFrame([("orders-1-c-1-1",)], "event_id string")
    told, size = events.told_apart(ids, ids.limit(0), ["event_id"], 0)
    found = events.first_of_new(parsed, told, size, ["event_id"])
    assert found.count() == 1
    assert found._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
