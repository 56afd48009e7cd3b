from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from changefold.config import ORDERS
from changefold.plans import pipeline, staging
from changefold.sources import derived, events
from changefold.sources.tables import Warehouse
from changefold.streaming import landing, state
from tests.conftest import event, line, raw, rows, write_lines

NOW = 1_700_000_000_000
LOG = [event(k % 7, "cuudr"[k % 5], NOW + 10 * (k % 11) + k % 3, lsn=k, n=k) for k in range(40)]
COPIES = LOG + LOG[::3]
STATE = ("order_id", "_last_op", "ts_ms", "lsn", "event_id")


def split(items, ways):
    return [items[i::ways] for i in range(ways)]


@pytest.mark.parametrize("ways", [1, 4])
def test_streams_end_where_the_batch_does(spark, tmp_path, ways):
    for i, part in enumerate(split(COPIES, ways)):
        write_lines(tmp_path / "log" / f"{i}.jsonl", [line(e) for e in part] + [""])
    lines = landing.stream_lines(spark, str(tmp_path / "log"), files_per_batch=1)
    landing.start_landing(lines, str(tmp_path / "raw"), ORDERS, str(tmp_path / "cp")).awaitTermination()
    landed = events.read_raw(spark, str(tmp_path / "raw"))
    assert rows(landed, "event_id") == rows(raw(spark, LOG), "event_id")
    # Each micro-batch left its figures; one that is landed again leaves its own once more.
    figures = events.logged_report(spark, [str(tmp_path / "raw")])
    assert rows(figures) == [(t, len(COPIES), len(LOG), len(COPIES) - len(LOG)) for t in ("raw_orders_cdc", "total")]
    assert events.logged_loads(spark, str(tmp_path / "raw")).count() == ways

    wh = Warehouse(spark, str(tmp_path / "tables"), buckets=3)
    stream = state.stream_raw(spark, str(tmp_path / "raw"), files_per_batch=2)
    state.start_state(stream, wh, "state_orders", ORDERS, str(tmp_path / "cp2")).awaitTermination()
    got = pipeline.table(wh, "state_orders")
    assert rows(got, *STATE) == rows(staging.fold(raw(spark, LOG), ORDERS), *STATE)


def test_only_new_files_are_taken_in(spark, tmp_path):
    def land():
        lines = landing.stream_lines(spark, str(tmp_path / "log"))
        landing.start_landing(lines, str(tmp_path / "raw"), ORDERS, str(tmp_path / "cp")).awaitTermination()
        return events.read_raw(spark, str(tmp_path / "raw")).count()

    write_lines(tmp_path / "log" / "a.jsonl", [line(e) for e in LOG[:2]])
    assert land() == 2
    write_lines(tmp_path / "log" / "b.jsonl", [line(e) for e in LOG[1:4]])
    assert land() == 4
    assert land() == 4


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "tables"), buckets=3)
    fold_in = state.fold_batch(wh, "state_orders", ORDERS)
    first, second = raw(spark, LOG[:25]), raw(spark, LOG[20:])

    def batch(df):
        return df.withColumn("_loaded_at", F.lit(datetime(2026, 1, 1))).withColumn("load_id", F.lit(1))

    for df, number in ((first, 0), (first, 0), (second, 1), (first, 0), (second, 1)):
        fold_in(batch(df), number)
    got = rows(pipeline.table(wh, "state_orders"), *STATE)
    assert got == rows(staging.fold(raw(spark, LOG), ORDERS), *STATE)


def test_running_state_and_bounded_deduplication(spark, tmp_path):
    write_lines(tmp_path / "log" / "a.jsonl", [line(e) for e in COPIES])
    lines = landing.stream_lines(spark, str(tmp_path / "log"))

    def collect(df, mode, name):
        q = (df.writeStream.format("memory").queryName(name).outputMode(mode)
             .option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start())
        q.awaitTermination()
        return spark.table(name)

    parsed = events.parse_events(lines)
    newest = collect(state.running_state(parsed, ORDERS), "complete", "running")
    expected = staging.fold(raw(spark, LOG), ORDERS)
    assert rows(newest, "order_id", "ts_ms", "lsn") == rows(expected, "order_id", "ts_ms", "lsn")
    distinct = collect(landing.distinct_within(lines, "1 day"), "append", "bounded")
    assert rows(distinct, "event_id") == rows(raw(spark, LOG), "event_id")


def test_micro_batches_follow_what_is_landed_not_its_files(spark, tmp_path):
    landed = raw(spark, LOG).withColumn("_loaded_at", F.lit(datetime(2026, 1, 1)))
    landed.repartition(30).write.parquet(str(tmp_path / "raw" / "load_id=1"))
    stream = state.stream_raw(spark, str(tmp_path / "raw"), epochs=3)
    wh = Warehouse(spark, str(tmp_path / "tables"), buckets=2)
    state.start_state(stream, wh, "state_orders", ORDERS, str(tmp_path / "cp")).awaitTermination()
    assert 1 < wh.last_run() <= 4
    assert rows(pipeline.table(wh, "state_orders"), *STATE) == rows(staging.fold(raw(spark, LOG), ORDERS), *STATE)


def test_a_written_log_is_dealt_to_bounded_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(derived, "TASK_ROWS", 50)
    orders = [(k, k % 9, 10.0 + k, datetime(1997, 1, 1)) for k in range(600)]
    (tmp_path / "sf").mkdir()
    spark.createDataFrame(orders, "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp_ntz").coalesce(
        1).write.parquet(str(tmp_path / "sf" / "orders.parquet"))
    log = derived.order_log(spark, str(tmp_path / "sf"))
    assert log.rdd.getNumPartitions() == 12
    per_batch = derived.write_log(log, str(tmp_path / "log"), 2)
    assert 10 <= per_batch <= 13
    written = spark.read.text(str(tmp_path / "log"))
    assert rows(written) == rows(derived.log_lines(log).select("value"))
    # Copies of an event stand in more than one file.
    lines = landing.stream_lines(spark, str(tmp_path / "log"), files_per_batch=per_batch)
    landing.start_landing(lines, str(tmp_path / "raw"), ORDERS, str(tmp_path / "cp")).awaitTermination()
    assert 2 <= events.logged_loads(spark, str(tmp_path / "raw")).count() <= 3
    got = events.read_raw(spark, str(tmp_path / "raw"))
    assert rows(got, "event_id") == rows(log.select("event_id").distinct())
