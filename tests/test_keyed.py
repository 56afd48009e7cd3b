"""The stateful operator against the fold, over several epochs and a restart."""

from __future__ import annotations

import json
import time

import pandas as pd
import pytest
from pyspark.sql import Row
from pyspark.sql.streaming.stateful_processor import TimerValues

from changefold.config import ORDERS
from changefold.plans import staging
from changefold.streaming import keyed, state
from tests.conftest import event, raw, rows

NOW = 1_700_000_000_000
LOG = [event(k % 7, "cuudr"[k % 5], NOW + 10 * (k % 11) + k % 3, lsn=k, n=k) for k in range(40)]
COLUMNS = ("order_id", "ts_ms", "lsn", "event_id")


@pytest.fixture
def stream(spark, tmp_path):
    def land(load, events):
        raw(spark, events).selectExpr("*", "current_timestamp() AS _loaded_at").coalesce(1).write.parquet(
            f"{tmp_path}/raw/load_id={load}")

    def take_in(**settings):
        events = state.stream_raw(spark, f"{tmp_path}/raw", files_per_batch=1)
        query = keyed.start_newest(keyed.newest_events(events, ORDERS, **settings), f"{tmp_path}/out", f"{tmp_path}/cp")
        query.awaitTermination()
        return keyed.newest_now(spark, f"{tmp_path}/out", ORDERS)

    return land, take_in


def test_epochs_and_a_restart_end_where_the_fold_does(spark, tmp_path, stream):
    land, take_in = stream
    for load in range(2):
        land(load, LOG[load:20:2] + LOG[:2])
    assert rows(take_in(), *COLUMNS) == rows(staging.fold(raw(spark, LOG[:20]), ORDERS), *COLUMNS)
    # A new query goes on from the state in the store: what is late or known is not sent.
    late = [event(k, "u", 1, lsn=900 + k, n="late") for k in range(7)]
    land(2, LOG[:20] + late)
    take_in()
    assert spark.read.parquet(f"{tmp_path}/out").filter("epoch = 2").count() == 0
    land(3, LOG)
    got = take_in()
    assert rows(got, *COLUMNS) == rows(staging.fold(raw(spark, LOG), ORDERS), *COLUMNS)
    assert take_in().count() == got.count()  # nothing new
    sent = spark.read.parquet(f"{tmp_path}/out").filter("epoch = 3")
    assert 0 < sent.count() <= 7 and sent.select("order_id").distinct().count() == sent.count()


def test_tombstones_are_forgotten_after_their_time(spark, tmp_path, stream):
    """An older event counts again once the tombstone is gone, and not before."""
    land, take_in = stream
    older = event(1, "u", NOW - 5, lsn=1, n="older")
    land(0, [event(1, "d", NOW, lsn=2), event(2, "d", NOW, lsn=2), event(3, "c", NOW, lsn=2)])
    land(1, [event(2, "c", NOW + 1, lsn=9)])  # comes back, so its timer is taken back
    take_in(forget_ms=1_000)
    time.sleep(1.2)
    land(2, [event(4, "c", NOW, lsn=3)])  # timers run with the next epoch
    take_in(forget_ms=1_000)
    land(3, [older, event(2, "u", NOW - 5, lsn=1), event(3, "u", NOW - 5, lsn=1)])
    take_in(forget_ms=1_000)
    sent = spark.read.parquet(f"{tmp_path}/out").filter("epoch = 3").collect()
    assert {r.order_id: r.op for r in sent} == {1: "u"}


def test_a_key_goes_to_the_store_once_to_read_and_once_to_write():
    """Each call of a state is a way to the store and back, for every key of an epoch."""
    calls = []

    class Value:
        def __init__(self):
            self.value = None

        def get(self):
            calls.append("get")
            return self.value

        def exists(self):
            calls.append("exists")
            return self.value is not None

        def update(self, value):
            calls.append("update")
            self.value = value

    keeper = keyed.NewestEvent("order_id")
    keeper.newest = Value()
    newer = Row(ts_ms=2, lsn=2, event_id="b", op="u", after_json="{}")
    older = Row(ts_ms=1, lsn=1, event_id="a", op="c", after_json="{}")
    for batch, sent in (([older], 1), ([newer, older], 1), ([older, newer], 0)):
        assert len(list(keeper.handleInputRows((7,), iter(batch), None))) == sent
    assert keeper.newest.value == (2, 2, "b", "u", "{}")
    assert calls == ["get", "update", "get", "update", "get"]


GROUPED = LOG + [event(None, "c", NOW, lsn=90, after={}), event(9_007_199_254_740_993, "c", NOW, lsn=91, note='"\t ')]


def test_groups_of_keys_end_where_the_fold_does(spark, tmp_path, stream):
    land, take_in = stream
    for load in range(2):
        land(load, GROUPED[load:20:2] + GROUPED[:2])
    assert rows(take_in(groups=3), *COLUMNS) == rows(staging.fold(raw(spark, GROUPED[:20]), ORDERS), *COLUMNS)
    late = [event(k, "u", 1, lsn=900 + k, n="late") for k in range(7)]
    land(2, GROUPED[:20] + late)
    take_in(groups=3)
    assert spark.read.parquet(f"{tmp_path}/out").filter("epoch = 2").count() == 0
    land(3, GROUPED)
    got = take_in(groups=3)
    assert rows(got, *COLUMNS) == rows(staging.fold(raw(spark, GROUPED), ORDERS), *COLUMNS)
    images = {r.event_id: r.after_json for r in got.collect()}
    assert all(images[e["event_id"]] == e["after_json"] for e in GROUPED if e["event_id"] in images)
    sent = spark.read.parquet(f"{tmp_path}/out").filter("epoch = 3")
    assert 2 < sent.count() <= 9 and sent.select("order_id").distinct().count() == sent.count()


def test_groups_forget_tombstones_after_their_time(spark, tmp_path, stream):
    land, take_in = stream
    land(0, [event(1, "d", NOW, lsn=2), event(2, "d", NOW, lsn=2), event(3, "c", NOW, lsn=2)])
    land(1, [event(2, "c", NOW + 1, lsn=9)])  # comes back, so its timer finds nothing
    take_in(forget_ms=1_000, groups=1)
    time.sleep(1.2)
    land(2, [event(4, "c", NOW, lsn=3)])  # timers run with the next epoch
    take_in(forget_ms=1_000, groups=1)
    land(3, [event(k, "u", NOW - 5, lsn=1) for k in (1, 2, 3)])
    take_in(forget_ms=1_000, groups=1)
    sent = spark.read.parquet(f"{tmp_path}/out").filter("epoch = 3").collect()
    assert {r.order_id: r.op for r in sent} == {1: "u"}


class Store:
    """A value state and a handle that count the ways to the store."""

    def __init__(self):
        self.value, self.calls, self.timers = None, [], []

    def get(self):
        self.calls.append("get")
        return self.value

    def update(self, value):
        self.calls.append("update")
        self.value = value

    def clear(self):
        self.calls.append("clear")
        self.value = None

    def registerTimer(self, at):
        self.timers.append(at)


def grouped(now, store, events=None, **settings):
    """The keys of ``events`` that one epoch sends, or those left after a timer."""
    keeper = keyed.NewestOfGroup("order_id", **settings)
    keeper.newest = keeper.handle = store
    clock = TimerValues(now)
    if events is None:
        list(keeper.handleExpiredTimer((0,), clock, None))
        return sorted(int(k) for k in keeper._held())
    texts = [json.dumps([str(k), str(ts), str(ts), f"e{ts}", op, "{}"]) for k, op, ts in events]
    frames = [pd.DataFrame({"key_group": 0, "event": texts[i:i + 2]}) for i in range(0, len(texts), 2)]
    sent = [f for f in keeper.handleInputRows((0,), iter(frames), clock)]
    return sorted(k for f in sent for k in f["order_id"])


def test_a_group_goes_to_the_store_once_to_read_and_once_to_write():
    store = Store()
    assert grouped(0, store, [(k, "c", 10) for k in range(50)]) == [*range(50)]
    assert grouped(0, store, [(k, "u", 10 + k % 2) for k in range(50)]) == [*range(1, 50, 2)]
    assert grouped(0, store, [(k, "u", 9) for k in range(50)]) == []
    assert store.calls == ["get", "update", "get", "update", "get"] and store.timers == []


def test_a_tombstone_of_a_group_stops_older_events_until_its_timer():
    store, forget = Store(), {"forget_ms": 100}
    assert grouped(0, store, [(1, "d", 10), (2, "d", 10), (3, "c", 10)], **forget) == [1, 2, 3]
    assert grouped(50, store, [(2, "d", 11)], **forget) == [2]
    assert grouped(120, store, [(1, "u", 9), (3, "u", 9)], **forget) == []
    assert store.timers == [100, 150]
    assert grouped(120, store, **forget) == [2, 3]
    assert grouped(130, store, [(1, "u", 9), (2, "u", 9)], **forget) == [1]
    assert grouped(150, store, **forget) == [1, 3]


def test_keys_of_a_group_live_as_long_as_their_time():
    store, ttl = Store(), {"ttl_ms": 100}
    assert grouped(0, store, [(1, "c", 10), (2, "c", 10)], **ttl) == [1, 2]
    assert grouped(60, store, [(2, "u", 11), (1, "u", 9)], **ttl) == [2]
    assert grouped(110, store, [(1, "u", 9), (2, "u", 9)], **ttl) == [1]
    assert store.timers == [100, 160, 210]
    assert grouped(165, store, **ttl) == [1]
    assert grouped(210, store, **ttl) == [] and store.value is None
