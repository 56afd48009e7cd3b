"""Current state per key by a stateful operator of its own.

``running_state`` lets a streaming aggregate keep the newest event; here a processor holds
it as keyed value state in a RocksDB store, says so only when a newer event wins, and can
let go of what it no longer needs: tombstones by a timer, keys unheard of by their time to
live. Late and repeated events lose against the state and are not sent on.

A key that has a state of its own costs several calls to the store and an Arrow batch in each
epoch. Where an epoch holds many keys, groups of keys share a state (``groups``): a group then
costs what a key did, and is written again whole in each epoch that changes one of its keys.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from changefold.config import DELETE_OP, LOG_ORDER, LogConfig
from changefold.functions.payload import record_key
from changefold.operators.fold import latest_per_key
from changefold.sources.events import read_or_empty

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
NEWEST = "ts_ms bigint, lsn bigint, event_id string, op string, after_json string"
DEADLINE = "at bigint"
GROUP, EVENT = "events string", "event"
# Events of a log for each group of keys: a state of some 150 kB.
GROUP_EVENTS = 1024


class NewestEvent(StatefulProcessor):
    """Keeps the newest event of each key, tombstones included.

    ``forget_ms``: a tombstone is dropped in the first epoch so long after it came (None:
    never). A tombstone that is gone no longer stops an older event, so this must be longer than events are late.
    ``ttl_ms``: a key of which nothing newer came for so long is dropped.
    """

    def __init__(self, key: str, forget_ms: int | None = None, ttl_ms: int | None = None):
        self.row = Row(key, "ts_ms", "lsn", "event_id", "op", "after_json")
        self.forget_ms, self.ttl_ms = forget_ms, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", NEWEST, self.ttl_ms)
        self.deadline = handle.getValueState("deadline", DEADLINE, self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        best = before = self.newest.get()  # None if there is none: each call goes to the store and back
        for r in rows:
            event = (r.ts_ms, r.lsn, r.event_id, r.op, r.after_json)
            if best is None or event[:3] > best[:3]:
                best = event
        if best == before:
            return
        self.newest.update(best)
        if self.forget_ms is not None:
            self._wait(timerValues.getCurrentProcessingTimeInMs() if best[3] == DELETE_OP else None)
        yield self.row(*key, *best)

    def _wait(self, now: int | None) -> None:
        """Set the timer of a tombstone, and take back the one of a key that came back."""
        if self.deadline.exists():
            self.handle.deleteTimer(self.deadline.get()[0])
            self.deadline.clear()
        if now is not None:
            self.deadline.update((now + self.forget_ms,))
            self.handle.registerTimer(now + self.forget_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.newest.exists() and self.newest.get()[3] == DELETE_OP:
            self.newest.clear()
            self.deadline.clear()
        return iter(())

    def close(self) -> None:
        pass


class NewestOfGroup(StatefulProcessor):
    """``NewestEvent`` for the keys of a group, which lie in one value of the store.

    An event is a list of texts: key, ``ts_ms``, ``lsn``, ``event_id``, ``op``, ``after_json``.
    It comes as JSON, and so the value keeps one for each key, with the time it came at as the
    last entry if anything is ever to be dropped.
    """

    def __init__(self, key: str, forget_ms: int | None = None, ttl_ms: int | None = None):
        self.columns = [key, "ts_ms", "lsn", "event_id", "op", "after_json"]
        self.forget_ms, self.ttl_ms = forget_ms, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", GROUP)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        held = {k: e for k, e in self._held().items() if not _past(e, self.ttl_ms, now)}
        best: dict[str | None, list] = {}
        for frame in rows:
            for event in json.loads(f"[{','.join(frame[EVENT])}]"):
                before = best.get(event[0]) or held.get(event[0])
                if before is None or _place(event) > _place(before):
                    best[event[0]] = event
        if not best:
            return
        came = [] if self.forget_ms is None and self.ttl_ms is None else [now]
        self._write({**held, **{k: e + came for k, e in best.items()}})
        if self.forget_ms is not None and any(e[4] == DELETE_OP for e in best.values()):
            self.handle.registerTimer(now + self.forget_ms)
        if self.ttl_ms is not None:
            self.handle.registerTimer(now + self.ttl_ms)
        sent = [[None if x is None else int(x) for x in e[:3]] + e[3:] for e in best.values()]
        yield pd.DataFrame(sent, columns=self.columns, dtype=object)  # else a NULL makes floats of a column

    def _held(self) -> dict[str | None, list]:
        stored = self.newest.get()
        return {} if stored is None else {e[0]: e for e in json.loads(stored[0])}

    def _write(self, held: dict[str | None, list]) -> None:
        self.newest.update((json.dumps([*held.values()], ensure_ascii=False, separators=(",", ":")),))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Drop what is due by now. The timer of an event that lost since finds nothing."""
        held, now = self._held(), timerValues.getCurrentProcessingTimeInMs()
        left = {k: e for k, e in held.items()
                if not _past(e, self.forget_ms if e[4] == DELETE_OP else None, now) and not _past(e, self.ttl_ms, now)}
        if not left:
            self.newest.clear()
        elif len(left) < len(held):
            self._write(left)
        return iter(())

    def close(self) -> None:
        pass


def _place(event: list) -> tuple[int, int, str]:
    return int(event[1]), int(event[2]), event[3]


def _past(event: list, span: int | None, now: int) -> bool:
    """Whether an event is to be dropped by ``now``, ``span`` ms (None: never) after it came."""
    return span is not None and len(event) > 6 and event[6] + span <= now


def groups_for(events: int) -> int:
    """In how many groups to keep the keys of a log of about so many events."""
    return max(1, -(-events // GROUP_EVENTS))


@contextmanager
def stateful(spark: SparkSession) -> Iterator[None]:
    """Settings that a stream takes over when it starts: state in RocksDB, and no epochs
    without events, which processing-time timers would ask for without end."""
    settings = {"spark.sql.streaming.stateStore.providerClass": STORE,
                "spark.sql.streaming.noDataMicroBatches.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def newest_events(
    events: DataFrame, config: LogConfig, forget_ms: int | None = None, ttl_ms: int | None = None,
    groups: int | None = None,
) -> DataFrame:
    """The newest event of each key of a stream of raw events, sent when it changes.

    ``groups``: keep the keys in so many groups (None: each by itself, for epochs of few keys
    beside a large state). The number belongs to the checkpoint and stays as long as that does.
    """
    keyed = events.select(
        record_key(config.key).alias(config.key), "ts_ms", "lsn", "event_id", "op", "after_json")
    out = {"outputStructType": f"{config.key} bigint, {NEWEST}", "outputMode": "Update", "timeMode": "ProcessingTime"}
    if not groups:
        processor = NewestEvent(config.key, forget_ms, ttl_ms)
        return keyed.groupBy(config.key).transformWithState(statefulProcessor=processor, **out)
    group = F.pmod(F.xxhash64(config.key), F.lit(groups)).cast("int").alias("key_group")
    event = F.to_json(F.array(*[F.col(c).cast("string") for c in keyed.columns])).alias(EVENT)
    return keyed.select(group, event).groupBy("key_group").transformWithStateInPandas(
        statefulProcessor=NewestOfGroup(config.key, forget_ms, ttl_ms), **out)


def start_newest(newest: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write what changes in each epoch to a folder of its own; an epoch that is delivered
    again rewrites it. Stops when everything present was read."""

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    with stateful(newest.sparkSession):
        return (
            newest.writeStream.foreachBatch(write).outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )


def newest_now(spark: SparkSession, path: str, config: LogConfig) -> DataFrame:
    """The newest event of each key as of the last epoch that was written."""
    sent = read_or_empty(spark, path, f"{config.key} bigint, {NEWEST}, epoch bigint").drop("epoch")
    return latest_per_key(sent, [config.key], LOG_ORDER)
