"""Loads are picked by their filters; the others are not opened."""

from __future__ import annotations

from pathlib import Path

import pytest

from changefold.config import ORDERS
from changefold.sources import events, seen
from tests.conftest import event, line, rows
from tests.test_landing import load


def break_files(folder: Path):
    """Whoever opens one of these files fails."""
    for f in folder.glob("*.parquet"):
        f.write_text("no Parquet")
    for f in folder.glob(".*.crc"):
        f.unlink()


def lines_of(*keys):
    return [line(event(k, "c", k)) for k in keys]


def test_loads_without_candidates_are_not_opened(spark, tmp_path):
    for n in range(1, 5):
        load(spark, tmp_path, lines_of(*range(10 * n, 10 * n + 10)), load_id=n, name=f"l{n}")
    raw = Path(tmp_path) / "raw"
    for n in (1, 2, 4):
        break_files(raw / f"load_id={n}")
    # Ids of load 3 and new ones: only load 3 is compared.
    lines = lines_of(33, 34, 34, 50, 51)
    text = spark.createDataFrame([(x, "f", 0, i) for i, x in enumerate(lines)], "value string, _file string, _offset long, _row long")
    result = events.land(spark, text, str(raw), ORDERS, 5, events.datetime(2026, 1, 1))
    assert (result.read, result.inserted, result.skipped) == (5, 2, 3)
    landed = spark.read.schema(events.RAW_SCHEMA).parquet(f"{raw}/load_id=5")
    assert {r.event_id for r in landed.collect()} == {event(k, "c", k)["event_id"] for k in (50, 51)}
    # The broken load is opened as soon as one of its ids comes.
    again = text.filter("_row >= 0").unionByName(spark.createDataFrame(
        [(lines_of(25)[0], "f", 0, 99)], "value string, _file string, _offset long, _row long"))
    with pytest.raises(Exception, match="Parquet|FAILED_READ_FILE"):
        events.land(spark, again, str(raw), ORDERS, 6, events.datetime(2026, 1, 1))


def test_a_load_without_a_whole_filter_is_looked_at(spark, tmp_path):
    load(spark, tmp_path, lines_of(1, 2), load_id=1, name="a")
    load(spark, tmp_path, lines_of(3, 4), load_id=2, name="b")
    path = str(tmp_path / "raw")
    filters = events.read_filters(spark, path)
    seen.forget(spark, path, 2, filters)  # as if the landing of load 2 had stopped half way
    ids = spark.createDataFrame([("nowhere",)], "event_id string")
    assert seen.suspects(ids, events.read_raw(spark, path), events.read_filters(spark, path)) == [2]
    result, raw = load(spark, tmp_path, lines_of(2, 3, 5), load_id=3, name="c")
    assert result.inserted == 1 and raw.count() == 5
    # Landed by an earlier version: there is no filter at all.
    for f in Path(seen.seen_path(path)).glob("load_id=1/*"):
        f.unlink()
    assert seen.suspects(ids, events.read_raw(spark, path), events.read_filters(spark, path)) == [1, 2]


@pytest.mark.parametrize("most", [seen.BROADCAST_HASHES, 0])
def test_filters_hold_each_load(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(seen, "BROADCAST_HASHES", most)
    for n in range(3):
        load(spark, tmp_path, lines_of(n, n + 10), load_id=n, name=f"l{n}")
    path = str(tmp_path / "raw")
    raw, filters = events.read_raw(spark, path), events.read_filters(spark, path)
    assert rows(filters, "load_id") == [(n,) for n in (0, 0, 1, 1, 2, 2)]
    ids = spark.createDataFrame([(event(k, "c", k)["event_id"],) for k in (1, 12, 99)] * 2, "event_id string")
    assert seen.suspects(ids, raw, filters) == [1, 2]
    assert seen.suspects(ids, raw, filters, among=[0, 2]) == [2]
    assert seen.suspects(ids.limit(0), raw, filters) == []


def test_a_task_that_is_run_again_counts_once(spark, tmp_path):
    """Every task that reads the lines fails after its last row, the first time."""
    def fails_once(batches):
        from pyspark import TaskContext

        yield from batches
        if TaskContext.get().attemptNumber() == 0:
            raise OSError("lost")

    lines = spark.createDataFrame([(x, "f", 0, i) for i, x in enumerate(lines_of(*range(40), *range(10)))],
                                  "value string, _file string, _offset long, _row long").repartition(3)
    shaky = lines.mapInArrow(fails_once, lines.schema)
    result = events.land(spark, shaky, str(tmp_path / "raw"), ORDERS, 1, events.datetime(2026, 1, 1))
    assert (result.read, result.inserted, result.skipped) == (50, 40, 10)
    again = events.land(spark, lines.limit(0), str(tmp_path / "raw"), ORDERS, 2, events.datetime(2026, 1, 1))
    assert (again.read, again.inserted) == (0, 0)
