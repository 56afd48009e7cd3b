"""Landing one mixed log: read once, written once, dealt out by source table.

All raw tables of a mixed landing are folders ``raw_table=<name>`` of one base path, so one
write with dynamic partitions fills them together; the folder of a table is a raw table like
any other. Events of a table that nobody asked for go to ``dead_letters`` and are counted.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changefold.config import LogConfig
from changefold.functions.times import instant
from changefold.operators.fold import first_arrivals
from changefold.session import tasks_at_least
from changefold.sources.events import (
    ARRIVAL, RAW_COLUMNS, TASK_LINES, LoadResult, first_of_new, log_load, parse_events, parse_ids, read_filters,
    read_raw, told_apart, written_ids,
)
from changefold.sources.seen import forget, loads_of, remember, suspects

DEAD_LETTERS = "dead_letters"


def table_path(base: str, raw_table: str) -> str:
    """The folder of one raw table; what reads or streams raw tables takes it as it is."""
    return f"{base.rstrip('/')}/raw_table={raw_table}"


def raw_table_of(configs: Sequence[LogConfig]):
    """The raw table that an event belongs to, by its source table."""
    out = F.lit(DEAD_LETTERS)
    for c in configs:
        out = F.when(F.col("source_table") == c.source_table, c.raw_table).otherwise(out)
    return out.alias("raw_table")


def land_mixed(
    spark: SparkSession, lines: DataFrame, base: str, configs: Sequence[LogConfig], load_id: int,
    loaded_at: datetime,
) -> list[LoadResult]:
    """Append the unseen events of a log of several source tables, each to its raw table.

    An id is known within its table. Tables of a load are written by one plan over one scan
    of the lines (their ids are read in a pass before it and meet the history first, as in
    ``land``); a repeated load rewrites its own folders. Returns a result for each table,
    dead letters last.
    """
    events = parse_events(lines, ARRIVAL).select("*", raw_table_of(configs))
    names, history = [*(c.raw_table for c in configs), DEAD_LETTERS], None
    raws = {n: read_raw(spark, table_path(base, n)) for n in names}
    earlier = {n: loads_of(raw) - {load_id} for n, raw in raws.items()}
    if any(earlier.values()):
        ids = parse_ids(lines, source_table=True, checked=True)
        ids, size = written_ids(ids.select(raw_table_of(configs), "event_id", "nulls"))
    else:
        ids = parse_ids(lines, source_table=True).select(raw_table_of(configs))
    read = {r.raw_table: r["count"] for r in ids.groupBy("raw_table").count().collect()}

    for name, raw in raws.items():
        path = table_path(base, name)
        filters = read_filters(spark, path)
        own = ids.filter(F.col("raw_table") == name)
        picked = suspects(own, raw, filters, earlier[name]) if earlier[name] and name in read else []
        forget(spark, path, load_id, filters)
        if picked:
            part = raw.filter(F.col("load_id").isin(picked)).select(F.lit(name).alias("raw_table"), "event_id")
            history = part if history is None else history.unionByName(part)

    keys = ["raw_table", "event_id"]
    if history is not None:
        told, new = told_apart(ids, history, keys, size["bytes"] or 0)
        rows = first_of_new(events, told, new, keys)
    else:
        rows = first_arrivals(events, ARRIVAL, *keys)
    rows = rows.withColumn("_loaded_at", instant(loaded_at)).withColumn("load_id", F.lit(load_id).cast("bigint"))
    with tasks_at_least(spark, -(-sum(read.values()) // TASK_LINES)):
        rows.select(*RAW_COLUMNS, "raw_table", "load_id").write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("raw_table", "load_id").parquet(base)

    out = []
    for name in names:
        path, inserted = table_path(base, name), 0
        if name in read:
            inserted = remember(spark, read_raw(spark, path).filter(F.col("load_id") == load_id), path, load_id)
        out.append(LoadResult(name, read.get(name, 0), inserted))
        if name in read:
            log_load(spark, out[-1], path, load_id)
    return out
