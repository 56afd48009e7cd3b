"""Landing change events: JSON lines to an append-only raw table."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changefold.config import LogConfig
from changefold.functions.times import instant
from changefold.operators.fold import first_arrivals
from changefold.operators.joins import BROADCAST_BATCH_BYTES, unseen
from changefold.session import materialize, tasks_at_least
from changefold.sources.seen import FILTER, forget, loads_of, remember, seen_path, suspects

ENVELOPE = (
    "event_id string, op string, ts_ms bigint, "
    "source struct<db: string, table: string, lsn: bigint, connector: string>, "
    "before string, after string"
)
RAW_COLUMNS = [
    "event_id", "op", "ts_ms", "source_table", "lsn", "before_json", "after_json", "_loaded_at",
]
RAW_SCHEMA = (
    "event_id string, op string, ts_ms bigint, source_table string, lsn bigint, "
    "before_json string, after_json string, _loaded_at timestamp"
)
RAW_PARTITIONS = "load_id bigint"
LOAD_FIGURES = "table_name string, read bigint, inserted bigint, skipped bigint"
# Lines of a log whose events one task sorts, at most: some 200 MB of them.
TASK_LINES = 400_000
# What an id takes in a hashed relation besides its own bytes, at most.
ID_ROW_BYTES = 100
# The position of a line in its files: file, offset of the split, row in the task.
ARRIVAL = ["_file", "_offset", "_row"]


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A parquet folder, or no rows while nothing was written to it yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def not_blank(lines: DataFrame) -> DataFrame:
    # An envelope is told by its first byte; only other lines are searched.
    return lines.filter(F.col("value").startswith("{") | F.col("value").rlike(r"(?U)\S"))


def with_arrival(lines: DataFrame) -> DataFrame:
    """Keep where each line stood, as long as the text scan can still tell."""
    return lines.select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_offset"),
        F.monotonically_increasing_id().alias("_row"),
    )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Non-blank lines of a file or folder with their position; none if it is missing."""
    try:
        return not_blank(with_arrival(spark.read.text(path)))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "value string, _file string, _offset bigint, _row bigint")


def _required(value: Column, doc: Column, name: str) -> Column:
    """``value``, or a failed job if the document lacks the key ``name``.

    The keys are only looked up for a NULL value, as an explicit null is allowed.
    (As two conditions in one ``and`` they would be looked up on every line.)
    """
    missing = F.coalesce(~F.array_contains(F.json_object_keys(doc), name), F.lit(True))
    message = F.concat(F.lit(f"change event without '{name}': "), F.col("value"))
    checked = F.when(missing, F.raise_error(message)).otherwise(value)
    return F.when(value.isNull(), checked).otherwise(value)


def _event_id(doc: Column) -> Column:
    missing = F.raise_error(F.concat(F.lit("change event without an event_id: "), doc))
    return F.when(F.col("_e.event_id").isNull(), missing).otherwise(F.col("_e.event_id")).alias("event_id")


def parse_events(lines: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Envelope lines to raw columns. A line that is no event stops the job.

    Payloads stay JSON text, so a new or retyped attribute never breaks a load.
    """
    doc = F.col("value")
    e = F.from_json(doc, ENVELOPE, {"mode": "FAILFAST"})
    parsed = lines.withColumn("_e", e)
    return parsed.select(
        _event_id(doc),
        *[c.alias(name) for name, c in _envelope(doc).items()],
        F.coalesce("_e.before", F.lit("null")).alias("before_json"),
        F.coalesce("_e.after", F.lit("null")).alias("after_json"),
        *extra,
    )


def _envelope(doc: Column) -> dict[str, Column]:
    """What a line has to hold beside its event id, from its parsed ``_e``."""
    source = F.get_json_object(doc, "$.source")
    return {
        "op": _required(F.col("_e.op"), doc, "op"),
        "ts_ms": _required(F.col("_e.ts_ms"), doc, "ts_ms"),
        "source_table": _required(F.col("_e.source.table"), source, "table"),
        "lsn": _required(F.col("_e.source.lsn"), source, "lsn"),
    }


def parse_ids(lines: DataFrame, source_table: bool = False, checked: bool = False) -> DataFrame:
    """The event ids of envelope lines, with their ``source_table`` if asked for, as
    ``parse_events`` would read them. Images, most of a line, are passed over.

    ``checked``: a line that ``parse_events`` refuses stops the job here as well, so that
    images of events that are known need not be read. ``nulls`` counts what is null there.
    """
    fields = "event_id string, source struct<table: string>" if source_table else "event_id string"
    if checked:
        fields = "event_id string, op string, ts_ms bigint, source struct<table: string, lsn: bigint>"
    doc = F.col("value")
    parsed = lines.withColumn("_e", F.from_json(doc, fields, {"mode": "FAILFAST"}))
    held = _envelope(doc)
    out = [held["source_table"].alias("source_table")] if source_table else []
    if checked:
        out.append(sum((c.isNull().cast("int") for c in held.values()), F.lit(0)).alias("nulls"))
    return parsed.select(_event_id(doc), *out)


def route(events: DataFrame, configs: Sequence[LogConfig]) -> Iterator[tuple[LogConfig, DataFrame]]:
    """Split one mixed log by source table."""
    for config in configs:
        yield config, events.filter(F.col("source_table") == config.source_table)


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, f"{RAW_SCHEMA}, {RAW_PARTITIONS}")


def read_filters(spark: SparkSession, path: str) -> DataFrame:
    """The filters of the loads of the raw table at ``path``."""
    return read_or_empty(spark, seen_path(path), FILTER)


def new_events(
    events: DataFrame, history: DataFrame | None, arrival: Sequence[str], batch_bytes: int | None,
    ids: DataFrame | None = None,
) -> DataFrame:
    """First copy of every event that the history (None: there is none) does not hold yet.
    ``ids``: the event ids of ``events``, if they are written already.

    Copies collapse first: they leave the map tasks as one row each, and the
    rows are then already partitioned for the comparison with the history.
    """
    first = first_arrivals(events, arrival).drop(*arrival)
    if history is None:
        return first
    return unseen(first, history, "event_id", ids=events if ids is None else ids, ids_bytes=batch_bytes)


@dataclass(frozen=True)
class LoadResult:
    table: str
    read: int
    inserted: int

    @property
    def skipped(self) -> int:
        return self.read - self.inserted


def land(
    spark: SparkSession,
    lines: DataFrame,
    path: str,
    config: LogConfig,
    load_id: int,
    loaded_at: datetime,
) -> LoadResult:
    """Append the unseen events of ``lines`` to the raw table at ``path``.

    Every load owns the folder ``load_id=<n>``. A load that is repeated after a
    crash, or replayed by a stream, rewrites its own folder and so adds nothing
    twice; its own earlier rows do not count as seen. Of the history only the loads are
    read whose filter holds an id of the batch (``sources.seen``). Where there is a history,
    ids meet it before whole events are read: nothing new, and only the ids are read.
    """
    events = parse_events(lines, ARRIVAL)
    raw, filters = read_raw(spark, path), read_filters(spark, path)
    earlier = loads_of(raw)
    if others := earlier - {load_id}:
        ids, size = written_ids(parse_ids(lines, checked=True).select("event_id", "nulls"))
    else:
        ids, size = None, {"n": lines.count()}
    if size["n"] == 0 and load_id not in earlier:
        return LoadResult(config.raw_table, 0, 0)
    if others and (picked := suspects(ids, raw, filters, others)):
        history = raw.filter(F.col("load_id").isin(picked))
        told, new = told_apart(ids, history, ["event_id"], size["bytes"] or 0)
        rows = first_of_new(events, told, new, ["event_id"])
    else:
        rows = first_arrivals(events, ARRIVAL)
    rows = rows.withColumn("_loaded_at", instant(loaded_at))
    forget(spark, path, load_id, filters)
    with tasks_at_least(spark, -(-size["n"] // TASK_LINES)):
        rows.select(*RAW_COLUMNS).write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/load_id={load_id}")
    inserted = remember(spark, read_raw(spark, path).filter(F.col("load_id") == load_id), path, load_id)
    result = LoadResult(config.raw_table, size["n"], inserted)
    log_load(spark, result, path, load_id)
    return result


def log_load(spark: SparkSession, result: LoadResult, path: str, load_id: int) -> None:
    """Keep the figures of a load beside its raw table; a repeated load rewrites its own."""
    row = [(result.table, result.read, result.inserted, result.skipped)]
    spark.createDataFrame(row, LOAD_FIGURES).coalesce(1).write.mode("overwrite").parquet(
        f"{path.rstrip('/')}_loads/load_id={load_id}")


def logged_loads(spark: SparkSession, path: str) -> DataFrame:
    """The figures of each load of the raw table at ``path``, whoever landed it: runs,
    micro-batches of a stream, and before or after a restart."""
    return read_or_empty(spark, f"{path.rstrip('/')}_loads", f"{LOAD_FIGURES}, {RAW_PARTITIONS}")


def logged_report(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Read, inserted and skipped per raw table over all its loads, and over all tables."""
    all_loads = reduce(DataFrame.unionByName, [logged_loads(spark, p) for p in paths])
    figures = [F.sum(c).cast("bigint").alias(c) for c in ("read", "inserted", "skipped")]
    return with_total(all_loads.groupBy("table_name").agg(*figures))


def written_ids(ids: DataFrame) -> tuple[DataFrame, dict]:
    """The ids of a batch, written once, and from the written table ``n`` rows and at most
    ``bytes`` in a hashed relation. A task that is run again writes, and so counts, once."""
    table = materialize(ids, "ids")
    bound = F.sum(F.octet_length("event_id") + ID_ROW_BYTES)
    return table, table.agg(F.count(F.lit(1)).alias("n"), bound.alias("bytes")).first().asDict()


def told_apart(
    ids: DataFrame, history: DataFrame, keys: Sequence[str], ids_bytes: int,
) -> tuple[DataFrame, dict]:
    """The written ``ids``, each once, and whether ``history`` holds them (``held``), written;
    of those that it does not hold ``n`` and ``bytes`` as in ``written_ids``."""
    history = history.select(*keys)
    if ids_bytes <= BROADCAST_BATCH_BYTES:
        # Few ids go to the history, and only those found there come back.
        history = history.join(F.broadcast(ids.select(*keys)), [*keys], "left_semi")
    both = ids.select(*keys, F.lit(True).alias("asked"), F.lit(False).alias("held")).unionByName(
        history.select(*keys, F.lit(False).alias("asked"), F.lit(True).alias("held")))
    each = both.groupBy(*keys).agg(F.max("asked").alias("asked"), F.max("held").alias("held"))
    told = materialize(each.filter("asked").drop("asked"), "told-ids")
    new, bound = ~F.col("held"), F.octet_length("event_id") + ID_ROW_BYTES
    return told, told.agg(F.count_if(new).alias("n"), F.sum(F.when(new, bound)).alias("bytes")).first().asDict()


def first_of_new(events: DataFrame, told: DataFrame, size: dict, keys: Sequence[str]) -> DataFrame:
    """The first copy of each event whose id is new, by what ``told_apart`` gave. Few new ids
    go to the events, and others are not sorted; without any, no event is read."""
    if not size["n"]:
        return events.sparkSession.createDataFrame([], events.schema)
    if size["bytes"] <= BROADCAST_BATCH_BYTES:
        # Compared null-safe, as a test for null would be pushed down and parse each line again.
        new = told.filter("NOT held").select(*[F.col(k).alias(f"_new_{k}") for k in keys])
        same = [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in keys]
        return first_arrivals(events.join(F.broadcast(new), same, "left_semi"), ARRIVAL, *keys)
    known = told.filter("held").select(*keys)
    return first_arrivals(events, ARRIVAL, *keys).join(known, [*keys], "left_anti")


def load_report(spark: SparkSession, results: Sequence[LoadResult]) -> DataFrame:
    """Read, inserted and skipped per table, and over all tables."""
    rows = [(r.table, r.read, r.inserted, r.skipped) for r in results]
    per_table = spark.createDataFrame(rows, LOAD_FIGURES)
    return with_total(per_table)


def with_total(per_table: DataFrame) -> DataFrame:
    total = per_table.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in ("read", "inserted", "skipped")]
    )
    return per_table.unionByName(total.select(F.lit("total").alias("table_name"), "*"))


def batch_metrics(events: DataFrame, table: str) -> DataFrame:
    """The load figures of a batch on an empty table: rows, distinct ids, copies.

    Counted per id first, so a redelivered event is one row after map-side combine.
    """
    per_id = events.groupBy("event_id").agg(F.count("*").alias("n"))
    read = F.coalesce(F.sum("n"), F.lit(0)).cast("bigint")
    return per_id.agg(
        F.lit(table).alias("table_name"), read.alias("read"), F.count("*").alias("inserted")
    ).select("*", (F.col("read") - F.col("inserted")).alias("skipped"))


def envelope_line(source_db: str, connector: str) -> Column:
    """An event row as one line of JSON, for writing a log (payloads are JSON text)."""
    def text(c: Column) -> Column:
        return F.concat(F.lit('"'), c, F.lit('"'))

    return F.concat(
        F.lit('{"event_id":'), text(F.col("event_id")),
        F.lit(',"op":'), text(F.col("op")),
        F.lit(',"ts_ms":'), F.col("ts_ms").cast("string"),
        F.lit(f',"source":{{"db":"{source_db}","table":'), text(F.col("source_table")),
        F.lit(',"lsn":'), F.col("lsn").cast("string"),
        F.lit(f',"connector":"{connector}"}},"before":'), F.col("before_json"),
        F.lit(',"after":'), F.col("after_json"),
        F.lit("}"),
    )


def write_lines(lines: DataFrame, path: str) -> None:
    """Write a log as JSON lines, one folder per source table."""
    lines.select("source_table", "value").write.mode("overwrite").partitionBy("source_table").text(path)
