"""Current state and fact kept up to date from the landed events, as streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from changefold.config import LogConfig
from changefold.functions.payload import record_key
from changefold.plans.incremental import advance_state
from changefold.plans.pipeline import SCHEMAS
from changefold.sources.events import RAW_PARTITIONS, RAW_SCHEMA, read_raw
from changefold.sources.tables import Warehouse


def stream_raw(
    spark: SparkSession, raw_path: str, files_per_batch: int | None = None, epochs: int | None = None
) -> DataFrame:
    """Events as they are appended to a raw table.

    ``epochs``: take in what is landed by now in about so many micro-batches. One whose keys
    fall into all buckets rewrites the tables, so micro-batches of a fixed number of files
    would cost the square of the log.
    """
    reader = spark.readStream.schema(f"{RAW_SCHEMA}, {RAW_PARTITIONS}")
    if epochs:
        files_per_batch = max(1, -(-len(read_raw(spark, raw_path).inputFiles()) // epochs))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(raw_path)


def fold_batch(wh: Warehouse, name: str, config: LogConfig) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that folds each micro-batch into a state table.

    The rows of a batch compete with the stored ones by their place in the log,
    so late events change nothing, and so does a batch that is delivered again.
    """

    def fold_in(batch: DataFrame, batch_id: int) -> None:
        run = batch_id + 1
        last = wh.last_run()
        if last is not None and last >= run:
            return
        events = batch.drop("load_id")
        touched = advance_state(wh, name, SCHEMAS[name], config, events, run)
        wh.publish(run, {name: touched})

    return fold_in


def start_state(
    events: DataFrame, wh: Warehouse, name: str, config: LogConfig, checkpoint: str
) -> StreamingQuery:
    """Keep state table ``name`` current; ``wh`` belongs to this stream alone."""
    return (
        events.writeStream.foreachBatch(fold_batch(wh, name, config))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def running_state(events: DataFrame, config: LogConfig) -> DataFrame:
    """Newest event per key as a streaming aggregate, for ``update`` output.

    The state store holds one event per key and no history; the maximum is
    combined map-side, so a hot key sends one row per task.
    """
    newest = F.max_by(
        F.struct("op", "ts_ms", "lsn", "event_id", "after_json"),
        F.struct("ts_ms", "lsn", "event_id"),
    )
    return (
        events.groupBy(record_key(config.key).alias(config.key))
        .agg(newest.alias("_newest"))
        .select(config.key, "_newest.*")
    )
