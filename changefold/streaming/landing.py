"""Landing as a stream: new log files are taken in once each."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from changefold.config import LogConfig
from changefold.sources.events import land, not_blank, parse_events


def stream_lines(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Non-blank lines of the files that appear in a folder, with their position."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return not_blank(
        reader.text(path).select(
            "value",
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_offset"),
        )
    )


def start_landing(
    lines: DataFrame,
    raw_path: str,
    config: LogConfig,
    checkpoint: str,
    first_load: int = 0,
) -> StreamingQuery:
    """Append the unseen events of each micro-batch to the raw table; stops when
    everything present was read.

    A micro-batch may be delivered again after a failure. It then has the same
    number, so it rewrites the same load folder and adds nothing twice.
    """

    def take_in(batch: DataFrame, batch_id: int) -> None:
        numbered = batch.withColumn("_row", F.monotonically_increasing_id())
        now = datetime.now(timezone.utc)
        land(batch.sparkSession, numbered, raw_path, config, first_load + batch_id, now)

    return (
        lines.writeStream.foreachBatch(take_in)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def distinct_within(lines: DataFrame, delay: str) -> DataFrame:
    """Events of a stream of lines, copies dropped within ``delay`` of event time.

    The bounded alternative to comparing with the whole raw table: state is kept
    for ``delay`` only, so a copy that comes later than that is not noticed.
    """
    events = parse_events(lines).withColumn("_event_time", F.timestamp_millis("ts_ms"))
    return (
        events.withWatermark("_event_time", delay)
        .dropDuplicatesWithinWatermark(["event_id"])
        .drop("_event_time")
    )
