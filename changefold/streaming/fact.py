"""The order fact as a stream: both logs in one query, one epoch for all tables.

A micro-batch holds the newly landed events of both raw tables. It is folded into both
states, its keys and the orders of its changed customers are the affected orders, and fact,
dimension and daily table follow in the same publication. Readers see an epoch whole or
not at all; one that is delivered again is known by its number and left out.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from changefold.config import CUSTOMERS, ORDERS
from changefold.plans.running import advance
from changefold.sources.tables import Warehouse
from changefold.streaming.state import stream_raw


def stream_changes(
    spark: SparkSession, wh: Warehouse, files_per_batch: int | None = None, epochs: int | None = None
) -> DataFrame:
    """Events of both logs as they are appended to the raw tables under ``wh``, all that is
    landed by now in about so many ``epochs`` (see ``stream_raw``)."""
    orders, customers = (
        stream_raw(spark, wh.raw_path(c.raw_table), files_per_batch, epochs) for c in (ORDERS, CUSTOMERS))
    return orders.unionByName(customers)


def take_epoch(wh: Warehouse) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that takes each micro-batch into all tables of ``wh``.

    Rows compete by their place in the log, so late and repeated events change nothing, and
    an epoch that crashed before its publication rewrites its own folders.
    """

    def take_in(batch: DataFrame, batch_id: int) -> None:
        run, last = batch_id + 1, wh.last_run()
        if last is not None and last >= run:
            return
        events = wh.keep("epoch", batch.drop("load_id"), run)
        orders, customers = (events.filter(F.col("source_table") == c.source_table) for c in (ORDERS, CUSTOMERS))
        wh.publish(run, advance(wh, run, datetime.now(timezone.utc), orders, customers))

    return take_in


def start_fact(changes: DataFrame, wh: Warehouse, checkpoint: str) -> StreamingQuery:
    """Keep the tables of ``wh``, which belong to this stream alone, current; stops when
    everything landed was taken in."""
    return (
        changes.writeStream.foreachBatch(take_epoch(wh))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
