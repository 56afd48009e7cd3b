"""Incremental maintenance of state, fact and snapshot.

Two ways to keep the order fact up to date:

``event_watermark``  takes orders whose event time is past the newest one in the
                     fact. Cheap, but a late update, a delete or a change of the
                     customer is never seen.
``affected_keys``    takes the orders touched by newly landed events of either
                     log, and brings exactly those to their current state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changefold.config import EARLIEST, LogConfig
from changefold.functions.payload import record_key
from changefold.operators.fold import latest_per_key
from changefold.operators.joins import replace_by_key, splittable_join
from changefold.plans.staging import keyed_events, typed_rows
from changefold.sources.tables import Warehouse, rows_with_keys

EVENT_WATERMARK, AFFECTED_KEYS = "event_watermark", "affected_keys"


def merge_state(state: DataFrame, batch: DataFrame, config: LogConfig) -> DataFrame:
    """Fold new events into stored state.

    Both sides compete by their place in the log, so a late event loses against
    a newer stored state and a replayed batch changes nothing. Tombstones stay
    in the state: without them an older update could revive a deleted key.
    Events are read before they compete, so that state and batch meet in one shuffle.
    """
    read = typed_rows(keyed_events(batch, config), config)
    return latest_per_key(state.unionByName(read), [config.key])


def advance_state(
    wh: Warehouse, name: str, schema: str, config: LogConfig, batch: DataFrame, run: int
) -> list[int]:
    """Fold a batch of events into a state table; returns the buckets written.

    Only the stored rows of the batch's own keys compete with it. The keys are kept
    as ``changed_<table>`` for later steps of the run.
    """
    keys = wh.keep(
        f"changed_{name}",
        batch.select(record_key(config.key).alias(config.key)).distinct(), run,
    )
    stored = wh.read(name, schema, wh.touched(keys, config.key))
    rivals = rows_with_keys(stored, keys, config.key)
    return wh.replace_keys(name, schema, merge_state(rivals, batch, config), keys, config.key, run)


def loaded_watermark(fact: DataFrame) -> DataFrame:
    """One row: the newest event time in the fact, or long ago for an empty fact."""
    return fact.agg(
        F.coalesce(F.max("_cdc_ts"), F.lit(EARLIEST).cast("timestamp")).alias("watermark")
    )


def past_watermark(enriched: DataFrame, fact: DataFrame) -> DataFrame:
    return enriched.filter(F.col("_cdc_ts") > loaded_watermark(fact).scalar())


def upsert_by_watermark(fact: DataFrame, enriched: DataFrame) -> DataFrame:
    """The fact after one run in ``event_watermark`` mode; both have equal columns."""
    return replace_by_key(fact, past_watermark(enriched, fact), "order_id")


def affected_orders(
    order_keys: DataFrame, customer_keys: DataFrame, orders_now: DataFrame, fact: DataFrame
) -> DataFrame:
    """Ids of orders to rebuild: changed themselves, or owned (before or after) by
    a changed customer. The few changed customers meet the orders as a semi join."""
    customers = customer_keys.select("customer_id").distinct()
    pairs = orders_now.select("order_id", "customer_id").unionByName(
        fact.select("order_id", "customer_id")
    )
    owned = splittable_join(pairs, customers, "customer_id", "left_semi")
    return order_keys.select("order_id").union(owned.select("order_id")).distinct()


def upsert_affected(fact: DataFrame, enriched: DataFrame, affected: DataFrame) -> DataFrame:
    """The fact after one run in ``affected_keys`` mode: affected orders leave, and
    come back in their current state if they are still alive."""
    touched = affected.select(F.col("order_id").alias("_touched"))
    rows = enriched.join(touched, F.col("order_id").eqNullSafe(F.col("_touched")), "left_semi")
    return replace_by_key(fact, rows, "order_id", drop_keys=affected)
