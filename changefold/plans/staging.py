"""Current state of each source table, from its change log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changefold.config import CUSTOMERS, LOG_ORDER, ORDERS, LogConfig
from changefold.functions.payload import event_time, record_key, text_fields, typed, variant_key, variant_text
from changefold.operators.fold import drop_tombstones, latest_per_key


def keyed_events(raw: DataFrame, config: LogConfig) -> DataFrame:
    """Events with their record key; only the columns the fold needs."""
    return raw.select(
        record_key(config.key).alias(config.key), "op", *LOG_ORDER, "after_json"
    )


def typed_rows(events: DataFrame, config: LogConfig) -> DataFrame:
    """Read the typed attributes of each event's new image; tombstones have none."""
    texts = events.select(
        config.key, F.col("op").alias("_last_op"), *LOG_ORDER,
        text_fields("after_json", config.fields),
    )
    out = [typed(F.col(f.name), f) for f in config.fields]
    return texts.select(config.key, *out, event_time().alias("_cdc_ts"), "_last_op", *LOG_ORDER)


def fold(raw: DataFrame, config: LogConfig) -> DataFrame:
    """Newest state per key, tombstones included, with its place in the log.

    Payloads are parsed after the fold, once for each surviving row.
    """
    return typed_rows(latest_per_key(keyed_events(raw, config), [config.key]), config)


def live(state: DataFrame, config: LogConfig) -> DataFrame:
    """The staging relation: live rows, without the columns of the fold."""
    hidden = LOG_ORDER if config.keep_op else (*LOG_ORDER, "_last_op")
    return drop_tombstones(state, "_last_op").drop(*hidden)


def staged(raw: DataFrame, config: LogConfig) -> DataFrame:
    latest = drop_tombstones(latest_per_key(keyed_events(raw, config), [config.key]))
    return live(typed_rows(latest, config), config)


def staged_documents(raw: DataFrame, config: LogConfig) -> DataFrame:
    """The staging relation from events whose payloads are variants (``sources.variants``):
    attributes are read where they stand, and nothing is parsed."""
    keyed = raw.select(variant_key(config.key).alias(config.key), "op", *LOG_ORDER, "after_doc")
    latest = drop_tombstones(latest_per_key(keyed, [config.key]))
    out = [typed(variant_text("after_doc", f.name), f) for f in config.fields]
    rows = latest.select(config.key, *out, event_time().alias("_cdc_ts"), F.col("op").alias("_last_op"), *LOG_ORDER)
    return live(rows, config)


def stg_orders(raw: DataFrame) -> DataFrame:
    return staged(raw, ORDERS)


def stg_customers(raw: DataFrame) -> DataFrame:
    return staged(raw, CUSTOMERS)
