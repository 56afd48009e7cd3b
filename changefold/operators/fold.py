"""Folding a change log: first copy of an event, newest event of a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changefold.config import DELETE_OP, LOG_ORDER


def _first_in_order(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    # row_number() <= 1 is planned as a window group limit: every map task keeps
    # one row per key before the shuffle, so a key (or the NULL key) that holds a
    # third of all rows sends one row per task, not its whole group.
    ranked = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", ranked).filter("_rank = 1").drop("_rank")


def first_arrivals(df: DataFrame, arrival: Sequence[str], *keys: str) -> DataFrame:
    """One row per ``keys`` (the event id): the copy that arrived first, as told by ``arrival``."""
    return _first_in_order(df, keys or ["event_id"], [F.col(c).asc() for c in arrival])


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str] = LOG_ORDER
) -> DataFrame:
    """The newest event of every key. Tombstones compete like any other event.

    Copies of one event carry the same order columns and payload, so the result
    is the same over a log that was not de-duplicated.
    """
    return _first_in_order(df, keys, [F.col(c).desc() for c in order])


def drop_tombstones(df: DataFrame, op: str = "op") -> DataFrame:
    """Keep live rows. Only valid above ``latest_per_key``: a filter below it
    would bring back the state before the delete. A NULL op is dropped too."""
    return df.filter(F.col(op) != DELETE_OP)
