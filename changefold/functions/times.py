"""The run's own clock as literals; a time without a zone means UTC."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


def in_utc(ts: datetime) -> datetime:
    return ts.replace(tzinfo=timezone.utc) if ts.tzinfo is None else ts.astimezone(timezone.utc)


def instant(ts: datetime) -> Column:
    """A point in time, whatever zone driver and session are in."""
    return F.lit(in_utc(ts).isoformat()).cast("timestamp")


def wall_clock(ts: datetime) -> Column:
    """The same without a zone, to compare with payload times."""
    return F.lit(in_utc(ts).replace(tzinfo=None).isoformat()).cast("timestamp_ntz")
