"""Which loads may hold an event id already: a filter of 64-bit hashes for each load.

A filter is a table of its own beside the raw table, eight bytes an id and one folder a load.
A batch meets the filters, not the history; only loads whose filter holds the hash of one of
its ids are opened, and there the ids themselves are compared. A single load is opened at once. Two ids with one hash cost a
look at a load and change nothing. A load without a filter, which an earlier version landed
or whose landing stopped half way, is always looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FILTER = "h bigint, load_id bigint"
# Hashes of a batch are broadcast up to so many (about 50 MB).
BROADCAST_HASHES = 2_000_000


def seen_path(raw_path: str) -> str:
    return f"{raw_path.rstrip('/')}_seen"


def id_hash(column: str = "event_id"):
    return F.xxhash64(column)


def loads_of(table: DataFrame) -> set[int]:
    """The loads that have files in a raw table or its filters; no file is opened."""
    return {int(n) for n in re.findall(r"/load_id=(-?\d+)/", "\n".join(table.inputFiles()))}


def forget(spark: SparkSession, raw_path: str, load_id: int, filters: DataFrame) -> None:
    """Mark a load, before it is written again, as one to be looked at in any case."""
    if load_id in loads_of(filters):
        spark.createDataFrame([(None,)], "h bigint").coalesce(1).write.mode("overwrite").parquet(
            f"{seen_path(raw_path)}/load_id={load_id}")


def remember(spark: SparkSession, ids: DataFrame, raw_path: str, load_id: int) -> int:
    """Write the filter of a load that has just been written, from its own ids; returns how
    many there are, from the files written."""
    path = f"{seen_path(raw_path)}/load_id={load_id}"
    ids.select(id_hash().alias("h")).sortWithinPartitions("h").write.mode("overwrite").parquet(path)
    return spark.read.schema("h bigint").parquet(path).count()


def suspects(ids: DataFrame, raw: DataFrame, filters: DataFrame, among: Iterable[int] | None = None) -> list[int]:
    """Loads of ``raw``, or those ``among`` them, that may hold one of the written ``ids``
    (event_id; copies allowed). At most one number for each load comes to the driver."""
    loads = loads_of(raw)
    if among is not None:
        loads &= set(among)
    filtered = loads_of(filters) & loads
    if not filtered or len(loads) == 1:
        return sorted(loads)  # the ids of one load are read as fast as its filter
    asked = ids.select(id_hash().alias("asked")).distinct()
    if asked.count() <= BROADCAST_HASHES:
        asked = F.broadcast(asked)
    known = filters.filter(F.col("load_id").isin(sorted(filtered)))
    found = known.join(asked, F.col("h") == F.col("asked"), "left_semi").select("load_id").union(
        known.filter("h IS NULL").select("load_id"))
    return sorted((loads - filtered) | {r.load_id for r in found.distinct().collect()})
