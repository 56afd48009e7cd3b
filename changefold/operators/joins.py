"""Joins on keys: lookup of a parent, unseen events, replace by key, orphans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Ids of a batch are broadcast only while the text they came from is below this.
BROADCAST_BATCH_BYTES = 256 * 1024 * 1024


def splittable_join(left: DataFrame, right: DataFrame, key: str, how: str) -> DataFrame:
    """Equi join on ``key`` in which a hot key on the left can be split over tasks.

    Adaptive execution only splits a key that owns, say, a third of the left rows
    when both inputs come straight from a shuffle. A right side that was just
    folded or grouped by ``key`` is already partitioned by it and would be read in
    place, so the join also compares a hash of the key: that asks for a shuffle
    of its own (of one narrow row per key) and keeps the split possible. The hash
    follows from the key, so it never changes a match.
    """
    hashed = right.withColumn("_key_hash", F.xxhash64(key))
    same = (left[key] == hashed[key]) & (F.xxhash64(left[key]) == hashed["_key_hash"])
    return left.join(hashed, same, how).drop("_key_hash")


def parent_join(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Left join children to the one parent with the same ``key``."""
    return splittable_join(child, parent, key, "left")


def recurring(
    history: DataFrame, key: str, ids: DataFrame, ids_bytes: int | None
) -> DataFrame:
    """Rows of ``history`` whose ``key`` is among the ``ids`` of a batch.

    The batch is small against the history, so its ids (copies allowed) go to the
    history: as a broadcast while ``ids_bytes``, an upper bound of their size,
    proves them small, by shuffle beyond that.
    """
    ids = ids.select(key)
    if ids_bytes is not None and ids_bytes <= BROADCAST_BATCH_BYTES:
        ids = F.broadcast(ids)
    else:
        # One row per id and task before the shuffle, however many copies came.
        ids = ids.distinct()
    return history.join(ids, key, "left_semi")


def unseen(
    batch: DataFrame, history: DataFrame, key: str, ids: DataFrame, ids_bytes: int | None
) -> DataFrame:
    """Rows of ``batch`` whose ``key`` is nowhere in ``history``; only ids present
    on both sides come back to thin out the batch. See ``recurring`` for ``ids``."""
    seen = recurring(history.select(key), key, ids, ids_bytes)
    return batch.join(seen, key, "left_anti")


def replace_by_key(
    target: DataFrame, rows: DataFrame, key: str, drop_keys: DataFrame | None = None
) -> DataFrame:
    """Delete the keys of ``rows`` (or exactly ``drop_keys``) from ``target``, add ``rows``.

    Without ``drop_keys`` a NULL key deletes nothing, like SQL equality; a NULL
    among ``drop_keys`` is taken at its word.
    """
    if drop_keys is None:
        kept = target.join(rows.select(key), key, "left_anti")
    else:
        gone = drop_keys.select(F.col(key).alias("_gone"))
        kept = target.join(gone, F.col(key).eqNullSafe(F.col("_gone")), "left_anti")
    return kept.select(*target.columns).unionByName(rows)


def orphan_keys(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child keys without a parent and how many child rows carry each.

    Children are counted per key first, so a hot key is one row in the join.
    """
    per_key = child.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.count("*").alias("child_rows")
    )
    return per_key.join(parent.select(key), key, "left_anti")
