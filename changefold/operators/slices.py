"""Ordered passes over a key's events that survive one enormous key.

``lag``, ``lead`` and running values need a key's events in order, and a window
sorts a key's whole group in one task. Keys that hold a sizeable share of all
rows are therefore cut into slices: each slice is a window group of its own and
takes what it needs across its border from a table of slice edges, which is
bounded by the number of slices. All other keys keep the plain window.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changefold.session import materialize

# A key is heavy when it holds more than 1/HEAVY_PARTS of all rows, so there are
# fewer than HEAVY_PARTS heavy keys, and few more slices than that.
HEAVY_PARTS = 500
# Below this many rows a group is no load for one task, whatever its share.
HEAVY_MIN_ROWS = 1_000_000

SLICE, SLICED = "_slice", "_sliced"


@dataclass(frozen=True)
class Sliced:
    """A frame with a slice number per row; ``any_heavy`` tells if slices exist."""

    df: DataFrame
    key: str
    any_heavy: bool


def slice_heavy_keys(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    parts: int = HEAVY_PARTS,
    min_rows: int = HEAVY_MIN_ROWS,
    tie_break: Sequence[Column] = (),
) -> Sliced:
    """Number the slices of heavy keys along ``order``.

    One counting pass with map-side combine over the key column; fewer than
    ``parts`` keys reach the driver and later every task. The rows of heavy keys
    are range-partitioned by key and ``order`` (then ``tie_break``, where rows with
    equal order may be separated), so slices are even however the rows lie in
    time. The borders come from a sample, hence the numbered rows are written
    once: every later pass sees the same slices.
    """
    per_key = df.groupBy(key).agg(F.count("*").alias("n"))
    total = df.agg(F.count("*")).scalar()
    found = (
        per_key.filter(F.col("n") >= min_rows)
        .filter(F.col("n") * parts > total)
        .select(F.col(key).alias("_heavy_key"), "n", total.alias("total"))
    )
    keys = found.collect()
    if not keys:
        return Sliced(df.withColumn(SLICE, F.lit(0)), key, False)
    heavy = F.broadcast(df.sparkSession.createDataFrame(keys, found.schema).select("_heavy_key"))
    is_heavy = F.col(key).eqNullSafe(F.col("_heavy_key"))
    slices = math.ceil(sum(r.n for r in keys) * parts / keys[0].total)
    numbered = (
        df.join(heavy, is_heavy, "left_semi")
        .repartitionByRange(slices, key, *order, *tie_break)
        .withColumn(SLICE, F.spark_partition_id())
    )
    others = df.join(heavy, is_heavy, "left_anti").withColumn(SLICE, F.lit(0))
    both = others.withColumn(SLICED, F.lit(False)).unionByName(
        materialize(numbered, "slices").withColumn(SLICED, F.lit(True))
    )
    return Sliced(both, key, True)


def _across(
    sliced: Sliced, order: Sequence[Column], edge: Column, forward: bool
) -> DataFrame:
    """Per slice of a heavy key, the nearest value of ``edge`` in a slice beyond it."""
    pick = F.min_by if forward else F.max_by
    usable = sliced.df.filter(F.col(SLICED)).withColumn("_edge", edge)
    edges = (
        usable.groupBy(sliced.key, SLICE)
        .agg(pick("_edge", F.when(F.col("_edge").isNotNull(), F.struct(*order))).alias("_edge"))
    )
    w = Window.partitionBy(sliced.key)
    if forward:
        nearest = F.first("_edge", ignorenulls=True).over(
            w.orderBy(SLICE).rowsBetween(1, Window.unboundedFollowing)
        )
    else:
        nearest = F.last("_edge", ignorenulls=True).over(
            w.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
        )
    return edges.select(
        F.col(sliced.key).alias("_e_key"), F.col(SLICE).alias("_e_slice"), nearest.alias("_edge")
    )


def _with_edges(sliced: Sliced, df: DataFrame, edges: DataFrame) -> DataFrame:
    # Edges: one row per slice and heavy key in it, some 2 * HEAVY_PARTS at most.
    return df.join(
        F.broadcast(edges),
        F.col(sliced.key).eqNullSafe(F.col("_e_key")) & (F.col(SLICE) == F.col("_e_slice")),
        "left",
    ).drop("_e_key", "_e_slice")


def neighbour(
    sliced: Sliced, order: Sequence[str], value: Column, name: str, forward: bool = False
) -> Sliced:
    """Add the value of the key's previous (or next) row as column ``name``.

    ``value`` must not be NULL itself (wrap nullable columns in a struct); NULL
    in the result means there is no such row.
    """
    cols = [F.col(c) for c in order]
    w = Window.partitionBy(sliced.key, SLICE).orderBy(*cols)
    beside = F.lead(value).over(w) if forward else F.lag(value).over(w)
    out = sliced.df.withColumn(name, beside)
    if sliced.any_heavy:
        edges = _across(sliced, cols, value, forward)
        out = _with_edges(sliced, out, edges)
        out = out.withColumn(name, F.coalesce(name, "_edge")).drop("_edge")
    return Sliced(out, sliced.key, sliced.any_heavy)


def carried(sliced: Sliced, order: Sequence[str], value: Column, name: str) -> Sliced:
    """Add the key's newest non-NULL ``value`` at or before each row."""
    cols = [F.col(c) for c in order]
    w = Window.partitionBy(sliced.key, SLICE).orderBy(*cols)
    running = F.last(value, ignorenulls=True).over(
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    out = sliced.df.withColumn(name, running)
    if sliced.any_heavy:
        edges = _across(sliced, cols, value, forward=False)
        out = _with_edges(sliced, out, edges)
        out = out.withColumn(name, F.coalesce(name, "_edge")).drop("_edge")
    return Sliced(out, sliced.key, sliced.any_heavy)


def unsliced(sliced: Sliced) -> DataFrame:
    return sliced.df.drop(SLICE, SLICED)
