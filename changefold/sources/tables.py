"""Named tables under one base path, with all-or-nothing publication.

A run writes new folders only: ``<layer>/<table>/run=<r>/bucket=<b>``. Which run
holds the current rows of a bucket is listed in ``published/run=<r>``, written
last as one small file. Readers follow that list, so they see the tables of the
last published run even while, or after, another run fails half way.

Tables that are updated by key are split into hash buckets of the key; an
update rewrites the buckets it touches and leaves the others where they are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changefold.sources.events import read_or_empty, read_raw

MAP_SCHEMA = "table_name string, bucket int, at_run bigint"
# The entry of a publication that holds the number of buckets.
BUCKETS = "#buckets"
# Entries that hold the loads of a raw table that were taken in: one row per load.
LOADS = "#loads:"
# Keys are bigints or 32-character ids, so this many take at most some 200 MB.
BROADCAST_KEYS = 2_000_000
LAYERS = {
    "state_orders": "state", "state_customers": "state",
    "fct_orders": "marts", "dim_customers": "marts", "agg_daily_revenue": "marts",
    "customers_snapshot": "snapshots",
    "state_customer_orders": "state", "state_customer_totals": "state", "state_daily_totals": "state",
}


def rows_with_keys(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` is in the written frame ``keys``; few keys travel
    to the rows, many meet them by shuffle. A NULL key finds NULL."""
    asked = keys.select(F.col(key).alias("_asked"))
    if keys.count() <= BROADCAST_KEYS:
        asked = F.broadcast(asked)
    return df.join(asked, F.col(key).eqNullSafe(F.col("_asked")), "left_semi")


class Warehouse:
    """Tables of one base path. ``buckets`` is fixed for the life of the path:
    choose it so that a bucket of the largest keyed table fills a few tasks."""

    def __init__(self, spark: SparkSession, base: str, buckets: int = 64):
        self.spark, self.base, self.buckets = spark, base.rstrip("/"), buckets
        self._seen, self._last, self._map = False, None, []
        self._loads: dict[str, set[int]] = {}

    def raw_path(self, raw_table: str) -> str:
        return f"{self.base}/raw/{raw_table}"

    def raw(self, raw_table: str) -> DataFrame:
        return read_raw(self.spark, self.raw_path(raw_table))

    def taken_loads(self, raw_table: str) -> list[int]:
        """Loads of a raw table that the published run, or one before it, took in."""
        self.last_run()
        return sorted(self._loads.get(raw_table, ()))

    def open_loads(self, raw_table: str) -> list[int]:
        """Loads with events that no published run took in, whoever landed them and
        however they are numbered. Only their folders are opened."""
        rows = self.raw(raw_table).filter(~F.col("load_id").isin(self.taken_loads(raw_table)))
        return sorted(r.load_id for r in rows.select("load_id").distinct().collect())

    def _path(self, table: str) -> str:
        return f"{self.base}/{LAYERS[table]}/{table}"

    # -- publication -------------------------------------------------------

    def _published(self) -> DataFrame:
        return read_or_empty(self.spark, f"{self.base}/published", f"{MAP_SCHEMA}, run bigint")

    def refresh(self) -> None:
        """Look at the newest publication from now on. Until then all reads of this
        object see one and the same run, whatever is published meanwhile."""
        published = self._published()
        last = published.agg(F.max("run")).first()[0]
        rows = [] if last is None else published.filter(F.col("run") == last).collect()
        for r in rows:
            if r.table_name == BUCKETS and r.bucket != self.buckets:
                raise ValueError(
                    f"{self.base} was made with {r.bucket} buckets and is opened with {self.buckets}")
        self._last = last
        self._map = [(r.table_name, r.bucket, r.at_run) for r in rows if not r.table_name.startswith("#")]
        self._loads = {}
        for r in rows:
            if r.table_name.startswith(LOADS):
                self._loads.setdefault(r.table_name[len(LOADS):], set()).add(r.at_run)
        self._seen = True

    def last_run(self) -> int | None:
        """The published run this object reads."""
        if not self._seen:
            self.refresh()
        return self._last

    def current_map(self) -> list[tuple[str, int, int]]:
        """(table, bucket, run) of that publication: at most tables x buckets rows."""
        self.last_run()
        return self._map

    def publish(
        self, run: int, written: Mapping[str, Sequence[int] | None],
        loads: Mapping[str, Sequence[int]] | None = None,
    ) -> None:
        """Make the buckets ``written`` by ``run`` current (None: the whole table), and
        count the ``loads`` of each raw table as taken in."""
        entries = {
            (t, b): r for t, b, r in self.current_map()
            if not (t in written and written[t] is None)
        }
        for table, touched in written.items():
            filled = {0} if touched is None else self._filled(table, run)
            for b in [0] if touched is None else touched:
                entries.pop((table, b), None)  # a bucket without rows has no folder
                if b in filled:
                    entries[table, b] = run
        taken = {t: set(ids) for t, ids in self._loads.items()}
        for raw_table, ids in (loads or {}).items():
            taken.setdefault(raw_table, set()).update(ids)
        rows = [(t, b, r) for (t, b), r in entries.items()] + [(BUCKETS, self.buckets, run)]
        rows += [(f"{LOADS}{t}", None, i) for t, ids in taken.items() for i in sorted(ids)]
        (
            self.spark.createDataFrame(rows, MAP_SCHEMA)
            .coalesce(1).write.mode("overwrite").parquet(f"{self.base}/published/run={run}")
        )
        self.refresh()

    # -- reading -----------------------------------------------------------

    def _filled(self, table: str, run: int) -> set[int]:
        """The buckets to which ``run`` wrote rows; only that run's folder is listed."""
        files = read_or_empty(self.spark, f"{self._path(table)}/run={run}", "bucket int").inputFiles()
        return {int(f.rsplit("/bucket=", 1)[1].split("/")[0]) for f in files}

    def read(
        self, table: str, schema: str, buckets: Sequence[int] | None = None
    ) -> DataFrame:
        """The published rows of ``table``, or of some of its ``buckets``."""
        asked = None if buckets is None else set(buckets)
        # Folders of other runs are neither opened nor listed.
        folders = [f"{self._path(table)}/run={r}/bucket={b}" for t, b, r in self.current_map()
                   if t == table and (asked is None or b in asked)]
        if not folders:
            return self.spark.createDataFrame([], schema)
        stored = self.spark.read.schema(f"{schema}, run bigint, bucket int").option("basePath", self._path(table))
        return stored.parquet(*folders).drop("bucket", "run")

    def has(self, table: str) -> bool:
        """Whether the publication has rows of ``table``."""
        return any(t == table for t, _, _ in self.current_map())

    def written(
        self, table: str, schema: str, run: int, buckets: Sequence[int] | None = None
    ) -> DataFrame:
        """What ``run`` wrote, published or not - for checks before publication."""
        found = read_or_empty(self.spark, f"{self._path(table)}/run={run}", f"{schema}, bucket int")
        return (found if buckets is None else found.filter(F.col("bucket").isin(list(buckets)))).drop("bucket")

    def audited(
        self, table: str, schema: str, run: int, touched: Sequence[int] | None,
        buckets: Sequence[int] | None = None,
    ) -> DataFrame:
        """``table``, or some of its ``buckets``, as it would read if ``run``, which wrote
        the buckets ``touched``, were published."""
        asked = set(range(self.buckets)) if buckets is None else set(buckets)
        if touched is None:
            return self.written(table, schema, run)
        # A table that was published whole is bucket 0; a run that touches it rewrites it.
        return self.read(table, schema, sorted(asked - set(touched))).unionByName(
            self.written(table, schema, run, buckets))

    def kept(self, name: str, run: int) -> DataFrame:
        """An interim result of a run, see ``keep``."""
        return self.spark.read.parquet(f"{self.base}/interim/run={run}/{name}")

    # -- writing -----------------------------------------------------------

    def keep(self, name: str, df: DataFrame, run: int) -> DataFrame:
        """Write an interim result of a run and go on from the written rows, where
        several steps would otherwise compute it again."""
        path = f"{self.base}/interim/run={run}/{name}"
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def bucket_of(self, key: str) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def touched(self, keys: DataFrame, key: str) -> list[int]:
        """Bucket numbers of some keys: never more than the number of buckets."""
        rows = keys.select(self.bucket_of(key).alias("b")).distinct().collect()
        return sorted(r.b for r in rows)

    def write_whole(self, table: str, df: DataFrame, run: int) -> None:
        """Full replacement of a table."""
        df.write.mode("overwrite").parquet(f"{self._path(table)}/run={run}/bucket=0")

    def write_buckets(self, table: str, df: DataFrame, key: str, run: int) -> list[int]:
        """Full replacement of a table that is updated by key."""
        out = df.withColumn("bucket", self.bucket_of(key)).hint("rebalance", "bucket")
        out.write.mode("overwrite").option("compression", "zstd").partitionBy("bucket").parquet(f"{self._path(table)}/run={run}")
        return list(range(self.buckets))

    def replace_keys(
        self, table: str, schema: str, rows: DataFrame, keys: DataFrame, key: str, run: int,
        more: Sequence[int] = (), bucket_key: str | None = None,
    ) -> list[int]:
        """Delete ``keys`` from a table and add ``rows``, whose keys are among them or fall
        into the buckets ``more``.

        ``keys`` should be a written frame of ``key`` (and ``bucket_key``). Rewrites
        the buckets the keys fall in and ``more``, and returns their numbers. Few keys are sent
        to the stored rows, which then are not shuffled (the writer still sorts them by
        bucket); only the added rows are. Many keys meet the
        stored rows by shuffle, and everything is dealt out to its buckets anew.
        """
        bucket = self.bucket_of(bucket_key or key)
        touched = sorted({*self.touched(keys, bucket_key or key), *more})
        few = keys.count() <= BROADCAST_KEYS
        gone = keys.select(F.col(key).alias("_gone"))
        stored = self.read(table, schema, touched)
        kept = stored.join(
            F.broadcast(gone) if few else gone, F.col(key).eqNullSafe(F.col("_gone")), "left_anti"
        ).withColumn("bucket", bucket)
        added = rows.select(*stored.columns).withColumn("bucket", bucket)
        if few:
            out = kept.unionByName(added.hint("rebalance", "bucket"))
        else:
            out = kept.unionByName(added).hint("rebalance", "bucket")
        out.write.mode("overwrite").option("compression", "zstd").partitionBy("bucket").parquet(f"{self._path(table)}/run={run}")
        return touched
