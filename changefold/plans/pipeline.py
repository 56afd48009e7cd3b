"""One run of the whole chain: land, fold, snapshot, marts, gate, publish.

Everything a run builds goes to folders of its own and is checked there. Only
when the gate passes is the run published; until then, and after a failed gate,
readers keep the tables of the run before. A run that is repeated after a crash
rewrites its own folders; a run that was published already does nothing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changefold.config import CUSTOMERS, MAX_ORPHAN_PCT, ORDERS, LogConfig
from changefold.functions.times import in_utc
from changefold.operators.history import SCD_ID, SCD_TO, snapshot_delta
from changefold.operators.joins import recurring
from changefold.operators.quality import Check, require_pass
from changefold.plans.gates import CHECKS, gate_report
from changefold.plans.incremental import (
    AFFECTED_KEYS, EVENT_WATERMARK, advance_state, affected_orders, past_watermark,
)
from changefold.plans.marts import fct_orders, int_orders_enriched
from changefold.plans.running import (
    advance_customers, advance_days, advance_index, fact_changes, order_changes, owned_orders,
)
from changefold.plans.schemas import SCHEMAS
from changefold.plans.staging import live
from changefold.sources.events import ID_ROW_BYTES, LoadResult, land, read_filters, read_lines
from changefold.sources.seen import suspects
from changefold.sources.tables import Warehouse, rows_with_keys

SNAPSHOT_COLUMNS = ["customer_id", "full_name", "email", "country", "tier", "updated_at"]


@dataclass(frozen=True)
class RunResult:
    run: int
    loads: tuple[LoadResult, ...]
    published: bool


def run_number(run_ts: datetime) -> int:
    """Runs are numbered by their time, so a later run always has a higher number."""
    return int(in_utc(run_ts).timestamp() * 1000)


def table(wh: Warehouse, name: str) -> DataFrame:
    """A published table."""
    return wh.read(name, SCHEMAS[name])


def unprocessed(wh: Warehouse, config: LogConfig, loads: Sequence[int]) -> DataFrame:
    """Landed events of the open ``loads`` of a run: its own, those of runs whose gate
    failed, and those that a stream landed."""
    return wh.raw(config.raw_table).filter(F.col("load_id").isin(list(loads)))


def checked_ids(wh: Warehouse, config: LogConfig, loads: Sequence[int] | None = None) -> DataFrame:
    """Event ids the raw checks of a run have to look at.

    Runs before this one found no id twice among theirs, so only ids of the
    open loads can be repeated now: those, and their like in the history. Only loads
    whose filter holds one of them are read.
    """
    ids = wh.raw(config.raw_table).select("event_id", "load_id")
    loads = wh.open_loads(config.raw_table) if loads is None else list(loads)
    fresh = ids.filter(F.col("load_id").isin(loads)).select("event_id")
    taken = wh.taken_loads(config.raw_table)
    if not taken:
        return fresh
    size = fresh.agg(F.coalesce(F.sum(F.octet_length("event_id") + ID_ROW_BYTES), F.lit(0))).first()[0]
    picked = suspects(fresh, ids, read_filters(wh.spark, wh.raw_path(config.raw_table)), taken)
    earlier = ids.filter(F.col("load_id").isin(picked)).select("event_id")
    return fresh.unionByName(recurring(earlier, "event_id", fresh, size))


def published_tables(wh: Warehouse) -> dict[str, DataFrame]:
    """All relations a reader may query, by name, as of the last published run."""
    marts = {name: table(wh, name) for name in SCHEMAS if not name.startswith("state_")}
    orders, customers = (table(wh, f"state_{t}") for t in ("orders", "customers"))
    return {
        **{c.raw_table: unprocessed(wh, c, wh.taken_loads(c.raw_table)) for c in (ORDERS, CUSTOMERS)},
        "stg_orders": live(orders, ORDERS),
        "stg_customers": live(customers, CUSTOMERS),
        "int_orders_enriched": int_orders_enriched(live(orders, ORDERS), live(customers, CUSTOMERS)),
        **marts,
    }


def _build_fact(
    wh: Warehouse, run: int, run_ts: datetime, mode: str, orders: DataFrame, customers: DataFrame,
    index: list[int],
) -> list[int]:
    """Bring the fact up to date; returns the buckets written. ``index``: those of the
    customers' orders that the run wrote."""
    name, schema = "fct_orders", SCHEMAS["fct_orders"]
    fact = wh.read(name, schema)
    if mode == EVENT_WATERMARK:
        enriched = int_orders_enriched(orders, customers)
        rows = wh.keep("fact_rows", fct_orders(past_watermark(enriched, fact), run_ts), run)
        keys = rows.select("order_id").filter(F.col("order_id").isNotNull())
        # A row without a key replaces nothing, but its bucket is published as well.
        return wh.replace_keys(name, schema, rows, keys, "order_id", run, wh.touched(rows, "order_id"))
    order_keys, customer_keys = (wh.kept(f"changed_state_{t}", run) for t in ("orders", "customers"))
    if wh.has("state_customer_orders"):
        owned = owned_orders(wh, run, customer_keys, index)
        affected = order_keys.select("order_id").union(owned).distinct()
    elif not wh.has("state_orders") and not wh.has(name):
        affected = order_keys.select("order_id")  # all orders that there are
    else:
        affected = affected_orders(order_keys, customer_keys, orders, fact)
    affected = wh.keep("affected_orders", affected, run)
    changed = rows_with_keys(orders, affected, "order_id")
    rows = fct_orders(int_orders_enriched(changed, customers), run_ts)
    return wh.replace_keys(name, schema, rows, affected, "order_id", run)


def _snapshot(wh: Warehouse, run: int, run_ts: datetime, customers: DataFrame) -> list[int]:
    """Compare the customers that had events since the last published run (no other
    can differ) with their open rows."""
    name, schema = "customers_snapshot", SCHEMAS["customers_snapshot"]
    changed = wh.kept("changed_state_customers", run)
    open_rows = wh.read(name, schema, wh.touched(changed, "customer_id")).filter(
        F.col(SCD_TO).isNull()
    )
    current = rows_with_keys(customers.select(*SNAPSHOT_COLUMNS), changed, "customer_id")
    delta = snapshot_delta(open_rows, current, "customer_id", run_ts)
    delta = wh.keep("snapshot_delta", delta, run)
    keys = delta.select(SCD_ID, "customer_id")
    return wh.replace_keys(name, schema, delta, keys, SCD_ID, run, bucket_key="customer_id")


def run(
    spark: SparkSession,
    wh: Warehouse,
    logs: Mapping[str, str],
    run_ts: datetime,
    mode: str = AFFECTED_KEYS,
    checks: Sequence[Check] = CHECKS,
    max_orphan_pct: float = MAX_ORPHAN_PCT,
) -> RunResult:
    """Take in the log files named by ``logs`` (source table -> path).

    Raises ``QualityGateError`` after writing the check report if the gate fails.
    """
    number, last = run_number(run_ts), wh.last_run()
    if last is not None and last >= number:
        return RunResult(number, (), False)

    loads = tuple(
        land(spark, read_lines(spark, logs[c.source_table]), wh.raw_path(c.raw_table), c, number, run_ts)
        for c in (ORDERS, CUSTOMERS) if c.source_table in logs
    )
    # Fixed here: what a stream lands meanwhile is left to the next run.
    fresh = {c.raw_table: wh.open_loads(c.raw_table) for c in (ORDERS, CUSTOMERS)}
    written: dict[str, list[int] | None] = {
        name: advance_state(
            wh, name, SCHEMAS[name], config, unprocessed(wh, config, fresh[config.raw_table]), number)
        for name, config in (("state_orders", ORDERS), ("state_customers", CUSTOMERS))
    }

    def current(name: str) -> DataFrame:
        return wh.audited(name, SCHEMAS[name], number, written[name])

    orders = live(current("state_orders"), ORDERS)
    customers = live(current("state_customers"), CUSTOMERS)
    written["customers_snapshot"] = _snapshot(wh, number, run_ts, customers)
    changes = order_changes(wh, number, written["state_orders"])
    written["state_customer_orders"] = index = advance_index(wh, number, changes)
    written["fct_orders"] = _build_fact(wh, number, run_ts, mode, orders, customers, index)
    written.update(advance_customers(wh, number, changes, index, written["state_customers"]))
    moved = fact_changes(wh, number, "fact_rows" if mode == EVENT_WATERMARK else None, written["fct_orders"])
    written.update(advance_days(wh, number, moved))
    fact = current("fct_orders")

    report = gate_report(
        {
            **{c.raw_table: checked_ids(wh, c, fresh[c.raw_table]) for c in (ORDERS, CUSTOMERS)},
            "stg_orders": orders,
            "stg_customers": customers,
            "fct_orders": fact,
            "dim_customers": current("dim_customers"),
            "agg_daily_revenue": current("agg_daily_revenue"),
        },
        run_ts, checks, max_orphan_pct,
    )
    path = f"{wh.base}/audit/run={number}"
    report.coalesce(1).write.mode("overwrite").parquet(path)
    require_pass(spark.read.parquet(path))
    wh.publish(number, written, fresh)
    return RunResult(number, loads, True)
