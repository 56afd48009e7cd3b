"""Every operator of the package as a query over the given tables.

The change log is derived from the order and customer tables by Spark itself
(``changefold.sources.derived``), over their whole length.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changefold.config import CUSTOMERS, CUSTOMER_TIERS, ORDERS, SNAPSHOT_CHECK_COLUMNS, LogConfig
from changefold.functions.payload import event_id, json_text, record_key
from changefold.operators import quality
from changefold.operators.fold import first_arrivals, latest_per_key
from changefold.operators.history import SCD_ID, SCD_TO, as_of, empty_snapshot, snapshot_delta, versions_from_log
from changefold.operators.joins import orphan_keys, replace_by_key
from changefold.plans import drift, gates, incremental, marts, pipeline, serving, sketches, staging
from changefold.session import materialize, new_run_dir, prepare, tasks_at_least
from changefold.sources import derived, events, routing, variants
from changefold.sources.tables import Warehouse
from changefold.streaming import fact as stream_fact
from changefold.streaming import keyed as stream_keyed
from changefold.streaming import landing as stream_landing
from changefold.streaming import state as stream_state

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = datetime(2001, 7, 1)
RUN_1, RUN_2, RUN_3 = (datetime(2026, 1, d) for d in (1, 2, 3))
# The second of two batches starts here, and also brings what came late.
BATCH_2_FROM = 883_612_800_000  # 1998-01-01
RAW = ["event_id", "op", "ts_ms", "source_table", "lsn", "before_json", "after_json"]

QUERIES: dict[str, Query] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Give values a form both engines hand to Python alike: money as double,
    dates as text, timestamps without zone."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double").alias(f.name)
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string").alias(f.name)
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz").alias(f.name)
        out.append(c)
    return df.select(*out)


def query(build: Query) -> Query:
    @wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(build(prepare(spark), sf_dir))

    QUERIES[build.__name__] = run
    return run


# ------------------------------------------------------------- relations

def landed_orders(spark: SparkSession, sf: str) -> DataFrame:
    return first_arrivals(derived.order_log(spark, sf), ["_copy"]).drop("_copy")


def landed_customers(spark: SparkSession, sf: str) -> DataFrame:
    return first_arrivals(derived.customer_log(spark, sf), ["_copy"]).drop("_copy")


# The fold is the same over copies, so the marts need no de-duplication before it.

def orders_now(spark: SparkSession, sf: str) -> DataFrame:
    return staging.stg_orders(derived.order_log(spark, sf))


def customers_now(spark: SparkSession, sf: str) -> DataFrame:
    return staging.stg_customers(derived.customer_log(spark, sf))


def enriched_now(spark: SparkSession, sf: str) -> DataFrame:
    return marts.int_orders_enriched(orders_now(spark, sf), customers_now(spark, sf))


def dimension_now(spark: SparkSession, sf: str) -> DataFrame:
    return marts.dim_customers(customers_now(spark, sf), orders_now(spark, sf))


def daily_now(spark: SparkSession, sf: str) -> DataFrame:
    return marts.agg_daily_revenue(enriched_now(spark, sf))


def in_first_batch(late_every: int) -> Column:
    """Which events the first of two batches holds; all others come with the second."""
    key = F.floor(F.col("lsn") / 10)
    late = (F.col("op") != "c") & (key % late_every == 0)
    return (F.col("ts_ms") < BATCH_2_FROM) & ~late


def first_orders(spark: SparkSession, sf: str) -> DataFrame:
    return derived.order_log(spark, sf).filter(in_first_batch(3))


def later_orders(spark: SparkSession, sf: str) -> DataFrame:
    return derived.order_log(spark, sf).filter(~in_first_batch(3))


def first_customers(spark: SparkSession, sf: str) -> DataFrame:
    return derived.customer_log(spark, sf).filter(in_first_batch(2))


def later_customers(spark: SparkSession, sf: str) -> DataFrame:
    return derived.customer_log(spark, sf).filter(~in_first_batch(2))


def first_fact(spark: SparkSession, sf: str) -> DataFrame:
    fact = marts.int_orders_enriched(
        staging.stg_orders(first_orders(spark, sf)), staging.stg_customers(first_customers(spark, sf))
    )
    return materialize(fact, "fact")


# --------------------------------------------------------------- landing

def _parsed(log: DataFrame) -> DataFrame:
    lines = events.not_blank(derived.log_lines(log))
    return events.parse_events(lines, ["_copy"])


def _first_of_orders(spark: SparkSession, sf: str, log: DataFrame) -> DataFrame:
    """First copies of the order log, whole events, over as many tasks as the orders ask for."""
    orders = spark.read.schema(derived.ORDER_COLUMNS).parquet(f"{sf}/orders.parquet")
    with tasks_at_least(spark, derived.tasks_of(orders)):
        return materialize(first_arrivals(log, ["_copy"]).drop("_copy"), "first-copies")


@query
def landing_orders_raw(spark: SparkSession, sf: str) -> DataFrame:
    return _first_of_orders(spark, sf, _parsed(derived.order_log(spark, sf))).select(*RAW)


@query
def landing_customers_raw(spark: SparkSession, sf: str) -> DataFrame:
    return first_arrivals(_parsed(derived.customer_log(spark, sf)), ["_copy"]).select(*RAW)


@query
def landing_routed_counts(spark: SparkSession, sf: str) -> DataFrame:
    mixed = derived.order_log(spark, sf).unionByName(derived.customer_log(spark, sf))
    parts = [
        first_arrivals(part, ["_copy"]).groupBy("op").agg(F.count("*").alias("events"))
        .select(F.lit(config.raw_table).alias("raw_table"), "op", "events")
        for config, part in events.route(_parsed(mixed), [ORDERS, CUSTOMERS])
    ]
    return parts[0].unionByName(parts[1])


@query
def landing_load_report(spark: SparkSession, sf: str) -> DataFrame:
    per_table = events.batch_metrics(_parsed(derived.order_log(spark, sf)), ORDERS.raw_table)
    per_table = per_table.unionByName(
        events.batch_metrics(_parsed(derived.customer_log(spark, sf)), CUSTOMERS.raw_table)
    )
    return events.with_total(materialize(per_table, "loads"))


@query
def landing_second_batch(spark: SparkSession, sf: str) -> DataFrame:
    """The whole log again, on top of its first batch: only unseen events remain."""
    history = materialize(
        first_arrivals(first_orders(spark, sf), ["_copy"]).select("event_id"), "history"
    )
    return events.new_events(derived.order_log(spark, sf), history, ["_copy"], None).select(*RAW)


@query
def landing_third_load(spark: SparkSession, sf: str) -> DataFrame:
    """What a third load adds to two: the whole log is offered after its first batch and
    the even ones of the others. Loads are picked by their filters."""
    base = new_run_dir(spark, "landing")
    logs = {1: first_orders(spark, sf), 2: later_orders(spark, sf).filter(F.floor(F.col("lsn") / 10) % 2 == 0),
            3: derived.order_log(spark, sf)}
    for load, log in logs.items():
        derived.write_log(log, f"{base}/{load}")
        events.land(spark, events.read_lines(spark, f"{base}/{load}"), f"{base}/raw", ORDERS, load, RUN_1)
    return events.read_raw(spark, f"{base}/raw").filter("load_id = 3").select(*RAW)


@query
def landing_mixed_report(spark: SparkSession, sf: str) -> DataFrame:
    """Both logs as one, with the customers' log once more under a table nobody asked for:
    landed in one pass, and offered again."""
    base = new_run_dir(spark, "mixed")
    orders, customers = derived.order_log(spark, sf), derived.customer_log(spark, sf)
    mixed = orders.unionByName(customers).unionByName(customers.withColumn("source_table", F.lit("audit")))
    derived.write_log(mixed, f"{base}/log")
    parts = []
    for attempt in (1, 2):
        results = routing.land_mixed(
            spark, events.read_lines(spark, f"{base}/log"), f"{base}/raw", [ORDERS, CUSTOMERS], attempt, RUN_1)
        parts.append(events.load_report(spark, results).withColumn("attempt", F.lit(attempt)))
    return parts[0].unionByName(parts[1])


@query
def landing_rerun_report(spark: SparkSession, sf: str) -> DataFrame:
    """Log files written, landed, and landed again: the second attempt adds nothing."""
    base = new_run_dir(spark, "landing")
    logs = {ORDERS: derived.order_log(spark, sf), CUSTOMERS: derived.customer_log(spark, sf)}
    report = []
    for config, log in logs.items():
        path = f"{base}/log/{config.source_table}"
        derived.write_log(log, path)
        for attempt in (1, 2):
            r = events.land(
                spark, events.read_lines(spark, path), f"{base}/{config.raw_table}", config, attempt, RUN_1
            )
            report.append((attempt, r.table, r.read, r.inserted, r.skipped))
    return spark.createDataFrame(
        report, "attempt int, table_name string, read bigint, inserted bigint, skipped bigint"
    )


@query
def landing_duplicate_count(spark: SparkSession, sf: str) -> DataFrame:
    metrics = events.batch_metrics(derived.order_log(spark, sf), ORDERS.raw_table)
    return metrics.select(F.col("skipped").alias("duplicates"))


@query
def change_log_lines(spark: SparkSession, sf: str) -> DataFrame:
    both = derived.order_log(spark, sf).unionByName(derived.customer_log(spark, sf))
    return events.not_blank(derived.log_lines(both)).select("source_table", "value")


# ------------------------------------------------- current state and marts

@query
def stg_orders(spark: SparkSession, sf: str) -> DataFrame:
    return orders_now(spark, sf)


@query
def stg_customers(spark: SparkSession, sf: str) -> DataFrame:
    return customers_now(spark, sf)


@query
def stg_orders_from_documents(spark: SparkSession, sf: str) -> DataFrame:
    """The staging relation read from payloads that were parsed when they were written."""
    path = new_run_dir(spark, "documents")
    variants.write_documents(derived.order_log(spark, sf), path, 1)
    return staging.staged_documents(variants.read_documents(spark, path), ORDERS)


@query
def folded_orders_with_tombstones(spark: SparkSession, sf: str) -> DataFrame:
    state = staging.fold(derived.order_log(spark, sf), ORDERS)
    return state.select("order_id", "_last_op", "_cdc_ts")


@query
def int_orders_enriched(spark: SparkSession, sf: str) -> DataFrame:
    return enriched_now(spark, sf)


@query
def fct_orders(spark: SparkSession, sf: str) -> DataFrame:
    return marts.fct_orders(enriched_now(spark, sf), RUN_1).drop("_processed_at")


@query
def dim_customers(spark: SparkSession, sf: str) -> DataFrame:
    return dimension_now(spark, sf)


@query
def agg_daily_revenue(spark: SparkSession, sf: str) -> DataFrame:
    return daily_now(spark, sf).orderBy(
        F.asc_nulls_last("order_date"), F.asc_nulls_last("country")
    )


@query
def orphan_orders(spark: SparkSession, sf: str) -> DataFrame:
    return orphan_keys(orders_now(spark, sf), customers_now(spark, sf), "customer_id")


@query
def events_latest_per_user(spark: SparkSession, sf: str) -> DataFrame:
    table = spark.read.parquet(f"{sf}/events.parquet")
    latest = latest_per_key(table, ["user_id"], ["ts", "event_id"])
    return latest.select("user_id", "event_type", "ts", "value")


@query
def events_daily_volume(spark: SparkSession, sf: str) -> DataFrame:
    table = spark.read.parquet(f"{sf}/events.parquet")
    return table.groupBy(F.to_date("ts").alias("event_day"), "event_type").agg(F.count("*").alias("n"))


@query
def events_payload_attribute(spark: SparkSession, sf: str) -> DataFrame:
    table = spark.read.parquet(f"{sf}/events.parquet")
    k = table.select("event_type", json_text("props", "k").alias("k"))
    return k.groupBy("event_type").agg(
        F.count("k").alias("with_k"), F.sum(F.col("k").cast("bigint")).alias("sum_k")
    )


# --------------------------------------------------- incremental, history

@query
def incremental_state_merge(spark: SparkSession, sf: str) -> DataFrame:
    """State of the first batch, then the rest of the log folded into it."""
    state = materialize(staging.fold(first_orders(spark, sf), ORDERS), "state")
    merged = incremental.merge_state(state, later_orders(spark, sf), ORDERS)
    return merged.select("order_id", "customer_id", "status", "amount", "_last_op", "_cdc_ts")


@query
def incremental_watermark(spark: SparkSession, sf: str) -> DataFrame:
    return incremental.loaded_watermark(first_fact(spark, sf))


@query
def incremental_fact_watermark(spark: SparkSession, sf: str) -> DataFrame:
    now = materialize(enriched_now(spark, sf), "enriched")
    return incremental.upsert_by_watermark(first_fact(spark, sf), now)


@query
def incremental_fact_affected_keys(spark: SparkSession, sf: str) -> DataFrame:
    fact = first_fact(spark, sf)
    orders = materialize(orders_now(spark, sf), "orders")
    customers = customers_now(spark, sf)

    affected = materialize(
        incremental.affected_orders(
            later_orders(spark, sf).select(record_key("order_id").alias("order_id")),
            later_customers(spark, sf).select(record_key("customer_id").alias("customer_id")),
            orders, fact,
        ),
        "affected",
    )
    return incremental.upsert_affected(
        fact, marts.int_orders_enriched(orders, customers), affected
    )


def tier_versions(spark: SparkSession, sf: str) -> DataFrame:
    log = landed_customers(spark, sf).select(
        record_key("customer_id").alias("customer_id"), "op", "ts_ms", "lsn", "event_id",
        json_text("after_json", "tier").alias("tier"),
    )
    return versions_from_log(materialize(log, "tiers"), "customer_id", ["tier"])


@query
def history_customer_versions(spark: SparkSession, sf: str) -> DataFrame:
    return tier_versions(spark, sf)


@query
def history_tier_at_order(spark: SparkSession, sf: str) -> DataFrame:
    """The tier each customer had when they placed each order."""
    placed = spark.read.parquet(f"{sf}/orders.parquet").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("created_at"),
    )
    versions = materialize(tier_versions(spark, sf), "versions")
    return as_of(placed, "created_at", versions, "customer_id", ["tier"])


@query
def history_snapshot_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Three snapshot runs: first batch, whole log, whole log once more."""
    states = [first_customers(spark, sf), derived.customer_log(spark, sf), derived.customer_log(spark, sf)]
    history = None
    for run_ts, log in zip((RUN_1, RUN_2, RUN_3), states, strict=True):
        current = staging.stg_customers(log).select(*pipeline.SNAPSHOT_COLUMNS)
        history = empty_snapshot(current) if history is None else history
        open_rows = history.filter(F.col(SCD_TO).isNull())
        delta = snapshot_delta(open_rows, current, "customer_id", run_ts, SNAPSHOT_CHECK_COLUMNS)
        history = materialize(replace_by_key(history, materialize(delta, "delta"), SCD_ID), "history")
    return history


# --------------------------------------------------------------- quality

@query
def dq_check_report(spark: SparkSession, sf: str) -> DataFrame:
    """All declared checks. What several of them fold or join is written once."""
    orders = materialize(orders_now(spark, sf), "orders")
    customers = materialize(customers_now(spark, sf), "customers")
    fact = materialize(marts.int_orders_enriched(orders, customers), "fact")
    tables = {
        ORDERS.raw_table: landed_orders(spark, sf),
        CUSTOMERS.raw_table: landed_customers(spark, sf),
        "stg_orders": orders,
        "stg_customers": customers,
        "fct_orders": fact,
        # Two checks look at the dimension, by value and by row.
        "dim_customers": materialize(
            marts.dim_customers(customers, orders).select("customer_id", "lifetime_gmv"), "dimension"),
        "agg_daily_revenue": marts.agg_daily_revenue(fact),
    }
    return gates.gate_report(tables, AS_OF)


@query
def dq_null_emails(spark: SparkSession, sf: str) -> DataFrame:
    return quality.null_rows(customers_now(spark, sf), "email").select("customer_id", "tier")


@query
def dq_repeated_event_ids(spark: SparkSession, sf: str) -> DataFrame:
    return quality.repeated_values(derived.order_log(spark, sf), "event_id")


@query
def dq_unaccepted_tiers(spark: SparkSession, sf: str) -> DataFrame:
    return quality.unaccepted_values(customers_now(spark, sf), "tier", CUSTOMER_TIERS)


@query
def dq_orders_without_customer(spark: SparkSession, sf: str) -> DataFrame:
    return orphan_keys(orders_now(spark, sf), customers_now(spark, sf), "customer_id")


@query
def dq_amounts_out_of_range(spark: SparkSession, sf: str) -> DataFrame:
    bad = quality.rows_outside_range(orders_now(spark, sf), "amount", low=0)
    return bad.select("order_id", "amount")


@query
def dq_orphan_rate_gate(spark: SparkSession, sf: str) -> DataFrame:
    return gates.orphan_rate(enriched_now(spark, sf))


@query
def dq_orphan_rate_over_2_pct(spark: SparkSession, sf: str) -> DataFrame:
    return gates.orphan_rate(enriched_now(spark, sf), max_pct=2.0)


@query
def dq_future_orders(spark: SparkSession, sf: str) -> DataFrame:
    return gates.future_orders(enriched_now(spark, sf), AS_OF)


@query
def dq_scorecard(spark: SparkSession, sf: str) -> DataFrame:
    return gates.scorecard(enriched_now(spark, sf), customers_now(spark, sf), AS_OF)


# --------------------------------------------------------------- serving

@query
def srv_headline_kpis(spark: SparkSession, sf: str) -> DataFrame:
    return serving.headline_kpis(enriched_now(spark, sf))


@query
def srv_raw_event_counts(spark: SparkSession, sf: str) -> DataFrame:
    return serving.raw_event_counts(landed_orders(spark, sf), landed_customers(spark, sf))


@query
def srv_orphan_rate(spark: SparkSession, sf: str) -> DataFrame:
    return serving.orphan_rate(enriched_now(spark, sf))


@query
def srv_null_email_rate(spark: SparkSession, sf: str) -> DataFrame:
    return serving.null_email_rate(dimension_now(spark, sf))


@query
def srv_future_orders(spark: SparkSession, sf: str) -> DataFrame:
    return serving.future_order_count(enriched_now(spark, sf), AS_OF)


@query
def srv_daily_totals(spark: SparkSession, sf: str) -> DataFrame:
    return serving.daily_totals(daily_now(spark, sf))


@query
def srv_orders_by_status(spark: SparkSession, sf: str) -> DataFrame:
    return serving.orders_by_status(enriched_now(spark, sf))


@query
def srv_customers_by_tier(spark: SparkSession, sf: str) -> DataFrame:
    return serving.customers_by_tier(dimension_now(spark, sf))


@query
def srv_by_country(spark: SparkSession, sf: str) -> DataFrame:
    return serving.by_country(daily_now(spark, sf))


@query
def srv_country_labels(spark: SparkSession, sf: str) -> DataFrame:
    return serving.country_labels(serving.by_country(daily_now(spark, sf)))


@query
def srv_country_map(spark: SparkSession, sf: str) -> DataFrame:
    return serving.country_map(daily_now(spark, sf))


@query
def srv_cancellation_trend(spark: SparkSession, sf: str) -> DataFrame:
    return serving.cancellation_trend(daily_now(spark, sf))


@query
def srv_top_customers(spark: SparkSession, sf: str) -> DataFrame:
    return serving.top_customers(dimension_now(spark, sf))


@query
def srv_drift_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return serving.drift_coverage(enriched_now(spark, sf))


@query
def srv_events_by_op(spark: SparkSession, sf: str) -> DataFrame:
    return serving.events_by_op(landed_orders(spark, sf), landed_customers(spark, sf))


@query
def srv_drift_onset(spark: SparkSession, sf: str) -> DataFrame:
    return serving.drift_onset(landed_orders(spark, sf))


@query
def srv_customers_from_sketches(spark: SparkSession, sf: str) -> DataFrame:
    """Customers per country of two years, exact and whether the estimate from the daily
    sketches is within four standard errors of it."""
    fact = materialize(enriched_now(spark, sf), "fact")
    first, last = date(1995, 1, 1), date(1996, 12, 31)
    told = sketches.distinct_customers(
        materialize(sketches.daily_sketches(fact), "sketches"), first, last, by=["country"])
    day = F.to_date("created_at")
    exact = fact.filter(day.between(F.lit(first), F.lit(last))).groupBy("country").agg(
        F.count_distinct("customer_id").alias("exact"))
    near = F.abs(F.col("customers") - F.col("exact")) <= 4 * sketches.standard_error() * F.col("exact")
    return exact.join(told.withColumnRenamed("country", "_country"), F.col("country").eqNullSafe(F.col("_country"))).select(
        "country", F.col("exact").alias("customers"), near.alias("estimate_is_near"))


@query
def drift_of_a_load(spark: SparkSession, sf: str) -> DataFrame:
    """Fields of a load against an accepted profile that knows neither currency nor amounts
    that are text."""
    log = landed_orders(spark, sf)
    key = F.floor(F.col("lsn") / 10)
    plain = in_first_batch(3) & (key % 20 != 0) & (key % 211 != 0)
    known, found = (materialize(drift.profile(log.filter(x)), "profile") for x in (plain, ~plain))
    return drift.drift(known, found)


@query
def srv_daily_event_volume(spark: SparkSession, sf: str) -> DataFrame:
    return serving.daily_event_volume(landed_orders(spark, sf))


def layers(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    orders = materialize(orders_now(spark, sf), "orders")
    customers = materialize(customers_now(spark, sf), "customers")
    fact = materialize(marts.int_orders_enriched(orders, customers), "fact")
    return {
        "raw.orders": landed_orders(spark, sf),
        "raw.customers": landed_customers(spark, sf),
        "stg_orders": orders,
        "stg_customers": customers,
        "int_orders": fact,
        "fct_orders": fact,
        "dim_customers": marts.dim_customers(customers, orders),
        "agg_daily": marts.agg_daily_revenue(fact),
    }


@query
def srv_layer_counts(spark: SparkSession, sf: str) -> DataFrame:
    return serving.layer_counts(layers(spark, sf))


@query
def srv_lineage_edges(spark: SparkSession, sf: str) -> DataFrame:
    return serving.lineage_edges(materialize(serving.layer_counts(layers(spark, sf)), "counts"))


@query
def srv_ad_hoc_query(spark: SparkSession, sf: str) -> DataFrame:
    return serving.ad_hoc(
        spark, {"agg_daily_revenue": daily_now(spark, sf)},
        "SELECT bigint(year(order_date)) AS order_year, sum(total_orders) AS orders, sum(gmv) AS gmv "
        "FROM agg_daily_revenue GROUP BY 1",
    )


# ------------------------------------------------- streams, the whole chain

def _land_stream(
    spark: SparkSession, log: DataFrame, folder: str, raw_path: str, config: LogConfig, checkpoint: str, batches: int,
) -> None:
    """Write a log and land it by a stream in so many micro-batches, however large it is:
    copies and late events meet different ones."""
    lines = stream_landing.stream_lines(spark, folder, files_per_batch=derived.write_log(log, folder, batches))
    stream_landing.start_landing(lines, raw_path, config, checkpoint).awaitTermination()


@query
def stream_landed_orders(spark: SparkSession, sf: str) -> DataFrame:
    base = new_run_dir(spark, "stream")
    _land_stream(spark, derived.order_log(spark, sf), f"{base}/log", f"{base}/raw", ORDERS, f"{base}/offsets", 3)
    return events.read_raw(spark, f"{base}/raw").select(*RAW)


@query
def stream_load_report(spark: SparkSession, sf: str) -> DataFrame:
    """Figures of all micro-batches of two landing streams, from what they left behind."""
    base = new_run_dir(spark, "stream")
    for config, log in ((ORDERS, derived.order_log(spark, sf)), (CUSTOMERS, derived.customer_log(spark, sf))):
        _land_stream(spark, log, f"{base}/{config.source_table}", f"{base}/{config.raw_table}", config,
                     f"{base}/{config.source_table}-offsets", 2)
    return events.logged_report(spark, [f"{base}/{c.raw_table}" for c in (ORDERS, CUSTOMERS)])


@query
def stream_current_orders(spark: SparkSession, sf: str) -> DataFrame:
    base = new_run_dir(spark, "stream")
    _land_stream(spark, derived.order_log(spark, sf), f"{base}/log", f"{base}/raw", ORDERS, f"{base}/landing", 2)
    wh = Warehouse(spark, f"{base}/tables", buckets=8)
    raw = stream_state.stream_raw(spark, f"{base}/raw")
    stream_state.start_state(raw, wh, "state_orders", ORDERS, f"{base}/state").awaitTermination()
    state = pipeline.table(wh, "state_orders")
    return state.select("order_id", "customer_id", "status", "amount", "_last_op", "_cdc_ts")


@query
def stream_newest_orders(spark: SparkSession, sf: str) -> DataFrame:
    """The same state, held by a stateful operator over several epochs."""
    base = new_run_dir(spark, "stream")
    log = derived.order_log(spark, sf).select(*RAW, F.lit(RUN_1).alias("_loaded_at"), F.col("_copy").alias("load_id"))
    log.write.partitionBy("load_id").parquet(f"{base}/raw")
    raw = stream_state.stream_raw(spark, f"{base}/raw", epochs=3)
    groups = stream_keyed.groups_for(events.read_raw(spark, f"{base}/raw").count())
    newest = stream_keyed.newest_events(raw, ORDERS, groups=groups)
    stream_keyed.start_newest(newest, f"{base}/newest", f"{base}/offsets").awaitTermination()
    state = staging.typed_rows(stream_keyed.newest_now(spark, f"{base}/newest", ORDERS), ORDERS)
    return state.select("order_id", "customer_id", "status", "amount", "_last_op", "_cdc_ts")


def streamed(spark: SparkSession, sf: str) -> Warehouse:
    """Both logs landed by streams, each in two loads that mix old and new events, and taken
    into all tables by the stream of both, in several epochs."""
    base = new_run_dir(spark, "stream")
    wh = Warehouse(spark, f"{base}/tables", buckets=8)
    for config, log in ((ORDERS, derived.order_log(spark, sf)), (CUSTOMERS, derived.customer_log(spark, sf))):
        _land_stream(spark, log, f"{base}/{config.source_table}", wh.raw_path(config.raw_table), config,
                     f"{base}/{config.source_table}-offsets", 2)
    changes = stream_fact.stream_changes(spark, wh, epochs=3)
    stream_fact.start_fact(changes, wh, f"{base}/fact-offsets").awaitTermination()
    return wh


@query
def stream_fct_orders(spark: SparkSession, sf: str) -> DataFrame:
    return pipeline.table(streamed(spark, sf), "fct_orders").drop("_processed_at")


@query
def stream_agg_daily_revenue(spark: SparkSession, sf: str) -> DataFrame:
    return pipeline.table(streamed(spark, sf), "agg_daily_revenue")


#: Declared checks that the derived log breaks on purpose; its chain takes them as warnings.
BROKEN = (
    "not_null_stg_orders_status", "relationships_stg_orders_customer_id",
    "accepted_values_stg_customers_tier", "accepted_range_dim_customers_lifetime_gmv",
)
LENIENT = [replace(c, severity=quality.WARN) if c.name in BROKEN else c for c in gates.CHECKS]


def run_or_refuse(spark: SparkSession, wh: Warehouse, logs: dict[str, str], run_ts: datetime) -> None:
    """A run over the first batch. Orders whose customers come with the second are orphans in
    it; where they are too many, the gate refuses the run. Its loads then stay open, and the
    next run takes them in. Any other check that fails is an error."""
    try:
        pipeline.run(spark, wh, logs, run_ts, checks=LENIENT)
    except quality.QualityGateError:
        report = spark.read.parquet(f"{wh.base}/audit/run={pipeline.run_number(run_ts)}")
        failed = {r.check_name for r in report.filter("status = 'fail'").collect()}
        if failed != {gates.ORPHAN_RATE}:
            raise


def published(spark: SparkSession, sf: str, **second) -> Warehouse:
    """Two runs of the whole chain: the first batch, then the complete log again, the
    latter with the options ``second``. All declared checks are run.

    With options, the tables at the end may depend on what the first run published, so it
    has to pass its gate."""
    base = new_run_dir(spark, "chain")
    logs = {
        "first": {"orders": first_orders(spark, sf), "customers": first_customers(spark, sf)},
        "all": {"orders": derived.order_log(spark, sf), "customers": derived.customer_log(spark, sf)},
    }
    wh = Warehouse(spark, f"{base}/tables", buckets=8)
    for (name, log), run_ts in zip(logs.items(), (RUN_1, RUN_2), strict=True):
        for table, rows in log.items():
            derived.write_log(rows, f"{base}/{name}/{table}")
        paths = {t: f"{base}/{name}/{t}" for t in log}
        if name == "first" and not second:
            run_or_refuse(spark, wh, paths, run_ts)
        else:
            options = {"checks": LENIENT, **(second if name == "all" else {})}
            pipeline.run(spark, wh, paths, run_ts, **options)
    return wh


@query
def published_fct_orders(spark: SparkSession, sf: str) -> DataFrame:
    return pipeline.table(published(spark, sf), "fct_orders").drop("_processed_at")


@query
def published_agg_daily_revenue(spark: SparkSession, sf: str) -> DataFrame:
    return pipeline.table(published(spark, sf), "agg_daily_revenue")


@query
def published_dim_customers(spark: SparkSession, sf: str) -> DataFrame:
    return pipeline.table(published(spark, sf), "dim_customers")


@query
def published_fct_orders_watermark(spark: SparkSession, sf: str) -> DataFrame:
    wh = published(spark, sf, mode=incremental.EVENT_WATERMARK)
    return pipeline.table(wh, "fct_orders").drop("_processed_at")


@query
def published_audit_report(spark: SparkSession, sf: str) -> DataFrame:
    """The check rows of the second run, beside the tables it published."""
    base = published(spark, sf).base
    return spark.read.parquet(f"{base}/audit/run={pipeline.run_number(RUN_2)}")


@query
def dq_refused_run(spark: SparkSession, sf: str) -> DataFrame:
    """The fact that readers see after the second run failed its declared checks."""
    base = new_run_dir(spark, "refused")
    wh = Warehouse(spark, f"{base}/tables", buckets=8)
    for number, (orders, customers, run_ts, checks) in enumerate((
        (first_orders(spark, sf), first_customers(spark, sf), RUN_1, LENIENT),
        (derived.order_log(spark, sf), derived.customer_log(spark, sf), RUN_2, gates.CHECKS),
    )):
        logs = {"orders": orders, "customers": customers}
        for table, rows in logs.items():
            derived.write_log(rows, f"{base}/{number}/{table}")
        paths = {t: f"{base}/{number}/{t}" for t in logs}
        if number == 0:
            pipeline.run(spark, wh, paths, run_ts, checks=checks)
            continue
        try:
            pipeline.run(spark, wh, paths, run_ts, checks=checks)
        except quality.QualityGateError:
            wh.refresh()
        else:
            raise AssertionError("the gate let a run pass that breaks declared checks")
    return pipeline.table(wh, "fct_orders").drop("_processed_at")


@query
def stream_then_published_fct_orders(spark: SparkSession, sf: str) -> DataFrame:
    """A run over the first batch, the complete order log landed by a stream, and a run
    that takes in the stream's loads."""
    base = new_run_dir(spark, "handover")
    wh = Warehouse(spark, f"{base}/tables", buckets=8)
    for table, rows in (("orders", first_orders(spark, sf)), ("customers", first_customers(spark, sf))):
        derived.write_log(rows, f"{base}/first/{table}")
    run_or_refuse(spark, wh, {t: f"{base}/first/{t}" for t in ("orders", "customers")}, RUN_1)
    _land_stream(spark, derived.order_log(spark, sf), f"{base}/log", wh.raw_path(ORDERS.raw_table), ORDERS,
                 f"{base}/offsets", 3)
    derived.write_log(derived.customer_log(spark, sf), f"{base}/all/customers")
    pipeline.run(spark, wh, {"customers": f"{base}/all/customers"}, RUN_2, checks=LENIENT)
    return pipeline.table(wh, "fct_orders").drop("_processed_at")


@query
def landing_ids_assigned(spark: SparkSession, sf: str) -> DataFrame:
    """The order log as if its source sent no ids: each event gets its id from its place."""
    rows = _first_of_orders(spark, sf, derived.order_log(spark, sf)).drop("event_id")
    key = record_key(ORDERS.key)
    given = event_id("orders", key, F.col("op"), F.col("ts_ms"), F.col("lsn"))
    return rows.select(given.alias("event_id"), "op", "ts_ms", "lsn", key.alias("order_id"))
