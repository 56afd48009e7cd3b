"""Columns of the stored tables."""

from __future__ import annotations

FOLDED = "_cdc_ts timestamp, _last_op string, ts_ms bigint, lsn bigint, event_id string"
SCHEMAS = {
    "state_orders": (
        "order_id bigint, customer_id bigint, status string, amount decimal(12,2), "
        f"currency string, created_at timestamp_ntz, updated_at timestamp_ntz, {FOLDED}"
    ),
    "state_customers": (
        "customer_id bigint, full_name string, email string, country string, tier string, "
        f"created_at timestamp_ntz, updated_at timestamp_ntz, {FOLDED}"
    ),
    "fct_orders": (
        "order_id bigint, customer_id bigint, is_orphan_order boolean, country string, "
        "tier string, status string, amount decimal(12,2), currency string, is_lost boolean, "
        "is_completed boolean, created_at timestamp_ntz, updated_at timestamp_ntz, "
        "_cdc_ts timestamp, _processed_at timestamp"
    ),
    "dim_customers": (
        "customer_id bigint, full_name string, email string, country string, tier string, "
        "lifetime_orders bigint, lifetime_gmv decimal(38,2), lost_orders bigint, "
        "created_at timestamp_ntz, last_order_event_at timestamp"
    ),
    "agg_daily_revenue": (
        "order_date date, country string, total_orders bigint, completed_orders bigint, "
        "lost_orders bigint, gmv decimal(38,2), cancellation_rate_pct double"
    ),
    "customers_snapshot": (
        "customer_id bigint, full_name string, email string, country string, tier string, "
        "updated_at timestamp_ntz, dbt_scd_id string, dbt_updated_at timestamp, "
        "dbt_valid_from timestamp, dbt_valid_to timestamp"
    ),
    # Running sums that the marts are kept up to date by. The first names each live order
    # under its customer; the sums of the others take signed rows, see ``plans.running``.
    "state_customer_orders": "customer_id bigint, order_id bigint, _cdc_ts timestamp",
    "state_customer_totals": (
        "customer_id bigint, orders bigint, gmv decimal(38,2), lost bigint, last_at timestamp"
    ),
    "state_daily_totals": (
        "order_date date, country string, orders bigint, completed bigint, lost bigint, "
        "gmv decimal(38,2), priced bigint"
    ),
}
