"""DuckDB SQL for every registered query, written from the definition of the
change log alone.

The log is built once more here, event kind by event kind, and everything else
is stated over it in DuckDB's own terms. Money is given as DOUBLE and dates as
text on both sides, so the two engines hand the same values to Python.
"""

from __future__ import annotations

# ---------------------------------------------------------------- the logs

ORDER_LOG = """
ob AS (
  SELECT o_orderkey AS k, CASE WHEN o_custkey % 41 = 0 THEN -o_custkey ELSE o_custkey END AS cust, o_orderdate AS placed,
         epoch_ms(o_orderdate) AS t0,
         CASE WHEN o_orderkey % 307 = 0 THEN -o_totalprice ELSE o_totalprice END AS price,
         CASE WHEN o_orderkey % 401 = 0 THEN NULL
              WHEN o_orderkey % 4 = 0 THEN 'delivered' WHEN o_orderkey % 4 = 1 THEN 'cancelled'
              WHEN o_orderkey % 4 = 2 THEN 'shipped' ELSE 'refunded' END AS later
  FROM orders),
oe AS (
  SELECT k, 'c' AS op, t0 AS ts, 10*k+1 AS lsn, 'pending' AS status FROM ob
  UNION ALL
  SELECT k, 'u', CASE WHEN k % 17 = 0 THEN t0 - 259200000 ELSE t0 + 3600000 END, 10*k+2, later
  FROM ob WHERE k % 5 <> 0
  UNION ALL
  SELECT k, 'd', CASE WHEN k % 91 = 0 THEN t0 - 3600000 ELSE t0 + 7200000 END, 10*k+3, later
  FROM ob WHERE k % 13 = 0
  UNION ALL
  SELECT k, 'r', t0 + 1800000, 10*k+4, 'confirmed' FROM ob WHERE k % 101 = 0),
o_once AS (
  SELECT substr(sha1('orders|' || oe.k || '|' || op || '|' || ts || '|' || lsn), 1, 16) AS event_id,
         op, ts AS ts_ms, 'orders' AS source_table, lsn,
         CASE WHEN op IN ('u', 'd') THEN '{"order_id":' || oe.k || ',"status":"pending"}'
              ELSE 'null' END AS before_json,
         CASE WHEN op = 'd' THEN 'null' ELSE
           '{"order_id":' || oe.k || ',"customer_id":' || cust
           || ',"status":' || coalesce('"' || status || '"', 'null')
           || ',"amount":' || CASE WHEN oe.k % 211 = 0 THEN '"n/a"'
                                   WHEN oe.k % 20 = 0 THEN '"' || price || '"'
                                   ELSE CAST(price AS VARCHAR) END
           || ',"created_at":"' || strftime(placed, '%Y-%m-%dT%H:%M:%S') || '+00:00"'
           || ',"updated_at":"' || strftime(epoch_ms(ts), '%Y-%m-%dT%H:%M:%S') || '+00:00"'
           || CASE WHEN placed < TIMESTAMP '1998-12-15' THEN ''
                   ELSE ',"currency":"' || ['INR', 'USD', 'GBP'][oe.k % 3 + 1] || '"' END
           || '}' END AS after_json,
         oe.k AS k
  FROM oe JOIN ob ON ob.k = oe.k),
o_sent AS (
  SELECT *, 1 AS nth FROM o_once
  UNION ALL SELECT *, 2 FROM o_once WHERE k % 25 = 0
  UNION ALL SELECT *, 3 FROM o_once WHERE k % 125 = 0),
raw_o AS (
  SELECT event_id, op, ts_ms, source_table, lsn, before_json, after_json, k
  FROM o_sent QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY nth) = 1)
"""

CUSTOMER_LOG = """
cb AS (
  SELECT c_custkey AS k, c_name AS name, 788918400000 + 60000 * c_custkey AS t0,
         CASE WHEN c_nationkey = 24 THEN 'ZZ'
              ELSE ['IN','US','GB','AE','SG','AU','DE','CA'][c_nationkey % 8 + 1] END AS country
  FROM customer),
ce AS (
  SELECT k, 'c' AS op, t0 AS ts, 10*k+1 AS lsn,
         CASE WHEN k % 149 = 0 THEN 'vip' ELSE 'bronze' END AS tier, name AS full_name FROM cb
  UNION ALL SELECT k, 'u', t0 + 43200000000, 10*k+2, 'silver', name FROM cb WHERE k % 3 = 0
  UNION ALL SELECT k, 'u', 788918400000 + 103680000000 - 60000*k, 10*k+3, 'gold', name
            FROM cb WHERE k % 6 = 0
  UNION ALL SELECT k, 'u', t0 + 129600000000, 10*k+4, 'gold', name || ' Jr' FROM cb WHERE k % 12 = 0
  UNION ALL SELECT k, 'u', t0 + 34560000000, 10*k+5, 'bronze', name FROM cb WHERE k % 18 = 0
  UNION ALL SELECT k, 'd', t0 + 138240000000, 10*k+6, 'bronze', name FROM cb WHERE k % 97 = 0),
c_once AS (
  SELECT substr(sha1('customers|' || ce.k || '|' || op || '|' || ts || '|' || lsn), 1, 16) AS event_id,
         op, ts AS ts_ms, 'customers' AS source_table, lsn,
         CASE WHEN op = 'c' THEN 'null' ELSE '{"customer_id":' || ce.k || '}' END AS before_json,
         CASE WHEN op = 'd' THEN 'null' ELSE
           '{"customer_id":' || ce.k || ',"full_name":"' || full_name || '"'
           || ',"email":' || CASE WHEN ce.k % 33 = 0 THEN 'null'
                                  ELSE '"user' || ce.k || '@example.com"' END
           || ',"country":"' || country || '","tier":"' || tier || '"'
           || ',"created_at":"' || strftime(epoch_ms(t0), '%Y-%m-%dT%H:%M:%S') || '+00:00"'
           || ',"updated_at":"' || strftime(epoch_ms(ts), '%Y-%m-%dT%H:%M:%S') || '+00:00"}'
           END AS after_json,
         ce.k AS k
  FROM ce JOIN cb ON cb.k = ce.k),
c_sent AS (
  SELECT *, 1 AS nth FROM c_once
  UNION ALL SELECT *, 2 FROM c_once WHERE k % 25 = 0),
raw_c AS (
  SELECT event_id, op, ts_ms, source_table, lsn, before_json, after_json, k
  FROM c_sent QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY nth) = 1)
"""


# ------------------------------------------------------- current state, marts

def newest_orders(name: str, log: str) -> str:
    """Newest event per order, tombstones included, attributes typed."""
    return f"""
{name} AS (
  SELECT coalesce(after_json->>'$.order_id', before_json->>'$.order_id')::BIGINT AS order_id,
         (after_json->>'$.customer_id')::BIGINT AS customer_id,
         after_json->>'$.status' AS status,
         TRY_CAST(after_json->>'$.amount' AS DECIMAL(12,2)) AS amount,
         ifnull(after_json->>'$.currency', 'INR') AS currency,
         TRY_CAST(after_json->>'$.created_at' AS TIMESTAMP) AS created_at,
         TRY_CAST(after_json->>'$.updated_at' AS TIMESTAMP) AS updated_at,
         epoch_ms(ts_ms) AS _cdc_ts, op AS _last_op
  FROM {log}
  WHERE (k, ts_ms, lsn) IN (
    SELECT (k, m.ts_ms, m.lsn) FROM (
      SELECT k, max({{'ts_ms': ts_ms, 'lsn': lsn}}) AS m FROM {log} GROUP BY k)))"""


def newest_customers(name: str, log: str) -> str:
    return f"""
{name} AS (
  SELECT coalesce(after_json->>'$.customer_id', before_json->>'$.customer_id')::BIGINT AS customer_id,
         after_json->>'$.full_name' AS full_name, after_json->>'$.email' AS email,
         after_json->>'$.country' AS country, after_json->>'$.tier' AS tier,
         TRY_CAST(after_json->>'$.created_at' AS TIMESTAMP) AS created_at,
         TRY_CAST(after_json->>'$.updated_at' AS TIMESTAMP) AS updated_at,
         epoch_ms(ts_ms) AS _cdc_ts, op AS _last_op
  FROM {log}
  WHERE (k, ts_ms, lsn) IN (
    SELECT (k, m.ts_ms, m.lsn) FROM (
      SELECT k, max({{'ts_ms': ts_ms, 'lsn': lsn}}) AS m FROM {log} GROUP BY k)))"""


def enriched(name: str, orders: str, customers: str) -> str:
    return f"""
{name} AS (
  SELECT so.order_id, so.customer_id, sc.customer_id IS NULL AS is_orphan_order,
         sc.country, sc.tier, so.status, so.amount, so.currency,
         CASE WHEN so.status IS NULL THEN NULL
              ELSE list_contains(['cancelled', 'refunded'], so.status) END AS is_lost,
         so.status = 'delivered' AS is_completed,
         so.created_at, so.updated_at, so._cdc_ts
  FROM {orders} so LEFT JOIN {customers} sc ON sc.customer_id = so.customer_id)"""


STAGING = ",".join([
    ORDER_LOG, CUSTOMER_LOG,
    newest_orders("no", "raw_o"), newest_customers("nc", "raw_c"),
    "\nso AS (SELECT * FROM no WHERE _last_op <> 'd')",
    "\nsc AS (SELECT * EXCLUDE (_last_op) FROM nc WHERE _last_op <> 'd')",
])
FACT = STAGING + "," + enriched("fct", "so", "sc")
DIM = FACT + """,
dim AS (
  SELECT sc.customer_id, any_value(sc.full_name) AS full_name, any_value(sc.email) AS email,
         any_value(sc.country) AS country, any_value(sc.tier) AS tier,
         count(f.order_id) AS lifetime_orders,
         coalesce(CASE WHEN count(f.order_id) = 0 THEN 0.00
                       ELSE sum(CASE WHEN f.is_completed THEN f.amount ELSE 0.00 END) END, 0.00)
           AS lifetime_gmv,
         count(f.order_id) FILTER (WHERE f.is_lost) AS lost_orders,
         any_value(sc.created_at) AS created_at,
         max(f._cdc_ts) AS last_order_event_at
  FROM sc LEFT JOIN fct f ON f.customer_id = sc.customer_id
  GROUP BY sc.customer_id)"""
DAILY = FACT + """,
daily AS (
  SELECT CAST(created_at AS DATE) AS order_date, country,
         count(*) AS total_orders,
         count(*) FILTER (WHERE is_completed) AS completed_orders,
         count(*) FILTER (WHERE is_lost) AS lost_orders,
         sum(CASE WHEN is_completed THEN amount ELSE 0.00 END) AS gmv,
         round(100.0::DOUBLE * count(*) FILTER (WHERE is_lost) / count(*), 2) AS cancellation_rate_pct
  FROM fct WHERE created_at IS NOT NULL
  GROUP BY ALL)"""


def with_(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body.strip()}"


RAW_OUT = "event_id, op, ts_ms, source_table, lsn, " \
    "(before_json::JSON)::VARCHAR AS before_json, (after_json::JSON)::VARCHAR AS after_json"
ENRICHED_OUT = "SELECT * REPLACE (amount::DOUBLE AS amount) FROM "
AS_OF = "TIMESTAMP '2001-07-01 00:00:00'"
# The clock of the chain's second run.
RUN_2 = "TIMESTAMP '2026-01-02 00:00:00'"
# When the second of two batches starts, and who is late for the first.
FIRST_O = "ts_ms < 883612800000 AND NOT (op <> 'c' AND k % 3 = 0)"
FIRST_C = "ts_ms < 883612800000 AND NOT (op <> 'c' AND k % 2 = 0)"

TWO_BATCHES = STAGING + f""",
o1 AS (SELECT * FROM raw_o WHERE {FIRST_O}),
c1 AS (SELECT * FROM raw_c WHERE {FIRST_C}),""" + ",".join([
    newest_orders("no1", "o1"), newest_customers("nc1", "c1"),
    "\nso1 AS (SELECT * FROM no1 WHERE _last_op <> 'd')",
    "\nsc1 AS (SELECT * FROM nc1 WHERE _last_op <> 'd')",
    enriched("fct1", "so1", "sc1"), enriched("fct2", "so", "sc"),
])

VERSIONS = CUSTOMER_LOG + """,
steps AS (
  SELECT k, op, ts_ms, lsn, after_json->>'$.tier' AS tier,
         lag(op) OVER w AS prev_op, lag(after_json->>'$.tier') OVER w AS prev_tier
  FROM raw_c WINDOW w AS (PARTITION BY k ORDER BY ts_ms, lsn)),
turns AS (
  SELECT *, lead(ts_ms) OVER (PARTITION BY k ORDER BY ts_ms, lsn) AS until_ms
  FROM steps
  WHERE prev_op IS NULL OR (op = 'd') <> (prev_op = 'd') OR tier IS DISTINCT FROM prev_tier),
versions AS (
  SELECT k AS customer_id, tier, epoch_ms(ts_ms) AS valid_from, epoch_ms(until_ms) AS valid_to
  FROM turns WHERE op <> 'd' AND (until_ms IS NULL OR until_ms > ts_ms))"""

# ------------------------------------------------------------------ checks

def _check(kind: str, table: str, column: str, source: str, failures: str, severity: str = "error") -> str:
    return (
        f"SELECT '{kind}_{table}_{column}' AS check_name, '{table}' AS table_name, "
        f"'{severity}' AS severity, ({failures.format(t=source, c=column)})::BIGINT AS failures"
    )


_NULLS = "SELECT count(*) FROM {t} WHERE {c} IS NULL"
_TWICE = "SELECT count(*) FROM (SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)"
_STATUS = "SELECT count(DISTINCT status) FROM {t} WHERE status NOT IN " \
    "('pending','confirmed','shipped','delivered','cancelled','refunded')"
_TIER = "SELECT count(DISTINCT tier) FROM {t} WHERE tier NOT IN ('bronze','silver','gold','platinum')"
_NEGATIVE = "SELECT count(*) FROM {t} WHERE {c} < 0"
_RATE = "SELECT count(*) FROM {t} WHERE {c} < 0 OR {c} > 100"
_ORPHAN = "SELECT count(*) FROM {t} x WHERE {c} IS NOT NULL AND NOT EXISTS " \
    "(SELECT 1 FROM sc WHERE sc.{c} = x.{c})"

CHECK_ROWS = "\nUNION ALL ".join([
    _check("not_null", "raw_orders_cdc", "event_id", "raw_o", _NULLS),
    _check("unique", "raw_orders_cdc", "event_id", "raw_o", _TWICE),
    _check("not_null", "raw_customers_cdc", "event_id", "raw_c", _NULLS),
    _check("unique", "raw_customers_cdc", "event_id", "raw_c", _TWICE),
    _check("not_null", "stg_orders", "order_id", "so", _NULLS),
    _check("unique", "stg_orders", "order_id", "so", _TWICE),
    _check("not_null", "stg_orders", "customer_id", "so", _NULLS),
    _check("relationships", "stg_orders", "customer_id", "so", _ORPHAN),
    _check("not_null", "stg_orders", "status", "so", _NULLS),
    _check("accepted_values", "stg_orders", "status", "so", _STATUS),
    _check("accepted_range", "stg_orders", "amount", "so", _NEGATIVE, "warn"),
    _check("not_null", "stg_customers", "customer_id", "sc", _NULLS),
    _check("unique", "stg_customers", "customer_id", "sc", _TWICE),
    _check("not_null", "stg_customers", "email", "sc", _NULLS, "warn"),
    _check("accepted_values", "stg_customers", "tier", "sc", _TIER),
    _check("not_null", "fct_orders", "order_id", "fct", _NULLS),
    _check("unique", "fct_orders", "order_id", "fct", _TWICE),
    _check("accepted_range", "fct_orders", "amount", "fct", _NEGATIVE, "warn"),
    _check("accepted_values", "fct_orders", "status", "fct", _STATUS),
    _check("not_null", "dim_customers", "customer_id", "dim", _NULLS),
    _check("unique", "dim_customers", "customer_id", "dim", _TWICE),
    _check("accepted_range", "dim_customers", "lifetime_gmv", "dim", _NEGATIVE),
    _check("accepted_range", "agg_daily_revenue", "cancellation_rate_pct", "daily", _RATE),
    "SELECT 'orphan_rate_under_threshold', 'fct_orders', 'error', "
    "(SELECT (count(*) FILTER (WHERE is_orphan_order) * 20 > count(*))::BIGINT FROM fct)",
    "SELECT 'no_future_orders', 'fct_orders', 'error', "
    f"(SELECT count(*) FROM fct WHERE created_at > {AS_OF})",
])
DIM_AND_DAILY = DIM + DAILY[len(FACT):]

# ------------------------------------------------------------------- events

USER_EVENTS = """
SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type,
       max(ts) AS ts, arg_max(value, (ts, event_id)) AS value
FROM events GROUP BY user_id
"""


def _rate(flag: str, digits: int) -> str:
    return f"round(100.0::DOUBLE * count(*) FILTER (WHERE {flag}) / count(*), {digits})"


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}

    # landing
    q["landing_orders_raw"] = with_(ORDER_LOG, f"SELECT {RAW_OUT} FROM raw_o")
    q["landing_customers_raw"] = with_(CUSTOMER_LOG, f"SELECT {RAW_OUT} FROM raw_c")
    q["landing_routed_counts"] = with_(f"{ORDER_LOG}, {CUSTOMER_LOG}", """
SELECT 'raw_orders_cdc' AS raw_table, op, count(DISTINCT event_id) AS events FROM o_sent GROUP BY op
UNION ALL
SELECT 'raw_customers_cdc', op, count(DISTINCT event_id) FROM c_sent GROUP BY op""")
    loads = """
loads AS (
  SELECT 'raw_orders_cdc' AS table_name, count(*) AS read, count(DISTINCT event_id) AS inserted FROM o_sent
  UNION ALL
  SELECT 'raw_customers_cdc', count(*), count(DISTINCT event_id) FROM c_sent)"""
    q["landing_load_report"] = with_(f"{ORDER_LOG}, {CUSTOMER_LOG}, {loads}", """
SELECT coalesce(table_name, 'total') AS table_name, sum(read)::BIGINT AS read,
       sum(inserted)::BIGINT AS inserted, sum(read - inserted)::BIGINT AS skipped
FROM loads GROUP BY ROLLUP (table_name)""")
    q["landing_second_batch"] = with_(ORDER_LOG, f"""
SELECT {RAW_OUT} FROM raw_o WHERE NOT ({FIRST_O})""")
    q["landing_third_load"] = with_(ORDER_LOG, f"""
SELECT {RAW_OUT} FROM raw_o WHERE NOT ({FIRST_O}) AND k % 2 = 1""")
    q["landing_mixed_report"] = with_(f"{ORDER_LOG}, {CUSTOMER_LOG}", """
, loads(table_name, read, inserted) AS (
  SELECT 'raw_orders_cdc', (SELECT count(*) FROM o_sent), (SELECT count(*) FROM raw_o) UNION ALL
  SELECT 'raw_customers_cdc', (SELECT count(*) FROM c_sent), (SELECT count(*) FROM raw_c) UNION ALL
  SELECT 'dead_letters', (SELECT count(*) FROM c_sent), (SELECT count(*) FROM raw_c))
, tries AS (
  SELECT 1 AS attempt, * FROM loads UNION ALL SELECT 2, table_name, read, 0 FROM loads)
SELECT attempt, table_name, read, inserted, read - inserted AS skipped FROM tries UNION ALL
SELECT attempt, 'total', sum(read)::BIGINT, sum(inserted)::BIGINT, sum(read - inserted)::BIGINT
FROM tries GROUP BY attempt""")
    q["landing_rerun_report"] = with_(f"{ORDER_LOG}, {CUSTOMER_LOG}, {loads}", """
SELECT 1 AS attempt, table_name, read, inserted, read - inserted AS skipped FROM loads
UNION ALL
SELECT 2, table_name, read, 0, read FROM loads""")
    q["landing_duplicate_count"] = with_(ORDER_LOG, """
SELECT count(*) - count(DISTINCT event_id) AS duplicates FROM o_sent""")
    q["change_log_lines"] = with_(f"{ORDER_LOG}, {CUSTOMER_LOG}", """
SELECT source_table, '{"event_id":"' || event_id || '","op":"' || op || '","ts_ms":' || ts_ms
       || ',"source":{"db":"derived","table":"' || source_table || '","lsn":' || lsn
       || ',"connector":"tables"},"before":' || before_json || ',"after":' || after_json || '}' AS value
FROM (SELECT event_id, op, ts_ms, source_table, lsn, before_json, after_json FROM o_sent
      UNION ALL
      SELECT event_id, op, ts_ms, source_table, lsn, before_json, after_json FROM c_sent)""")

    # current state and marts
    q["stg_orders"] = with_(STAGING, f"{ENRICHED_OUT} so")
    q["stg_customers"] = with_(STAGING, "SELECT * FROM sc")
    q["folded_orders_with_tombstones"] = with_(
        STAGING, "SELECT order_id, _last_op, _cdc_ts FROM no")
    q["int_orders_enriched"] = with_(FACT, f"{ENRICHED_OUT} fct")
    q["fct_orders"] = with_(FACT, f"{ENRICHED_OUT} fct")
    q["dim_customers"] = with_(
        DIM, "SELECT * REPLACE (lifetime_gmv::DOUBLE AS lifetime_gmv) FROM dim")
    q["agg_daily_revenue"] = with_(DAILY, """
SELECT * REPLACE (order_date::VARCHAR AS order_date, gmv::DOUBLE AS gmv) FROM daily""")
    q["orphan_orders"] = with_(FACT, """
SELECT customer_id, count(*) AS child_rows FROM fct
WHERE is_orphan_order AND customer_id IS NOT NULL GROUP BY customer_id""")
    q["events_latest_per_user"] = USER_EVENTS
    q["events_daily_volume"] = """
SELECT strftime(ts, '%Y-%m-%d') AS event_day, event_type, count(*) AS n FROM events GROUP BY ALL"""
    q["events_payload_attribute"] = """
SELECT event_type, count(props->>'$.k') AS with_k, sum((props->>'$.k')::BIGINT)::BIGINT AS sum_k
FROM events GROUP BY event_type"""

    # incremental and history
    q["incremental_state_merge"] = with_(
        STAGING, "SELECT order_id, customer_id, status, amount::DOUBLE AS amount, _last_op, _cdc_ts FROM no")
    q["incremental_fact_watermark"] = with_(TWO_BATCHES, f"""
, fresh AS (SELECT * FROM fct2 WHERE _cdc_ts > (SELECT max(_cdc_ts) FROM fct1))
{ENRICHED_OUT} (SELECT * FROM fresh UNION ALL
  SELECT * FROM fct1 WHERE order_id NOT IN (SELECT order_id FROM fresh))""")
    q["incremental_fact_affected_keys"] = with_(FACT, f"{ENRICHED_OUT} fct")
    q["incremental_watermark"] = with_(TWO_BATCHES, "SELECT max(_cdc_ts) AS watermark FROM fct1")
    q["history_customer_versions"] = with_(VERSIONS, "SELECT * FROM versions")
    q["history_tier_at_order"] = with_(VERSIONS + "," + ORDER_LOG, """
, placed AS (SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS created_at FROM orders)
SELECT p.order_id, p.customer_id, p.created_at,
       CASE WHEN v.valid_to IS NULL OR p.created_at < v.valid_to THEN v.tier END AS tier
FROM placed p ASOF LEFT JOIN versions v
  ON p.customer_id = v.customer_id AND p.created_at >= v.valid_from""")
    q["history_snapshot_runs"] = with_(TWO_BATCHES, """
, t1 AS (SELECT TIMESTAMP '2026-01-01 00:00:00' AS a, TIMESTAMP '2026-01-02 00:00:00' AS b),
verdict AS (
  SELECT x.customer_id, x.customer_id IN (SELECT customer_id FROM sc)
         AND (x.customer_id, coalesce(x.tier, '~'), coalesce(x.country, '~'), coalesce(x.email, '~'))
         NOT IN (SELECT (customer_id, coalesce(tier, '~'), coalesce(country, '~'), coalesce(email, '~'))
                 FROM sc) AS changed
  FROM sc1 x),
hist AS (
  SELECT x.customer_id, full_name, email, country, tier, updated_at, a AS since,
         CASE WHEN changed THEN b END AS until
  FROM sc1 x JOIN verdict USING (customer_id), t1
  UNION ALL
  SELECT y.customer_id, full_name, email, country, tier, updated_at, b, NULL
  FROM sc y LEFT JOIN verdict v ON v.customer_id = y.customer_id, t1
  WHERE v.changed IS NULL OR v.changed)
SELECT customer_id, full_name, email, country, tier, updated_at,
       md5(customer_id || '|' || strftime(since, '%Y-%m-%dT%H:%M:%S')) AS dbt_scd_id,
       since AS dbt_updated_at, since AS dbt_valid_from, until AS dbt_valid_to
FROM hist""")

    # quality
    q["dq_check_report"] = with_(DIM_AND_DAILY, f"""
SELECT *, CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status
FROM ({CHECK_ROWS})""")
    q["dq_null_emails"] = with_(STAGING, "SELECT customer_id, tier FROM sc WHERE email IS NULL")
    q["dq_repeated_event_ids"] = with_(ORDER_LOG, """
SELECT event_id, count(*) AS n_rows FROM o_sent GROUP BY event_id HAVING count(*) > 1""")
    q["dq_unaccepted_tiers"] = with_(STAGING, """
SELECT tier, count(*) AS n_rows FROM sc
WHERE tier NOT IN ('bronze','silver','gold','platinum') GROUP BY tier""")
    q["dq_orders_without_customer"] = with_(STAGING, """
SELECT customer_id, count(*) AS child_rows FROM so ANTI JOIN sc USING (customer_id)
WHERE customer_id IS NOT NULL GROUP BY customer_id""")
    q["dq_amounts_out_of_range"] = with_(
        STAGING, "SELECT order_id, amount::DOUBLE AS amount FROM so WHERE amount < 0")
    q["dq_orphan_rate_over_2_pct"] = with_(FACT, f"""
SELECT count(*) FILTER (WHERE is_orphan_order) AS orphans, count(*) AS total,
       {_rate('is_orphan_order', 2)} AS orphan_pct
FROM fct HAVING count(*) FILTER (WHERE is_orphan_order) * 50 > count(*)""")
    q["dq_orphan_rate_gate"] = with_(FACT, f"""
SELECT count(*) FILTER (WHERE is_orphan_order) AS orphans, count(*) AS total,
       {_rate('is_orphan_order', 2)} AS orphan_pct
FROM fct HAVING count(*) FILTER (WHERE is_orphan_order) * 20 > count(*)""")
    q["dq_future_orders"] = with_(
        FACT, f"SELECT order_id, created_at FROM fct WHERE created_at > {AS_OF}")
    q["dq_scorecard"] = with_(FACT, f"""
, m AS (
  SELECT 'orphan_rate' AS metric, {_rate('is_orphan_order', 2)} AS value, 5.0::DOUBLE AS threshold FROM fct
  UNION ALL SELECT 'future_orders', count(*)::DOUBLE, 0.0 FROM fct WHERE created_at > {AS_OF}
  UNION ALL SELECT 'drift_coverage', {_rate("currency <> 'INR'", 1)}, 1.0 FROM fct
  UNION ALL SELECT 'null_email_rate', {_rate('email IS NULL', 2)}, 5.0 FROM sc)
SELECT *, CASE WHEN metric = 'drift_coverage' THEN if(value >= threshold, 'green', 'red')
               WHEN value <= threshold THEN 'green'
               WHEN value <= threshold + threshold THEN 'yellow' ELSE 'red' END AS light
FROM m""")

    # serving
    q["srv_headline_kpis"] = with_(FACT, f"""
SELECT count(*) AS orders, count(DISTINCT customer_id) AS customers,
       round(sum(CASE WHEN is_completed THEN amount ELSE 0.00 END), 0)::DOUBLE AS gmv,
       {_rate('is_lost', 1)} AS cancel_rate, round(avg(amount), 0) AS aov FROM fct""")
    q["srv_raw_event_counts"] = with_(f"{ORDER_LOG}, {CUSTOMER_LOG}", """
, n AS (SELECT 'orders' AS log, count(*) AS events FROM raw_o
        UNION ALL SELECT 'customers', count(*) FROM raw_c)
SELECT log, events FROM n UNION ALL SELECT 'total', sum(events)::BIGINT FROM n""")
    q["srv_orphan_rate"] = with_(FACT, f"SELECT {_rate('is_orphan_order', 2)} AS orphan_pct FROM fct")
    q["srv_null_email_rate"] = with_(DIM, f"SELECT {_rate('email IS NULL', 2)} AS null_email_pct FROM dim")
    q["srv_future_orders"] = with_(
        FACT, f"SELECT count(*) AS future_orders FROM fct WHERE created_at > {AS_OF}")
    q["srv_daily_totals"] = with_(DAILY, """
SELECT order_date::VARCHAR AS order_date, sum(gmv)::DOUBLE AS gmv, sum(total_orders)::BIGINT AS orders,
       sum(completed_orders)::BIGINT AS completed, sum(lost_orders)::BIGINT AS lost
FROM daily GROUP BY ALL ORDER BY order_date""")
    q["srv_orders_by_status"] = with_(FACT, """
SELECT status, count(*) AS n,
       list_position(['pending','confirmed','shipped','delivered','cancelled','refunded'], status) - 1
         AS lifecycle_rank
FROM fct GROUP BY status ORDER BY lifecycle_rank""")
    q["srv_customers_by_tier"] = with_(DIM, """
SELECT tier, count(*) AS n,
       round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM dim), 2) AS share_pct
FROM dim GROUP BY tier""")
    country = """
SELECT country, sum(gmv)::DOUBLE AS gmv, sum(total_orders)::BIGINT AS orders
FROM daily WHERE country IS NOT NULL GROUP BY country"""
    q["srv_by_country"] = with_(DAILY, country)
    codes = """
codes(country, iso3, flag) AS (VALUES
  ('IN','IND','🇮🇳'), ('US','USA','🇺🇸'), ('GB','GBR','🇬🇧'), ('AE','ARE','🇦🇪'),
  ('SG','SGP','🇸🇬'), ('AU','AUS','🇦🇺'), ('DE','DEU','🇩🇪'), ('CA','CAN','🇨🇦'))"""
    q["srv_country_labels"] = with_(f"{DAILY}, {codes}", f"""
SELECT t.*, iso3, coalesce(flag, '') AS flag FROM ({country}) t LEFT JOIN codes USING (country)""")
    q["srv_country_map"] = with_(f"{DAILY}, {codes}", f"""
SELECT t.*, iso3, flag FROM ({country}) t JOIN codes USING (country)""")
    q["srv_cancellation_trend"] = with_(DAILY, """
SELECT order_date::VARCHAR AS order_date,
       round(avg(cancellation_rate_pct), 1) AS rate
FROM daily GROUP BY ALL ORDER BY order_date""")
    q["srv_top_customers"] = with_(DIM, """
SELECT full_name, tier, lifetime_orders, round(lifetime_gmv, 0)::DOUBLE AS gmv
FROM dim ORDER BY lifetime_gmv DESC, customer_id LIMIT 10""")
    q["srv_drift_coverage"] = with_(FACT, f"""
SELECT {_rate("currency <> 'INR'", 1)} AS drift_pct FROM fct""")
    q["srv_events_by_op"] = with_(f"{ORDER_LOG}, {CUSTOMER_LOG}", """
SELECT op, count(*) AS n,
       CASE op WHEN 'c' THEN 'Create' WHEN 'u' THEN 'Update' WHEN 'd' THEN 'Delete'
               WHEN 'r' THEN 'Snapshot' ELSE op END AS label
FROM (SELECT op FROM raw_o UNION ALL SELECT op FROM raw_c) GROUP BY op""")
    q["srv_drift_onset"] = with_(ORDER_LOG, """
SELECT strftime(epoch_ms(ts_ms), '%Y-%m-%d') AS event_day,
       round(count(after_json->>'$.currency')::DOUBLE / count(*) * 100.0::DOUBLE, 1) AS pct
FROM raw_o WHERE op = 'c' GROUP BY ALL ORDER BY event_day""")
    q["srv_customers_from_sketches"] = with_(FACT, """
SELECT country, count(DISTINCT customer_id) AS customers, true AS estimate_is_near
FROM fct WHERE created_at::DATE BETWEEN DATE '1995-01-01' AND DATE '1996-12-31' GROUP BY country""")
    q["drift_of_a_load"] = with_(ORDER_LOG, f"""
, fields AS (
  SELECT ({FIRST_O}) AND k % 20 <> 0 AND k % 211 <> 0 AS known, after_json, unnest(json_keys(after_json)) AS field
  FROM raw_o WHERE after_json <> 'null')
, kinds AS (
  SELECT known, field, CASE json_type(after_json, '$.' || field) WHEN 'NULL' THEN NULL WHEN 'VARCHAR' THEN 'string'
                                                                 ELSE 'number' END AS kind FROM fields)
, sides AS (
  SELECT field, count(*) FILTER (WHERE known) AS n, count(*) FILTER (WHERE NOT known) AS events,
         coalesce(string_agg(DISTINCT kind, ',' ORDER BY kind) FILTER (WHERE known), '') AS kinds_before,
         coalesce(string_agg(DISTINCT kind, ',' ORDER BY kind) FILTER (WHERE NOT known), '') AS kinds_found
  FROM kinds GROUP BY field)
SELECT field, CASE WHEN n = 0 THEN 'added' WHEN events = 0 THEN 'gone'
                   WHEN NOT list_has_all(string_split(kinds_before, ','), string_split(kinds_found, ',')) THEN 'retyped'
                   ELSE 'same' END AS change, kinds_before, kinds_found, events FROM sides""")
    q["srv_daily_event_volume"] = with_(ORDER_LOG, """
SELECT strftime(epoch_ms(ts_ms), '%Y-%m-%d') AS event_day, count(*) AS n
FROM raw_o GROUP BY ALL ORDER BY event_day""")
    layers = """
layers(layer, n_rows) AS (
  SELECT 'raw.orders', (SELECT count(*) FROM raw_o) UNION ALL
  SELECT 'raw.customers', (SELECT count(*) FROM raw_c) UNION ALL
  SELECT 'stg_orders', (SELECT count(*) FROM so) UNION ALL
  SELECT 'stg_customers', (SELECT count(*) FROM sc) UNION ALL
  SELECT 'int_orders', (SELECT count(*) FROM fct) UNION ALL
  SELECT 'fct_orders', (SELECT count(*) FROM fct) UNION ALL
  SELECT 'dim_customers', (SELECT count(*) FROM dim) UNION ALL
  SELECT 'agg_daily', (SELECT count(*) FROM daily))"""
    q["srv_layer_counts"] = with_(f"{DIM_AND_DAILY}, {layers}", "SELECT * FROM layers")
    q["srv_lineage_edges"] = with_(f"{DIM_AND_DAILY}, {layers}", """
SELECT e.source, e.target, l.n_rows AS weight
FROM (VALUES ('raw.orders', 'stg_orders'), ('raw.customers', 'stg_customers'),
             ('stg_orders', 'int_orders'), ('stg_customers', 'int_orders'),
             ('int_orders', 'fct_orders'), ('stg_customers', 'dim_customers'),
             ('int_orders', 'dim_customers'), ('fct_orders', 'agg_daily')) e(source, target)
JOIN layers l ON l.layer = e.source""")
    q["srv_ad_hoc_query"] = with_(DAILY, """
SELECT year(order_date)::BIGINT AS order_year, sum(total_orders)::BIGINT AS orders,
       sum(gmv)::DOUBLE AS gmv
FROM daily GROUP BY ALL""")

    # streams and the whole chain end where the batch results do
    q["stream_landed_orders"] = q["landing_orders_raw"]
    q["stream_current_orders"] = q["incremental_state_merge"]
    q["stream_load_report"] = q["landing_load_report"]
    q["stg_orders_from_documents"] = q["stg_orders"]
    q["stream_newest_orders"] = q["incremental_state_merge"]
    q["stream_fct_orders"] = q["fct_orders"]
    q["stream_agg_daily_revenue"] = q["agg_daily_revenue"]
    q["published_fct_orders"] = q["fct_orders"]
    q["published_agg_daily_revenue"] = q["agg_daily_revenue"]
    q["published_dim_customers"] = q["dim_customers"]
    q["published_fct_orders_watermark"] = q["incremental_fact_watermark"]
    q["stream_then_published_fct_orders"] = q["fct_orders"]
    q["dq_refused_run"] = with_(TWO_BATCHES, f"{ENRICHED_OUT} fct1")
    q["published_audit_report"] = with_(DIM_AND_DAILY, f"""
, r AS (SELECT * FROM ({CHECK_ROWS.replace(AS_OF, RUN_2)})),
s AS (SELECT * REPLACE (CASE WHEN check_name IN ('not_null_stg_orders_status',
        'relationships_stg_orders_customer_id', 'accepted_values_stg_customers_tier',
        'accepted_range_dim_customers_lifetime_gmv')
      THEN 'warn' ELSE severity END AS severity) FROM r)
SELECT *, CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status
FROM s""")
    q["landing_ids_assigned"] = with_(ORDER_LOG, """
SELECT substr(sha1('orders|' || id || '|' || op || '|' || ts_ms || '|' || lsn), 1, 16) AS event_id,
       op, ts_ms, lsn, id AS order_id
FROM (SELECT *, coalesce(after_json->>'$.order_id', before_json->>'$.order_id')::BIGINT AS id FROM raw_o)""")
    return q
