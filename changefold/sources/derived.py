"""A change log derived from the order and customer tables.

There is no change log among the given tables, so one is worked out from them:
every order and customer row becomes the handful of events that could have led
to it, with the faults of a real log - copies, late and rewound events,
tombstones, snapshot reads, retyped and missing attributes, orphans. All of it
is a narrow per-row expression, so the log grows with the tables and needs no
shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changefold.sources.events import envelope_line

HOUR = 3_600_000
DAY = 24 * HOUR
CUSTOMERS_SINCE = 788_918_400_000  # 1995-01-01
ORDER_COLUMNS = "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp_ntz"
CUSTOMER_COLUMNS = "c_custkey bigint, c_name string, c_nationkey int"
SOURCE_DB, CONNECTOR = "derived", "tables"
# Rows of a table that one task turns into events: some 200 MB of them.
TASK_ROWS = 200_000


def _events(names: str, *rows: tuple[str, str]) -> str:
    """SQL text of an array with one struct per event, NULL where its condition fails."""
    fields = names.split(", ")

    def struct(values: str) -> str:
        pairs = zip(fields, values.split(" | "), strict=True)
        return "named_struct(" + ", ".join(f"'{n}', {v}" for n, v in pairs) + ")"

    events = (f"if({condition}, {struct(values)}, NULL)" for condition, values in rows)
    return f"array({', '.join(events)})"


# The events of one order. Late updates carry an older time than the create; a
# rewound tombstone too, and it then loses although its log position is newer.
ORDER_EVENTS = _events(
    "op, ts_ms, lsn, status",
    ("true", "'c' | t0 | k * 10 + 1 | 'pending'"),
    ("k % 5 <> 0", f"'u' | if(k % 17 = 0, t0 - {3 * DAY}, t0 + {HOUR}) | k * 10 + 2 | later"),
    ("k % 13 = 0", f"'d' | if(k % 91 = 0, t0 - {HOUR}, t0 + {2 * HOUR}) | k * 10 + 3 | later"),
    ("k % 101 = 0", f"'r' | t0 + {HOUR // 2} | k * 10 + 4 | 'confirmed'"),
)
ORDER_IMAGE = """
    concat('{"order_id":', k, ',"customer_id":', customer,
           ',"status":', coalesce('"' || status || '"', 'null'),
           ',"amount":', CASE WHEN k % 211 = 0 THEN '"n/a"'
                              WHEN k % 20 = 0 THEN '"' || price || '"'
                              ELSE string(price) END,
           ',"created_at":"', replace(string(placed), ' ', 'T'), '+00:00',
           '","updated_at":"',
           replace(string(timestamp_millis(ts_ms)), ' ', 'T'), '+00:00"',
           CASE WHEN placed < TIMESTAMP_NTZ '1998-12-15 00:00:00' THEN ''
                WHEN k % 3 = 0 THEN ',"currency":"INR"'
                WHEN k % 3 = 1 THEN ',"currency":"USD"'
                ELSE ',"currency":"GBP"' END, '}')
"""

# A new name alone (event 4) is no new version of what is tracked; event 5
# arrives last by log position, but is older than the upgrades.
CUSTOMER_EVENTS = _events(
    "op, ts_ms, lsn, tier, suffix",
    ("true", "'c' | t0 | k * 10 + 1 | if(k % 149 = 0, 'vip', 'bronze') | ''"),
    ("k % 3 = 0", f"'u' | t0 + {500 * DAY} | k * 10 + 2 | 'silver' | ''"),
    ("k % 6 = 0",
     f"'u' | {CUSTOMERS_SINCE + 1200 * DAY} - k * 60000 | k * 10 + 3 | 'gold' | ''"),
    ("k % 12 = 0", f"'u' | t0 + {1500 * DAY} | k * 10 + 4 | 'gold' | ' Jr'"),
    ("k % 18 = 0", f"'u' | t0 + {400 * DAY} | k * 10 + 5 | 'bronze' | ''"),
    ("k % 97 = 0", f"'d' | t0 + {1600 * DAY} | k * 10 + 6 | 'bronze' | ''"),
)
# Country codes by nation; nation 24 gets a code that no lookup knows.
CUSTOMER_IMAGE = """
    concat('{"customer_id":', k, ',"full_name":"', name, suffix, '"',
           ',"email":', if(k % 33 = 0, 'null', '"user' || k || '@example.com"'),
           ',"country":"', if(nation = 24, 'ZZ', element_at(
               array('IN', 'US', 'GB', 'AE', 'SG', 'AU', 'DE', 'CA'), nation % 8 + 1)), '"',
           ',"tier":"', tier, '"',
           ',"created_at":"',
           replace(string(timestamp_millis(t0)), ' ', 'T'), '+00:00',
           '","updated_at":"',
           replace(string(timestamp_millis(ts_ms)), ' ', 'T'), '+00:00"}')
"""


def tasks_of(table: DataFrame) -> int:
    """Tasks that turn a table into events, or sort these, with ``TASK_ROWS`` of its rows each."""
    return -(-table.count() // TASK_ROWS)


def _spread(df: DataFrame) -> DataFrame:
    """Give every core a share, and no task much more than ``TASK_ROWS`` rows.

    A row becomes several wide events, so tasks that are cut by the bytes of the table
    would grow with it. The rows are counted from the file footers. A table that is read
    by enough tasks stays as it is.
    """
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, tasks_of(df))
    return df.repartition(tasks) if 2 * df.rdd.getNumPartitions() < tasks else df


def _raw(rows: DataFrame, table: str, events: str, copies: str, before: str, image: str) -> DataFrame:
    """Raw columns plus ``_copy``, which numbers the copies of one event as they arrive."""
    return (
        rows.selectExpr("*", f"inline({events})")
        .filter("op IS NOT NULL")
        .selectExpr("*", f"explode(sequence(1, {copies})) AS _copy")
        .selectExpr(
            f"substring(sha1(concat_ws('|', '{table}', k, op, ts_ms, lsn)), 1, 16) AS event_id",
            "op",
            "ts_ms",
            f"'{table}' AS source_table",
            "lsn",
            f"if(op IN ('u', 'd'), {before}, 'null') AS before_json",
            f"if(op <> 'd', {image}, 'null') AS after_json",
            "_copy",
        )
    )


def order_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw columns of the order log, copies of redelivered events included."""
    rows = _spread(spark.read.schema(ORDER_COLUMNS).parquet(f"{sf_dir}/orders.parquet")).selectExpr(
        "o_orderkey AS k",
        "if(o_custkey % 41 = 0, -o_custkey, o_custkey) AS customer",
        "if(o_orderkey % 307 = 0, -o_totalprice, o_totalprice) AS price",
        "o_orderdate AS placed",
        "unix_millis(cast(o_orderdate AS timestamp)) AS t0",
        "if(o_orderkey % 401 = 0, NULL, element_at("
        "array('delivered', 'cancelled', 'shipped', 'refunded'), int(o_orderkey % 4) + 1)) AS later",
    )
    return _raw(
        rows, "orders", ORDER_EVENTS,
        copies="CASE WHEN k % 125 = 0 THEN 3 WHEN k % 25 = 0 THEN 2 ELSE 1 END",
        before="""concat('{"order_id":', k, ',"status":"pending"}')""",
        image=ORDER_IMAGE,
    )


def customer_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw columns of the customer log. Some orders name customers that are not in it."""
    rows = _spread(
        spark.read.schema(CUSTOMER_COLUMNS).parquet(f"{sf_dir}/customer.parquet")
    ).selectExpr(
        "c_custkey AS k", "c_name AS name", "c_nationkey AS nation",
        f"{CUSTOMERS_SINCE} + c_custkey * 60000 AS t0",
    )
    return _raw(
        rows, "customers", CUSTOMER_EVENTS,
        copies="if(k % 25 = 0, 2, 1)",
        before="""concat('{"customer_id":', k, '}')""",
        image=CUSTOMER_IMAGE,
    )


def write_log(events: DataFrame, path: str, batches: int = 1) -> int:
    """Write a log as compressed JSON lines, batch after batch; returns how many files a
    stream takes at a time to meet it in so many micro-batches.

    Copies of an event and its like are dealt out to different batches. A task writes a
    file of its own in each batch, so files grow in number, not in size.
    """
    batch = F.pmod(F.xxhash64("lsn", "_copy"), F.lit(batches))
    for number in range(batches):
        part = events.filter(batch == number) if batches > 1 else events
        log_lines(part).select("value").write.mode("append").option("compression", "lz4").text(path)
    files = events.sparkSession.read.text(path).inputFiles()
    return max(1, -(-len(files) // batches))


def log_lines(events: DataFrame) -> DataFrame:
    """The log as text: one envelope per line, with a blank line now and then."""
    line = envelope_line(SOURCE_DB, CONNECTOR)
    return events.select("source_table", "_copy", line.alias("_line"), "lsn").selectExpr(
        "source_table", "_copy",
        "explode(if(lsn % 977 = 1, array(_line, '  '), array(_line))) AS value",
    )
