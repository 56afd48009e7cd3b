"""Run queries and their DuckDB SQL side by side and report differences.

    python -m checks.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.oracles import oracle_sql
from checks.queries import QUERIES

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def session(cores: str = "8", settings: dict[str, str] | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName("changefold")
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        # No call-site capture for every column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in (settings or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(value: object) -> object:
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def as_rows(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def difference(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both give the same columns, types and rows."""
    theirs = con.execute(sql)
    names, types = zip(*[(d[0], str(d[1])) for d in theirs.description], strict=True)
    expected = as_rows(list(names), theirs.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    kinds = {
        "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
        "timestamp_ntz": "TIMESTAMP", "int": "INTEGER",
    }
    for f in df.schema.fields:
        theirs_type = types[names.index(f.name)]
        if kinds.get(f.dataType.simpleString()) != theirs_type:
            return f"type of {f.name}: {f.dataType.simpleString()} != {theirs_type}"
    got = as_rows(df.columns, [tuple(r) for r in df.collect()])
    if got == expected:
        return None if got else "both empty"
    extra, missing = got - expected, expected - got
    return (
        f"{sum(got.values())} vs {sum(expected.values())} rows; "
        f"only here {sum(extra.values())} {list(extra)[:2]}; "
        f"only there {sum(missing.values())} {list(missing)[:2]}"
    )


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark, con, sqls = session(), duck(sf), oracle_sql()
    bad = 0
    for name in names:
        start = time.time()
        try:
            result = difference(QUERIES[name](spark, sf), con, sqls[name])
        except Exception as e:  # noqa: BLE001 - report and go on with the next query
            result = f"{type(e).__name__}: {str(e)[:600]}"
        bad += result not in (None, "both empty")
        print(f"{'ok ' if result is None else 'DIFF'} {name} {time.time() - start:.1f}s {result or ''}", flush=True)
    print(f"{len(names) - bad}/{len(names)} equal")


if __name__ == "__main__":
    main()
