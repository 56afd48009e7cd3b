from __future__ import annotations

import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from checks.compare import session  # noqa: E402

RAW = (
    "event_id string, op string, ts_ms bigint, source_table string, lsn bigint, "
    "before_json string, after_json string"
)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    # A task may fail once, as on a cluster.
    spark = session("4, 2", {
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        "spark.sql.shuffle.partitions": "2",
        "spark.default.parallelism": "2",
    })
    yield spark
    spark.stop()


def event(key, op, ts, lsn=None, table="orders", before=None, after=None, event_id=None, **attrs):
    """One raw event; attributes make up the new image unless ``after`` is given."""
    pk = {"orders": "order_id", "customers": "customer_id"}[table]
    lsn = ts if lsn is None else lsn
    if after is None and op != "d":
        after = {pk: key, **attrs}
    if before is None and op in ("u", "d"):
        before = {pk: key}
    return {
        "event_id": event_id or f"{table}-{key}-{op}-{ts}-{lsn}",
        "op": op, "ts_ms": ts, "source_table": table, "lsn": lsn,
        "before_json": json.dumps(before), "after_json": json.dumps(after),
    }


def raw(spark, events):
    names = [f.strip().split(" ")[0] for f in RAW.split(",")]
    return spark.createDataFrame([tuple(e[n] for n in names) for e in events], RAW)


def line(e):
    """A raw event as an envelope line."""
    return json.dumps({
        "event_id": e["event_id"], "op": e["op"], "ts_ms": e["ts_ms"],
        "source": {"db": "shop", "table": e["source_table"], "lsn": e["lsn"], "connector": "test"},
        "before": json.loads(e["before_json"]), "after": json.loads(e["after_json"]),
    })


def write_lines(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(x + "\n" for x in lines))
    return str(path)


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
