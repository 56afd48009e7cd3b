"""Hot keys: what the plans do about a key that holds a large share of all rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from changefold.config import LOG_ORDER
from changefold.operators.history import as_of, versions_from_log
from changefold.operators.joins import parent_join
from changefold.operators.slices import SLICE, slice_heavy_keys
from changefold.operators.fold import first_arrivals, latest_per_key
from changefold.plans import staging
from tests.conftest import rows


def executed(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def conf(spark):
    saved = {}

    def set_conf(**values):
        for k, v in values.items():
            k = "spark.sql." + k.replace("__", ".")
            saved.setdefault(k, spark.conf.get(k, None))
            spark.conf.set(k, v)

    yield set_conf
    for k, v in saved.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_fold_limits_groups_before_the_shuffle(spark):
    raw = spark.range(10).selectExpr(
        "string(id) AS event_id", "'c' AS op", "id AS ts_ms", "id AS lsn",
        "'null' AS before_json", """concat('{"order_id":', id % 3, '}') AS after_json""",
    )
    for df in (staging.stg_orders(raw), first_arrivals(raw, ["lsn"])):
        text = df._jdf.queryExecution().executedPlan().toString()
        partial = next(x for x in text.splitlines() if "WindowGroupLimit" in x and "Partial" in x)
        exchange = next(x for x in text.splitlines() if "Exchange" in x)
        # The plan is printed from the root: the partial limit is below the exchange.
        assert text.index(exchange) < text.index(partial)


def test_parent_join_splits_a_hot_parent(spark, conf):
    conf(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        adaptive__advisoryPartitionSizeInBytes="20KB",
        adaptive__coalescePartitions__enabled="false",
        shuffle__partitions="40",
    )
    children = spark.range(0, 60_000, 1, 8).selectExpr(
        "id AS order_id", "if(id % 3 = 0, 7, id % 1000) AS customer_id", "md5(string(id)) AS status"
    )
    log = spark.range(3000).selectExpr("id % 1000 AS customer_id", "id AS ts_ms", "id AS lsn",
                                       "string(id) AS event_id", "string(id % 5) AS tier")
    parents = latest_per_key(log, ["customer_id"])
    # Without the hash the parents are read in place and no split is possible.
    assert "skew=true" not in executed(children.join(parents, "customer_id", "left"))
    joined = parent_join(children, parents, "customer_id").select("order_id", "tier")
    assert "skew=true" in executed(joined)
    assert joined.count() == 60_000
    assert joined.filter("tier IS NULL").count() == 0


@pytest.fixture(scope="module")
def tier_log(spark):
    # Key 1 holds half of all events; deletes and repeats of the same tier included.
    return spark.range(0, 4000, 1, 4).selectExpr(
        "if(id % 2 = 0, 1, id % 97) AS customer_id",
        "if(id % 31 = 0, 'd', 'u') AS op",
        "(id * 7919) % 100000 AS ts_ms",
        "id AS lsn",
        "string(id) AS event_id",
        "if(id % 31 = 0, NULL, element_at(array('bronze', 'silver', 'gold'), int(id * 31 % 7 % 3) + 1)) AS tier",
    )


def brute_versions(log):
    by_key = {}
    for r in log.collect():
        by_key.setdefault(r.customer_id, []).append(r)
    out = []
    for key, events in by_key.items():
        events.sort(key=lambda r: (r.ts_ms, r.lsn, r.event_id))
        runs = []
        for e in events:
            image = (e.op == "d", e.tier)
            if not runs or runs[-1][0] != image:
                runs.append((image, e.ts_ms))
        for i, ((gone, tier), start) in enumerate(runs):
            end = runs[i + 1][1] if i + 1 < len(runs) else None
            if not gone and (end is None or end > start):
                out.append((key, tier, start, end))
    return sorted(out, key=repr)


def in_millis(versions):
    millis = [F.unix_millis(F.col(c).cast("timestamp")) for c in ("valid_from", "valid_to")]
    return rows(versions.select("customer_id", "tier", *millis))


@pytest.mark.parametrize("parts", [500, 20, 3])
def test_versions_do_not_depend_on_slices(spark, tier_log, parts):
    sliced = slice_heavy_keys(tier_log, "customer_id", LOG_ORDER, parts, min_rows=100)
    assert sliced.any_heavy
    biggest = sliced.df.groupBy("customer_id", SLICE).count().agg(F.max("count")).first()[0]
    whole = tier_log.filter("customer_id = 1").count()
    assert biggest < whole
    got = versions_from_log(tier_log, "customer_id", ["tier"], parts=parts, min_rows=100)
    assert in_millis(got) == brute_versions(tier_log)


def test_a_hot_key_with_one_timestamp_is_sliced_too(spark):
    log = spark.range(0, 3000, 1, 4).selectExpr(
        "if(id < 2000, 1, id) AS customer_id", "'u' AS op", "5 * int(id / 1999.0) AS ts_ms", "id AS lsn",
        "string(id) AS event_id", "if(id % 2 = 0, 'gold', 'silver') AS tier",
    ).selectExpr("customer_id", "op", "bigint(ts_ms) AS ts_ms", "lsn", "event_id", "tier")
    sliced = slice_heavy_keys(log, "customer_id", LOG_ORDER, parts=10, min_rows=100)
    sizes = sliced.df.filter("customer_id = 1").groupBy(SLICE).count()
    assert sizes.count() >= 5 and sizes.agg(F.max("count")).first()[0] < 800
    got = versions_from_log(log, "customer_id", ["tier"], parts=10, min_rows=100)
    assert in_millis(got) == brute_versions(log)


def test_probes_of_one_instant_are_separated(spark):
    versions = spark.sql(
        "SELECT 1L AS customer_id, 'gold' AS tier, TIMESTAMP_NTZ'2020-01-01' AS valid_from, "
        "CAST(NULL AS TIMESTAMP_NTZ) AS valid_to"
    )
    probe = spark.range(2000).selectExpr(
        "id AS order_id", "1L AS customer_id", "TIMESTAMP_NTZ'2021-01-01' AS created_at")
    got = as_of(probe, "created_at", versions, "customer_id", ["tier"], parts=10, min_rows=100)
    assert got.filter("tier = 'gold'").count() == 2000


def test_no_slices_without_a_heavy_key(spark, tier_log):
    assert not slice_heavy_keys(tier_log, "customer_id", LOG_ORDER).any_heavy
    assert in_millis(versions_from_log(tier_log, "customer_id", ["tier"])) == brute_versions(tier_log)


@pytest.mark.parametrize("min_rows", [10**6, 100])
def test_as_of_matches_brute_force(spark, tier_log, min_rows):
    versions = versions_from_log(tier_log, "customer_id", ["tier"])
    probe = spark.range(3000).selectExpr(
        "id AS order_id",
        "CASE WHEN id % 3 = 0 THEN 1 WHEN id % 50 = 1 THEN NULL ELSE id % 120 END AS customer_id",
        "CASE WHEN id % 77 = 5 THEN NULL ELSE "
        "cast(timestamp_millis((id * 104729) % 110000 - 3000) AS timestamp_ntz) END AS created_at",
    )
    got = as_of(probe, "created_at", versions, "customer_id", ["tier"], parts=20, min_rows=min_rows)
    spans = {}
    for v in versions.collect():
        spans.setdefault(v.customer_id, []).append(v)
    expected = []
    for p in probe.collect():
        tier = None
        if p.created_at is not None:
            for v in spans.get(p.customer_id, []):
                if v.valid_from <= p.created_at and (v.valid_to is None or p.created_at < v.valid_to):
                    tier = v.tier
        expected.append((p.order_id, p.customer_id, p.created_at, tier))
    assert rows(got) == sorted(expected, key=repr)
    if min_rows == 100:
        assert slice_heavy_keys(probe, "customer_id", ["order_id"], 20, 100).any_heavy
