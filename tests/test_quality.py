from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from changefold.operators import quality as q
from changefold.plans import gates
from tests.conftest import rows

AS_OF = datetime(2026, 1, 1)


def report(tables, checks):
    return {r.check_name: (r.failures, r.status) for r in q.check_report(tables, checks).collect()}


@pytest.fixture(scope="module")
def t(spark):
    return spark.createDataFrame(
        [(1, "a", 5.0, 1), (2, "b", -1.0, 2), (2, None, 101.0, 9), (None, "zzz", None, None)],
        "id bigint, kind string, amount double, parent bigint",
    )


def test_each_rule_counts_its_failures(spark, t):
    parents = spark.createDataFrame([(1,), (2,)], "parent bigint")
    got = report({"t": t, "p": parents}, [
        q.Check("t", "id", "not_null"),
        q.Check("t", "id", "unique"),
        q.Check("t", "kind", "accepted_values", values=("a", "b")),
        q.Check("t", "amount", "accepted_range", low=0, high=100),
        q.Check("t", "parent", "relationships", parent="p"),
    ])
    assert got == {
        "not_null_t_id": (1, "fail"),
        "unique_t_id": (1, "fail"),
        "accepted_values_t_kind": (1, "fail"),
        "accepted_range_t_amount": (2, "fail"),
        "relationships_t_parent": (1, "fail"),
    }


def test_each_rule_passes_on_good_rows_and_lets_null_pass(spark):
    good = spark.createDataFrame(
        [(1, "a", 0.0, 1), (2, "b", 100.0, None), (3, None, None, 1)],
        "id bigint, kind string, amount double, parent bigint",
    )
    got = report({"t": good, "p": spark.createDataFrame([(1,)], "parent bigint")}, [
        q.Check("t", "id", "not_null"),
        q.Check("t", "id", "unique"),
        q.Check("t", "kind", "accepted_values", values=("a", "b")),
        q.Check("t", "amount", "accepted_range", low=0, high=100),
        q.Check("t", "parent", "relationships", parent="p"),
    ])
    assert set(got.values()) == {(0, "pass")}


def test_a_warning_is_reported_but_does_not_block(spark, t):
    checks = [q.Check("t", "id", "not_null", q.WARN), q.Check("t", "amount", "accepted_range", q.WARN, low=0)]
    df = q.check_report({"t": t}, checks)
    assert {r.status for r in df.collect()} == {"warn"}
    q.require_pass(df)
    with pytest.raises(q.QualityGateError, match=r"not_null_t_id \(1\)"):
        q.require_pass(q.check_report({"t": t}, [q.Check("t", "id", "not_null")]))


def fact(spark, n, orphans, created="2025-01-01 00:00:00"):
    return spark.range(n).select(
        F.col("id").alias("order_id"),
        (F.col("id") < orphans).alias("is_orphan_order"),
        F.lit(created).cast("timestamp_ntz").alias("created_at"),
        F.lit("INR").alias("currency"),
    )


def test_orphan_rate_gate_is_strictly_above_the_threshold(spark):
    assert gates.orphan_rate(fact(spark, 100, 5)).count() == 0
    assert rows(gates.orphan_rate(fact(spark, 100, 6))) == [(6, 100, 6.0)]
    assert gates.orphan_rate(fact(spark, 0, 0)).count() == 0


def test_future_orders(spark):
    assert gates.future_orders(fact(spark, 3, 0), AS_OF).count() == 0
    assert gates.future_orders(fact(spark, 3, 0, "2026-01-01 00:00:00"), AS_OF).count() == 0
    assert gates.future_orders(fact(spark, 3, 0, "2026-01-01 00:00:01"), AS_OF).count() == 3


def test_declared_checks():
    assert len(gates.CHECKS) == 23
    assert sum(c.severity == q.WARN for c in gates.CHECKS) == 3
    assert len({c.name for c in gates.CHECKS}) == 23


@pytest.mark.parametrize(("value", "low_is_good", "light"), [
    (5.0, True, "green"), (5.01, True, "yellow"), (10.0, True, "yellow"), (10.01, True, "red"),
    (5.0, False, "green"), (4.99, False, "red"),
])
def test_traffic_light(spark, value, low_is_good, light):
    got = spark.range(1).select(q.traffic_light(F.lit(value), 5, low_is_good).alias("x")).first().x
    assert got == light


def test_scorecard(spark):
    customers = spark.createDataFrame([(1, None), (2, "x")], "customer_id bigint, email string")
    got = {r.metric: (r.value, r.light) for r in gates.scorecard(fact(spark, 100, 7), customers, AS_OF).collect()}
    assert got == {
        "orphan_rate": (7.0, "yellow"), "future_orders": (0.0, "green"),
        "drift_coverage": (0.0, "red"), "null_email_rate": (50.0, "red"),
    }
