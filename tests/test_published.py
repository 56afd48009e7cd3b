"""The published chain over tables of so many customers that most come after the first batch."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest

from changefold.operators.quality import QualityGateError
from changefold.plans import pipeline
from changefold.sources.tables import Warehouse
from checks import queries
from tests.conftest import rows

LATE = 2_000_000  # a customer of this key is created in 1998, as the second batch begins


@pytest.fixture
def tables(spark, tmp_path):
    customers = [*range(1, 11), *range(LATE, LATE + 30)]
    placed = datetime(1995, 6, 1)
    orders = [(k, customers[k % len(customers)], 100.0 + k, placed + timedelta(days=7 * k)) for k in range(1, 161)]
    spark.createDataFrame(
        [(k, f"Customer {k}", k % 25) for k in customers if k % 41], "c_custkey bigint, c_name string, c_nationkey int"
    ).write.parquet(f"{tmp_path}/sf/customer.parquet")
    spark.createDataFrame(
        [o for o in orders if o[1] % 41 and o[1] % 97],
        "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp_ntz",
    ).write.parquet(f"{tmp_path}/sf/orders.parquet")
    return f"{tmp_path}/sf"


@pytest.mark.parametrize(("name", "same"), [
    ("published_agg_daily_revenue", "agg_daily_revenue"),
    ("stream_then_published_fct_orders", "fct_orders"),
])
def test_a_first_batch_that_the_gate_refuses_is_taken_in_by_the_second_run(spark, tables, name, same):
    got = rows(queries.QUERIES[name](spark, tables))
    assert got and got == rows(queries.QUERIES[same](spark, tables))


def test_the_gate_still_refuses_the_first_run(spark, tables):
    """Where the end depends on what the first run published, its refusal is an error."""
    with pytest.raises(QualityGateError, match="orphan_rate_under_threshold"):
        queries.QUERIES["published_fct_orders_watermark"](spark, tables)


@pytest.mark.parametrize("failed", [["unique_fct_orders_order_id"], ["orphan_rate_under_threshold", "no_future_orders"]])
def test_a_refusal_for_another_check_is_an_error(spark, tmp_path, monkeypatch, failed):
    wh = Warehouse(spark, str(tmp_path / "tables"))

    def refuse(spark, wh, logs, run_ts, checks):
        spark.createDataFrame([(c, "fail") for c in failed], "check_name string, status string").write.parquet(
            f"{wh.base}/audit/run={pipeline.run_number(run_ts)}")
        raise QualityGateError("refused")

    monkeypatch.setattr(pipeline, "run", refuse)
    with pytest.raises(QualityGateError):
        queries.run_or_refuse(spark, wh, {}, queries.RUN_1)
