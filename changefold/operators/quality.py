"""Data-quality checks: each counts failing rows and carries a severity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changefold.operators.joins import orphan_keys

ERROR, WARN = "error", "warn"
REPORT_COLUMNS = ["check_name", "table_name", "severity", "failures", "status"]


@dataclass(frozen=True)
class Check:
    """One rule on one column.

    ``kind``: ``not_null``, ``unique``, ``accepted_values`` (``values``),
    ``relationships`` (``parent`` table with the same column) or
    ``accepted_range`` (``low``/``high``, inclusive). Apart from ``not_null``
    every rule lets NULL pass.
    """

    table: str
    column: str
    kind: str
    severity: str = ERROR
    values: tuple[str, ...] = ()
    parent: str | None = None
    low: float | None = None
    high: float | None = None

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.table}_{self.column}"


def null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def repeated_values(df: DataFrame, column: str) -> DataFrame:
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column).agg(F.count("*").alias("n_rows"))
        .filter("n_rows > 1")
    )


def unaccepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Distinct values outside the list, with their row counts."""
    return (
        df.filter(~F.col(column).isin(*values))
        .groupBy(column).agg(F.count("*").alias("n_rows"))
    )


def outside(column: str, low: float | None, high: float | None) -> Column:
    value = F.col(column)
    below = F.lit(False) if low is None else value < F.lit(low)
    above = F.lit(False) if high is None else value > F.lit(high)
    return below | above


def rows_outside_range(
    df: DataFrame, column: str, low: float | None = None, high: float | None = None
) -> DataFrame:
    return df.filter(outside(column, low, high))


def _finish(counts: DataFrame) -> DataFrame:
    status = F.when(F.col("failures") == 0, "pass").when(
        F.col("severity") == WARN, "warn"
    ).otherwise("fail")
    return counts.withColumn("status", status).select(*REPORT_COLUMNS)


def _as_rows(totals: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row per check from the columns ``n0``, ``n1``, ... of a one-row frame."""
    rows = ", ".join(
        f"named_struct('check_name', '{c.name}', 'table_name', '{c.table}', "
        f"'severity', '{c.severity}', 'failures', bigint(coalesce(n{i}, 0)))"
        for i, c in enumerate(checks)
    )
    return totals.selectExpr(f"inline(array({rows}))")


def row_check_counts(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Not-null and range rules of one table in a single pass over it."""
    failing = [
        F.col(c.column).isNull() if c.kind == "not_null" else outside(c.column, c.low, c.high)
        for c in checks
    ]
    return _as_rows(
        df.agg(*[F.count_if(f).alias(f"n{i}") for i, f in enumerate(failing)]), checks
    )


def value_check_counts(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Not-null, unique and accepted-values rules of one column, all from the rows
    counted per value: one shuffle, after map-side combine."""
    value, n = F.col(checks[0].column), F.col("n_rows")

    def failures(c: Check) -> Column:
        if c.kind == "not_null":
            return F.sum(F.when(value.isNull(), n))
        if c.kind == "unique":
            return F.count_if(value.isNotNull() & (n > 1))
        return F.count_if(~value.isin(*c.values))

    per_value = df.groupBy(value).agg(F.count("*").alias("n_rows"))
    return _as_rows(per_value.agg(*[failures(c).alias(f"n{i}") for i, c in enumerate(checks)]), checks)


def parent_check_counts(df: DataFrame, parent: DataFrame, check: Check) -> DataFrame:
    return _as_rows(
        orphan_keys(df, parent, check.column).agg(F.sum("child_rows").alias("n0")), [check]
    )


def as_count(check_name: str, table: str, severity: str, failing: Column, df: DataFrame) -> DataFrame:
    return df.agg(failing.cast("bigint").alias("failures")).select(
        F.lit(check_name).alias("check_name"),
        F.lit(table).alias("table_name"),
        F.lit(severity).alias("severity"),
        "failures",
    )


def check_report(
    tables: Mapping[str, DataFrame],
    checks: Sequence[Check],
    extra: Sequence[DataFrame] = (),
) -> DataFrame:
    """One row per check: failures and pass / warn / fail.

    ``extra`` are further counts with the columns of ``as_count``.
    """
    by_column: dict[tuple[str, str], list[Check]] = {}
    for c in checks:
        by_column.setdefault((c.table, c.column), []).append(c)
    parts, by_row = [], {}
    for (table, _), here in by_column.items():
        parents = [c for c in here if c.kind == "relationships"]
        per_row = [c for c in here if c.kind in ("not_null", "accepted_range")]
        per_value = [c for c in here if c.kind in ("unique", "accepted_values")]
        if per_value:
            # The column is grouped anyway, so its NULLs are counted there too.
            per_value += [c for c in per_row if c.kind == "not_null"]
            per_row = [c for c in per_row if c.kind != "not_null"]
            parts.append(value_check_counts(tables[table], per_value))
        parts += [parent_check_counts(tables[table], tables[c.parent], c) for c in parents]
        by_row.setdefault(table, []).extend(per_row)
    parts += [row_check_counts(tables[t], cs) for t, cs in by_row.items() if cs]
    return _finish(reduce(DataFrame.unionByName, [*parts, *extra]))


def traffic_light(value: Column, threshold: float, low_is_good: bool = True) -> Column:
    """Green within tolerance; yellow up to twice it where low is good; else red."""
    if low_is_good:
        return (
            F.when(value <= threshold, "green")
            .when(value <= 2 * threshold, "yellow")
            .otherwise("red")
        )
    return F.when(value >= threshold, "green").otherwise("red")


class QualityGateError(RuntimeError):
    """Raised when a check of severity ``error`` failed; the run is not published."""


def require_pass(report: DataFrame) -> None:
    """Stop the run if any error-level check failed. The report has one row per check."""
    failed = report.filter("status = 'fail'").orderBy("check_name").collect()
    if failed:
        names = ", ".join(f"{r.check_name} ({r.failures})" for r in failed)
        raise QualityGateError(f"quality gate failed: {names}")
