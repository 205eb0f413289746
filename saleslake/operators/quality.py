"""Data tests: nulls, uniqueness, amounts, freshness."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleslake.functions.stamp import instant

PASS, WARN, FAIL, ERROR = "pass", "warn", "fail", "error"


@dataclass(frozen=True)
class FreshnessRule:
    warn_after: timedelta
    error_after: timedelta


# The default of the bronze group, and the rule of raw_sales that overrides it.
BRONZE_DEFAULT = FreshnessRule(warn_after=timedelta(days=2), error_after=timedelta(days=3))
RAW_SALES = FreshnessRule(warn_after=timedelta(hours=1), error_after=timedelta(days=2))


def not_null_failures(rows: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """One row per column: table_name, column_name, failures. One scan for all columns."""
    counts = rows.agg(*(F.count_if(F.col(name).isNull()).alias(name) for name in columns))
    return counts.unpivot([], list(columns), "column_name", "failures").select(
        F.lit(table).alias("table_name"), "column_name", "failures"
    )


def duplicate_keys(rows: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with how often. NULL is not a key."""
    return (
        rows.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count("*").alias("n_rows"))
        .where(F.col("n_rows") > 1)
    )


def non_positive(rows: DataFrame, key: str = "id", amount: str = "amount_paid") -> DataFrame:
    """Keys of rows whose amount is zero or negative; a missing amount is not one."""
    return rows.where(F.col(amount) <= 0).select(key)


@dataclass(frozen=True)
class Check:
    """One line of the report: how many rows (or keys) of a table break a rule."""

    name: str
    column: str


def table_report(
    rows: DataFrame,
    table: str,
    not_null: Sequence[str] = (),
    unique: str | None = None,
    failing: Mapping[Check, Column] | None = None,
) -> DataFrame:
    """All checks of one table in one scan: check_name, table_name, column_name, failures, status.

    ``failing`` maps further checks to the condition that a bad row meets. A unique key
    adds one shuffle of (key, counts), reduced per task first; without one the only rows
    that move are one per task.
    """
    conditions = {Check("not_null", name): F.col(name).isNull() for name in not_null}
    conditions.update(failing or {})
    names = {check: f"c{i}" for i, check in enumerate(conditions)}
    if unique is None:
        totals = rows.agg(*(F.count_if(conditions[c]).alias(n) for c, n in names.items()))
    else:
        per_key = rows.groupBy(unique).agg(
            F.count("*").alias("n_rows"),
            *(F.count_if(conditions[c]).alias(n) for c, n in names.items()),
        )
        repeated = F.col(unique).isNotNull() & (F.col("n_rows") > 1)
        sums = [F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names.values()]
        check = Check("unique", unique)
        names[check] = f"c{len(names)}"
        totals = per_key.agg(*sums, F.count_if(repeated).alias(names[check]))
    lines = [
        F.struct(
            F.lit(check.name).alias("check_name"),
            F.lit(table).alias("table_name"),
            F.lit(check.column).alias("column_name"),
            F.col(name).cast("long").alias("failures"),
        )
        for check, name in names.items()
    ]
    return with_status(totals.select(F.inline(F.array(*lines))))


def with_status(failures: DataFrame) -> DataFrame:
    return failures.withColumn("status", F.when(F.col("failures") == 0, PASS).otherwise(FAIL))


def union_reports(reports: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


def freshness(
    rows: DataFrame, loaded_at: str, now: datetime | Column, rule: FreshnessRule
) -> DataFrame:
    """One row: last_loaded_at, age_seconds, status. An empty table is an error."""
    at = now if isinstance(now, Column) else instant(now)
    seconds = F.timestamp_diff("SECOND", F.col("last_loaded_at"), at)
    status = (
        F.when(F.col("age_seconds") <= int(rule.warn_after.total_seconds()), PASS)
        .when(F.col("age_seconds") <= int(rule.error_after.total_seconds()), WARN)
        .otherwise(ERROR)
    )
    return (
        rows.agg(F.max(loaded_at).alias("last_loaded_at"))
        .withColumn("age_seconds", seconds)
        .withColumn("status", status)
    )


def require_passed(report: DataFrame) -> None:
    """Raise when a line of the report failed. The report has one line per check."""
    bad = report.where(F.col("status").isin(FAIL, ERROR)).collect()
    if bad:
        lines = "; ".join(f"{r.check_name} {r.table_name}.{r.column_name}: {r.failures}" for r in bad)
        raise AssertionError(f"{len(bad)} data checks failed: {lines}")
