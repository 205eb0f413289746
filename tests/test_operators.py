"""Upsert, models, data tests and column functions on small hand-made rows."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from saleslake.functions import stamp
from saleslake.operators import quality
from saleslake.operators.upsert import (
    latest_per_key,
    merge_batch,
    merge_statement,
    rows_replaced,
    within_key_range,
)
from saleslake.plans import models
from saleslake.schemas import CONTRACT
from saleslake.sinks.names import table_name
from saleslake.sources.registry import Registry, Source

NOW = datetime(2024, 7, 21, 12, 0, tzinfo=timezone.utc)


def rows_of(frame):
    return sorted(tuple(r) for r in frame.collect())


# --- upsert -------------------------------------------------------------------------


def test_latest_per_key_takes_newest_then_largest_and_skips_null_keys(spark):
    rows = spark.createDataFrame(
        [(1, 10, "a"), (1, 20, "b"), (1, 20, "c"), (2, None, "x"), (2, 5, None), (None, 99, "n")],
        "id long, at int, v string",
    )
    assert rows_of(latest_per_key(rows, "id", ["at"])) == [(1, 20, "c"), (2, 5, None)]
    assert latest_per_key(rows, "id", ["at"]).columns == rows.columns


def test_merge_batch_wins_over_target(spark):
    target = spark.createDataFrame([(1, "t"), (2, "t")], "id long, v string")
    batch = spark.createDataFrame([(2, "b", 1), (3, "b", 1), (3, "c", 2), (None, "z", 1)], "id long, v string, at int")
    batch = latest_per_key(batch, "id", ["at"]).drop("at")
    assert rows_of(merge_batch(target, batch, "id")) == [(1, "t"), (2, "b"), (3, "c")]
    assert rows_of(rows_replaced(target, batch, "id")) == [(2, "t")]
    assert rows_of(within_key_range(target, batch, "id")) == [(2, "t")]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.integers(0, 6), st.integers(0, 9), st.integers(-3, 3)), min_size=1, max_size=30),
    st.integers(0, 10),
)
def test_upsert_in_two_batches_equals_one(spark, rows, cut):
    frame = spark.createDataFrame(rows, "id int, at int, v int")
    whole = latest_per_key(frame, "id", ["at"])
    old = latest_per_key(frame.where(F.col("at") < cut), "id", ["at"])
    new = latest_per_key(frame.where(F.col("at") >= cut), "id", ["at"])
    brute = {}
    for i, at, v in rows:
        brute[i] = max(brute.get(i, (at, v)), (at, v))
    expected = sorted((i, at, v) for i, (at, v) in brute.items())
    assert rows_of(whole) == expected
    assert rows_of(merge_batch(old, new, "id")) == expected


def test_a_key_with_a_third_of_the_rows_is_reduced_before_the_shuffle(spark):
    hot = spark.range(0, 30_000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + 100).alias("id"), F.col("id").alias("at")
    )
    newest = latest_per_key(hot, "id", ["at"])
    assert newest.where("id = 7").first()["at"] == 29_997
    assert newest.count() == 20_001
    plan = newest._jdf.queryExecution().executedPlan().toString()
    partial, exchange = plan.index("partial_max"), plan.index("Exchange hashpartitioning(id")
    assert exchange < partial  # plans print from the result down: partial below exchange


def test_merge_statement_parses(spark):
    text = merge_statement("cat.silver.fact_sales", "batch", ["id"])
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(text).toString()
    assert "MergeIntoTable" in plan


# --- models -------------------------------------------------------------------------

FACT = (
    "id long, customer_id long, employee_id long, product_id long, amount_paid decimal(18,4), transaction_date string"
)


def sale(i, amount, day, customer=1, employee=1, product=1):
    return (i, customer, employee, product, None if amount is None else Decimal(amount), day)


def test_daily_summary(spark):
    rows = spark.createDataFrame(
        [
            sale(1, "10.5", "2024-07-20", customer=1, product=1),
            sale(2, "0.25", "7/20/2024", customer=1, product=2),
            sale(3, None, "2024-07-20T23:59:59", customer=2, product=2),
            sale(4, "7", "junk"),
            sale(5, "8", None),
        ],
        FACT,
    )
    fact = models.fact_sales(rows, newest_by=())
    for one_scan in (True, False):
        out = models.daily_sales_summary(fact, one_scan).collect()
        assert [tuple(r) for r in out] == [(date(2024, 7, 20), 3, 10.75, 5.375, 0.25, 10.5, 2, 1, 2)]
    assert fact.where("transaction_date is null").count() == 2


def test_enriched_keeps_a_sale_without_its_product(spark):
    fact = spark.createDataFrame([sale(1, "1", "2024-07-20", product=9), sale(2, "2", None, customer=None)], FACT)
    person = spark.createDataFrame([(1, "Ann", "Lee")], "id long, first_name string, last_name string")
    product = spark.createDataFrame([(1, "nut")], "id long, name string")
    out = models.sales_enriched(fact, person, person, product).orderBy("id").collect()
    assert [(r.id, r.customer_name, r.employee_last_name, r.product_name) for r in out] == [
        (1, "Ann", "Lee", None),
        (2, None, "Lee", "nut"),
    ]


def test_enriched_splits_a_hot_foreign_key_when_a_dimension_is_too_big_to_broadcast(spark):
    """With broadcasts off, one customer holding half of the sales is split over tasks."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "60KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "30KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key) for key in conf if spark.conf.get(key, None) is not None}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        fact = spark.range(0, 60_000, 1, 8).select(
            "id",
            F.when(F.col("id") % 2 == 0, 5).otherwise(F.col("id") % 500).alias("customer_id"),
            (F.col("id") % 50).alias("employee_id"),
            (F.col("id") % 70).alias("product_id"),
            F.lit(1).cast("decimal(18,4)").alias("amount_paid"),
            F.current_timestamp().alias("transaction_date"),
        )
        people = spark.range(500).select("id", F.lit("f").alias("first_name"), F.lit("l").alias("last_name"))
        things = spark.range(500).select("id", F.lit("n").alias("name"))
        out = models.sales_enriched(fact, people, people, things)
        assert out.where("product_name is null or customer_name is null").count() == 0
        out.collect()
        assert "SortMergeJoin(skew=true)" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in conf:
            if key in before:
                spark.conf.set(key, before[key])
            else:
                spark.conf.unset(key)


# --- data tests ---------------------------------------------------------------------


def test_contract_counts():
    assert sum(len(c.not_null) for c in CONTRACT.values()) == 14
    assert sum(len(c.unique) for c in CONTRACT.values()) == 3


def test_non_positive_ignores_null(spark):
    rows = spark.createDataFrame([(1, 1.0), (2, 0.0), (3, -1.0), (4, None)], "id long, amount_paid double")
    assert rows_of(quality.non_positive(rows)) == [(2,), (3,)]
    assert rows_of(quality.not_null_failures(rows, "t", ["amount_paid"])) == [("t", "amount_paid", 1)]


def test_unique_and_not_null_agree_in_the_report(spark):
    rows = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "id long")
    assert rows_of(quality.duplicate_keys(rows, "id")) == [(1, 2)]
    report = rows_of(quality.table_report(rows, "t", ["id"], unique="id"))
    assert report == [("not_null", "t", "id", 2, "fail"), ("unique", "t", "id", 1, "fail")]
    with pytest.raises(AssertionError, match="not_null t.id: 2"):
        quality.require_passed(quality.table_report(rows, "t", ["id"]))


def test_report_of_an_empty_table_passes(spark):
    rows = spark.createDataFrame([], "id long, amount_paid double")
    report = quality.table_report(
        rows, "t", ["id"], "id", {quality.Check("positive", "amount_paid"): F.col("amount_paid") <= 0}
    )
    assert {r.status for r in report.collect()} == {"pass"} and report.count() == 3
    quality.require_passed(report)


@pytest.mark.parametrize(
    ("age", "status"),
    [
        (timedelta(hours=1), "pass"),
        (timedelta(hours=1, seconds=1), "warn"),
        (timedelta(days=2), "warn"),
        (timedelta(days=2, seconds=1), "error"),
        (None, "error"),
    ],
)
def test_freshness_limits(spark, age, status):
    rows = spark.range(0 if age is None else 1).select(stamp.instant(NOW - (age or timedelta())).alias("loaded_at"))
    out = quality.freshness(rows, "loaded_at", NOW, quality.RAW_SALES).first()
    assert out.status == status
    assert out.age_seconds == (None if age is None else int(age.total_seconds()))


# --- names, sources -----------------------------------------------------------------


def test_table_name():
    assert table_name(" silver ", "fact_sales") == "silver.fact_sales"
    assert table_name(None, "daily", "target") == "target.daily"


def test_registry(spark):
    known = Registry(group_freshness={"layer_bronze": quality.BRONZE_DEFAULT})
    known.add(Source("layer_bronze", "raw_sales", "bronze", "sales", "loaded_at", quality.RAW_SALES))
    known.add(Source("layer_bronze", "other", "bronze"))
    assert known.get("layer_bronze", "raw_sales").table == "bronze.sales"
    assert known.get("layer_bronze", "other").table == "bronze.other"
    assert known.freshness_of("layer_bronze", "raw_sales") == quality.RAW_SALES
    assert known.freshness_of("layer_bronze", "other") == quality.BRONZE_DEFAULT
    with pytest.raises(LookupError, match="raw_sales"):
        known.get("layer_bronze", "sales")


# --- columns ------------------------------------------------------------------------


def test_parse_timestamp(spark):
    texts = ["2024-07-20", "2024-07-21T10:00:00Z", "7/21/2024", "junk", None, "13/45/2024", "12:30", "T12:30:45"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    out = [r[0] for r in rows.select(stamp.parse_timestamp("t").cast("string")).collect()]
    assert out == ["2024-07-20 00:00:00", "2024-07-21 10:00:00", "2024-07-21 00:00:00", None, None, None, None, None]


def test_stamps_are_true_instants_whatever_the_session_zone(spark):
    run = datetime(2024, 7, 21, 12, 35, 0, 999_999, tzinfo=timezone(timedelta(hours=2)))
    rows = stamp.with_loaded_at(spark.range(2), run)
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        seconds = {r[0] for r in rows.select(F.unix_timestamp("loaded_at")).collect()}
        clock = {r[0] for r in rows.select(stamp.wall_clock("loaded_at").cast("string")).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert seconds == {int(datetime(2024, 7, 21, 10, 35, tzinfo=timezone.utc).timestamp())}
    assert clock == {"2024-07-21 11:35:00"}
    with pytest.raises(ValueError, match="time zone"):
        stamp.as_utc(datetime(2024, 7, 21))


def test_text_literal_to_timestamp(spark):
    out = spark.range(1).select(
        F.lit("2024-07-21 10:35:00").cast("timestamp").cast("string"),
        F.lit("no").try_cast("timestamp"),
        stamp.day_text(F.lit("2024-07-21 23:59:59").cast("timestamp")),
    )
    assert tuple(out.first()) == ("2024-07-21 10:35:00", None, "2024-07-21")
