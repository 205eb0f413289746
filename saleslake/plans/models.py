"""Silver and gold models."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleslake.functions.stamp import parse_timestamp
from saleslake.operators.upsert import latest_per_key
from saleslake.schemas import KEY

FACT_COLUMNS = (
    "id",
    "customer_id",
    "employee_id",
    "product_id",
    "amount_paid",
    "transaction_date",
)
DIMENSIONS: dict[str, tuple[str, ...]] = {
    "dim_customer": ("id", "first_name"),
    "dim_employee": ("id", "first_name", "last_name"),
    "dim_product": ("id", "name"),
}
PERIOD = "sales_period"
BUCKET = "id_bucket"
DAY = "sales_date"
NO_PERIOD = "unknown"
SOURCE = "source_batch"  # the batch of bronze that a stored row came from


def dimension(rows: DataFrame, model: str, newest_by: Sequence[str] = ()) -> DataFrame:
    """The newest attributes of every id; the batch they came from stays with them."""
    columns = DIMENSIONS[model]
    extra = [name for name in newest_by if name not in columns]
    kept = [name for name in (*columns, *extra) if name in columns or name == SOURCE]
    return latest_per_key(rows.select(*columns, *extra), KEY, newest_by).select(*kept)


def with_bucket(rows: DataFrame, buckets: int) -> DataFrame:
    """Add the partition of each key: one of ``buckets``, told by the key alone."""
    return rows.withColumn(BUCKET, F.pmod(F.xxhash64(KEY), F.lit(buckets)).cast("string"))


def with_transaction_time(rows: DataFrame) -> DataFrame:
    """transaction_date as a time; text that is no date becomes NULL."""
    if isinstance(rows.schema["transaction_date"].dataType, T.StringType):
        return rows.withColumn("transaction_date", parse_timestamp("transaction_date"))
    return rows


# Within one load, rows of an id are ranked by their own values, in this order.
FACT_TIE_BREAK = ("transaction_date", "product_id", "employee_id", "customer_id", "amount_paid")


def fact_sales(rows: DataFrame, newest_by: Sequence[str] = ("loaded_at",)) -> DataFrame:
    """The newest version of every sale; the batch it came from stays with it."""
    order = (*newest_by, *(name for name in FACT_TIE_BREAK if name not in newest_by))
    extra = [name for name in newest_by if name not in FACT_COLUMNS]
    parsed = with_transaction_time(rows.select(*FACT_COLUMNS, *extra))
    kept = [name for name in (*FACT_COLUMNS, *extra) if name in FACT_COLUMNS or name == SOURCE]
    return latest_per_key(parsed, KEY, order).select(*kept)


def with_period(fact: DataFrame, pattern: str) -> DataFrame:
    """Add the partition of each sale. Undated sales have a partition of their own."""
    period = F.coalesce(F.date_format("transaction_date", pattern), F.lit(NO_PERIOD))
    return fact.withColumn(PERIOD, period)


# The counts of gold and the columns they count.
DAILY_COUNTS = {"n_customers": "customer_id", "n_employees": "employee_id", "n_products": "product_id"}


def daily_sales_summary(fact: DataFrame, one_scan: bool = True) -> DataFrame:
    """One row per day with a sale. Sums are exact decimals until the last step.

    With ``one_scan`` the distinct counts share a scan, which repeats each sale four
    times ahead of the partial aggregate. Without it each count scans its own column
    and day and only the daily results are joined: less to shuffle, and the better
    choice for a large stored fact, but a computed one would be computed four times.
    """
    amount = "amount_paid"
    total = F.sum(amount).cast("double")
    measures = [
        F.count("*").alias("n_transactions"),
        total.alias("total_amount"),
        (total / F.count(amount)).alias("avg_amount"),
        F.min(amount).cast("double").alias("min_amount"),
        F.max(amount).cast("double").alias("max_amount"),
    ]
    counts = [F.count_distinct(column).alias(name) for name, column in DAILY_COUNTS.items()]
    dated = fact.where(F.col("transaction_date").isNotNull())
    by_day = dated.groupBy(F.to_date("transaction_date").alias(DAY))
    if one_scan:
        return by_day.agg(*measures, *counts)
    return reduce(lambda days, count: days.join(by_day.agg(count), DAY), counts, by_day.agg(*measures))


def sales_enriched(
    fact: DataFrame, customers: DataFrame, employees: DataFrame, products: DataFrame
) -> DataFrame:
    """Sales with the names behind their keys; a sale without its dimension row stays.

    No broadcast is forced. The optimizer broadcasts a dimension whose measured size is
    under its threshold; a larger one is joined by shuffle, where adaptive execution
    splits the partition of a key that holds many sales.
    """
    customer = customers.select(F.col("id").alias("customer_id"), F.col("first_name").alias("customer_name"))
    employee = employees.select(
        F.col("id").alias("employee_id"),
        F.col("first_name").alias("employee_first_name"),
        F.col("last_name").alias("employee_last_name"),
    )
    product = products.select(F.col("id").alias("product_id"), F.col("name").alias("product_name"))
    return (
        fact.join(customer, "customer_id", "left")
        .join(employee, "employee_id", "left")
        .join(product, "product_id", "left")
        .select(*fact.columns, "customer_name", "employee_first_name", "employee_last_name", "product_name")
    )
