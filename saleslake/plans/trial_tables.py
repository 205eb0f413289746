"""The order tables of the test data, seen as sales.

A sale is a line of an order; its customer and day are in the order's header. The key
``id`` is not unique, on purpose: lines that repeat it are later versions of a sale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleslake.operators.upsert import latest_per_key
from saleslake.plans.models import FACT_COLUMNS
from saleslake.schemas import MONEY
from saleslake.session import fit_to_input
from saleslake.sources.files import total_bytes

ORDER = "order_key"
LINE_ORDER = ("loaded_at", "product_id", "employee_id", "amount_paid")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table. The session's scans and shuffles are fitted to its size."""
    path = f"{sf_dir}/{name}.parquet"
    fit_to_input(spark, total_bytes(spark, path))
    return spark.read.parquet(path)


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales without what the header knows."""
    price = F.col("l_extendedprice").cast("decimal(15,2)")
    discount = F.col("l_discount").cast("decimal(5,2)")
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("l_orderkey").alias(ORDER),
        F.col("l_suppkey").alias("employee_id"),
        F.col("l_partkey").alias("product_id"),
        (price * (1 - discount)).cast(MONEY).alias("amount_paid"),
        F.col("l_shipdate").alias("loaded_at"),
    )


def headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias(ORDER),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("transaction_date"),
    )


def with_header(rows: DataFrame, header: DataFrame) -> DataFrame:
    """Sales with customer and day. A line whose header is missing stays."""
    return rows.join(header, ORDER, "left").select(
        *FACT_COLUMNS, *(name for name in rows.columns if name not in (*FACT_COLUMNS, ORDER))
    )


def with_header_of_few(rows: DataFrame, header: DataFrame) -> DataFrame:
    """The same for a small written table of lines: the headers are cut down first.

    Both joins see the table's measured size, so the headers are filtered by a
    broadcast of it while they are scanned and are never shuffled as a whole.
    """
    return with_header(rows, header.join(rows.select(ORDER), ORDER, "left_semi"))


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_header(lines(spark, sf_dir), headers(spark, sf_dir))


def fact_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per sale, header looked up after the older versions are gone.

    The header depends on the id alone, so this equals looking it up first, but joins
    fewer rows, and an id with very many versions is reduced before it meets a join.
    """
    newest = latest_per_key(lines(spark, sf_dir), "id", LINE_ORDER)
    return with_header(newest, headers(spark, sf_dir)).select(*FACT_COLUMNS)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("first_name")
    )


def employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"),
        F.substring("s_name", 1, 8).alias("first_name"),
        F.expr("substr(s_name, 10)").alias("last_name"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name")
    )


def landed_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales as a landing file holds them, with the load time kept aside for splitting."""
    # written once per order, not per line
    text = F.date_format("transaction_date", "yyyy-MM-dd'T'HH:mm:ss")
    return with_header(lines(spark, sf_dir), headers(spark, sf_dir).withColumn("transaction_date", text))
