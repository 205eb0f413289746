"""Column contract of the layers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# At most 18 digits, so that sums and comparisons run on plain longs. Four decimals: what
# has more is rounded to them.
MONEY = T.DecimalType(18, 4)

KEY = "id"
CORRUPT = "_corrupt_record"
# JSON text of what a record holds beyond its feed's columns; NULL when that is nothing.
OTHER = "_other_attributes"


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


# What a landing file of each feed holds. transaction_date stays text until silver.
FEEDS: dict[str, T.StructType] = {
    "sales": _struct(
        id=T.LongType(),
        customer_id=T.LongType(),
        employee_id=T.LongType(),
        product_id=T.LongType(),
        amount_paid=MONEY,
        transaction_date=T.StringType(),
    ),
    "customer": _struct(id=T.LongType(), first_name=T.StringType()),
    "employee": _struct(id=T.LongType(), first_name=T.StringType(), last_name=T.StringType()),
    "product": _struct(id=T.LongType(), name=T.StringType()),
}


def with_corrupt(schema: T.StructType) -> T.StructType:
    """The schema plus the column that keeps the text of a record that did not fit."""
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)])


@dataclass(frozen=True)
class TableContract:
    """Declared data tests of one table."""

    not_null: tuple[str, ...]
    unique: tuple[str, ...] = ()


# The declared tests, table by table.
CONTRACT: dict[str, TableContract] = {
    "raw_sales": TableContract(not_null=("id", "amount_paid", "product_id")),
    "dim_customer": TableContract(not_null=("id",), unique=("id",)),
    "dim_employee": TableContract(not_null=("id", "first_name", "last_name"), unique=("id",)),
    "dim_product": TableContract(not_null=("id", "name"), unique=("id",)),
    "fact_sales": TableContract(
        not_null=("id", "customer_id", "employee_id", "product_id", "amount_paid")
    ),
}
