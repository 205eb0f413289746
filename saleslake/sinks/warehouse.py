"""A sample of a frame for an external warehouse over JDBC."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

SAMPLE_ROWS = 150


def first_rows(rows: DataFrame, order_by: Sequence[str], n: int = SAMPLE_ROWS) -> DataFrame:
    """The first ``n`` rows in the given order.

    Every task keeps its own best ``n`` and only those meet, so the whole frame is
    neither sorted nor moved.
    """
    return rows.orderBy(*order_by).limit(n)


def write_warehouse(
    rows: DataFrame,
    url: str,
    table: str,
    overwrite: bool = False,
    properties: Mapping[str, str] | None = None,
) -> None:
    """Insert rows into a warehouse table; ``overwrite`` replaces its contents."""
    rows.write.jdbc(url, table, mode="overwrite" if overwrite else "append", properties=dict(properties or {}))
