"""One row per key, and merging a batch into a keyed table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(rows: DataFrame, key: str, newest_by: Sequence[str]) -> DataFrame:
    """The newest row of every key; rows without a key are left out.

    Newest is the largest by ``newest_by``, then by every other column, so that the
    answer does not depend on the order of arrival. It is an aggregate, not a window:
    each task reduces a key to one row before the shuffle, so a key that holds a third
    of the table costs one row per task, and the sort is on the key alone.
    """
    others = [name for name in rows.columns if name != key and name not in newest_by]
    packed = F.struct(*newest_by, *others)
    newest = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(packed).alias("newest"))
    return newest.select(*(F.col(n) if n == key else F.col(f"newest.{n}") for n in rows.columns))


def merge_batch(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """The target after an upsert. The batch must hold each key once."""
    untouched = target.join(batch.select(key), key, "left_anti")
    return untouched.unionByName(batch)


def rows_replaced(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """The target's rows whose key the batch brings again."""
    return target.join(batch.select(key), key, "left_semi")


def within_key_range(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """The target's rows that can match the batch at all.

    The batch's smallest and largest key become literals that Parquet compares with
    the ranges of its row groups; new sales mostly carry new ids, so most are skipped.
    """
    low, high = batch.agg(F.min(key), F.max(key)).first()
    return target.where(F.col(key).between(low, high))


def merge_statement(target: str, batch: str, key: Sequence[str]) -> str:
    """The upsert as MERGE, for a catalog whose tables support it."""
    on = " AND ".join(f"t.`{k}` = b.`{k}`" for k in key)
    return (
        f"MERGE INTO {target} t USING {batch} b ON {on} "
        "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"
    )
