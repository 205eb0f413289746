"""Writing and removing landing files."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleslake.sources import files
from saleslake.sources.landing import NoLandingFile, latest_file, manifest

DAY = "ingest_date"


def write_landing(rows: DataFrame, root: str, day: date | str | None = None, fmt: str = "json") -> None:
    """Write rows as the batch of their day; a day that was there is replaced, others stay.

    Without ``day`` the rows carry their own ``ingest_date`` column. Rows of one day
    are brought together first, so that a wide job does not leave one small file per
    task and day; adaptive execution splits a day that is large.

    A write that fails leaves what was there: new files are put beside the former ones by the
    job's commit, and only then do the former go. A driver that dies between the two leaves both;
    the day's next write removes them.
    """
    if fmt not in ("json", "csv"):
        raise ValueError(f"unsupported landing format: {fmt!r}")
    spark = rows.sparkSession
    if day is not None:
        # the folder itself, so that a day without rows replaces what was there too
        path = f"{root.rstrip('/')}/{DAY}={day}"
        former = files.files_in(spark, path)
        writer = rows.drop(DAY).write.mode("append")
    else:
        by_day = rows.hint("rebalance", DAY).write.partitionBy(DAY)
        # staged by the job and put in place by its commit
        writer, path, former = by_day.option("partitionOverwriteMode", "dynamic").mode("overwrite"), root, []
    writer = writer.format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(path)
    files.delete_all(spark, former)


def undo_latest_object(spark: SparkSession, root: str, prefix: str) -> str:
    """Remove the newest named object and return its path."""
    path = latest_file(spark, root, prefix)["path"]
    files.delete(spark, path)
    return path


def undo_latest_day(spark: SparkSession, root: str) -> str:
    """Remove the newest dated folder and return its day."""
    newest = manifest(spark, root, suffix=None).agg(F.max("batch_day")).first()[0]
    if newest is None:
        raise NoLandingFile(f"no dated landing folder under {root}")
    files.delete(spark, f"{root.rstrip('/')}/{DAY}={newest}")
    return newest


def purge_objects(spark: SparkSession, root: str, prefix: str, confirm: bool = False) -> int:
    """Remove every named object of the prefix, whatever its suffix; return how many."""
    if not confirm:
        raise PermissionError(f"purging {prefix}_* under {root} needs confirm=True")
    paths = [row["path"] for row in manifest(spark, root, prefix, suffix=None).select("path").collect()]
    return files.delete_all(spark, paths)


def purge_days(spark: SparkSession, root: str, confirm: bool = False) -> bool:
    """Remove the whole folder of a dated landing."""
    if not confirm:
        raise PermissionError(f"purging {root} needs confirm=True")
    return files.delete(spark, root)
