"""Bronze: append-only tables with one partition per load run.

A partition is visible only once the catalog lists it, after all its files are in
place. So a run that dies leaves nothing behind that a reader sees, and a repeated
run replaces its own partition instead of adding the rows again. Partition names
sort by load time, which turns "the last batch" into partition pruning and "undo the
last batch" into a catalog change. Batches are numbered in the order in which they are
appended, also those of a run that comes late; readers remember the numbers they have read.

Two small tables stand beside a bronze table, with a partition per batch as well. One has the
files that the batch was loaded from, empty ones too. It is written first and counts only for
batches that the catalog lists: one change of the catalog decides on rows and files, be it an
append, an undo or a purge. The other has what was counted while the batch was written.
"""

from __future__ import annotations

import hashlib
from collections.abc import Collection, Mapping, Sequence
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleslake.functions.stamp import as_utc, with_loaded_at
from saleslake.schemas import OTHER, with_corrupt

BATCH = "batch_id"
ROWS = "rows"
_NUMBERED = "saleslake.batches"
_UNDONE = "saleslake.undone"
_STAMPS = (
    T.StructField(OTHER, T.StringType(), True),
    T.StructField("source_file", T.StringType(), True),
    T.StructField("received_at", T.TimestampType(), True),
    T.StructField("loaded_at", T.TimestampType(), True),
)
FILE = "source_file STRING, received_at TIMESTAMP"
_COUNT = "counted STRING, n BIGINT"
_ARROW = {"STRING": pa.string(), "BIGINT": pa.int64(), "TIMESTAMP": pa.timestamp("us", "UTC")}


def run_stamp(run_ts: datetime) -> str:
    """How the names of a run's batches begin."""
    return f"{as_utc(run_ts):%Y%m%dT%H%M%S}"


def create_bronze(spark: SparkSession, table: str, schema: T.StructType) -> None:
    columns = T.StructType([*with_corrupt(schema).fields, *_STAMPS])
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({ddl}, {BATCH} STRING) "
        f"USING parquet PARTITIONED BY ({BATCH})"
    )


def _batches(spark: SparkSession, table: str) -> DataFrame:
    """The load runs of a table, from the catalog alone."""
    return spark.sql(f"SHOW PARTITIONS {table}").select(
        F.regexp_extract("partition", rf"{BATCH}=(.*)$", 1).alias(BATCH)
    )


def number_of(batch: Column) -> Column:
    """The number in a batch's name."""
    return F.split(batch, "-").getItem(1).cast("long")


def batches(spark: SparkSession, table: str) -> dict[int, str]:
    """The load runs of a table by number: as many names as it has partitions."""
    if not spark.catalog.tableExists(table):
        return {}
    return {int(row[BATCH].split("-")[1]): row[BATCH] for row in _batches(spark, table).collect()}


def newest_batch(spark: SparkSession, table: str) -> str | None:
    """The last load run; None when there is none."""
    if not spark.catalog.tableExists(table):
        return None
    return _batches(spark, table).agg(F.max(BATCH)).first()[0]


def _property(spark: SparkSession, table: str, key: str) -> str:
    found = spark.sql(f"SHOW TBLPROPERTIES {table}").where(F.col("key") == key).first()
    return found["value"] if found else ""


def _next_number(spark: SparkSession, table: str) -> int:
    """A number that no batch of the table had before, also none that was dropped since."""
    number = int(_property(spark, table, _NUMBERED) or 0) + 1
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{_NUMBERED}' = '{number}')")
    return number


def _beside(table: str, what: str) -> str:
    return f"{table}__{what}"


def _write_beside(spark: SparkSession, table: str, what: str, batch: str, columns: str, rows: Collection[tuple]) -> None:
    name = _beside(table, what)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}, {BATCH} STRING) USING parquet PARTITIONED BY ({BATCH})")
    names, kinds = zip(*(column.split() for column in columns.split(", ")), strict=True)
    # a local table: no tasks are needed to make it
    local = pa.table([pa.array(values, _ARROW[kind]) for values, kind in zip(zip(*rows, strict=True), kinds, strict=True)], names)
    frame = spark.createDataFrame(local).coalesce(1)
    spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION ({BATCH} = '{batch}') SELECT * FROM {{frame}}", frame=frame)


def append_batch(
    rows: DataFrame,
    table: str,
    run_ts: datetime,
    source: str = "",
    files: Sequence[tuple[str, datetime]] | None = None,
    counted: Mapping[str, Column] | None = None,
) -> str:
    """Append rows, stamped with their run's load time; return the batch id.

    ``source`` says what the rows were read from. A batch of the same run and source is a
    retry and replaces the former one; other sources of a run are batches of their own.
    Batches sort by run and then by their number, which is never given twice: what is
    loaded again after an undo is a new batch to readers. A run may come later than another
    of a later time.

    ``files`` are the files read, by name and arrival time, also those without rows; from then on
    :func:`loaded_files` knows them. ``counted`` are conditions whose rows are counted while the
    batch is written, for :func:`counts`.
    """
    spark = rows.sparkSession
    stamp, mark = run_stamp(run_ts), hashlib.md5(source.encode()).hexdigest()[:12]
    own = _batches(spark, table).where(F.col(BATCH).startswith(f"{stamp}-") & F.col(BATCH).endswith(f"-{mark}"))
    former = own.first()
    new = former[BATCH] if former else f"{stamp}-{_next_number(spark, table):09d}-{mark}"
    if files is not None:
        # instants: what Spark hands out as the driver's clock readings
        _write_beside(spark, table, "files", new, FILE, [(name, at.astimezone(timezone.utc)) for name, at in files])
    if OTHER not in rows.columns:
        rows = rows.withColumn(OTHER, F.lit(None).cast("string"))
    columns = [name for name in spark.table(table).columns if name != BATCH]
    stamped = with_loaded_at(rows, run_ts).select(*columns)
    seen = Observation()
    if counted is not None:
        totals = [F.count_if(condition).alias(name) for name, condition in counted.items()]
        stamped = stamped.observe(seen, F.count("*").alias(ROWS), *totals)
    spark.sql(
        f"INSERT OVERWRITE TABLE {table} PARTITION ({BATCH} = '{new}') SELECT * FROM {{rows}}", rows=stamped
    )
    if counted is not None:
        _write_beside(spark, table, "counts", new, _COUNT, list(seen.get.items()))
    return new


def _of_live_batches(spark: SparkSession, table: str, what: str, columns: str) -> DataFrame:
    """The rows beside a table that belong to batches which the catalog lists."""
    name = _beside(table, what)
    if not spark.catalog.tableExists(name):
        empty = (column.split() for column in f"{columns}, {BATCH} STRING".split(", "))
        return spark.range(0).select(*(F.lit(None).cast(kind).alias(column) for column, kind in empty))
    return spark.table(name).join(_batches(spark, table), BATCH, "left_semi")


def loaded_files(spark: SparkSession, table: str) -> DataFrame:
    """(source_file, received_at, batch_id) of the files that the table's batches were loaded from."""
    return _of_live_batches(spark, table, "files", FILE)


def counts(spark: SparkSession, table: str) -> DataFrame:
    """(counted, n, batch_id) of batches that were counted while they were written."""
    return _of_live_batches(spark, table, "counts", _COUNT)


def files_taken_back(spark: SparkSession, table: str) -> DataFrame | None:
    """Files of batches that are gone, undone or never completed; None when there are none."""
    name = _beside(table, "files")
    if not spark.catalog.tableExists(name):
        return None
    gone = _batches(spark, name).join(_batches(spark, table), BATCH, "left_anti")
    if gone.isEmpty():
        return None
    return spark.table(name).join(gone, BATCH, "left_semi").select("source_file", "received_at").distinct()


def forget_files_taken_back(spark: SparkSession, table: str) -> None:
    """Drop what the files table has of batches that are gone."""
    name = _beside(table, "files")
    gone = _batches(spark, name).join(_batches(spark, table), BATCH, "left_anti")
    _drop(spark, name, [row[BATCH] for row in gone.collect()])


def _drop(spark: SparkSession, table: str, names: Sequence[str]) -> None:
    """Drop batches in one statement."""
    if names:
        parts = ", ".join(f"PARTITION ({BATCH} = '{name}')" for name in names)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {parts}")


def drop_batches_before(spark: SparkSession, table: str, batch: str) -> None:
    """Drop the runs that came before one."""
    _drop(spark, table, [row[BATCH] for row in _batches(spark, table).where(F.col(BATCH) < batch).collect()])


def newest_rows(spark: SparkSession, table: str) -> DataFrame:
    """The rows of the newest batch that has any; a run over empty files leaves one without.

    Batches that were counted tell it; the others are asked in one job.
    """
    rows, known = spark.table(table), counts(spark, table).where(F.col("counted") == ROWS)
    other = _batches(spark, table).join(known, BATCH, "left_anti")
    names = [row[BATCH] for row in other.collect()]
    filled = known.where("n > 0").select(BATCH)
    if names:
        filled = filled.unionByName(rows.where(F.col(BATCH).isin(names)).select(BATCH))
    newest = filled.agg(F.max(BATCH)).first()[0]
    return rows.where(F.col(BATCH) == newest) if newest else rows


def undo_last_batch(spark: SparkSession, table: str) -> str:
    """Drop the newest run with all of its pieces; no file of a row is read or written.

    The table remembers the batches, so that the tables built from it can take them back too.
    """
    last = newest_batch(spark, table)
    if last is None:
        raise LookupError(f"{table} holds no batch")
    run = last.split("-")[0]
    names = [row[BATCH] for row in _batches(spark, table).where(F.col(BATCH).startswith(f"{run}-")).collect()]
    undone = undone_batches(spark, table) | {int(name.split("-")[1]) for name in names}
    # noted first: what is noted but still there is not taken back by anyone
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{_UNDONE}' = '{as_ranges(undone)}')")
    _drop(spark, table, names)
    return last


def undone_batches(spark: SparkSession, table: str) -> set[int]:
    """Numbers of the batches that were ever undone and are gone."""
    if not spark.catalog.tableExists(table):
        return set()
    return from_ranges(_property(spark, table, _UNDONE)) - set(batches(spark, table))


def purge_table(spark: SparkSession, table: str, confirm: bool = False) -> None:
    """Empty a bronze table. What was built from it stays; its files count as not loaded."""
    if not confirm:
        raise PermissionError(f"purging {table} needs confirm=True")
    _drop(spark, table, list(batches(spark, table).values()))


def as_ranges(numbers: Collection[int]) -> str:
    """Numbers as text: ``1-4,6``."""
    out: list[list[int]] = []
    for n in sorted(numbers):
        if out and n == out[-1][1] + 1:
            out[-1][1] = n
        else:
            out.append([n, n])
    return ",".join(str(a) if a == b else f"{a}-{b}" for a, b in out)


def from_ranges(text: str) -> set[int]:
    parts = [part.split("-") for part in text.split(",") if part]
    return {n for part in parts for n in range(int(part[0]), int(part[-1]) + 1)}
