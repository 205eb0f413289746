"""Tables that an upsert changes: whole, or by partition.

They are plain partitioned tables of the catalog. Parquet has no MERGE, and a table cannot be
overwritten while it is read, so the new contents of the touched partitions are written to a
staging folder first. One dynamic ``INSERT OVERWRITE`` then puts them in place, one statement
drops the partitions that became empty, and one sets the properties, such as how far the sources
were read. None of it depends on the number of partitions that stay.

What is staged is noted on the table before its partitions are touched. A run that dies in
between leaves the note, and :meth:`ReplacedTable.recover` puts the staged rows in place again;
the read position did not move, so the caller's next run repeats the upsert, which is idempotent.
Readers of several partitions may see some of them before and some after a change.

On a catalog with MERGE (Iceberg, Delta) use :func:`saleslake.operators.upsert.merge_statement`.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from saleslake.session import write_out
from saleslake.sources import files

_VERSION = "saleslake.version"
_STAGED = "saleslake.staged"


@dataclass(frozen=True)
class ReplacedTable:
    """``work`` is a folder outside the table for what is staged."""

    spark: SparkSession
    name: str
    work: str
    partition_by: str | None = None
    sort_by: str | None = None

    def exists(self) -> bool:
        """Whether a first version was completed."""
        return self.version() > 0

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def properties(self) -> dict[str, str]:
        if not self.spark.catalog.tableExists(self.name):
            return {}
        return {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {self.name}").collect()}

    def version(self) -> int:
        """How many changes were completed; 0 before the first one."""
        return int(self.properties().get(_VERSION, 0))

    def publish(
        self,
        rows: DataFrame,
        replaced: Collection[str] | None = None,
        properties: Mapping[str, str] | None = None,
        noted: Mapping[str, str] | None = None,
    ) -> int:
        """Make ``rows`` the contents and return the new version.

        With ``replaced``, the rows are the new contents of those partitions only; every
        other partition is neither read nor written. ``noted`` are properties that hold from the
        moment on from which the change will be completed, even if this run dies.
        """
        current = self.version()
        if current == 0:
            self._create(rows)
            self._overwrite(rows)
        else:
            staged = f"{self.work}/staged"
            write_out(rows, f"{staged}/rows")
            values = None if replaced is None else [(value,) for value in replaced]
            named = self.spark.createDataFrame(values or [], "value string")
            write_out(named, f"{staged}/replaced")
            self._set({**(noted or {}), _STAGED: "partitions" if replaced is not None else "table"})
            self._put_in_place()
        self._set({**(properties or {}), _VERSION: str(current + 1), _STAGED: ""})
        files.delete(self.spark, f"{self.work}/staged")
        return current + 1

    def recover(self) -> None:
        """Complete the overwrite of a run that died during one."""
        if self.properties().get(_STAGED):
            self._put_in_place()
            self._set({_STAGED: ""})

    def note(self, properties: Mapping[str, str]) -> None:
        """Set properties without a new version."""
        self._set(properties)

    def _put_in_place(self) -> None:
        rows = self.spark.read.schema(self.read().schema).parquet(f"{self.work}/staged/rows")
        self._overwrite(rows)
        if self.properties()[_STAGED] != "partitions":
            return
        filled = rows.select(self.partition_by).distinct()
        replaced = self.spark.read.schema("value string").parquet(f"{self.work}/staged/replaced")
        # partition values: at most one per day of the calendar, or per bucket
        emptied = replaced.join(filled, replaced["value"] == filled[self.partition_by], "left_anti").collect()
        if emptied:
            parts = ", ".join(f"PARTITION ({self.partition_by} = '{row['value']}')" for row in emptied)
            self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS {parts}")

    def _create(self, rows: DataFrame) -> None:
        # what a run left behind that died before its first version
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        ordered = sorted(rows.schema, key=lambda field: field.name == self.partition_by)
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ordered)
        layout = f"PARTITIONED BY ({self.partition_by})" if self.partition_by else ""
        self.spark.sql(
            f"CREATE TABLE {self.name} ({ddl}) USING parquet OPTIONS (partitionOverwriteMode 'dynamic') {layout}"
        )

    def _overwrite(self, rows: DataFrame) -> None:
        """Replace the partitions that the rows are of; without partitions, the table."""
        by = [self.partition_by] if self.partition_by else []
        # One task per partition value, or several for a large one: without this every
        # task writes a small file into every partition.
        rows = rows.hint("rebalance", *by)
        order = by + ([self.sort_by] if self.sort_by else [])
        if order:
            # Sorted files have narrow min/max ranges, so a key range reads few row groups.
            rows = rows.sortWithinPartitions(*order)
        rows.select(*self.read().columns).write.insertInto(self.name, overwrite=True)

    def _set(self, properties: Mapping[str, str]) -> None:
        pairs = ", ".join(f"'{key}' = '{value}'" for key, value in properties.items())
        self.spark.sql(f"ALTER TABLE {self.name} SET TBLPROPERTIES ({pairs})")
