"""Building a lake, step after step: ingest, silver, gold, checks."""

from __future__ import annotations

from collections.abc import Collection
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from saleslake.functions.stamp import with_loaded_at
from saleslake.operators.quality import (
    BRONZE_DEFAULT,
    FAIL,
    RAW_SALES,
    Check,
    freshness,
    table_report,
    union_reports,
    with_status,
)
from saleslake.operators.upsert import rows_replaced, within_key_range
from saleslake.plans import counting, models
from saleslake.schemas import CONTRACT, FEEDS, KEY
from saleslake.session import fit_to_input, frame_bytes, write_out
from saleslake.sinks import bronze
from saleslake.sinks.names import table_name
from saleslake.sinks.replaced import ReplacedTable
from saleslake.sinks.warehouse import SAMPLE_ROWS, first_rows
from saleslake.sources import files
from saleslake.sources.landing import (
    FILE_COLUMNS,
    latest_file,
    manifest,
    pending_files,
    read_landing,
    read_latest,
)
from saleslake.sources.registry import Registry, Source

LAYERS = ("silver", "gold")
_FEED_OF = {"dim_customer": "customer", "dim_employee": "employee", "dim_product": "product"}
_READ = "saleslake.read_batches"
_NEWEST_READ = "saleslake.newest_read_batch"
_BUCKETS = "saleslake.buckets"
_CHANGES = "saleslake.changes"  # how many change lists of the fact there are, or were counted
_COUNTS = "saleslake.counts"  # numbers of the folders that hold the reference counts
COUNTS_MERGED_AT = 16  # folders of reference counts after which they become one


@dataclass(frozen=True)
class Lake:
    """A lake under one root folder. ``suffix`` keeps namespaces of several lakes apart.

    ``period`` is the date pattern of the fact's partitions, the unit that an upsert
    rewrites: months by default, ``yyyy-MM-dd`` where one day fills many files.
    ``buckets`` is the same for dimensions: into how many parts, by key, a dimension is
    split; an upsert rewrites the parts that hold a key of its batch. Both are chosen
    once for a lake.
    """

    spark: SparkSession
    root: str
    suffix: str = ""
    period: str = "yyyy-MM"
    buckets: int = 1

    def namespace(self, layer: str) -> str:
        return f"{layer}{self.suffix}"

    def table(self, layer: str, model: str) -> str:
        return table_name(self.namespace(layer), model)

    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    def create(self) -> Lake:
        """Create the namespaces and the bronze tables; existing ones are left as they are."""
        for layer in ("bronze", "silver", "gold"):
            self.spark.sql(
                f"CREATE SCHEMA IF NOT EXISTS {self.namespace(layer)} LOCATION '{self.path(layer)}'"
            )
        for feed, schema in FEEDS.items():
            bronze.create_bronze(self.spark, self.table("bronze", feed), schema)
        return self

    def silver(self, model: str) -> ReplacedTable:
        split_by = models.PERIOD if model == "fact_sales" else models.BUCKET
        return ReplacedTable(
            self.spark, self.table("silver", model), self.path("work", model), split_by, sort_by=KEY
        )

    def gold(self, name: str = "daily_sales_summary") -> ReplacedTable:
        return ReplacedTable(self.spark, self.table("gold", name), self.path("work", name), sort_by=models.DAY)

    def registry(self) -> Registry:
        """The sources under their logical names."""
        known = Registry(group_freshness={"layer_bronze": BRONZE_DEFAULT})
        known.add(
            Source("layer_bronze", "raw_sales", self.namespace("bronze"), "sales", "loaded_at", RAW_SALES)
        )
        for model in (*models.DIMENSIONS, "fact_sales"):
            known.add(Source("layer_silver", model, self.namespace("silver")))
        known.add(Source("gold", "daily_sales_summary", self.namespace("gold")))
        return known


# --- bronze ---------------------------------------------------------------------------


def ingest_latest(
    lake: Lake,
    root: str,
    prefix: str,
    run_ts: datetime,
    feed: str | None = None,
    multi_line: bool = True,
    suffix: str = ".json",
) -> str | None:
    """Append the newest landing object; None when bronze holds it already."""
    newest = latest_file(lake.spark, root, prefix, suffix)
    listed = manifest(lake.spark, root, prefix, suffix).where(F.col("path") == newest["path"])
    return load_files(lake, listed, feed or prefix, run_ts, multi_line)


def ingest_pending(
    lake: Lake,
    root: str,
    prefix: str,
    run_ts: datetime,
    feed: str | None = None,
    multi_line: bool = True,
    fmt: str = "json",
    suffix: str | None = None,
) -> str | None:
    """Append every landing object of the format that bronze does not hold yet; its name ends
    with the format's unless another ``suffix`` is given."""
    listed = manifest(lake.spark, root, prefix, suffix or f".{fmt}")
    return load_files(lake, listed, feed or prefix, run_ts, multi_line, fmt)


def load_files(
    lake: Lake,
    listed: DataFrame,
    feed: str,
    run_ts: datetime,
    multi_line: bool = False,
    fmt: str = "json",
    max_files: int | None = None,
) -> str | None:
    """Append the listed files that no batch of bronze was loaded from, in batches of at most
    ``max_files``; return the last batch, None when there was nothing new.

    Bronze itself is not read: its files table tells what is loaded. A file without a record is
    loaded once like any other.
    """
    table = lake.table("bronze", feed)
    pending = pending_files(listed, bronze.loaded_files(lake.spark, table))
    # File names only, as many as Spark's own file index keeps on the driver to read them.
    found = pending.select(*FILE_COLUMNS).orderBy("received_at", "path").collect()
    batch = None
    for at in range(0, len(found), max_files or max(len(found), 1)):
        batch = _load(lake, found[at : at + max_files] if max_files else found, feed, run_ts, multi_line, fmt)
    return batch


def _load(lake: Lake, found: list[Row], feed: str, run_ts: datetime, multi_line: bool, fmt: str) -> str:
    source = "\n".join(sorted(f"{row['path']} {row['received_at']}" for row in found))
    sizes = {row["path"]: row["n_bytes"] for row in found}
    rows = read_landing(lake.spark, list(sizes), FEEDS[feed], fmt, multi_line, sizes)
    if multi_line:
        # A small object is read by one task; spread its rows before they are written.
        rows = rows.hint("rebalance")
    files = [(row["source_file"], row["received_at"]) for row in found]
    counted = {_line(check): condition for check, condition in _row_checks(feed).items()}
    return bronze.append_batch(rows, lake.table("bronze", feed), run_ts, source, files, counted)


def _row_checks(feed: str) -> dict[Check, Column]:
    """The checks of bronze that each row passes or fails by itself."""
    if feed != "sales":
        return {}
    checks = {Check("not_null", name): F.col(name).isNull() for name in CONTRACT["raw_sales"].not_null}
    return checks | {Check("positive", "amount_paid"): F.col("amount_paid") <= 0}


def _line(check: Check) -> str:
    return f"{check.name} {check.column}"


def latest_sample(lake: Lake, root: str, prefix: str, run_ts: datetime, n: int = SAMPLE_ROWS) -> DataFrame:
    """The first rows of the newest landing object, dated and stamped, for a warehouse.

    Send them with :func:`saleslake.sinks.warehouse.write_warehouse`.
    """
    rows = models.with_transaction_time(read_latest(lake.spark, root, prefix, FEEDS["sales"]))
    order = [field.name for field in FEEDS["sales"]]
    return first_rows(with_loaded_at(rows, run_ts), order, n)


# --- silver ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Changes:
    """What bronze has for a target that it has not read, and what it has lost. ``late`` tells
    that a run was read which is later than a new one."""

    new: list[str]
    undone: set[int]
    read: set[int]
    left: list[str]
    late: bool
    newest: str

    def properties(self) -> dict[str, str]:
        return {_READ: bronze.as_ranges(self.read), _NEWEST_READ: self.newest}


def _changes(lake: Lake, target: ReplacedTable, feed: str) -> Changes | None:
    """The batches that the target has not read, in whatever order they came, and those of its
    batches that were undone; None when there are neither."""
    table = lake.table("bronze", feed)
    held = bronze.batches(lake.spark, table)
    properties = target.properties()
    read = bronze.from_ranges(properties.get(_READ, ""))
    undone = bronze.undone_batches(lake.spark, table) & read
    new = sorted(held[n] for n in set(held) - read)
    if not new and not undone:
        return None
    newest_read = max(properties.get(_NEWEST_READ, ""), *(held[n] for n in set(held) & read), "")
    late = bool(new) and new[0] < newest_read
    return Changes(new, undone, (read | set(held)) - undone, sorted(held.values()), late, max([newest_read, *new]))


def _bronze_rows(lake: Lake, feed: str, names: list[str]) -> DataFrame:
    rows = lake.spark.table(lake.table("bronze", feed)).where(F.col(bronze.BATCH).isin(names))
    fit_to_input(lake.spark, frame_bytes(rows))
    return rows.withColumn(models.SOURCE, F.col(bronze.BATCH))


def _winners(lake: Lake, target: ReplacedTable, feed: str, found: Changes, newest) -> tuple[DataFrame, DataFrame, str]:
    """Written out: the newest row of every key that changes, and the target's rows of these keys.

    Keys change that a new batch brings, and those whose row came from a batch that was undone:
    these are found again in the bronze rows that are left, and are gone where there are none.
    A batch of a run that comes late loses against rows of later runs; without an undo these keys
    do not change.
    """
    staged = f"{target.work}/batch"
    batch = newest(_bronze_rows(lake, feed, found.new))
    batch = write_out(batch, f"{staged}/new")
    fit_to_input(lake.spark, _stored_bytes(target))
    keys, of = batch.select(KEY), target.read()
    if found.late and not found.undone:
        # rows of two batches are ranked by the batches alone
        met = within_key_range(of, keys, KEY).join(batch.select(KEY, F.col(models.SOURCE).alias("brought_by")), KEY)
        met = met.withColumn("stays", F.col(models.SOURCE) > F.col("brought_by")).select(*of.columns, "stays")
        met = write_out(met, f"{staged}/replaced")
        winners = batch.join(met.where("stays").select(KEY), KEY, "left_anti").select(*batch.columns)
        return write_out(winners, f"{staged}/winners"), met.where(~F.col("stays")).drop("stays"), staged
    candidates = batch
    if found.undone:
        number = bronze.number_of(F.col(models.SOURCE))
        lost = of.where(number.isin(sorted(found.undone))).select(KEY)
        lost = write_out(lost, f"{staged}/lost")
        again = rows_replaced(within_key_range(_bronze_rows(lake, feed, found.left), lost, KEY), lost, KEY)
        candidates = candidates.unionByName(newest(again))
        keys = keys.unionByName(lost).distinct()
    replaced = write_out(rows_replaced(within_key_range(of, keys, KEY), keys, KEY), f"{staged}/replaced")
    if not found.undone:
        return batch, replaced, staged
    standing = replaced.where(~bronze.number_of(F.col(models.SOURCE)).isin(sorted(found.undone)))
    winners = newest(candidates.select(*batch.columns).unionByName(standing.select(*batch.columns)))
    return write_out(winners, f"{staged}/winners"), replaced, staged


def _stored_bytes(target: ReplacedTable) -> int:
    """The size of the current version; files are told by the catalog's partitions."""
    return frame_bytes(target.read().where(F.col(target.partition_by).isNotNull()))


def _upsert(
    lake: Lake,
    target: ReplacedTable,
    winners: DataFrame,
    replaced: DataFrame,
    parts: list[str],
    properties: dict[str, str],
    noted: dict[str, str] | None = None,
) -> int:
    """Write the given partitions of the target again, with the replaced rows exchanged for the winners."""
    current = target.read().where(F.col(target.partition_by).isin(parts))
    fit_to_input(lake.spark, frame_bytes(current) + frame_bytes(winners))
    # the replaced rows are all of the target's with a key of the winners
    untouched = current.join(replaced.select(KEY), KEY, "left_anti")
    return target.publish(untouched.unionByName(winners), replaced=parts, properties=properties, noted=noted)


def _values(rows: DataFrame, column: str) -> list[str]:
    """Partition values: at most one per month or day of the calendar, or per bucket."""
    return [row[0] for row in rows.select(column).distinct().collect()]


def build_dimension(lake: Lake, model: str) -> int:
    """Upsert the new rows of a dimension and take back what was undone; return its version."""
    target, feed = lake.silver(model), _FEED_OF[model]
    target.recover()
    found = _changes(lake, target, feed)
    if found is None:
        return target.version()
    properties = {**found.properties(), _BUCKETS: str(lake.buckets)}

    def newest(rows: DataFrame) -> DataFrame:
        return models.with_bucket(models.dimension(rows, model, newest_by=(models.SOURCE,)), lake.buckets)

    if not target.exists():
        return target.publish(newest(_bronze_rows(lake, feed, found.new)), properties=properties)
    if target.properties()[_BUCKETS] != str(lake.buckets):
        raise ValueError(f"{target.name} has {target.properties()[_BUCKETS]} buckets, not {lake.buckets}")
    winners, replaced, staged = _winners(lake, target, feed, found, newest)
    parts = _values(winners.select(models.BUCKET).unionByName(replaced.select(models.BUCKET)), models.BUCKET)
    version = _upsert(lake, target, winners, replaced, parts, properties)
    files.delete(lake.spark, staged)
    return version


def build_fact(lake: Lake) -> int:
    """Upsert the new sales and take back what was undone; only periods that gain, lose or change
    a sale are written."""
    target = lake.silver("fact_sales")
    target.recover()
    found = _changes(lake, target, "sales")
    if found is None:
        return target.version()

    def newest(rows: DataFrame) -> DataFrame:
        return models.with_period(models.fact_sales(rows, newest_by=(models.SOURCE,)), lake.period)

    if not target.exists():
        return target.publish(newest(_bronze_rows(lake, "sales", found.new)), properties=found.properties())
    winners, replaced, staged = _winners(lake, target, "sales", found, newest)
    # Counts from the note on: the list of a run that dies before it is written again.
    number = int(target.properties().get(_CHANGES, 0)) + 1
    changes = write_out(counting.change_list(winners, replaced), _changes_path(lake, number))
    periods = _values(changes, models.PERIOD)
    version = _upsert(lake, target, winners, replaced, periods, found.properties(), {_CHANGES: str(number)})
    files.delete(lake.spark, staged)
    return version


def _changes_path(lake: Lake, number: int) -> str:
    """Sales that came and went with a change of the fact; gold reads them later."""
    return lake.path("work", "fact_sales", "changes", str(number))


def build_silver(lake: Lake) -> None:
    """Build the silver models side by side: no model reads another."""
    with ThreadPoolExecutor(max_workers=len(models.DIMENSIONS) + 1) as pool:
        steps = [pool.submit(build_fact, lake)]
        steps += [pool.submit(build_dimension, lake, model) for model in models.DIMENSIONS]
    for step in steps:
        step.result()


# --- gold -----------------------------------------------------------------------------


def build_gold(lake: Lake) -> int:
    """Count what changed in the fact since gold was last built; return gold's version.

    The fact is read by the first build, and later only for days that lost their smallest or
    largest amount. The state of the days remembers which changes it has counted, so those of
    a silver run whose gold step failed are picked up by the next one.
    """
    fact, state, gold = lake.silver("fact_sales"), lake.gold("daily_sales_state"), lake.gold()
    if not fact.exists():
        return gold.version()
    for target in (fact, state, gold):
        target.recover()
    changes = int(fact.properties().get(_CHANGES, 0))
    if not state.exists():
        _first_state(lake, fact, state, changes)
    elif int(state.properties()[_CHANGES]) != changes:
        _next_state(lake, fact, state, changes)
    counted = state.properties()[_CHANGES]
    if gold.properties().get(_CHANGES) == counted:
        return gold.version()
    return gold.publish(counting.summary(state.read()), properties={_CHANGES: counted})


def _counts_path(lake: Lake, number: int) -> str:
    """Reference counts of the changes up to one, from the one before that has a folder."""
    return lake.path("work", "daily_sales_state", "counts", f"list={number}")


def _read_counts(lake: Lake, numbers: list[int]) -> DataFrame:
    base = lake.path("work", "daily_sales_state", "counts")
    counts = lake.spark.read.schema(counting.REFERENCE_SCHEMA).option("basePath", base)
    return counts.parquet(*(_counts_path(lake, n) for n in numbers)).drop("list")


def _write_counts(lake: Lake, counts: DataFrame, number: int) -> DataFrame:
    rows = counts.hint("rebalance", models.PERIOD).sortWithinPartitions(models.PERIOD, models.DAY)
    rows.write.mode("overwrite").partitionBy(models.PERIOD).parquet(_counts_path(lake, number))
    return _read_counts(lake, [number])


def _first_state(lake: Lake, fact: ReplacedTable, state: ReplacedTable, changes: int) -> None:
    fit_to_input(lake.spark, _stored_bytes(fact))
    counts = _write_counts(lake, counting.reference_counts(counting.signed(fact.read(), 1)), changes)
    rows = counting.first_state(fact.read(), counts)
    state.publish(rows, properties={_CHANGES: str(changes), _COUNTS: str(changes)})


def _next_state(lake: Lake, fact: ReplacedTable, state: ReplacedTable, changes: int) -> None:
    known = state.properties()
    numbers = [int(n) for n in known[_COUNTS].split(",")]
    lists = range(int(known[_CHANGES]) + 1, changes + 1)
    listed = lake.spark.read.parquet(*(_changes_path(lake, n) for n in lists))
    fit_to_input(lake.spark, frame_bytes(listed))
    counts = _read_counts(lake, numbers)
    more = _write_counts(lake, counting.reference_counts(listed), changes)
    of_periods = counts.where(F.col(models.PERIOD).isin(_values(listed, models.PERIOD)))
    days = counting.next_state(state.read(), listed, of_periods, more)
    work = lake.path("work", "daily_sales_state", "next")
    days = write_out(days, work)
    lost = _values(days.where("lost"), models.PERIOD)
    if lost:
        days = counting.with_extremes(days, fact.read().where(F.col(models.PERIOD).isin(lost)))
    else:
        days = days.drop("lost")
    # Noted with what is staged: a change that a run which dies has staged must not be counted again.
    state.publish(days, noted={_CHANGES: str(changes), _COUNTS: ",".join(map(str, [*numbers, changes]))})
    files.delete(lake.spark, work)


def expire(lake: Lake) -> None:
    """Remove the change lists that gold has counted; make one of many folders of reference counts."""
    state = lake.gold("daily_sales_state")
    if not state.exists():
        return
    known = state.properties()
    for number in range(1, int(known[_CHANGES]) + 1):
        files.delete(lake.spark, _changes_path(lake, number))
    numbers = [int(n) for n in known[_COUNTS].split(",")]
    if len(numbers) >= COUNTS_MERGED_AT:
        counts = _read_counts(lake, numbers)
        fit_to_input(lake.spark, frame_bytes(counts))
        # a number of its own, below all later ones and unlike those it replaces
        merged = -numbers[-1]
        _write_counts(lake, counting.merged_counts(counts), merged)
        state.note({_COUNTS: str(merged)})
        for number in numbers:
            files.delete(lake.spark, _counts_path(lake, number))


def run(lake: Lake, layers: Collection[str] = LAYERS) -> None:
    """Build the chosen layers in their order."""
    unknown = set(layers) - set(LAYERS)
    if unknown:
        raise ValueError(f"unknown layers: {sorted(unknown)}")
    if "silver" in layers:
        build_silver(lake)
    if "gold" in layers:
        build_gold(lake)


# --- checks ---------------------------------------------------------------------------


def contract_report(
    sources: dict[str, DataFrame], unique_fact: bool = True, with_dates: bool = True
) -> DataFrame:
    """Every declared check on the given tables, one scan per table.

    Two lines are ours: the fact's key must be unique, since it is the upsert key, and
    sales that no day of gold can count are reported.
    """
    reports = []
    for table, rows in sources.items():
        contract = CONTRACT[table]
        unique = contract.unique[0] if contract.unique else None
        failing = {}
        if table == "raw_sales":
            failing[Check("positive", "amount_paid")] = F.col("amount_paid") <= 0
        if table == "fact_sales":
            unique = KEY if unique_fact else None
            if with_dates:
                failing[Check("dated", "transaction_date")] = F.col("transaction_date").isNull()
        reports.append(table_report(rows, table, contract.not_null, unique, failing))
    return union_reports(reports)


def bronze_report(lake: Lake) -> DataFrame:
    """The checks of raw_sales, summed from what was counted while its batches were written.

    Only batches that were not counted (appended by other means, or whose run died before its
    counts were written) are read.
    """
    table, checks = lake.table("bronze", "sales"), _row_checks("sales")
    known = bronze.counts(lake.spark, table)
    total = known.groupBy("counted").agg(F.sum("n").alias("n"))
    counted = {row[0] for row in known.where(F.col("counted") == bronze.ROWS).select(bronze.BATCH).collect()}
    others = [name for name in bronze.batches(lake.spark, table).values() if name not in counted]
    if others:
        rows = lake.spark.table(table).where(F.col(bronze.BATCH).isin(others))
        seen = rows.agg(*(F.count_if(condition).alias(_line(check)) for check, condition in checks.items()))
        total = total.unionByName(seen.unpivot([], seen.columns, "counted", "n"))
    names = ("counted", "check_name", "table_name", "column_name")
    lines = [(_line(check), check.name, "raw_sales", check.column) for check in checks]
    structs = [F.struct(*(F.lit(value).alias(name) for name, value in zip(names, line, strict=True))) for line in lines]
    report = lake.spark.range(1).select(F.inline(F.array(*structs)))
    failures = report.join(total, "counted", "left").groupBy("check_name", "table_name", "column_name").agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("failures")
    )
    return with_status(failures)


def check(lake: Lake) -> DataFrame:
    """The report over the lake's own tables. Every check of a missing table fails."""
    known = lake.registry()
    tables = {}
    missing = {}
    for model in (*models.DIMENSIONS, "fact_sales"):
        if lake.silver(model).exists():
            tables[model] = known.read(lake.spark, "layer_silver", model)
        else:
            # the checks of an empty table of its kind, without a count
            columns = models.DIMENSIONS.get(model, models.FACT_COLUMNS)
            none = F.lit(None).cast("string")
            missing[model] = lake.spark.range(0).select(*(none.alias(c) for c in columns))
    reports = [bronze_report(lake)]
    if tables:
        reports.append(contract_report(tables))
    if missing:
        reports.append(
            contract_report(missing).withColumns({"failures": F.lit(None).cast("long"), "status": F.lit(FAIL)})
        )
    return union_reports(reports)


def freshness_line(lake: Lake, now: datetime) -> DataFrame:
    """Freshness as a line of the report."""
    return check_freshness(lake, now).select(
        F.lit("freshness").alias("check_name"),
        F.lit("raw_sales").alias("table_name"),
        F.lit("loaded_at").alias("column_name"),
        (F.col("status") == "error").cast("long").alias("failures"),
        "status",
    )


def check_freshness(lake: Lake, now: datetime) -> DataFrame:
    """Freshness of raw_sales. All rows of a run share their load time, so the newest run
    that has rows is read."""
    known = lake.registry()
    source = known.get("layer_bronze", "raw_sales")
    rows = bronze.newest_rows(lake.spark, source.table)
    rule = known.freshness_of("layer_bronze", "raw_sales")
    return freshness(rows, source.loaded_at_field, now, rule)
