"""Every operator of the lake as a query over the test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from saleslake.functions.stamp import day_text, parse_timestamp, wall_clock
from saleslake.operators import quality
from saleslake.operators.upsert import latest_per_key, merge_batch
from saleslake.plans import lake as lakes
from saleslake.plans import models, trial_tables as trial
from saleslake.schemas import CONTRACT, CORRUPT, FEEDS, OTHER
from saleslake.session import work_dir, write_out
from saleslake.sinks import bronze
from saleslake.sinks.landing import DAY, purge_days, write_landing
from saleslake.sinks.warehouse import first_rows
from saleslake.sources.landing import SPLIT_BYTES, manifest, read_landing
from saleslake.sources.seed import load_seed
from saleslake.streaming.pickup import pick_up

Query = Callable[[SparkSession, str], DataFrame]

RUN_TS = datetime(2024, 7, 21, 10, 35, tzinfo=timezone.utc)
NEXT_RUN_TS = RUN_TS + timedelta(hours=1)
CUT = "1999-01-01"
IDS_OF_OBJECT = 10_000
NOW = "2024-01-31 12:00:00"
NOTE = 'a "b" \\ } ] , {['


def _shown(rows: DataFrame) -> DataFrame:
    """Amounts as doubles, the type both engines share."""
    return rows.withColumn("amount_paid", F.col("amount_paid").cast("double"))


def _utc(name: str):
    """An instant as the wall clock of UTC."""
    return wall_clock(name, "UTC").alias(name)


def _before_cut():
    return F.col("loaded_at") < F.lit(CUT).cast("timestamp_ntz")


# --- models ---------------------------------------------------------------------------


def daily_sales_summary(spark: SparkSession, sf: str) -> DataFrame:
    return models.daily_sales_summary(trial.fact_sales(spark, sf))


def fact_sales(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(trial.fact_sales(spark, sf))


def fact_sales_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """The fact of the batches before the cut, upserted with the batches since."""
    rows = trial.lines(spark, sf)
    target = latest_per_key(rows.where(_before_cut()), "id", trial.LINE_ORDER)
    batch = latest_per_key(rows.where(~_before_cut()), "id", trial.LINE_ORDER)
    merged = trial.with_header(merge_batch(target, batch, "id"), trial.headers(spark, sf))
    return _shown(merged.select(*models.FACT_COLUMNS))


def dim_customer(spark: SparkSession, sf: str) -> DataFrame:
    return models.dimension(trial.customers(spark, sf), "dim_customer")


def dim_employee(spark: SparkSession, sf: str) -> DataFrame:
    return models.dimension(trial.employees(spark, sf), "dim_employee")


def dim_product(spark: SparkSession, sf: str) -> DataFrame:
    return models.dimension(trial.products(spark, sf), "dim_product")


def sales_enriched(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(
        models.sales_enriched(
            trial.fact_sales(spark, sf),
            trial.customers(spark, sf),
            trial.employees(spark, sf),
            trial.products(spark, sf),
        )
    )


# --- batches --------------------------------------------------------------------------


def latest_batch(spark: SparkSession, sf: str) -> DataFrame:
    rows = trial.lines(spark, sf)
    newest = rows.where(F.col("loaded_at") == rows.agg(F.max("loaded_at")).scalar())
    few = write_out(newest, work_dir(spark, "latest_batch"))
    return _shown(trial.with_header_of_few(few, trial.headers(spark, sf)))


def undo_last_batch(spark: SparkSession, sf: str) -> DataFrame:
    rows = trial.lines(spark, sf)
    kept = rows.where(F.col("loaded_at") < rows.agg(F.max("loaded_at")).scalar())
    return _shown(trial.with_header(kept, trial.headers(spark, sf)))


def head_150(spark: SparkSession, sf: str) -> DataFrame:
    order = ["id", "loaded_at", "product_id", "employee_id", "amount_paid"]
    few = write_out(first_rows(trial.lines(spark, sf), order), work_dir(spark, "head"))
    return _shown(trial.with_header_of_few(few, trial.headers(spark, sf)))


# --- data tests -----------------------------------------------------------------------


def _contract_tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {
        "raw_sales": trial.lines(spark, sf),
        "dim_customer": dim_customer(spark, sf),
        "dim_employee": dim_employee(spark, sf),
        "dim_product": dim_product(spark, sf),
        "fact_sales": trial.fact_sales(spark, sf),
    }


def dq_not_null(spark: SparkSession, sf: str) -> DataFrame:
    return quality.union_reports(
        [
            quality.not_null_failures(rows, name, CONTRACT[name].not_null)
            for name, rows in _contract_tables(spark, sf).items()
        ]
    )


def dq_unique(spark: SparkSession, sf: str) -> DataFrame:
    return quality.duplicate_keys(trial.lines(spark, sf), "id")


def dq_non_positive_amount(spark: SparkSession, sf: str) -> DataFrame:
    balances = trial.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("amount_paid")
    )
    return quality.non_positive(balances)


def dq_report(spark: SparkSession, sf: str) -> DataFrame:
    return lakes.contract_report(_contract_tables(spark, sf))


def _event_freshness(spark: SparkSession, sf: str, rule: quality.FreshnessRule) -> DataFrame:
    now = F.lit(NOW).cast("timestamp_ntz")
    return quality.freshness(trial.table(spark, sf, "events"), "ts", now, rule)


def freshness(spark: SparkSession, sf: str) -> DataFrame:
    return _event_freshness(spark, sf, quality.RAW_SALES)


def freshness_default(spark: SparkSession, sf: str) -> DataFrame:
    return _event_freshness(spark, sf, quality.BRONZE_DEFAULT)


# --- columns --------------------------------------------------------------------------


def tz_shift(spark: SparkSession, sf: str) -> DataFrame:
    return trial.table(spark, sf, "orders").select(
        "o_orderkey", wall_clock("o_orderdate", "UTC+1", stored_zone="UTC").alias("shifted")
    )


def parse_transaction_date(spark: SparkSession, sf: str) -> DataFrame:
    """Days written in three accepted forms and one that is none."""
    day = F.col("o_orderdate")
    status = F.col("o_orderstatus")
    text = (
        F.when(status == "F", F.date_format(day, "M/d/yyyy"))
        .when(status == "O", day_text(day))
        .when(status == "P", F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss"))
    )
    text = F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(text, F.lit("?"))).otherwise(text)
    parsed = parse_timestamp("date_text").cast("date").alias("sales_date")
    written = trial.table(spark, sf, "orders").select("o_orderkey", text.alias("date_text"))
    return written.select("o_orderkey", "date_text", parsed)


# --- landing and bronze ---------------------------------------------------------------


def _by_year(rows: DataFrame) -> DataFrame:
    """Sales as landing batches: one per year of loading, named by its first day."""
    return rows.withColumn(DAY, day_text(F.date_trunc("year", F.col("loaded_at"))))


def landing_manifest(spark: SparkSession, sf: str) -> DataFrame:
    root = work_dir(spark, "landing")
    write_landing(_by_year(trial.lines(spark, sf)), root)
    listed = manifest(spark, root)
    return listed.groupBy("batch_day").agg((F.min("n_bytes") > 0).alias("has_data"))


def landing_day_replace(spark: SparkSession, sf: str) -> DataFrame:
    """All days land; then the newest lands again with its returned sales only."""
    root = work_dir(spark, "landing")
    returned = F.col("l_returnflag") == "R"
    flagged = trial.table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("l_partkey").alias("product_id"),
        day_text(F.date_trunc("year", F.col("l_shipdate"))).alias(DAY),
        returned.alias("returned"),
    )
    write_landing(flagged.drop("returned"), root)
    last = _newest_day(spark, root)
    write_landing(flagged.where((F.col(DAY) == last) & F.col("returned")).drop("returned"), root)
    schema = flagged.drop("returned").schema
    return spark.read.schema(schema).json(root).withColumn(DAY, F.col(DAY).cast("string"))


def _newest_day(spark: SparkSession, root: str) -> str:
    return manifest(spark, root).agg(F.max("batch_day")).first()[0]


def _new_lake(spark: SparkSession) -> lakes.Lake:
    return lakes.Lake(spark, work_dir(spark, "lake"), f"_{uuid.uuid4().hex[:12]}").create()


def _bronze_rows(lake: lakes.Lake) -> DataFrame:
    rows = lake.spark.table(lake.table("bronze", "sales"))
    return _shown(rows.select(*models.FACT_COLUMNS, _utc("loaded_at")))


def bronze_sales(spark: SparkSession, sf: str) -> DataFrame:
    """All sales through a JSON landing batch into bronze."""
    lake = _new_lake(spark)
    root = lake.path("landing")
    write_landing(trial.landed_sales(spark, sf).drop("loaded_at"), root, RUN_TS.date())
    rows = read_landing(spark, root, FEEDS["sales"])
    bronze.append_batch(rows, lake.table("bronze", "sales"), RUN_TS)
    return _bronze_rows(lake)


def csv_landing(spark: SparkSession, sf: str) -> DataFrame:
    """All sales through a CSV landing batch."""
    root = work_dir(spark, "landing")
    write_landing(trial.landed_sales(spark, sf).drop("loaded_at"), root, RUN_TS.date(), fmt="csv")
    rows = read_landing(spark, root, FEEDS["sales"], fmt="csv")
    return _shown(rows.select(*models.FACT_COLUMNS))


def named_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Sales in named objects, in two arrivals, beside objects of another prefix."""
    lake = _new_lake(spark)
    root = lake.path("landing")
    now = datetime.now(timezone.utc)
    sales = trial.landed_sales(spark, sf)
    trial.customers(spark, sf).write.json(f"{root}/other_1")
    for run, side in enumerate((_before_cut(), ~_before_cut())):
        sales.where(side).drop("loaded_at").write.json(f"{root}/sales_{run}")
        lakes.ingest_pending(lake, root, "sales", now + timedelta(hours=run), multi_line=False)
    return _shown(spark.table(lake.table("bronze", "sales")).select(*models.FACT_COLUMNS))


def latest_object_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Sales in objects of one JSON array each, with an attribute that their feed does not name.

    Objects hold ids of a range; that of the largest ids lands last and is the one taken.
    """
    lake = _new_lake(spark)
    root = lake.path("landing")
    sales = trial.landed_sales(spark, sf).drop("loaded_at").withColumn("decade", F.substring("transaction_date", 1, 3))
    ranged = sales.withColumn("part", F.floor(F.col("id") / IDS_OF_OBJECT))
    last = ranged.agg(F.max("part")).first()[0]
    for name, side in (("older", F.col("part") < last), ("newest", F.col("part") == last)):
        record = F.struct(*(c for c in ranged.columns if c != "part"))
        arrays = ranged.where(side).groupBy("part").agg(F.to_json(F.collect_list(record)).alias("value"))
        arrays.write.partitionBy("part").text(f"{root}/sales_{name}")
    lakes.ingest_latest(lake, root, "sales", datetime.now(timezone.utc), suffix=".txt")
    rows = spark.table(lake.table("bronze", "sales"))
    stamped = (F.col("received_at") <= F.col("loaded_at") + F.expr("INTERVAL 1 SECOND")).alias("stamped")
    return _shown(rows.select(*models.FACT_COLUMNS, F.col(OTHER).alias("other_attributes"), stamped))


def same_run_two_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Objects of two prefixes, loaded into one table by one run."""
    lake = _new_lake(spark)
    root, now = lake.path("landing"), datetime.now(timezone.utc)
    sales = trial.landed_sales(spark, sf)
    for prefix, side in (("sales", _before_cut()), ("returns", ~_before_cut())):
        sales.where(side).drop("loaded_at").write.json(f"{root}/{prefix}_0")
        lakes.ingest_pending(lake, root, prefix, now, feed="sales", multi_line=False)
    return _shown(spark.table(lake.table("bronze", "sales")).select(*models.FACT_COLUMNS))


def csv_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Sales in named CSV objects into bronze."""
    lake = _new_lake(spark)
    root = lake.path("landing")
    trial.landed_sales(spark, sf).drop("loaded_at").write.csv(f"{root}/sales_0", header=True)
    lakes.ingest_pending(lake, root, "sales", datetime.now(timezone.utc), multi_line=False, fmt="csv")
    return _shown(spark.table(lake.table("bronze", "sales")).select(*models.FACT_COLUMNS))


def undo_in_pieces(spark: SparkSession, sf: str) -> DataFrame:
    """A second run that loads in several pieces is taken back as a whole."""
    lake = _new_lake(spark)
    _land_and_pick_up(lake, sf, RUN_TS, first=True)
    root = lake.path("landing", "sales")
    later = trial.landed_sales(spark, sf).where(~_before_cut()).drop("loaded_at")
    write_landing(later.repartition(3), root, NEXT_RUN_TS.isoformat()[:13])
    pick_up(lake, "sales", root, NEXT_RUN_TS, max_files=1)
    bronze.undo_last_batch(spark, lake.table("bronze", "sales"))
    return _bronze_rows(lake)


def reingest_after_undo(spark: SparkSession, sf: str) -> DataFrame:
    """A run that silver has read is taken back; a fuller one of the same time replaces it."""
    lake = _new_lake(spark)
    _land_and_pick_up(lake, sf, RUN_TS, first=True)
    lakes.build_fact(lake)
    bronze.undo_last_batch(spark, lake.table("bronze", "sales"))
    root = lake.path("landing", "sales")
    write_landing(trial.landed_sales(spark, sf).drop("loaded_at"), root, RUN_TS.isoformat()[:13])
    pick_up(lake, "sales", root, RUN_TS)
    return _bronze_rows(lake)


def _land_arrays(lake: lakes.Lake, rows: DataFrame) -> str:
    """Objects of one JSON array each, of the sales whose ids are of a range."""
    path = lake.path("landing", "sales_arrays")
    ranged = rows.withColumn("part", F.floor(F.col("id") / IDS_OF_OBJECT))
    arrays = ranged.groupBy("part").agg(F.to_json(F.collect_list(F.struct(*rows.columns))).alias("value"))
    arrays.write.partitionBy("part").text(path)
    return path


def empty_object_once(spark: SparkSession, sf: str) -> DataFrame:
    """Objects of sales and one without a record, in two runs of ingest: files and rows of each batch."""
    lake, now = _new_lake(spark), datetime.now(timezone.utc)
    _land_arrays(lake, trial.landed_sales(spark, sf).drop("loaded_at"))
    spark.range(1).select(F.lit("[]").alias("value")).write.text(lake.path("landing", "sales_none"))
    for run in range(2):
        lakes.ingest_pending(lake, lake.path("landing"), "sales", now + timedelta(hours=run), suffix=".txt")
    table = lake.table("bronze", "sales")
    files = bronze.loaded_files(spark, table).groupBy(bronze.BATCH).agg(F.count("*").alias("n_files"))
    rows = spark.table(table).groupBy(bronze.BATCH).agg(F.count("*").alias("n_rows"), F.count_distinct("id").alias("n_ids"))
    return files.join(rows, bronze.BATCH, "left").select("n_files", "n_rows", "n_ids")


def arrays_in_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """Sales in objects of one JSON array each, with brackets, quotes and backslashes in their
    texts, read in blocks as large ones are."""
    lake = _new_lake(spark)
    sales = trial.landed_sales(spark, sf).drop("loaded_at").withColumn("note", F.lit(NOTE))
    path = _land_arrays(lake, sales)
    paths = [r["path"] for r in manifest(spark, path, suffix=".txt").select("path").collect()]
    sizes = {path: SPLIT_BYTES + 1 for path in paths}
    rows = read_landing(spark, paths, FEEDS["sales"], multi_line=True, sizes=sizes)
    note = F.get_json_object(OTHER, "$.note").alias("note")
    return _shown(rows.select(*models.FACT_COLUMNS, note, F.col(CORRUPT).isNull().alias("fits")))


def pick_up_after_undo(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs, the second undone and then picked up again from the same files."""
    lake = _new_lake(spark)
    _land_and_pick_up(lake, sf, RUN_TS, first=True)
    _land_and_pick_up(lake, sf, NEXT_RUN_TS, first=False)
    bronze.undo_last_batch(spark, lake.table("bronze", "sales"))
    pick_up(lake, "sales", lake.path("landing", "sales"), NEXT_RUN_TS)
    return _bronze_rows(lake)


def undo_reaches_gold(spark: SparkSession, sf: str) -> DataFrame:
    """Gold after a second run was undone that silver and gold had read."""
    lake = _new_lake(spark)
    _land_and_pick_up(lake, sf, RUN_TS, first=True)
    lakes.run(lake)
    _land_and_pick_up(lake, sf, NEXT_RUN_TS, first=False)
    lakes.run(lake)
    bronze.undo_last_batch(spark, lake.table("bronze", "sales"))
    lakes.run(lake)
    return lake.gold().read()


def gold_counted_on(spark: SparkSession, sf: str) -> DataFrame:
    """Gold after a second run was built, undone, loaded again and built again: counted on three times."""
    lake = _lake_of_two_runs(spark, sf)
    bronze.undo_last_batch(spark, lake.table("bronze", "sales"))
    lakes.run(lake)
    pick_up(lake, "sales", lake.path("landing", "sales"), NEXT_RUN_TS)
    lakes.run(lake)
    return lake.gold().read()


def late_run(spark: SparkSession, sf: str) -> DataFrame:
    """The stored fact where the run of the older sales came after that of the newer ones."""
    lake = _new_lake(spark)
    for run_ts, first in ((NEXT_RUN_TS, False), (RUN_TS, True)):
        _land_and_pick_up(lake, sf, run_ts, first)
        lakes.build_fact(lake)
    day = F.to_date("transaction_date").alias("sales_date")
    rows = lake.silver("fact_sales").read()
    return _shown(rows.select("id", "customer_id", "employee_id", "product_id", "amount_paid", day))


def bronze_undo(spark: SparkSession, sf: str) -> DataFrame:
    """Two load runs, the second of which is taken back."""
    lake = _new_lake(spark)
    _land_and_pick_up(lake, sf, RUN_TS, first=True)
    _land_and_pick_up(lake, sf, NEXT_RUN_TS, first=False)
    bronze.undo_last_batch(spark, lake.table("bronze", "sales"))
    return _bronze_rows(lake)


def _load_seed(lake: lakes.Lake, feed: str, rows: DataFrame, run_ts: datetime) -> DataFrame:
    path = lake.path("seeds", feed)
    rows.write.mode("overwrite").csv(path, header=True)
    return load_seed(lake.spark, path, FEEDS[feed], lake.table("bronze", feed), run_ts)


def seed_customer(spark: SparkSession, sf: str) -> DataFrame:
    rows = _load_seed(_new_lake(spark), "customer", trial.customers(spark, sf), RUN_TS)
    return rows.select("id", "first_name")


def _land_and_pick_up(lake: lakes.Lake, sf: str, run_ts: datetime, first: bool) -> None:
    """One run: the sales on its side of the cut land and are picked up."""
    root = lake.path("landing", "sales")
    side = _before_cut() if first else ~_before_cut()
    write_landing(trial.landed_sales(lake.spark, sf).where(side).drop("loaded_at"), root, run_ts.isoformat()[:13])
    pick_up(lake, "sales", root, run_ts)


def stream_pickup(spark: SparkSession, sf: str) -> DataFrame:
    """Two landings, three pick-ups: the last one finds nothing new."""
    lake = _new_lake(spark)
    _land_and_pick_up(lake, sf, RUN_TS, first=True)
    _land_and_pick_up(lake, sf, NEXT_RUN_TS, first=False)
    pick_up(lake, "sales", lake.path("landing", "sales"), NEXT_RUN_TS + timedelta(hours=1))
    return _bronze_rows(lake)


def _lake_of_two_runs(spark: SparkSession, sf: str) -> lakes.Lake:
    lake = _new_lake(spark)
    _load_seed(lake, "customer", trial.customers(spark, sf), RUN_TS)
    _load_seed(lake, "employee", trial.employees(spark, sf), RUN_TS)
    _load_seed(lake, "product", trial.products(spark, sf), RUN_TS)
    _land_and_pick_up(lake, sf, RUN_TS, first=True)
    lakes.run(lake)
    _land_and_pick_up(lake, sf, NEXT_RUN_TS, first=False)
    lakes.run(lake)
    return lake


def lake_fact_sales(spark: SparkSession, sf: str) -> DataFrame:
    """The stored fact after two runs, the second of which changes sales of the first."""
    rows = _lake_of_two_runs(spark, sf).silver("fact_sales").read()
    day = F.to_date("transaction_date").alias("sales_date")
    return _shown(rows.select("id", "customer_id", "employee_id", "product_id", "amount_paid", day))


def lake_daily_sales(spark: SparkSession, sf: str) -> DataFrame:
    """Stored gold after two runs, refreshed by the second for the days it touched."""
    return _lake_of_two_runs(spark, sf).gold().read()


def _dimension_of_two_seeds(lake: lakes.Lake, feed: str, rows: DataFrame, renamed: Column) -> DataFrame:
    """The stored dimension after a second seed, of those rows of the first that it renames."""
    name = [field.name for field in FEEDS[feed]][-1]
    columns = [field.name for field in FEEDS[feed]]
    first = rows.withColumn(name, F.concat(name, F.lit(" of old"))).select(*columns)
    for run_ts, seed in ((RUN_TS, first), (NEXT_RUN_TS, rows.where(renamed).select(*columns))):
        _load_seed(lake, feed, seed, run_ts)
        lakes.build_dimension(lake, f"dim_{feed}")
    return lake.silver(f"dim_{feed}").read().select(*columns)


def lake_dim_customer(spark: SparkSession, sf: str) -> DataFrame:
    """The stored dimension after a second seed that renames some of its customers."""
    customers = trial.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("first_name"), "c_acctbal"
    )
    lake = replace(_new_lake(spark), buckets=4)
    return _dimension_of_two_seeds(lake, "customer", customers, F.col("c_acctbal") > 5000)


def lake_dim_employee(spark: SparkSession, sf: str) -> DataFrame:
    lake = replace(_new_lake(spark), buckets=4)
    return _dimension_of_two_seeds(lake, "employee", trial.employees(spark, sf), F.col("id") % 3 == 0)


def lake_dim_product(spark: SparkSession, sf: str) -> DataFrame:
    lake = replace(_new_lake(spark), buckets=4)
    return _dimension_of_two_seeds(lake, "product", trial.products(spark, sf), F.col("name").like("%a%"))


def silver_without_gold(spark: SparkSession, sf: str) -> DataFrame:
    """Gold of a lake whose second run built the silver layer alone."""
    lake = _new_lake(spark)
    _land_and_pick_up(lake, sf, RUN_TS, first=True)
    lakes.run(lake)
    _land_and_pick_up(lake, sf, NEXT_RUN_TS, first=False)
    lakes.run(lake, layers=["silver"])
    return lake.gold().read()


def purged_and_loaded_again(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze is emptied after a first run; the second one loads what lands after it."""
    lake = _new_lake(spark)
    _land_and_pick_up(lake, sf, RUN_TS, first=True)
    bronze.purge_table(spark, lake.table("bronze", "sales"), confirm=True)
    purge_days(spark, lake.path("landing", "sales"), confirm=True)
    _land_and_pick_up(lake, sf, NEXT_RUN_TS, first=False)
    return _bronze_rows(lake)


def lake_checks(spark: SparkSession, sf: str) -> DataFrame:
    """The report over the stored tables after two runs."""
    return lakes.check(_lake_of_two_runs(spark, sf))


def checks_with_a_missing_table(spark: SparkSession, sf: str) -> DataFrame:
    """The report over a lake whose dimensions were never built."""
    lake = _new_lake(spark)
    _land_and_pick_up(lake, sf, RUN_TS, first=True)
    _land_and_pick_up(lake, sf, NEXT_RUN_TS, first=False)
    lakes.build_fact(lake)
    return lakes.check(lake)


def lake_freshness(spark: SparkSession, sf: str) -> DataFrame:
    """Freshness of bronze three hours after its last run."""
    lake = _new_lake(spark)
    _land_and_pick_up(lake, sf, RUN_TS, first=True)
    found = lakes.check_freshness(lake, RUN_TS + timedelta(hours=3))
    return found.select(_utc("last_loaded_at"), "age_seconds", "status")


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        daily_sales_summary,
        fact_sales,
        fact_sales_incremental,
        dim_customer,
        dim_employee,
        dim_product,
        sales_enriched,
        latest_batch,
        undo_last_batch,
        head_150,
        dq_not_null,
        dq_unique,
        dq_non_positive_amount,
        dq_report,
        freshness,
        freshness_default,
        tz_shift,
        parse_transaction_date,
        landing_manifest,
        landing_day_replace,
        bronze_sales,
        csv_landing,
        named_ingest,
        latest_object_ingest,
        bronze_undo,
        seed_customer,
        stream_pickup,
        lake_fact_sales,
        lake_daily_sales,
        lake_dim_customer,
        lake_dim_employee,
        lake_dim_product,
        silver_without_gold,
        purged_and_loaded_again,
        lake_checks,
        same_run_two_sources,
        csv_ingest,
        undo_in_pieces,
        reingest_after_undo,
        checks_with_a_missing_table,
        lake_freshness,
        empty_object_once,
        arrays_in_blocks,
        pick_up_after_undo,
        undo_reaches_gold,
        gold_counted_on,
        late_run,
    )
}
