"""Seconds of an upsert against a rebuild, and of one check pass against one query per check.

    python measure_upsert.py <sf_dir> [<cpus>]

Prints one JSON line per figure. Batches are sales of the newest days (as hourly runs
bring) or of ids spread over all days (the worst case: every period is rewritten).
"""

from __future__ import annotations

import json
import sys
import time
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslake.operators import quality
from saleslake.plans import lake as lakes
from saleslake.plans import trial_tables as trial
from saleslake.plans.trial_queries import _new_lake
from saleslake.schemas import CONTRACT
from saleslake.session import build_session
from saleslake.sinks import bronze

START = datetime(2024, 7, 21, tzinfo=timezone.utc)


def report(name: str, seconds: float, **more: object) -> None:
    print(json.dumps({"figure": name, "seconds": round(seconds, 2), **more}), flush=True)


def append(lake: lakes.Lake, rows: DataFrame, run: int) -> None:
    stamped = rows.drop("loaded_at").withColumns(
        {
            "transaction_date": F.date_format("transaction_date", "yyyy-MM-dd"),
            "_corrupt_record": F.lit(None).cast("string"),
            "source_file": F.lit("measure"),
            "received_at": F.current_timestamp(),
        }
    )
    bronze.append_batch(stamped, lake.table("bronze", "sales"), START + timedelta(hours=run))


def timed_fact(lake: lakes.Lake) -> float:
    start = time.perf_counter()
    lakes.build_fact(lake)
    return time.perf_counter() - start


def main() -> None:
    sf, cpus = sys.argv[1], sys.argv[2] if len(sys.argv) > 2 else "8"
    spark = build_session("saleslake-measure", f"local[{cpus}]", 32, **{"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    rows = trial.raw_sales(spark, sf)
    lake = _new_lake(spark)
    append(lake, rows, 0)
    timed_fact(_warm(spark, rows))
    full = timed_fact(lake)
    fact = lake.silver("fact_sales")
    report("rebuild of the fact", full, rows=fact.read().count())
    run = 0
    for share in (0.01, 0.1, 0.41):
        newest = F.expr(f"percentile_approx(unix_timestamp(transaction_date), {1 - share})")
        day = fact.read().agg(newest).first()[0]
        batches = {
            "newest days": rows.where(F.unix_timestamp("transaction_date") >= day),
            "all days": rows.where(F.pmod(F.xxhash64("id"), F.lit(1000)) < int(share * 1000)),
        }
        for kind, batch in batches.items():
            run += 1
            append(lake, batch, run)
            report(f"upsert of {share:.0%}, {kind}", timed_fact(lake))
    tables = _check_tables(spark, sf, fact)
    start = time.perf_counter()
    lakes.contract_report(tables).collect()
    report("all checks, one scan per table", time.perf_counter() - start)
    start = time.perf_counter()
    for name, table in tables.items():
        for column in CONTRACT[name].not_null:
            table.where(F.col(column).isNull()).count()
        if CONTRACT[name].unique or name == "fact_sales":
            quality.duplicate_keys(table, "id").count()
    tables["raw_sales"].where("amount_paid <= 0").count()
    tables["fact_sales"].where("transaction_date is null").count()
    report("all checks, one query each", time.perf_counter() - start)
    spark.stop()


def _warm(spark, rows: DataFrame) -> lakes.Lake:
    lake = _new_lake(spark)
    append(lake, rows.where("id % 50 = 0"), 0)
    return lake


def _check_tables(spark, sf: str, fact) -> dict[str, DataFrame]:
    return {
        "raw_sales": trial.lines(spark, sf),
        "dim_customer": trial.customers(spark, sf),
        "dim_employee": trial.employees(spark, sf),
        "dim_product": trial.products(spark, sf),
        "fact_sales": fact.read(),
    }


if __name__ == "__main__":
    main()
