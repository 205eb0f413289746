"""One hourly run, from the landing folder to the report."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from saleslake.plans import lake as lakes
from saleslake.streaming.pickup import pick_up


def hourly(lake: lakes.Lake, landing: str, run_ts: datetime) -> DataFrame:
    """Pick up the sales that landed, build silver and gold, and return all checks.

    A step that fails stops the run; the next run takes up what this one left.
    """
    pick_up(lake, "sales", landing, run_ts)
    lakes.run(lake)
    return lakes.check(lake).unionByName(lakes.freshness_line(lake, run_ts))
