"""Load stamps, time zones and tolerant parsing. All built-in column functions."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Text forms of a transaction date, after the ISO forms of a plain cast.
DATE_TEXT_FORMATS = ("M/d/yyyy",)
DAY_FORMAT = "yyyy-MM-dd"


def as_utc(run_ts: datetime) -> datetime:
    """The run's instant in whole seconds. A clock reading without a zone is refused."""
    if run_ts.tzinfo is None:
        raise ValueError("run_ts needs a time zone")
    return run_ts.astimezone(timezone.utc).replace(microsecond=0)


def instant(ts: datetime) -> Column:
    """A timestamp literal, independent of the session's and the host's zone."""
    return F.timestamp_seconds(F.lit(int(as_utc(ts).timestamp())))


def with_received_at(rows: DataFrame) -> DataFrame:
    """Add the file each row came from and the time the store received it."""
    return rows.withColumns(
        {
            "source_file": F.col("_metadata.file_path"),
            "received_at": F.col("_metadata.file_modification_time"),
        }
    )


def with_loaded_at(rows: DataFrame, run_ts: datetime) -> DataFrame:
    """Add the load time: one value for all rows of a run."""
    return rows.withColumn("loaded_at", instant(run_ts))


def wall_clock(column: Column | str, zone: str = "UTC+1", stored_zone: str | None = None) -> Column:
    """What a clock in ``zone`` shows, as a timestamp without zone.

    ``stored_zone`` is the zone a timestamp *without* zone is written in. Leave it out
    for true instants.
    """
    source = None if stored_zone is None else F.lit(stored_zone)
    return F.convert_timezone(source, F.lit(zone), F.col(column) if isinstance(column, str) else column)


def parse_timestamp(column: Column | str) -> Column:
    """Text to timestamp, NULL when no accepted form fits.

    A time without a date is no accepted form: a plain cast would set it on the current day.
    """
    text = F.col(column) if isinstance(column, str) else column
    forms = [F.try_to_timestamp(text, F.lit(form)) for form in DATE_TEXT_FORMATS]
    dated = F.when(text.rlike(r"^\s*[+-]?\d{4,}\s*(-|$)"), F.try_to_timestamp(text))
    return F.coalesce(dated, *forms)


def day_text(column: Column | str) -> Column:
    """The day of a timestamp as it appears in landing names."""
    return F.date_format(column, DAY_FORMAT)
