"""Small column builders shared by the operators."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocab as V


def fingerprint(*cols: Column) -> Column:
    """SHA-256 content key over the lower-cased parts joined by ``||``.

    No trimming; a null part vanishes without leaving an empty slot (``concat_ws``)."""
    return F.sha2(F.concat_ws("||", *[F.lower(c) for c in cols]), 256)


def first_or_null(arr: Column) -> Column:
    """Element 0 or null for a null/empty array (``arr[0]`` raises under ANSI)."""
    return F.get(arr, 0)


def parse_timestamp(text: Column) -> Column:
    """ISO-8601 text to timestamp; null for malformed input instead of an error."""
    return F.try_to_timestamp(text)


def as_timestamp(value) -> Column:
    """A literal instant (string, date or datetime) as a timestamp column."""
    if isinstance(value, Column):
        return value
    if isinstance(value, (dt.datetime, dt.date)):
        return F.lit(value).cast("timestamp")
    return F.lit(str(value)).cast("timestamp")


def run_timestamp(run_ts=None) -> Column:
    """One instant per run: the given value, else ``current_timestamp()``."""
    return F.current_timestamp() if run_ts is None else as_timestamp(run_ts)


def partition_parts(ts: Column, default_year: int = V.DEFAULT_YEAR,
                    default_month: int = V.DEFAULT_MONTH) -> tuple[Column, Column]:
    """``year``/``month`` partition values with defaults for undated rows."""
    return (F.coalesce(F.year(ts), F.lit(default_year)).alias("year"),
            F.coalesce(F.month(ts), F.lit(default_month)).alias("month"))


def parse_wall_clock(text: Column) -> Column:
    """Capture-time date parsing: drop the fraction and any zone designator and read
    the wall-clock time as UTC (an offset is overwritten, not converted)."""
    head = F.replace(F.split_part(text, F.lit("."), F.lit(1)), F.lit("Z"), F.lit(""))
    return F.try_to_timestamp(F.regexp_replace(head, r"[+-]\d{2}:\d{2}$", ""))


def recent(ts: Column, as_of, max_days: int = V.MAX_JOB_AGE_DAYS) -> Column:
    """Keep when the age in whole days (floored) is at most ``max_days``; a missing
    or unparseable date (null ``ts``) is kept."""
    age_days = F.floor((F.unix_micros(as_timestamp(as_of)) - F.unix_micros(ts.cast("timestamp"))) / 86_400_000_000)
    return ts.isNull() | (age_days <= max_days)


def relevant(domains: Column, internship: Column | None = None) -> Column:
    """Any matched domain, or (page sources) an internship."""
    hit = F.coalesce(F.size(domains) > 0, F.lit(False))
    if internship is not None:
        hit = hit | F.coalesce(internship, F.lit(False))
    return hit


def in_future(ts: Column, as_of_date) -> Column:
    """``ts > as_of_date`` compared at midnight: anything dated on the as-of day counts."""
    day = as_of_date if isinstance(as_of_date, Column) else F.lit(str(as_of_date)).cast("date")
    return ts > day.cast("timestamp")


def run_date_parts(ts: Column) -> tuple[Column, Column]:
    """Date and time keys of a landed batch: ``yyyy-MM-dd`` and ``HHmmss``."""
    return F.date_format(ts, "yyyy-MM-dd"), F.date_format(ts, "HHmmss")
