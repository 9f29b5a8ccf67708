"""Local-calendar dates, report keys and whole-day windows."""

from __future__ import annotations

from datetime import date, datetime, time, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterglass import domain


def local_date(instant: Column, tz: str = domain.TIME_ZONE, *, ntz: bool = False) -> Column:
    """Calendar date of a UTC instant; ``ntz`` says the column is a zone-less UTC time."""
    if ntz:
        return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(tz), instant))
    return F.to_date(F.convert_timezone(F.current_timezone(), F.lit(tz), instant.cast("timestamp_ntz")))


def is_ntz(frame: DataFrame, name: str) -> bool:
    return isinstance(frame.schema[name].dataType, T.TimestampNTZType)


def today_local(tz: str = domain.TIME_ZONE) -> date:
    """Driver-side current local date, so that date bounds stay literals."""
    return datetime.now(ZoneInfo(tz)).date()


def run_date(as_of: date) -> Column:
    """Data are complete up to the day before the run."""
    return F.date_sub(F.lit(as_of), 1)


def week_key(day: Column) -> Column:
    """Calendar year followed by ISO week, kept as is at year ends."""
    return F.concat(F.date_format(day, "yyyy"), F.lpad(F.weekofyear(day).cast("string"), 2, "0"))


def iso_week_key(day: Column) -> Column:
    iso_year = F.extract(F.lit("YEAROFWEEK"), day)
    return F.concat(iso_year.cast("string"), F.lpad(F.weekofyear(day).cast("string"), 2, "0"))


def month_key(day: Column) -> Column:
    return F.date_format(day, "yyyyMM")


def monday(day: Column) -> Column:
    return F.date_trunc("week", day).cast("date")


def whole_hours(start: Column, end: Column) -> Column:
    """Whole hours from start to end, cut towards zero."""
    return F.timestamp_diff("HOUR", start, end)


def days_between(start: Column, end: Column, places: int) -> Column:
    return F.round(whole_hours(start, end) / F.lit(24.0), places)


def day_bounds_utc(day: date, tz: str = domain.TIME_ZONE) -> tuple[datetime, datetime]:
    """UTC instants ``[start, end)`` of one local day."""
    zone = ZoneInfo(tz)
    edges = (datetime.combine(day + timedelta(days=n), time.min, tzinfo=zone) for n in (0, 1))
    start, end = (edge.astimezone(timezone.utc) for edge in edges)
    return start, end


def instant_literal(instant: datetime, *, ntz: bool) -> Column:
    text = instant.astimezone(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.expr(f"TIMESTAMP_NTZ'{text}'" if ntz else f"TIMESTAMP'{text}Z'")


def object_id_floor(instant: datetime) -> str:
    """Smallest 24-digit object id made in the second of ``instant``."""
    return f"{int(instant.timestamp()):08x}" + "0" * 16


def object_id_time(object_id: Column) -> Column:
    """Instant inside an object id (whole seconds, UTC)."""
    seconds = F.conv(F.substring(object_id, 1, 8), 16, 10).cast("bigint")
    return F.timestamp_seconds(seconds)


def date_window(*, watermark: date | None, start_date: date, lookback_days: int,
                today: date) -> tuple[date, date] | None:
    """First and last day to process, or None.

    Covers the days after the watermark, re-reads the last ``lookback_days`` and
    ends yesterday; never starts before ``start_date``.
    """
    last = today - timedelta(days=1)
    after_watermark = start_date if watermark is None else watermark + timedelta(days=1)
    first = max(start_date, min(after_watermark, last - timedelta(days=lookback_days - 1)))
    return (first, last) if first <= last else None


def date_spine(spark: SparkSession, window: tuple[date, date] | None) -> DataFrame:
    """One row per day of a window; no rows for None."""
    first, last = window or (date(1970, 1, 1), date(1970, 1, 1))
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(first), F.lit(last), F.expr("INTERVAL 1 DAY"))).alias("date_id"))
    return days if window else days.limit(0)


def watermark_windows(state: DataFrame, *, start_date: date, lookback_days: int, today: date) -> DataFrame:
    """Days to process for every watermark row, as (pipeline_name, date_id)."""
    last = F.date_sub(F.lit(today), 1)
    after = F.coalesce(F.date_add("last_processed_date", 1), F.lit(start_date))
    first = F.greatest(F.lit(start_date), F.least(after, F.date_sub(last, lookback_days - 1)))
    return (state.select("pipeline_name", first.alias("lo"), last.alias("hi"))
            .where("lo <= hi")
            .select("pipeline_name", F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("date_id")))
