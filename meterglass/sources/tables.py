"""Scans of the stored tables, with the filters that belong to each reader."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterglass import domain
from meterglass.functions import calendar
from meterglass.functions.values import safe_bigint
from meterglass.sources import documents


def scan_day(events: DataFrame, day: date, *, tz: str = domain.TIME_ZONE,
             id_buffer_hours: int = 0, columns: Sequence[str] | None = None) -> DataFrame:
    """One local day of a stored event table by instant (and id range), projected."""
    ntz = calendar.is_ntz(events, "eventTimeStamp")
    keep = documents.day_range(F.col("eventTimeStamp"), day, day, tz, ntz=ntz)
    if id_buffer_hours > 0:
        keep = documents.id_range(F.col("event_id"), day, day, tz, id_buffer_hours) & keep
    return events.where(keep).select(*(columns or events.columns))


def in_window(start_date: date, as_of: date) -> Column:
    """Complete days from the start date; literals, so partitions prune statically."""
    return (F.col("date_id") >= F.lit(start_date)) & (F.col("date_id") < F.lit(as_of))


def with_package_number(events: DataFrame) -> DataFrame:
    return events.withColumn("packageId", safe_bigint(F.col("packageId")))


def allowed(ids: Iterable[int]) -> Column:
    return F.col("packageId").isin(*ids)


def not_denied(ids: Iterable[int]) -> Column:
    """A missing package number is dropped too."""
    return ~F.col("packageId").isin(*ids)


def b2c_events(events: DataFrame) -> DataFrame:
    return with_package_number(events).where(allowed(domain.B2C_PACKAGES))


def b2b_events(events: DataFrame) -> DataFrame:
    return with_package_number(events).where(not_denied(domain.B2B_EXCLUDED_PACKAGES))


def b2c_packages(packages: DataFrame, *columns: str) -> DataFrame:
    return (with_package_number(packages).where(allowed(domain.B2C_PACKAGES))
            .select("packageId", *columns))


def b2b_packages(packages: DataFrame, *columns: str) -> DataFrame:
    return (with_package_number(packages).where(not_denied(domain.B2B_EXCLUDED_PACKAGES))
            .select("packageId", *columns))


def banned_users(users: DataFrame) -> DataFrame:
    """Users flagged as banned; a missing flag is not a ban."""
    return users.where("isBanned").select("userId").distinct()


def without_banned(rows: DataFrame, users: DataFrame) -> DataFrame:
    """Drop the rows of banned users; rows with no user stay.

    No broadcast hint: the list grows with the users, so the planner decides from
    its size, and a sort-merge anti join is split at run time if a user is hot.
    """
    return rows.join(banned_users(users), "userId", "left_anti")
