"""First-row-per-group rules.

All are ``row_number() = 1`` filters: Spark keeps one row per group in every
task before the shuffle, so a group that holds most of the rows (a repeated
event, the group of missing subscription ids) reaches its reducer as at most one
row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from meterglass import domain

_RANK = "__rank"


def first_by(rows: DataFrame, keys: list[str], *order: str | Column) -> DataFrame:
    """First row of each group in the given order; missing keys form one group."""
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return rows.withColumn(_RANK, rank).where(F.col(_RANK) == 1).drop(_RANK)


def one_per_event(events: DataFrame) -> DataFrame:
    """Earliest copy of each event id; other columns break ties so that reruns agree."""
    ties = [c for c in ("userId", "eventType", "packageId", "subscriptionId", "eggToken") if c in events.columns]
    return first_by(events, ["event_id"], "eventTimeStamp", *ties)


def one_per_lifecycle(events: DataFrame) -> DataFrame:
    """Earliest row per segment, event type and subscription."""
    return first_by(events, ["version", "eventType", "subscriptionId"], "eventTimeStamp", "event_id")


def one_per_subscription(events: DataFrame) -> DataFrame:
    """Earliest row per segment and subscription."""
    return first_by(events, ["version", "subscriptionId"], "eventTimeStamp", "event_id")


def latest_per_user(subscriptions: DataFrame) -> DataFrame:
    """Latest subscription per segment and user."""
    return first_by(subscriptions, ["version", "userId"],
                    F.desc("eventTimeStamp"), F.desc("event_id"))


def one_per_boundary(boundaries: DataFrame) -> DataFrame:
    """One row per user, instant and event type."""
    return first_by(boundaries, ["userId", "eventTimeStamp", "eventType"], "event_id")


def one_per_paid_subscription(subscriptions: DataFrame) -> DataFrame:
    """Earliest row per user and subscription."""
    return first_by(subscriptions, ["userId", "subscriptionId"], "eventTimeStamp", "event_id")


def collapse_lifecycle(events: DataFrame) -> DataFrame:
    """Lifecycle events once per subscription, all other events as they are.

    An event with no type belongs to neither side and drops out.
    """
    lifecycle = F.col("eventType").isin(*domain.LIFECYCLE)
    return events.where(~lifecycle).unionByName(one_per_lifecycle(events.where(lifecycle)))
