"""Repeat-purchase behaviour from partial results that merge across days.

Of each day there are kept: the first row of every subscription that a user bought on it, and one row per user with the sums of
its use (none: the user was seen). The first row over all days is the least of the days' first rows, sums add up, and the last day of
the data is the last one that holds a row, so a run folds the events of changed days only and no event is shuffled for the end of
the data. A copy of an event may lie ``copy_days`` after it: the days that far behind a changed one are folded again, and of the days
before only ids are read. Bans, names and prices are put on when the result is read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterglass import domain
from meterglass.functions import calendar
from meterglass.operators import dedup, splitting
from meterglass.plans import behavior
from meterglass.plans.cycle_state import COPY_DAYS
from meterglass.sources import commits, days, tables

BUYS, USE = "buys", "use"
#: Days folded by one job at most; copies are looked for from the first of them on.
DAYS_PER_JOB = 31


def schemas(events: DataFrame) -> dict[str, T.StructType]:
    instant = events.schema["eventTimeStamp"].dataType.simpleString()
    return {name: events.sparkSession.createDataFrame([], text).schema for name, text in {
        BUYS: f"userId string, kind string, subscriptionId string, packageId bigint, eventTimeStamp {instant}, event_id string, date_id date",
        USE: f"userId string, is_use boolean, cost {domain.MONEY_SUM}, tokens bigint, date_id date"}.items()}


def _runs(found: Sequence[date]) -> list[tuple[date, date]]:
    """Neighbouring days together, up to DAYS_PER_JOB."""
    out: list[tuple[date, date]] = []
    for day in found:
        if out and day == out[-1][1] + timedelta(days=1) and (day - out[-1][0]).days < DAYS_PER_JOB:
            out[-1] = (out[-1][0], day)
        else:
            out.append((day, day))
    return out


def _between(first: date, last: date):
    return (F.col("date_id") >= F.lit(first)) & (F.col("date_id") <= F.lit(last))


def folded(events: DataFrame, first: date, last: date, start_date: date, copy_days: int) -> dict[str, DataFrame]:
    """What is kept of the days first..last."""
    rows = tables.b2c_events(events.where(_between(first, last)))
    earlier = max(start_date, first - timedelta(days=copy_days))
    if earlier < first:
        before = tables.b2c_events(events.where(_between(earlier, first - timedelta(days=1)))).select("event_id")
        rows = rows.join(before, "event_id", "left_anti")
    rows = dedup.one_per_event(rows)
    kind = F.col("eventType")
    bought = (kind == domain.SUBSCRIBE) & F.col("packageId").isin(*domain.B2C_PACKAGES)
    buys = dedup.first_by(rows.where(bought).withColumn("kind", F.when(F.col("packageId") == domain.TRIAL_PACKAGE, "trial").otherwise("paid")),
                          ["date_id", "userId", "kind", "subscriptionId"], "eventTimeStamp", "event_id")
    used = behavior.is_usage()
    use = rows.groupBy("date_id", "userId").agg(
        F.coalesce(F.bool_or(used), F.lit(False)).alias("is_use"), F.sum(F.when(used, F.col("totalCostThb"))).cast(domain.MONEY_SUM).alias("cost"),
        F.sum(F.when(used, F.abs("eggToken"))).alias("tokens"))
    return {BUYS: buys, USE: use}


def update(events: DataFrame, path: str, *, start_date: date, as_of: date, changed: Sequence[date] = (),
           versions: Mapping[date, str] | None = None, copy_days: int = COPY_DAYS, keep: int = 2) -> list[date]:
    """Bring what is kept up to the events of the window; gives the days folded. ``changed`` or ``versions``: as for ``summary_state.update``."""
    spark = events.sparkSession
    read = commits.last(spark, path)
    entries = dict(read.entries)
    if versions is not None:
        seen = days.days_of(entries, "seen")
        changed = [*changed, *days.changed({d: v for d, v in versions.items() if start_date <= d < as_of}, seen)]
        entries = {k: v for k, v in entries.items() if not k.startswith("seen ")} | {
            f"seen {d}": v for d, v in versions.items() if start_date <= d < as_of}
    again = sorted({d + timedelta(days=n) for d in changed for n in range(copy_days + 1) if start_date <= d + timedelta(days=n) < as_of})
    if not again and entries == read.entries:
        return []
    for first, last in _runs(again):
        run = days.new_run()
        replaced = [first + timedelta(days=n) for n in range((last - first).days + 1)]
        for table, frame in folded(events, first, last, start_date, copy_days).items():
            names = schemas(events)[table].names
            entries = days.replaced(entries, table, replaced, days.write(frame.select(*names).hint("rebalance", days.DAY), path, table, run))
    commits.commit(spark, path, read, entries)
    days.prune(spark, path, keep)
    return again


def repeat_behavior(cycles: DataFrame, path: str, events: DataFrame, packages: DataFrame, users: DataFrame, *, start_date: date, as_of: date,
                    tz: str = domain.TIME_ZONE, mature_days: int = domain.MATURE_DAYS, rows_per_run: int = splitting.ROWS_PER_RUN) -> DataFrame:
    """As ``behavior.repeat_behavior``, from what is kept; ``events`` gives types only and is not read."""
    spark = events.sparkSession
    entries, kinds = commits.last(spark, path).entries, schemas(events)
    window = tables.in_window(start_date, as_of)
    buys, use = (days.read(spark, path, entries, t, kinds[t]).where(window) for t in (BUYS, USE))
    cuts = splitting.long_keys(buys.where("kind = 'paid'"), "userId", ("eventTimeStamp", "event_id"), rows_per_run)
    buys, use = tables.without_banned(buys, users), tables.without_banned(use, users)
    firsts = dedup.first_by(buys, ["userId", "kind", "subscriptionId"], "eventTimeStamp", "event_id")
    sums = use.where("is_use").groupBy("userId").agg(F.sum("cost").alias("cost"), F.sum("tokens").alias("tokens")).withColumn("kind", F.lit("use"))
    rows = firsts.drop("date_id").unionByName(sums, allowMissingColumns=True)
    named = tables.b2c_packages(packages, "packageName", "priceThb").distinct()
    end = use.select(F.max("date_id")).scalar()
    return behavior.finished(cycles, behavior.summed_purchases(rows, cuts, named), named, end,
                             calendar.is_ntz(events, "eventTimeStamp"), tz, mature_days)
