"""User-day tracking of both segments, their union and the numeric-key views.

Events are reduced to (user, day, package) before anything else happens. Every
later window is over that grain, where one user holds days x packages rows, so
a user with a third of all events is as cheap as any other.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from meterglass import domain
from meterglass.functions import calendar, figures
from meterglass.functions.values import safe_bigint
from meterglass.plans.summary import company_members
from meterglass.sources import tables

EVENT_COLUMNS = ("event_id", "date_id", "eventTimeStamp", "userId", "eventType", "packageId",
                 "eggToken", "chatToken", "totalCostThb")

# The output columns and their order are a contract with the reports.
B2C_COLUMNS = ("month_id", "week_id", "date_id", "userId", "packageName", "trial_conversion_cnt", "token_used",
               "totalCostThb", "free_trial_token_used", "package_1", "package_2", "event_row",
               "current_package_flag", "packageId", "run_date")
B2B_COLUMNS = ("month_id", "week_id", "date_id", "userId", "packageName", "token_used", "totalCostThb",
               "package_1", "package_2", "teamId", "teamName", "companyId", "companyName", "number_of_user_bin",
               "company_size_range", "event_row", "company_first_event_row", "team_first_event_row",
               "current_package_flag", "packageId", "run_date")
TOTAL_COLUMNS = ("version", "month_id", "week_id", "date_id", "userId", "packageName", "trial_conversion_cnt",
                 "token_used", "totalCostThb", "free_trial_token_used", "package_1", "package_2", "teamId",
                 "teamName", "companyId", "companyName", "number_of_user_bin", "company_size_range", "event_row",
                 "company_first_event_row", "team_first_event_row", "current_package_flag", "packageId", "run_date")

def _user() -> W:
    return W.partitionBy("userId")


def settled() -> Column:
    """Tracking counts settled use only, unlike summaries and cycles."""
    return F.col("eventType") == domain.TOKEN_USED


def distinct_events(events: DataFrame) -> DataFrame:
    """Whole-row duplicates removed; rows without a user never reach tracking."""
    return events.where(F.col("userId").isNotNull()).select(*EVENT_COLUMNS).distinct()


def user_day_packages(events: DataFrame, packages: DataFrame) -> DataFrame:
    """(user, day, package) sums of the distinct events, with the package name."""
    days = distinct_events(events).groupBy("userId", "date_id", "packageId").agg(
        F.sum(F.when(settled(), -F.col("eggToken"))).alias("token_used"),
        F.sum(F.when(settled(), F.col("totalCostThb"))).alias("totalCostThb"))
    return days.join(packages.select("packageId", "packageName").distinct(), "packageId")


def with_user_packages(days: DataFrame) -> DataFrame:
    """First two distinct package names of the user, a missing name sorting first."""
    names = F.sort_array(F.collect_set("packageName").over(_user()))
    unnamed = F.max(F.col("packageName").isNull()).over(_user())
    first = F.get(names, F.lit(0))
    return days.select(
        "*",
        F.when(~unnamed, first).alias("package_1"),
        F.when(unnamed, first).otherwise(F.get(names, F.lit(1))).alias("package_2"),
        F.max("packageId").over(_user()).alias("top_package"))


def _user_days(days: DataFrame, *measures: Column) -> DataFrame:
    """(user, day) rows with date keys, day rank and the latest-day flag."""
    merged = days.groupBy("userId", "date_id", "package_1", "package_2").agg(
        F.max("packageName").alias("packageName"),
        F.sum("token_used").alias("token_used"),
        F.sum("totalCostThb").cast(domain.MONEY_SUM).alias("totalCostThb"), *measures)
    return merged.where(F.col("packageName").isNotNull()).select(
        "*",
        calendar.month_key(F.col("date_id")).alias("month_id"),
        calendar.week_key(F.col("date_id")).alias("week_id"),
        day_rank(F.col("userId")).alias("event_row"),
        latest_day_flag().alias("current_package_flag"))


def day_rank(*keys: Column) -> Column:
    return F.dense_rank().over(W.partitionBy(*keys).orderBy("date_id")).cast("bigint")


def latest_day_flag() -> Column:
    """1 on the user's last day; a maximum, so the day rank's sort is not turned round."""
    return F.when(F.col("date_id") == F.max("date_id").over(_user()), 1).otherwise(0).cast("bigint")


def trial_conversions(events: DataFrame, packages: DataFrame) -> DataFrame:
    """(userId, date_id, event_id) of each user's first paid subscription, if a trial came before it.

    Only the order of two instants matters, so two minima replace running sums.
    """
    known = packages.select("packageId").distinct()
    bought = (events.where((F.col("eventType") == domain.SUBSCRIBE) & F.col("userId").isNotNull())
              .select("userId", "date_id", "packageId", "eventTimeStamp", "event_id")
              .join(known, "packageId", "left_semi"))
    trial = F.col("packageId") == domain.TRIAL_PACKAGE
    moment = F.struct("eventTimeStamp", "event_id")
    firsts = bought.groupBy("userId").agg(
        F.min(F.when(trial, moment)).alias("trial"),
        F.min(F.when(~trial, F.struct("eventTimeStamp", "event_id", "date_id"))).alias("paid"))
    before = F.col("trial") < F.struct("paid.eventTimeStamp", "paid.event_id")
    return firsts.where(before).select("userId", "paid.date_id", "paid.event_id")


def event_flags(events: DataFrame, packages: DataFrame) -> DataFrame:
    """Events with their report flag; a conversion shows a second time as a purchase."""
    converted = trial_conversions(events, packages).select("userId", "event_id", F.lit(True).alias("converted"))
    kind = F.col("eventType")
    flag = F.when(kind == domain.TOKEN_USED, "Active").otherwise(kind)
    flags = (F.when(F.col("converted"), F.array(F.lit(domain.TRIAL_CONVERSION), F.lit(domain.SUBSCRIBE)))
             .otherwise(F.array(flag)))
    return (events.join(converted, ["userId", "event_id"], "left")
            .withColumn("event_flag", F.explode(flags)).drop("converted"))


def user_tracking_b2c(events: DataFrame, packages: DataFrame, users: DataFrame, *,
                      start_date: date, as_of: date) -> DataFrame:
    events = tables.b2c_events(events.where(tables.in_window(start_date, as_of)))
    packages = tables.b2c_packages(packages, "packageName").distinct()
    days = with_user_packages(tables.without_banned(user_day_packages(events, packages), users))
    free = (F.col("package_1") == domain.FREE_TRIAL_NAME) & (F.col("packageId") == F.col("top_package"))
    rows = _user_days(days, F.sum(F.when(free, F.col("token_used"))).alias("free_trial_token_used"))
    converted = trial_conversions(events, packages).select("userId", "date_id", F.lit(True).alias("converted"))
    return (rows.join(converted, ["userId", "date_id"], "left")
            .withColumn("trial_conversion_cnt", F.when(F.col("converted"), 1).otherwise(0).cast("bigint"))
            .join(packages, "packageName")
            .withColumn("run_date", calendar.run_date(as_of))
            .select(*B2C_COLUMNS))


def company_sizes(members: DataFrame) -> DataFrame:
    """Users per company, in bins of ten with a label."""
    return (members.groupBy("companyId").agg(F.count_distinct("userId").alias("n"))
            .withColumn("number_of_user_bin", figures.size_bin(F.col("n")))
            .withColumn("company_size_range", figures.size_label(F.col("number_of_user_bin")))
            .select("companyId", "number_of_user_bin", "company_size_range"))


def sized_members(users: DataFrame, team: DataFrame, company: DataFrame) -> DataFrame:
    members = company_members(users, team, company)
    return members.join(company_sizes(members), "companyId")


def active_days(events: DataFrame, packages: DataFrame, members: DataFrame) -> DataFrame:
    """Distinct (company, team, day) with tracked activity.

    Read from three columns and collapsed per user-day in the map tasks, so ranking
    the days of a large company never touches its user-day rows.
    """
    named = packages.where(F.col("packageName").isNotNull()).select("packageId").distinct()
    days = events.select("userId", "date_id", "packageId").distinct().join(named, "packageId", "left_semi")
    return (days.select("userId", "date_id").distinct()
            .join(members.select("userId", "companyId", "teamId"), "userId")
            .select("companyId", "teamId", "date_id").distinct())


def ranked_days(days: DataFrame, key: str, name: str) -> DataFrame:
    """Running number of each active day of a company or team."""
    return days.select(key, "date_id").distinct().withColumn(name, day_rank(F.col(key)))


def user_tracking_b2b(events: DataFrame, packages: DataFrame, users: DataFrame, team: DataFrame,
                      company: DataFrame, *, start_date: date, as_of: date) -> DataFrame:
    events = tables.with_package_number(events.where(tables.in_window(start_date, as_of)))
    packages = tables.b2b_packages(packages, "packageName").distinct()
    members = sized_members(users, team, company)
    rows = _user_days(with_user_packages(user_day_packages(events, packages)))
    days = active_days(events, packages, members)
    return (rows.join(members, "userId")
            .join(ranked_days(days, "companyId", "company_first_event_row"), ["companyId", "date_id"])
            .join(ranked_days(days, "teamId", "team_first_event_row"), ["teamId", "date_id"])
            .join(packages, "packageName")
            .withColumn("run_date", calendar.run_date(as_of))
            .select(*B2B_COLUMNS))


def user_tracking_total(b2c: DataFrame, b2b: DataFrame) -> DataFrame:
    """Both segments in one frame; missing text becomes the word null, numbers stay missing."""
    both = (b2c.withColumn("version", F.lit("B2C"))
            .unionByName(b2b.withColumn("version", F.lit("B2B")), allowMissingColumns=True))
    return both.fillna(domain.NULL_TEXT).select(*TOTAL_COLUMNS)


def numeric_keys(tracking: DataFrame) -> DataFrame:
    """The same columns with month and week as numbers (works for all three frames)."""
    return (tracking.withColumn("month_id", safe_bigint(F.col("month_id")))
            .withColumn("week_id", safe_bigint(F.col("week_id"))))
