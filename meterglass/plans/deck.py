"""Headline metrics, company sizes, new users per week and slide placeholders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from meterglass import domain
from meterglass.functions import calendar, figures
from meterglass.functions.values import safe_bigint
from meterglass.operators import dedup
from meterglass.plans.summary import without_banned_b2c
from meterglass.sources import tables

COLUMNS = ("version", "userId", "packageId", "eventTimeStamp", "date_id", "subscriptionId", "event_id")


def all_packages(b2c_packages: DataFrame, b2b_packages: DataFrame) -> DataFrame:
    """Every listed package of both segments."""
    parts = [p.select(F.lit(v).alias("version"), safe_bigint(F.col("packageId").cast("string")).alias("packageId"),
                      "packageName") for v, p in (("B2C", b2c_packages), ("B2B", b2b_packages))]
    return parts[0].unionByName(parts[1])


def purchases(b2c_events: DataFrame, b2b_events: DataFrame, b2c_users: DataFrame) -> DataFrame:
    """Purchases of all time: no bans, B2C of any package, B2B without the internal ones."""
    bought = F.col("eventType") == domain.SUBSCRIBE
    b2c = tables.with_package_number(b2c_events.where(bought)).withColumn("version", F.lit("B2C"))
    b2b = tables.b2b_events(b2b_events.where(bought)).withColumn("version", F.lit("B2B"))
    return without_banned_b2c(b2c.select(*COLUMNS).unionByName(b2b.select(*COLUMNS)), b2c_users)


def subscriptions(b2c_events: DataFrame, b2b_events: DataFrame, b2c_users: DataFrame) -> DataFrame:
    return dedup.one_per_subscription(purchases(b2c_events, b2b_events, b2c_users))


def current_packages(subs: DataFrame, packages: DataFrame) -> DataFrame:
    """(version, userId, package): each user under the package bought last."""
    return (dedup.latest_per_user(subs).join(packages, ["version", "packageId"])
            .select("version", "userId", F.col("packageName").alias("package")))


def converted_users(subs: DataFrame) -> DataFrame:
    """B2C users with a trial and a paid subscription, in whichever order."""
    trial = F.col("packageId") == domain.TRIAL_PACKAGE
    return (subs.where(F.col("version") == "B2C").groupBy("userId")
            .agg(F.min(F.when(~trial, F.col("eventTimeStamp"))).alias("first_paid_ts"),
                 F.count_if(trial).alias("trials"), F.count_if(~trial).alias("paid"))
            .where("trials > 0 AND paid > 0").select("userId", "first_paid_ts"))


def conversion_packages(subs: DataFrame, packages: DataFrame) -> DataFrame:
    """Package at the first paid instant; a trial row of that same instant shows too.

    Joined on user and instant, so one user's purchases spread over all tasks.
    """
    rows = subs.where(F.col("version") == "B2C").withColumn("first_paid_ts", F.col("eventTimeStamp"))
    return (rows.join(converted_users(subs), ["userId", "first_paid_ts"])
            .join(packages, ["version", "packageId"])
            .select("userId", F.col("packageName").alias("to_package")))


def user_counts() -> dict[str, Column]:
    """Measure of every user metric over (version, package) rows."""
    version, package = F.col("version"), F.col("package")

    def of(v: str, name: str) -> Column:
        return F.count_if((version == v) & (package == name))

    def among(v: str, names: tuple[str, ...], inside: bool) -> Column:
        member = package.isin(*names)
        return F.count_if((version == v) & (member if inside else ~member))

    b2c, b2b = domain.B2C_SUBSCRIBER_NAMES, domain.B2B_SUBSCRIBER_NAMES
    return {
        "total_users": F.count(F.lit(1)),
        "b2c_users": F.count_if(version == "B2C"), "b2b_users": F.count_if(version == "B2B"),
        "b2c_subscriber": among("B2C", b2c, True), "b2c_free_trial": among("B2C", b2c, False),
        "b2c_starter": of("B2C", "Starter"), "b2c_standard": of("B2C", "Standard"), "b2c_pro": of("B2C", "Pro"),
        "b2b_subscriber": among("B2B", b2b, True), "b2b_others": among("B2B", b2b, False),
        "b2b_biz_starter": of("B2B", "Biz Starter"), "b2b_biz_standard": of("B2B", "Biz Standard"),
        "b2b_biz_pro": of("B2B", "Biz Pro"),
    }


def _long(row: DataFrame, keys: list[str]) -> DataFrame:
    """One row of measures turned into (metric_key, value_num) rows."""
    pairs = ", ".join(f"'{key}', `{key}`" for key in keys)
    return row.selectExpr(f"stack({len(keys)}, {pairs}) AS (metric_key, value_num)")


def slide_metrics(b2c_events: DataFrame, b2b_events: DataFrame, b2c_packages: DataFrame,
                  b2b_packages: DataFrame, b2c_users: DataFrame, tracking_b2b: DataFrame) -> DataFrame:
    """18 headline figures in long form, with the last day of data."""
    subs = subscriptions(b2c_events, b2b_events, b2c_users)
    packages = all_packages(b2c_packages, b2b_packages)
    users = user_counts()
    user_row = current_packages(subs, packages).agg(*[c.alias(k) for k, c in users.items()])
    to = F.col("to_package")
    conversions = {"free_trial_conversion": F.count(F.lit(1)), "to_starter": F.count_if(to == "Starter"),
                   "to_standard": F.count_if(to == "Standard"), "to_pro": F.count_if(to == "Pro")}
    conversion_row = conversion_packages(subs, packages).agg(*[c.alias(k) for k, c in conversions.items()])
    company_row = tracking_b2b.agg(F.count_distinct("companyId").alias("b2b_companies"))
    values = (_long(user_row, list(users)).unionByName(_long(conversion_row, list(conversions)))
              .unionByName(_long(company_row, ["b2b_companies"])))
    label = F.create_map(*[F.lit(v) for key, text, _ in domain.METRICS for v in (key, text)])
    order = F.create_map(*[F.lit(v) for key, _, number in domain.METRICS for v in (key, number)])
    end = subs.agg(F.max("date_id")).scalar()
    return values.select(
        "metric_key", label[F.col("metric_key")].alias("metric_label"), "value_num",
        figures.thousands(F.col("value_num")).alias("value_display"),
        order[F.col("metric_key")].cast("bigint").alias("sort_order"),
        end.alias("data_end"),
    ).select("*", figures.long_date(F.col("data_end")).alias("period_display"),
             F.current_timestamp().alias("generated_at")).orderBy("sort_order")


def read_metrics(metrics: DataFrame) -> DataFrame:
    """What the slide deck needs, in deck order."""
    return metrics.orderBy("sort_order").select("metric_key", "value_display", "period_display")


def slide_placeholders(metrics: DataFrame) -> DataFrame:
    """(placeholder, replacement) rows: metrics with a value, then the period once."""
    shown = metrics.where(F.col("value_display").isNotNull() & (F.coalesce("metric_key", F.lit("")) != "")).select(
        figures.placeholder(F.col("metric_key")).alias("placeholder"),
        F.col("value_display").alias("replacement"))
    period = metrics.where(F.coalesce("period_display", F.lit("")) != "").agg(
        F.min_by("period_display", "sort_order").alias("replacement"))
    period = period.where(F.col("replacement").isNotNull()).select(
        figures.placeholder(F.lit("period")).alias("placeholder"), "replacement")
    return shown.unionByName(period)


def company_size(tracking_b2b: DataFrame) -> DataFrame:
    """Companies and users per size range, smallest first."""
    return (tracking_b2b.groupBy("company_size_range", "companyId", "userId")
            .agg(F.min("number_of_user_bin").alias("bin"))
            .groupBy("company_size_range")
            .agg(F.min("bin").alias("bin_order"), F.count_distinct("companyId").alias("companies"),
                 F.count_distinct("userId").alias("users"))
            .orderBy("bin_order"))


def first_subscriptions(subs: DataFrame) -> DataFrame:
    return subs.groupBy("version", "userId").agg(F.min("date_id").alias("first_date"))


def new_users_weekly(subs: DataFrame) -> DataFrame:
    """New users per segment and Monday, with the running total.

    The running total is over one row per segment and week.
    """
    weeks = (first_subscriptions(subs)
             .groupBy(F.col("version").alias("segment"), calendar.monday(F.col("first_date")).alias("week_start"))
             .agg(F.count(F.lit(1)).alias("new_users")))
    running = W.partitionBy("segment").orderBy("week_start")
    return weeks.select(
        "segment", "week_start", calendar.iso_week_key(F.col("week_start")).alias("week_id"), "new_users",
        F.sum("new_users").over(running).alias("new_users_cumulative")).orderBy("segment", "week_start")
