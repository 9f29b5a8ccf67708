"""Summary fact, daily summary per package and daily summary per model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterglass import domain
from meterglass.functions.figures import model_label
from meterglass.operators import dedup
from meterglass.sources import tables

EVENT_COLUMNS = ("event_id", "date_id", "userId", "eventType", "subscriptionId", "eventTimeStamp",
                 "eggToken", "totalCostThb", "aiModel", "packageId")


def segment_packages(b2c_packages: DataFrame, b2b_packages: DataFrame) -> DataFrame:
    """Reported packages of both segments; a repeated number stays repeated."""
    columns = ("packageName", "priceThb")
    return (tables.b2c_packages(b2c_packages, *columns).withColumn("version", F.lit("B2C"))
            .unionByName(tables.b2b_packages(b2b_packages, *columns).withColumn("version", F.lit("B2B"))))


def segment_events(b2c_events: DataFrame, b2b_events: DataFrame, *columns: str) -> DataFrame:
    """Events of reported packages with a segment tag; bans are not applied yet."""
    columns = columns or EVENT_COLUMNS
    return (tables.b2c_events(b2c_events).select(F.lit("B2C").alias("version"), *columns)
            .unionByName(tables.b2b_events(b2b_events).select(F.lit("B2B").alias("version"), *columns)))


def without_banned_b2c(rows: DataFrame, b2c_users: DataFrame) -> DataFrame:
    banned = tables.banned_users(b2c_users).withColumn("version", F.lit("B2C"))
    return rows.join(banned, ["version", "userId"], "left_anti")


def company_members(b2b_users: DataFrame, team: DataFrame, company: DataFrame) -> DataFrame:
    """Users that reach a team and a company; missing keys drop out."""
    return (b2b_users.select("userId", "teamId", "teamName")
            .join(team.select("teamId", "companyId"), "teamId")
            .join(company.select("companyId", "companyName"), "companyId")
            .select("userId", "teamId", "teamName", "companyId", "companyName").distinct())


def mapped_users(b2b_users: DataFrame, team: DataFrame, company: DataFrame) -> DataFrame:
    """One row per user with a team and a company, tagged for a B2B-only join."""
    return (company_members(b2b_users, team, company).select("userId").distinct()
            .select(F.lit("B2B").alias("version"), "userId", F.lit(True).alias("is_mapped")))


def with_mapping_flag(rows: DataFrame, mapped: DataFrame) -> DataFrame:
    """``has_company_mapping``: always true for B2C, looked up for B2B only."""
    flagged = rows.join(mapped, ["version", "userId"], "left")
    flag = (F.col("version") == "B2C") | F.col("is_mapped").isNotNull()
    return flagged.withColumn("has_company_mapping", flag).drop("is_mapped")


def is_trial(name: Column) -> Column:
    return F.coalesce(name.startswith(domain.FREE_TRIAL_NAME), F.lit(False))


def is_usage(event_type: Column | str = "eventType") -> Column:
    """Settled and unsettled token use."""
    event_type = F.col(event_type) if isinstance(event_type, str) else event_type
    return event_type.startswith(domain.TOKEN_USED)


def summary_fact(b2c_events: DataFrame, b2b_events: DataFrame, b2c_packages: DataFrame,
                 b2b_packages: DataFrame, b2c_users: DataFrame, b2b_users: DataFrame,
                 team: DataFrame, company: DataFrame) -> DataFrame:
    """Event grain: filtered, lifecycle events once per subscription, named and priced."""
    events = without_banned_b2c(segment_events(b2c_events, b2b_events), b2c_users)
    fact = (dedup.collapse_lifecycle(events)
            .join(segment_packages(b2c_packages, b2b_packages), ["version", "packageId"], "left"))
    return (with_mapping_flag(fact, mapped_users(b2b_users, team, company))
            .withColumn("is_trial", is_trial(F.col("packageName")))
            .select("version", *EVENT_COLUMNS, "packageName", "priceThb", "is_trial", "has_company_mapping"))


MOMENT = ("eventTimeStamp", "event_id")
DAY_KEYS = ("date_id", "packageId", "userId")
MEASURES = ("usage_events", "tokens", "cost", "resets", "others")


def _usage_measures() -> list[Column]:
    return [F.count_if(is_usage()).alias("usage_events"),
            F.sum(F.when(is_usage(), F.abs("eggToken")).otherwise(0)).alias("tokens"),
            F.sum(F.when(is_usage(), F.col("totalCostThb")).otherwise(0)).cast(domain.MONEY_SUM).alias("cost"),
            F.count_if(F.col("eventType") == domain.MONTHLY_RESET).alias("resets"),
            F.count(F.lit(1)).alias("others")]


def _user_days(b2c_events: DataFrame, b2b_events: DataFrame, b2c_users: DataFrame) -> DataFrame:
    """Counts per (segment, day, package, user), from one read of the events.

    Events are summed to this grain first, so a heavy user shuffles a handful of
    rows per day, and the ban list and the mapping meet user-days, not events.
    Only lifecycle events keep their subscription and instant: they meet the ban list one
    by one, as a banned user's row must not win its subscription. The winner of a
    subscription is a minimum, so the group of missing subscription ids is folded in the map tasks.
    """
    plain = F.col("kind").isNull()
    # Plain rows are grouped by their own keys, lifecycle rows by their subscription.
    rows = without_banned_b2c(folded_events(b2c_events, b2b_events), b2c_users).groupBy(
        "version", "kind", "subscriptionId", *[F.when(plain, F.col(k)).alias(f"own_{k}") for k in DAY_KEYS]).agg(
        F.min(F.when(~plain, F.struct(*MOMENT, *DAY_KEYS))).alias("first"),
        *[F.sum(F.when(plain, F.col(m))).alias(m) for m in MEASURES])
    return rows.select(
        "version", *[F.when(plain, F.col(f"own_{k}")).otherwise(F.col(f"first.{k}")).alias(k) for k in DAY_KEYS], *MEASURES,
        F.when(~plain, (F.col("kind") == domain.SUBSCRIBE).cast("bigint")).alias("subs"),
        F.when(~plain, (F.col("kind") == domain.MAIN_EXPIRED).cast("bigint")).alias("expirations"))


def folded_events(b2c_events: DataFrame, b2b_events: DataFrame) -> DataFrame:
    """Plain rows (no ``kind``) summed per user and day, lifecycle rows per subscription and instant."""
    life = F.col("eventType").isin(*domain.LIFECYCLE)
    events = segment_events(b2c_events, b2b_events, "event_id", "date_id", "userId", "eventType",
                            "subscriptionId", "eventTimeStamp", "eggToken", "totalCostThb", "packageId")
    return (events.where(F.col("eventType").isNotNull())
            .groupBy("version", *DAY_KEYS, F.when(life, F.col("eventType")).alias("kind"),
                     *[F.when(life, F.col(c)).alias(c) for c in ("subscriptionId", *MOMENT)])
            .agg(*_usage_measures()))


def summary_daily(b2c_events: DataFrame, b2b_events: DataFrame, b2c_packages: DataFrame,
                  b2b_packages: DataFrame, b2c_users: DataFrame, b2b_users: DataFrame,
                  team: DataFrame, company: DataFrame) -> DataFrame:
    """Daily measures per segment, package and mapping flag.

    ``daily_active_users`` counts one day only and must not be added over days.
    """
    days = with_mapping_flag(_user_days(b2c_events, b2b_events, b2c_users),
                             mapped_users(b2b_users, team, company))
    return priced_daily(daily_counts(days), segment_packages(b2c_packages, b2b_packages))


def daily_counts(days: DataFrame) -> DataFrame:
    """User-days and first lifecycle rows per segment, day, package and mapping flag."""
    def total(name: str) -> Column:
        return F.sum(F.coalesce(F.col(name), F.lit(0)))

    return days.groupBy("version", "date_id", "packageId", "has_company_mapping").agg(
        F.count_distinct(F.when(F.col("usage_events") > 0, F.col("userId"))).alias("active"),
        *[total(n).alias(n) for n in ("usage_events", "cost", "resets", "others", "subs", "expirations")],
        F.sum("tokens").alias("tokens"))


def priced_daily(daily: DataFrame, packages: DataFrame) -> DataFrame:
    """The daily summary of such counts, by today's names and prices."""
    # From here on the rows are days x packages; a package number listed twice repeats its rows.
    priced = (daily.join(packages, ["version", "packageId"], "left")
              .withColumn("is_trial", is_trial(F.col("packageName"))))
    subs, paid = F.col("subs"), ~F.col("is_trial")
    # Rows that are not paid subscriptions add zero, unpriced ones add nothing at all.
    # Nine places of the price survive the product, as 18 + 18 digits fit a decimal.
    price = subs.cast("decimal(18,0)") * F.col("priceThb").cast("decimal(18,9)")
    revenue = (F.when(paid & (subs > 0) & F.col("priceThb").isNotNull(), price)
               .when(F.col("is_trial") | (F.col("others") + F.col("expirations") > 0), 0))
    tokens = F.when(F.col("tokens").isNull() & (subs + F.col("expirations") > 0), 0).otherwise(F.col("tokens"))
    return priced.groupBy("version", "date_id", "packageId", "packageName", "is_trial", "has_company_mapping").agg(
        F.max("active").alias("daily_active_users"),
        F.sum("usage_events").alias("usage_events"),
        F.sum(tokens).alias("tokens_used"),
        F.sum("cost").cast(domain.MONEY_SUM).alias("serving_cost_thb"),
        F.sum(subs).alias("new_subscriptions"),
        F.sum(F.when(paid, subs).otherwise(0)).alias("new_paid_subscriptions"),
        F.sum(F.when(paid, 0).otherwise(subs)).alias("new_trial_subscriptions"),
        F.sum("expirations").alias("expirations"),
        F.sum("resets").alias("monthly_resets"),
        F.sum(revenue).cast(domain.MONEY_SUM).alias("revenue_thb_est"))


def summary_model_daily(b2c_events: DataFrame, b2b_events: DataFrame, b2c_packages: DataFrame,
                        b2b_packages: DataFrame, b2c_users: DataFrame, b2b_users: DataFrame,
                        team: DataFrame, company: DataFrame) -> DataFrame:
    """Daily usage per segment, model and mapping flag."""
    days = with_mapping_flag(without_banned_b2c(model_user_days(b2c_events, b2b_events), b2c_users),
                             mapped_users(b2b_users, team, company))
    days = days.join(_listed(segment_packages(b2c_packages, b2b_packages)), ["version", "packageId"], "left")
    times = F.coalesce(F.col("times"), F.lit(1))
    return (days.groupBy("version", "date_id", model_label(F.col("aiModel")).alias("aiModel"), "has_company_mapping")
            .agg(F.count_distinct("userId").alias("daily_active_users"),
                 F.sum(F.col("n") * times).alias("usage_events"),
                 F.sum(F.col("tokens") * times).alias("tokens_used"),
                 F.sum(F.col("cost") * times).cast(domain.MONEY_SUM).alias("serving_cost_thb")))


def model_user_days(b2c_events: DataFrame, b2b_events: DataFrame) -> DataFrame:
    """Usage per (segment, day, model, package, user)."""
    events = segment_events(b2c_events, b2b_events,
                            "date_id", "userId", "eventType", "aiModel", "eggToken", "totalCostThb", "packageId")
    return (events.where(is_usage()).groupBy("version", "date_id", "aiModel", "packageId", "userId")
            .agg(F.count(F.lit(1)).alias("n"), F.sum(F.abs("eggToken")).alias("tokens"),
                 F.sum("totalCostThb").cast("decimal(28,6)").alias("cost")))


def _listed(packages: DataFrame) -> DataFrame:
    """A package number listed twice counts its usage twice."""
    return packages.groupBy("version", "packageId").agg(F.count(F.lit(1)).alias("times"))


def model_counts(days: DataFrame) -> DataFrame:
    """Model user-days per segment, day, model and mapping flag: once with users (no ``times``), and once per package without.

    A user of several packages counts once in the first kind of row.
    """
    label = model_label(F.col("aiModel")).alias("aiModel")
    keys = ("version", "date_id", label, "has_company_mapping")
    users = days.groupBy(*keys).agg(F.count_distinct("userId").alias("users"))
    sums = days.groupBy(*keys, "packageId").agg(*[F.sum(n).cast(kind).alias(n) for n, kind in (
        ("n", "bigint"), ("tokens", "bigint"), ("cost", domain.MONEY_SUM))])
    return sums.unionByName(users, allowMissingColumns=True)


def model_daily(counts: DataFrame, packages: DataFrame) -> DataFrame:
    """The model summary of such counts, by today's packages."""
    rows = counts.join(_listed(packages), ["version", "packageId"], "left")
    times = F.coalesce(F.col("times"), F.lit(1))
    return rows.groupBy("version", "date_id", "aiModel", "has_company_mapping").agg(
        F.max("users").alias("daily_active_users"), F.sum(F.col("n") * times).alias("usage_events"),
        F.sum(F.col("tokens") * times).alias("tokens_used"),
        F.sum(F.col("cost") * times).cast(domain.MONEY_SUM).alias("serving_cost_thb"))


def reconciled(summary: DataFrame) -> DataFrame:
    """Only rows whose B2B users also appear in user tracking."""
    return summary.where("has_company_mapping")
