"""Repeat-purchase behaviour, one row per user with at least one cycle."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterglass import domain
from meterglass.functions import calendar, figures
from meterglass.operators import dedup, splitting
from meterglass.plans.cycles import window_events
from meterglass.plans.summary import is_usage
from meterglass.sources import tables

COLUMNS = ("userId", "paid_subscribe_cnt", "trial_cnt", "user_type", "is_repeat", "first_paid_date",
           "last_paid_date", "is_mature_cohort", "avg_days_between_paid", "first_paid_packageId",
           "first_paid_packageName", "cycles_total", "cycles_completed", "paid_cycles_completed",
           "paid_cycles_exhausted", "ever_exhausted", "avg_utilization_paid", "avg_leftover_at_repurchase",
           "exhausted_repurchase_cnt", "exhausted_churn_cnt", "exhausted_wait_reset_cnt", "winback_cnt",
           "churned", "last_leftover_at_churn", "dominant_segment", "revenue_thb", "serving_cost_thb",
           "margin_thb", "tokens_used_total", "data_end")

EXACT = "decimal(38,12)"  # ratios are averaged exactly, so the order of rows cannot matter


def data_end(events: DataFrame) -> Column:
    """Last local day of the de-duplicated events, as a scalar subquery.

    The earliest copy of an event has its earliest day, so no ranking is needed.
    """
    first_days = events.groupBy("event_id").agg(F.min("date_id").alias("day"))
    return first_days.select(F.max("day")).scalar()


def purchases_and_use(events: DataFrame) -> DataFrame:
    """Per user: every paid subscription once, every trial once, one row of usage sums.

    One pass over the events: usage folds in the map tasks, subscriptions keep their
    instant, and the first row per subscription is picked afterwards.
    """
    bought, package = F.col("eventType") == domain.SUBSCRIBE, F.col("packageId")
    rows = events.withColumn(
        "kind", F.when(bought & package.isin(*domain.B2C_PAID_PACKAGES), "paid")
        .when(bought & (package == domain.TRIAL_PACKAGE), "trial").when(is_usage(), "use")
    ).where(F.col("kind").isNotNull())
    paid = F.col("kind") == "paid"
    folded = rows.groupBy(
        "userId", "kind", F.when(F.col("kind") != "use", F.col("subscriptionId")).alias("subscriptionId"),
        *[F.when(paid, F.col(c)).alias(c) for c in ("eventTimeStamp", "event_id", "packageId")],
    ).agg(F.sum("totalCostThb").alias("cost"), F.sum(F.abs("eggToken")).alias("tokens"))
    return dedup.first_by(folded, ["userId", "kind", "subscriptionId"], "eventTimeStamp", "event_id")


def user_purchases(events: DataFrame, cuts: DataFrame | None, packages: DataFrame) -> DataFrame:
    """Per user: subscriptions, gaps between them, list-price revenue, usage cost."""
    return summed_purchases(purchases_and_use(events), cuts, packages)


def summed_purchases(rows: DataFrame, cuts: DataFrame | None, packages: DataFrame) -> DataFrame:
    """The same from rows of ``purchases_and_use``."""
    paid = F.col("kind") == "paid"
    gaps = splitting.with_previous(rows.where(paid), cuts, "userId",
                                   ["eventTimeStamp", "event_id"], F.col("eventTimeStamp"), "prev_ts")
    rows = gaps.unionByName(rows.where(~paid), allowMissingColumns=True)
    prices = packages.groupBy("packageId").agg(F.sum("priceThb").alias("price"))
    ts, prev = F.col("eventTimeStamp"), F.col("prev_ts")
    return rows.join(prices, "packageId", "left").groupBy("userId").agg(
        F.count_if(paid).alias("paid_subscribe_cnt"),
        F.min(F.when(paid, ts)).alias("first_paid_ts"),
        F.max(F.when(paid, ts)).alias("last_paid_ts"),
        F.sum(F.when(paid, calendar.whole_hours(prev, ts))).alias("gap_hours"),
        F.count(F.when(paid, prev)).alias("gaps"),
        F.max(F.when(paid & prev.isNull(), F.col("packageId"))).alias("first_package"),
        F.sum(F.when(paid, F.col("price"))).alias("revenue"),
        F.count(F.when(F.col("kind") == "trial", F.col("subscriptionId"))).alias("trial_cnt"),
        F.sum(F.when(F.col("kind") == "use", F.col("cost"))).alias("cost"),
        F.sum(F.when(F.col("kind") == "use", F.col("tokens"))).alias("tokens"))


def mean_gap_days() -> Column:
    return figures.exact_mean(F.col("gap_hours"), 24 * F.col("gaps"), 1)


def cycle_rollup(cycles: DataFrame) -> DataFrame:
    """Per user: cycle counts, averages, last ending, win-backs and the commonest segment.

    Summed per (user, segment) first; the most frequent segment then needs no
    second pass. Cycle numbers give the order, so nothing is sorted per user.
    """
    rows = splitting.with_neighbour(cycles, "userId", "cycle_index", "end_type", "prev_end_type")
    done, paid = F.col("end_type") != "active", ~F.col("is_trial")
    expired = F.col("end_type") == "expired"
    counted = done & paid
    bought_again = paid & (F.col("end_type") == "repurchase")

    def n(condition: Column) -> Column:
        return F.count_if(condition)

    per_segment = rows.groupBy("userId", "segment").agg(
        F.count(F.lit(1)).alias("total"), n(done).alias("completed"), n(counted).alias("paid_completed"),
        n(counted & F.col("exhausted")).alias("paid_exhausted"), F.bool_or("exhausted").alias("exhausted"),
        F.sum(F.when(counted, F.col("utilization")).cast(EXACT)).alias("util"),
        F.count(F.when(counted, F.col("utilization"))).alias("util_n"),
        F.sum(F.when(bought_again, F.col("leftover_at_end"))).alias("left"),
        F.count(F.when(bought_again, F.col("leftover_at_end"))).alias("left_n"),
        n(paid).alias("paid"),
        n((F.col("start_type") == domain.SUBSCRIBE) & (F.col("prev_end_type") == "expired")).alias("winback"),
        F.max("cycle_index").alias("last_index"), F.max_by("end_type", "cycle_index").alias("last_end"),
        F.max(F.when(expired & F.col("leftover_at_end").isNotNull(), F.struct("cycle_index", "leftover_at_end")))
        .alias("churn_left"))
    segment, votes = F.col("segment"), F.col("paid_completed")
    votes = F.when((segment != "C9_unknown_quota") & (votes > 0), F.struct((-votes).alias("n"), segment.alias("s")))

    def paid_in(name: str) -> Column:
        return F.sum(F.when(segment == name, F.col("paid")).otherwise(0))

    def mean(top: str, bottom: str, places: int) -> Column:
        return figures.exact_mean(F.sum(top), F.sum(bottom), places)

    return per_segment.groupBy("userId").agg(
        F.sum("total").alias("cycles_total"), F.sum("completed").alias("cycles_completed"),
        F.sum("paid_completed").alias("paid_cycles_completed"),
        F.sum("paid_exhausted").alias("paid_cycles_exhausted"),
        F.coalesce(F.bool_or("exhausted"), F.lit(False)).alias("ever_exhausted"),
        mean("util", "util_n", 4).alias("avg_utilization_paid"),
        mean("left", "left_n", 0).alias("avg_leftover_at_repurchase"),
        paid_in("A1_exhausted_repurchase").alias("exhausted_repurchase_cnt"),
        paid_in("A2_exhausted_churn").alias("exhausted_churn_cnt"),
        paid_in("A3_exhausted_wait_reset").alias("exhausted_wait_reset_cnt"),
        F.sum("winback").alias("winback_cnt"),
        (F.max_by("last_end", "last_index") == "expired").alias("churned"),
        F.max("churn_left").getField("leftover_at_end").alias("last_leftover_at_churn"),
        F.min(votes).getField("s").alias("dominant_segment"))


def repeat_behavior(cycles: DataFrame, events: DataFrame, packages: DataFrame, users: DataFrame, *,
                    start_date: date, as_of: date, tz: str = domain.TIME_ZONE,
                    mature_days: int = domain.MATURE_DAYS,
                    rows_per_run: int = splitting.ROWS_PER_RUN) -> DataFrame:
    packages = tables.b2c_packages(packages, "packageName", "priceThb").distinct()
    events = window_events(events, start_date, as_of)
    purchases = events.where((F.col("eventType") == domain.SUBSCRIBE)
                             & F.col("packageId").isin(*domain.B2C_PAID_PACKAGES))
    cuts = splitting.long_keys(purchases, "userId", ("eventTimeStamp", "event_id"), rows_per_run)
    events = tables.without_banned(events, users)
    buyers = user_purchases(dedup.one_per_event(events), cuts, packages)
    return finished(cycles, buyers, packages, data_end(events), calendar.is_ntz(events, "eventTimeStamp"), tz, mature_days)


def finished(cycles: DataFrame, buyers: DataFrame, packages: DataFrame, end: Column, ntz: bool, tz: str, mature_days: int) -> DataFrame:
    """Users with a cycle, with their purchases. ``packages``: distinct (packageId, packageName, priceThb); ``end``: last day of the data."""
    names = packages.select(F.col("packageId").alias("first_paid_packageId"),
                            F.col("packageName").alias("first_paid_packageName"))

    def filled(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0))

    paid, trials = filled("paid_subscribe_cnt"), filled("trial_cnt")
    revenue, cost = filled("revenue").cast(domain.MONEY_SUM), filled("cost").cast(domain.MONEY_SUM)
    first_day = calendar.local_date(F.col("first_paid_ts"), tz, ntz=ntz)
    rows = (cycle_rollup(cycles).join(buyers, "userId", "left")
            .join(names, F.col("first_package") == F.col("first_paid_packageId"), "left")
            .withColumn("data_end", end))
    return rows.select(
        "*",
        F.when(paid >= 2, "repeat").when(paid == 1, "paid_once").when(trials >= 1, "trial_only")
        .otherwise("other").alias("user_type"),
        (paid >= 2).alias("is_repeat"),
        first_day.alias("first_paid_date"),
        calendar.local_date(F.col("last_paid_ts"), tz, ntz=ntz).alias("last_paid_date"),
        F.coalesce(first_day <= F.date_sub("data_end", mature_days), F.lit(False)).alias("is_mature_cohort"),
        mean_gap_days().alias("avg_days_between_paid"),
        revenue.alias("revenue_thb"), cost.alias("serving_cost_thb"),
        (revenue - cost).cast(domain.MONEY_SUM).alias("margin_thb"),
        filled("tokens").alias("tokens_used_total"),
    ).withColumns({"paid_subscribe_cnt": paid, "trial_cnt": trials}).select(*COLUMNS)
