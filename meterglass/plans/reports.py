"""Dashboard and report queries over the summary, tracking and behaviour tables.

All of them take ready frames: in production the stored tables, of which the
summaries hold days x packages rows.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from meterglass import domain
from meterglass.functions import calendar
from meterglass.functions.figures import direction, margin_percent, percent_change, safe_divide, share_percent, whole

KPI_SUMS = {"rev": "revenue_thb_est", "cost": "serving_cost_thb", "subs": "new_paid_subscriptions",
            "trials": "new_trial_subscriptions", "exp": "expirations", "tok": "tokens_used"}


def last_day(summary: DataFrame) -> Column:
    """Last day of the summary, as a scalar subquery."""
    return summary.select(F.max("date_id")).scalar()


def rolling(end: Column, days: int) -> dict[str, Column]:
    """The last ``days`` days and the ``days`` before them."""
    day = F.col("date_id")
    edge = F.date_sub(end, days)
    return {"cur": day > edge, "prev": (day > F.date_sub(end, 2 * days)) & (day <= edge)}


def active_users(tracking: DataFrame, end: Column, days: int) -> DataFrame:
    """One row: distinct users of both windows, counted after folding to one row per user."""
    flags = {n: F.max(F.when(c, 1).otherwise(0)).alias(n) for n, c in rolling(end, days).items()}
    users = tracking.where(F.col("userId").isNotNull()).groupBy("userId").agg(*flags.values())
    return users.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(f"{n}_users") for n in flags])


def kpi(summary: DataFrame, tracking: DataFrame, days: int = domain.ROLLING_DAYS,
        active: Callable[[DataFrame, Column, int], DataFrame] = active_users) -> DataFrame:
    """Current and previous window and all time, in one row.

    ``active``: counts the users of ``tracking``; ``user_bitmaps.active_users`` counts those of stored bitmaps.

    The summary is folded to one row per day first; its last day is then a maximum
    over those few rows. The finished row is one scalar subquery, which gives the
    user count its last day too, so neither input is computed twice.
    """
    by_day = (summary.groupBy("date_id").agg(*[F.sum(c).alias(k) for k, c in KPI_SUMS.items()])
              .withColumn("data_end", F.max("date_id").over(W.partitionBy(F.lit(0)))))
    windows = rolling(F.col("data_end"), days)
    sums = by_day.agg(
        F.max("date_id").alias("data_end"), F.min("date_id").alias("first_date"),
        *[F.sum(F.when(c, F.col(k))).cast(_kind(k)).alias(f"{n}_{k}") for n, c in windows.items() for k in KPI_SUMS],
        *[F.sum(k).cast(_kind(k)).alias(f"all_{k}") for k in ("rev", "cost", "subs")])
    row = sums.select(F.struct("*")).scalar()
    users = active(tracking, row.getField("data_end"), days)
    return users.select(row.alias("row"), "*").select("row.*", *users.columns)


def _kind(name: str) -> str:
    return domain.MONEY_SUM if name in ("rev", "cost") else "bigint"


def tiles(kpi_row: DataFrame) -> DataFrame:
    """Six tiles: label, figure, percent change, direction; margins on the profit tile."""
    def amount(name: str) -> tuple[Column, Column]:
        return tuple(F.coalesce(F.col(f"{w}_{name}").cast("double"), F.lit(0.0)) for w in ("cur", "prev"))

    revenue, cost = amount("rev"), amount("cost")
    profit = tuple(r - c for r, c in zip(revenue, cost))
    figure = {"revenue": revenue, "cost": cost, "profit": profit, "users": amount("users"),
              "subs": amount("subs"), "trials": amount("trials")}
    rows = F.array(*[
        F.struct(F.lit(n).cast("bigint").alias("tile"), F.lit(label).alias("label"),
                 figure[name][0].alias("value"),
                 F.round(percent_change(*figure[name]), 6).alias("change_pct"),
                 *[(F.round(margin_percent(profit[i], revenue[i]), 6) if name == "profit"
                    else F.lit(None).cast("double")).alias(w) for i, w in ((0, "margin_pct"), (1, "prev_margin_pct"))])
        for n, (label, name) in enumerate(domain.TILES, 1)])
    return kpi_row.select(F.inline(rows)).withColumn("direction", direction(F.col("change_pct")))


def weekly(summary: DataFrame, since: date = domain.WEEKLY_SINCE) -> DataFrame:
    """Money and purchases per Monday, with the gross profit."""
    weeks = summary.where(F.col("date_id") >= F.lit(since)).groupBy(week_text()).agg(
        whole(F.sum("revenue_thb_est")).alias("revenue"), whole(F.sum("serving_cost_thb")).alias("cost"),
        F.sum("new_paid_subscriptions").alias("paid_subs"), F.sum("new_trial_subscriptions").alias("trials"))
    return weeks.withColumn("profit", F.col("revenue") - F.col("cost")).orderBy("wk")


def week_text() -> Column:
    return F.date_format(calendar.monday(F.col("date_id")), "yyyy-MM-dd").alias("wk")


def weekly_users(tracking: DataFrame, since: date = domain.WEEKLY_SINCE) -> DataFrame:
    """Distinct users per Monday and segment; folded to (week, segment, user) first."""
    folded = tracking.where(F.col("date_id") >= F.lit(since)).select(week_text(), "version", "userId").distinct()
    return folded.groupBy("wk").agg(*[
        F.count(F.when(F.col("version") == v, F.col("userId"))).alias(f"{v.lower()}_users") for v in ("B2C", "B2B")
    ]).orderBy("wk")


def by_version(summary: DataFrame) -> DataFrame:
    return summary.groupBy("version").agg(
        whole(F.sum("revenue_thb_est")).alias("revenue"), whole(F.sum("serving_cost_thb")).alias("cost"),
        F.sum("new_paid_subscriptions").alias("paid_subs"),
        whole(F.sum("tokens_used") / F.lit(1e6)).alias("tokens_m")).orderBy("version")


def by_package(summary: DataFrame) -> DataFrame:
    """Non-trial packages with at least one purchase, highest revenue first."""
    return (summary.where(~F.col("is_trial")).groupBy("version", "packageName").agg(
        whole(F.sum("revenue_thb_est")).alias("revenue"), F.sum("new_paid_subscriptions").alias("subs"),
        whole(F.sum("serving_cost_thb")).alias("cost"))
        .where("subs > 0").orderBy(F.desc("revenue"), "version", "packageName"))


def top_models(models: DataFrame, k: int) -> DataFrame:
    """Most expensive models; equal costs are ordered by name."""
    return (models.groupBy("aiModel").agg(
        whole(F.sum("serving_cost_thb")).alias("cost"), whole(F.sum("tokens_used") / F.lit(1e6)).alias("tokens_m"))
        .orderBy(F.desc("cost"), "aiModel").limit(k))


def user_health(behavior: DataFrame) -> DataFrame:
    """Users and revenue by user type, largest group first."""
    total, n = F.sum("revenue_thb"), F.count(F.lit(1))
    return behavior.groupBy("user_type").agg(
        n.alias("users"), whole(total).alias("revenue"), whole(total / n).alias("avg_rev")
    ).orderBy(F.desc("users"), "user_type")


def repeat_figures(behavior: DataFrame) -> DataFrame:
    """Repeat, mature repeat and trial conversion shares, in one row."""
    paid, mature = F.col("paid_subscribe_cnt") >= 1, F.col("is_mature_cohort")
    tried, again = F.col("trial_cnt") > 0, F.col("is_repeat")
    n = F.count_if
    return behavior.agg(
        n(paid).alias("paid_users"), n(again).alias("repeat_users"),
        share_percent(n(again), n(paid)).alias("repeat_pct"),
        n(mature & paid).alias("mature_paid"), n(mature & again).alias("mature_repeat"),
        share_percent(n(mature & again), n(mature & paid)).alias("mature_repeat_pct"),
        n(F.col("churned") & paid).alias("churned"), n(tried).alias("trial_users"),
        share_percent(n(tried & paid), n(tried)).alias("trial_conv_pct"))


def scorecards(summary: DataFrame, tracking: DataFrame, days: int = domain.ROLLING_DAYS) -> DataFrame:
    """Six cards with their previous-period value and change."""
    row = kpi(summary, tracking, days)
    cards = ("users", "subs", "trials", "rev", "cost", "exp")
    pairs = ", ".join(f"'{c}', CAST(coalesce(cur_{c}, 0) AS DOUBLE), CAST(coalesce(prev_{c}, 0) AS DOUBLE)"
                      for c in cards)
    long = row.selectExpr(f"stack({len(cards)}, {pairs}) AS (card, value, previous)")
    return long.withColumn("change_pct", F.round(percent_change(F.col("value"), F.col("previous")), 6))


def daily_users(tracking: DataFrame) -> DataFrame:
    return tracking.groupBy("date_id").agg(F.count_distinct("userId").alias("users"))


def daily_money(summary: DataFrame) -> DataFrame:
    return summary.groupBy("date_id").agg(money_sum("revenue_thb_est"), money_sum("serving_cost_thb"))


def money_sum(name: str) -> Column:
    return F.sum(name).cast(domain.MONEY_SUM).alias(name)


def cost_by_version(summary: DataFrame) -> DataFrame:
    return summary.groupBy("version").agg(money_sum("serving_cost_thb"))


def revenue_by_package(summary: DataFrame) -> DataFrame:
    return summary.groupBy("packageName").agg(money_sum("revenue_thb_est"))


def repeat_rate(behavior: DataFrame) -> DataFrame:
    """Share of paying users who bought again: all users, and mature cohorts only."""
    def rate(rows: Column) -> Column:
        paid = F.count_if(rows & (F.col("paid_subscribe_cnt") >= 1))
        return safe_divide(F.count_if(rows & F.col("is_repeat")), paid)
    return behavior.agg(rate(F.lit(True)).alias("repeat_rate"),
                        rate(F.col("is_mature_cohort")).alias("mature_repeat_rate"))


def users_by(behavior: DataFrame, column: str) -> DataFrame:
    return behavior.groupBy(column).agg(F.count("userId").alias("users"))


def by_first_package(behavior: DataFrame) -> DataFrame:
    paid, again = F.count_if(F.col("paid_subscribe_cnt") >= 1), F.count_if(F.col("is_repeat"))
    return behavior.groupBy("first_paid_packageName").agg(
        F.count("userId").alias("users"), safe_divide(again, paid).alias("repeat_rate"),
        F.round(safe_divide(F.sum("revenue_thb"), F.count("revenue_thb")), 4).alias("avg_revenue_thb"))


def cost_by(events: DataFrame, column: str) -> DataFrame:
    """Cost of the raw events by one column (day, model, event type)."""
    return events.groupBy(column).agg(money_sum("totalCostThb"))


def top_users(events: DataFrame, k: int) -> DataFrame:
    """Users by cost; equal costs are ordered by user."""
    return cost_by(events, "userId").orderBy(F.desc("totalCostThb"), "userId").limit(k)
