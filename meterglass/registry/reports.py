"""Dashboard and report queries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterglass.plans import reports, summary, user_bitmaps
from meterglass.registry import behavior as behaviour
from meterglass.registry import summary as facts
from meterglass.registry import tracking
from meterglass.registry.common import on_sample
from meterglass.registry.sql import query
from meterglass.session import scratch_path
from meterglass.sources import tables
from meterglass.sources.sample import ROLLING_DAYS, WEEKLY_SINCE

DAYS = (facts.FACT, facts.DAILY)
MODELS = (facts.FACT, facts.MODEL)
USERS = (tracking.B2C, tracking.B2B, tracking.TOTAL)
BEHAVIOR = (behaviour.CYCLES, behaviour.BEHAVIOR)
SINCE = f"date_id >= DATE '{WEEKLY_SINCE}'"


def daily(s):
    return summary.summary_daily(*facts.args(s))


def models(s):
    return summary.summary_model_daily(*facts.args(s))


def _period(name: str, kind: str, source: str) -> str:
    return f"""CAST(sum({source}) FILTER (WHERE date_id > mx - {ROLLING_DAYS}) AS {kind}) AS cur_{name},
    CAST(sum({source}) FILTER (WHERE date_id > mx - {2 * ROLLING_DAYS} AND date_id <= mx - {ROLLING_DAYS}) AS {kind})
      AS prev_{name}"""


MONEY = "DECIMAL(38,6)"
KPI = f"""
kpi AS (
  SELECT max(date_id) AS data_end, min(date_id) AS first_date,
    {_period('rev', MONEY, 'revenue_thb_est')}, {_period('cost', MONEY, 'serving_cost_thb')},
    {_period('subs', 'BIGINT', 'new_paid_subscriptions')}, {_period('trials', 'BIGINT', 'new_trial_subscriptions')},
    {_period('exp', 'BIGINT', 'expirations')}, {_period('tok', 'BIGINT', 'tokens_used')},
    CAST(sum(revenue_thb_est) AS {MONEY}) AS all_rev, CAST(sum(serving_cost_thb) AS {MONEY}) AS all_cost,
    CAST(sum(new_paid_subscriptions) AS BIGINT) AS all_subs,
    (SELECT count(DISTINCT "userId") FROM tracking_total
     WHERE date_id > (SELECT max(date_id) FROM daily) - {ROLLING_DAYS}) AS cur_users,
    (SELECT count(DISTINCT "userId") FROM tracking_total
     WHERE date_id > (SELECT max(date_id) FROM daily) - {2 * ROLLING_DAYS}
       AND date_id <= (SELECT max(date_id) FROM daily) - {ROLLING_DAYS}) AS prev_users
  FROM daily, (SELECT max(date_id) AS mx FROM daily)
),
pair(card, value, previous) AS (
  SELECT 'users', cur_users::DOUBLE, prev_users::DOUBLE FROM kpi
  UNION ALL SELECT 'subs', cur_subs::DOUBLE, prev_subs::DOUBLE FROM kpi
  UNION ALL SELECT 'trials', cur_trials::DOUBLE, prev_trials::DOUBLE FROM kpi
  UNION ALL SELECT 'rev', cur_rev::DOUBLE, prev_rev::DOUBLE FROM kpi
  UNION ALL SELECT 'cost', cur_cost::DOUBLE, prev_cost::DOUBLE FROM kpi
  UNION ALL SELECT 'exp', cur_exp::DOUBLE, prev_exp::DOUBLE FROM kpi
  UNION ALL SELECT 'profit', cur_rev::DOUBLE - cur_cost::DOUBLE, prev_rev::DOUBLE - prev_cost::DOUBLE FROM kpi
),
change AS (
  SELECT *, round(CASE WHEN previous <> 0 THEN (value - previous) / previous * 100 ELSE 0 END, 6) AS change_pct
  FROM pair
)
"""

on_sample("dash_kpi", query("SELECT * FROM kpi", *DAYS, *USERS, KPI))(
    lambda s: reports.kpi(daily(s), tracking.total(s), ROLLING_DAYS))
on_sample("dash_tiles", query("""
  SELECT CAST(n AS BIGINT) AS tile, label, value, change_pct,
    CASE WHEN card = 'profit' THEN (SELECT round(CASE WHEN cur_rev <> 0
      THEN (cur_rev::DOUBLE - cur_cost::DOUBLE) / cur_rev::DOUBLE * 100 ELSE 0 END, 6) FROM kpi) END AS margin_pct,
    CASE WHEN card = 'profit' THEN (SELECT round(CASE WHEN prev_rev <> 0
      THEN (prev_rev::DOUBLE - prev_cost::DOUBLE) / prev_rev::DOUBLE * 100 ELSE 0 END, 6) FROM kpi) END
      AS prev_margin_pct,
    CASE WHEN change_pct > 0.05 THEN '▲' WHEN change_pct < -0.05 THEN '▼' ELSE '—' END AS direction
  FROM change JOIN (VALUES (1, 'รายได้ (ประมาณการ)', 'rev'), (2, 'ต้นทุน AI', 'cost'), (3, 'กำไรขั้นต้น', 'profit'),
    (4, 'ผู้ใช้ที่ใช้งานจริง', 'users'), (5, 'สมัครใหม่ (จ่ายเงิน)', 'subs'), (6, 'เริ่มทดลองใช้ฟรี', 'trials'))
    t(n, label, c) ON c = card""", *DAYS, *USERS, KPI))(
    lambda s: reports.tiles(reports.kpi(daily(s), tracking.total(s), ROLLING_DAYS)))
on_sample("report_scorecards", query("SELECT * FROM change WHERE card <> 'profit'", *DAYS, *USERS, KPI))(
    lambda s: reports.scorecards(daily(s), tracking.total(s), ROLLING_DAYS))

WEEK = "strftime(date_trunc('week', date_id), '%Y-%m-%d') AS wk"
ROUNDED = "CAST(round(sum({0}), 0) AS BIGINT)"
on_sample("dash_weekly", query(f"""
  SELECT *, revenue - cost AS profit FROM (
    SELECT {WEEK}, {ROUNDED.format('revenue_thb_est')} AS revenue, {ROUNDED.format('serving_cost_thb')} AS cost,
      CAST(sum(new_paid_subscriptions) AS BIGINT) AS paid_subs,
      CAST(sum(new_trial_subscriptions) AS BIGINT) AS trials
    FROM daily WHERE {SINCE} GROUP BY ALL)""", *DAYS))(lambda s: reports.weekly(daily(s), WEEKLY_SINCE))
on_sample("dash_weekly_users", query(f"""
  SELECT {WEEK}, count(DISTINCT "userId") FILTER (WHERE version = 'B2C') AS b2c_users,
    count(DISTINCT "userId") FILTER (WHERE version = 'B2B') AS b2b_users
  FROM tracking_total WHERE {SINCE} GROUP BY ALL""", *USERS))(
    lambda s: reports.weekly_users(tracking.total(s), WEEKLY_SINCE))
on_sample("dash_version", query(f"""
  SELECT version, {ROUNDED.format('revenue_thb_est')} AS revenue, {ROUNDED.format('serving_cost_thb')} AS cost,
    CAST(sum(new_paid_subscriptions) AS BIGINT) AS paid_subs,
    CAST(round(CAST(sum(tokens_used) AS DOUBLE) / 1e6) AS BIGINT) AS tokens_m
  FROM daily GROUP BY ALL""", *DAYS))(lambda s: reports.by_version(daily(s)))
on_sample("dash_package", query(f"""
  SELECT version, "packageName", {ROUNDED.format('revenue_thb_est')} AS revenue,
    CAST(sum(new_paid_subscriptions) AS BIGINT) AS subs, {ROUNDED.format('serving_cost_thb')} AS cost
  FROM daily WHERE NOT is_trial GROUP BY ALL HAVING sum(new_paid_subscriptions) > 0""", *DAYS))(
    lambda s: reports.by_package(daily(s)))

TOP = f"""
  SELECT "aiModel", {ROUNDED.format('serving_cost_thb')} AS cost,
    CAST(round(CAST(sum(tokens_used) AS DOUBLE) / 1e6) AS BIGINT) AS tokens_m
  FROM model_daily GROUP BY "aiModel" ORDER BY cost DESC, "aiModel" LIMIT """
on_sample("dash_model", query(TOP + "8", *MODELS))(lambda s: reports.top_models(models(s), 8))
on_sample("report_top_models", query(TOP + "10", *MODELS))(lambda s: reports.top_models(models(s), 10))
on_sample("dash_health", query(f"""
  SELECT user_type, count(*) AS users, {ROUNDED.format('revenue_thb')} AS revenue,
    CAST(round(sum(revenue_thb)::DOUBLE / count(*)) AS BIGINT) AS avg_rev FROM behavior GROUP BY ALL""", *BEHAVIOR))(
    lambda s: reports.user_health(behaviour.repeat_behavior(s)))
on_sample("dash_repeat", query("""
  SELECT *, round(100::DOUBLE * (repeat_users::DOUBLE / nullif(paid_users, 0)), 2) AS repeat_pct,
    round(100::DOUBLE * (mature_repeat::DOUBLE / nullif(mature_paid, 0)), 2) AS mature_repeat_pct,
    round(100::DOUBLE * (converted::DOUBLE / nullif(trial_users, 0)), 2) AS trial_conv_pct
  FROM (SELECT count(*) FILTER (WHERE paid_subscribe_cnt >= 1) AS paid_users,
      count(*) FILTER (WHERE is_repeat) AS repeat_users,
      count(*) FILTER (WHERE is_mature_cohort AND paid_subscribe_cnt >= 1) AS mature_paid,
      count(*) FILTER (WHERE is_mature_cohort AND is_repeat) AS mature_repeat,
      count(*) FILTER (WHERE churned AND paid_subscribe_cnt >= 1) AS churned,
      count(*) FILTER (WHERE trial_cnt > 0) AS trial_users,
      count(*) FILTER (WHERE trial_cnt > 0 AND paid_subscribe_cnt >= 1) AS converted FROM behavior)
  """.replace("SELECT *,", "SELECT * EXCLUDE (converted),"), *BEHAVIOR))(
    lambda s: reports.repeat_figures(behaviour.repeat_behavior(s)))

on_sample("report_daily_users", query(
    'SELECT date_id, count(DISTINCT "userId") AS users FROM tracking_total GROUP BY ALL', *USERS))(
    lambda s: reports.daily_users(tracking.total(s)))
SUM = "CAST(sum({0}) AS DECIMAL(38,6)) AS {0}"
on_sample("report_daily_money", query(
    f"SELECT date_id, {SUM.format('revenue_thb_est')}, {SUM.format('serving_cost_thb')} FROM daily GROUP BY ALL",
    *DAYS))(lambda s: reports.daily_money(daily(s)))
on_sample("report_cost_by_version", query(
    f"SELECT version, {SUM.format('serving_cost_thb')} FROM daily GROUP BY ALL", *DAYS))(
    lambda s: reports.cost_by_version(daily(s)))
on_sample("report_revenue_by_package", query(
    f'SELECT "packageName", {SUM.format("revenue_thb_est")} FROM daily GROUP BY ALL', *DAYS))(
    lambda s: reports.revenue_by_package(daily(s)))

RATE = """count(*) FILTER (WHERE is_repeat{0})::DOUBLE
    / nullif(count(*) FILTER (WHERE paid_subscribe_cnt >= 1{0}), 0)"""
on_sample("report_repeat_rate", query(f"""
  SELECT {RATE.format('')} AS repeat_rate, {RATE.format(' AND is_mature_cohort')} AS mature_repeat_rate
  FROM behavior""", *BEHAVIOR))(lambda s: reports.repeat_rate(behaviour.repeat_behavior(s)))
for _name, _column in (("report_user_types", "user_type"), ("report_segments", "dominant_segment")):
    on_sample(_name, query(f"SELECT {_column}, count(*) AS users FROM behavior GROUP BY ALL", *BEHAVIOR))(
        lambda s, column=_column: reports.users_by(behaviour.repeat_behavior(s), column))
on_sample("report_first_package", query(f"""
  SELECT "first_paid_packageName", count(*) AS users, {RATE.format('')} AS repeat_rate,
    round(sum(revenue_thb)::DOUBLE / count(revenue_thb), 4) AS avg_revenue_thb FROM behavior GROUP BY ALL""",
    *BEHAVIOR))(lambda s: reports.by_first_package(behaviour.repeat_behavior(s)))

COST = 'CAST(sum("totalCostThb") AS DECIMAL(38,6)) AS "totalCostThb"'


def both(s):
    return s.b2c_events.unionByName(s.b2b_events)


for _name, _column in (("chart_daily_cost", "date_id"), ("chart_cost_by_model", "aiModel"),
                       ("chart_cost_by_event_type", "eventType")):
    on_sample(_name, query(f'SELECT "{_column}", {COST} FROM dom GROUP BY ALL'))(
        lambda s, column=_column: reports.cost_by(both(s), column))
on_sample("chart_top_users", query(
    f'SELECT "userId", {COST} FROM dom GROUP BY ALL ORDER BY 2 DESC, 1 LIMIT 10'))(
    lambda s: reports.top_users(both(s), 10))


def kept_bitmaps(s) -> DataFrame:
    """Stored bitmaps of the tracked users, made in two runs: January 18th comes again, whole, in the second one."""
    rows = tracking.total(s).select("version", "date_id", "userId")
    path, spark = scratch_path(rows.sparkSession, "bitmaps"), rows.sparkSession
    rows.write.partitionBy("date_id").parquet(f"{path}-rows")
    rows = spark.read.schema(rows.schema).parquet(f"{path}-rows")
    every = sorted(r[0] for r in rows.select("date_id").distinct().collect())
    edge = date(2024, 1, 18)
    banned = tables.banned_users(s.b2c_users)
    user_bitmaps.update(rows.where((F.col("date_id") < F.lit(edge)) | (F.col("userId") < "u-3")), banned, path, changed=[d for d in every if d <= edge])
    user_bitmaps.update(rows, banned, path, changed=[d for d in every if d >= edge])
    return user_bitmaps.read(spark, path)


on_sample("bitmap_dash_kpi", query("SELECT * FROM kpi", *DAYS, *USERS, KPI))(
    lambda s: reports.kpi(daily(s), kept_bitmaps(s), ROLLING_DAYS, user_bitmaps.active_users))
on_sample("bitmap_weekly_users", query(f"""
  SELECT {WEEK}, count(DISTINCT "userId") FILTER (WHERE version = 'B2C') AS b2c_users,
    count(DISTINCT "userId") FILTER (WHERE version = 'B2B') AS b2b_users
  FROM tracking_total WHERE {SINCE} GROUP BY ALL""", *USERS))(
    lambda s: user_bitmaps.weekly_users(kept_bitmaps(s), WEEKLY_SINCE))
on_sample("bitmap_users_between", query("""
  SELECT version, count(DISTINCT "userId") AS users FROM tracking_total
  WHERE date_id BETWEEN DATE '2024-01-09' AND DATE '2024-01-21' GROUP BY ALL""", *USERS))(
    lambda s: user_bitmaps.users_between(kept_bitmaps(s), date(2024, 1, 9), date(2024, 1, 21)))
