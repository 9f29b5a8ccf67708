"""Summary products and the operators inside them."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from meterglass import domain
from meterglass.plans import summary, summary_state
from meterglass.registry.common import on_sample, register
from meterglass.registry.sql import query
from meterglass.session import scratch_path
from meterglass.sources import lake, sample

# Lifecycle rows once per (segment, type, subscription): found by comparing with the group's minimum.
FACT = """
life AS (
  SELECT *, min(("eventTimeStamp", event_id)) OVER (PARTITION BY seg, "eventType", "subscriptionId") AS lead_row
  FROM live WHERE "eventType" IN ('Subscribe', 'MainExpired')
),
kept AS (
  SELECT * EXCLUDE (lead_row) FROM life WHERE ("eventTimeStamp", event_id) = lead_row
  UNION ALL
  SELECT * FROM live WHERE "eventType" NOT IN ('Subscribe', 'MainExpired')
),
fact AS (
  SELECT s.*, p.name, p.price, coalesce(starts_with(p.name, 'Free Trial'), FALSE) AS trial,
         s.seg = 'B2C' OR s."userId" IN (SELECT "userId" FROM member) AS mapped
  FROM kept s LEFT JOIN pkg p ON p.seg = s.seg AND p.pid = s.pid
)
"""

DAILY = """
daily AS (
  SELECT seg AS version, date_id, pid AS "packageId", name AS "packageName", trial AS is_trial,
    mapped AS has_company_mapping,
    count(DISTINCT "userId") FILTER (WHERE "eventType" LIKE 'Token Used%') AS daily_active_users,
    count(*) FILTER (WHERE "eventType" LIKE 'Token Used%') AS usage_events,
    CAST(coalesce(sum(abs("eggToken")) FILTER (WHERE "eventType" LIKE 'Token Used%'), 0) AS BIGINT) AS tokens_used,
    CAST(coalesce(sum("totalCostThb") FILTER (WHERE "eventType" LIKE 'Token Used%'), 0) AS DECIMAL(38,6))
      AS serving_cost_thb,
    count(*) FILTER (WHERE "eventType" = 'Subscribe') AS new_subscriptions,
    count(*) FILTER (WHERE "eventType" = 'Subscribe' AND NOT trial) AS new_paid_subscriptions,
    count(*) FILTER (WHERE "eventType" = 'Subscribe' AND trial) AS new_trial_subscriptions,
    count(*) FILTER (WHERE "eventType" = 'MainExpired') AS expirations,
    count(*) FILTER (WHERE "eventType" = 'MonthlyReset') AS monthly_resets,
    CAST(sum(CASE WHEN "eventType" = 'Subscribe' AND NOT trial THEN price ELSE 0 END) AS DECIMAL(38,6))
      AS revenue_thb_est
  FROM fact GROUP BY ALL
)
"""

MODEL = """
model_daily AS (
  SELECT seg AS version, date_id, coalesce("aiModel", '(ไม่ระบุ)') AS "aiModel", mapped AS has_company_mapping,
    count(DISTINCT "userId") AS daily_active_users, count(*) AS usage_events,
    CAST(sum(abs("eggToken")) AS BIGINT) AS tokens_used,
    CAST(sum("totalCostThb") AS DECIMAL(38,6)) AS serving_cost_thb
  FROM fact WHERE "eventType" LIKE 'Token Used%' GROUP BY ALL
)
"""

FACT_DAILY = (FACT, DAILY)


def args(s):
    return (s.b2c_events, s.b2b_events, s.b2c_packages, s.b2b_packages, s.b2c_users, s.b2b_users, s.team, s.company)


@on_sample("summary_fact", query("""
  SELECT seg AS version, event_id, date_id, "userId", "eventType", "subscriptionId", "eventTimeStamp", "eggToken",
         "totalCostThb", "aiModel", pid AS "packageId", name AS "packageName", price AS "priceThb",
         trial AS is_trial, mapped AS has_company_mapping FROM fact""", FACT))
def _(s):
    return summary.summary_fact(*args(s))


@on_sample("summary_daily", query("SELECT * FROM daily", FACT, DAILY))
def _(s):
    return summary.summary_daily(*args(s))


@on_sample("summary_model_daily", query("SELECT * FROM model_daily", FACT, MODEL))
def _(s):
    return summary.summary_model_daily(*args(s))


@on_sample("report_b2b_reconcile", query(
    "SELECT * FROM daily WHERE version = 'B2B' AND has_company_mapping", FACT, DAILY))
def _(s):
    return summary.reconciled(summary.summary_daily(*args(s))).where("version = 'B2B'")


def _kept_by_day(spark, sf_dir) -> tuple[str, sample.Sample]:
    """Three runs: a first fill without some first subscriptions of January 5th, a run on new days, and one on that day, now whole."""
    s, path = sample.load(spark, sf_dir), scratch_path(spark, "summary-state")
    late = (F.col("date_id") == F.lit(date(2024, 1, 5))) & F.col("eventType").isin(*domain.LIFECYCLE)
    found = s.b2c_events.unionByName(s.b2b_events).agg(F.min("date_id"), F.max("date_id")).first()
    every = lake.days_of((found[0], found[1]))
    edge = date(2024, 1, 20)
    for keep, changed in ((~late & (F.col("date_id") < F.lit(edge)), [d for d in every if d < edge]), (~late, [d for d in every if d >= edge]),
                          (F.lit(True), [date(2024, 1, 5)])):
        summary_state.update(s.b2c_events.where(keep), s.b2b_events.where(keep), s.b2c_users, s.b2b_users, s.team, s.company, path, changed=changed)
    return path, s


@register("stored_summary_daily", query("SELECT * FROM daily", FACT, DAILY))
def _(spark, sf_dir):
    path, s = _kept_by_day(spark, sf_dir)
    return summary_state.summary_daily(spark, path, s.b2c_packages, s.b2b_packages)


@register("stored_summary_model_daily", query("SELECT * FROM model_daily", FACT, MODEL))
def _(spark, sf_dir):
    path, s = _kept_by_day(spark, sf_dir)
    return summary_state.summary_model_daily(spark, path, s.b2c_packages, s.b2b_packages)
