"""Filters, joins, aggregations, sorts and set operations, one query each."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterglass import domain
from meterglass.functions import calendar, figures
from meterglass.operators import dedup, splitting
from meterglass.plans import behavior, cycles, deck, reports, summary, tracking
from meterglass.registry import behavior as behaviour
from meterglass.registry import deck as decks
from meterglass.registry import reports as reported
from meterglass.registry import summary as facts
from meterglass.registry import tracking as tracked
from meterglass.registry.common import on_sample, register
from meterglass.registry.ingest import both
from meterglass.registry.sql import WINDOWED, query
from meterglass.sources import sample, tables

KEY = ("event_id", "userId", "eventType")
KEY_SQL = 'event_id, "userId", "eventType"'


def windowed(frame):
    return frame.where(tables.in_window(sample.START_DATE, sample.AS_OF))


def b2c_live(s):
    """Windowed B2C events of listed packages and users that are not banned."""
    return tables.without_banned(cycles.window_events(s.b2c_events, sample.START_DATE, sample.AS_OF), s.b2c_users)


def b2c_listed(s):
    return tables.b2c_packages(s.b2c_packages, "packageName").distinct()


def priced(s):
    return tables.b2c_packages(s.b2c_packages, "packageName", "priceThb").distinct()


# ----------------------------------------------------------------- filters
on_sample("filter_date_window", query(f"SELECT {KEY_SQL}, date_id FROM dom WHERE {WINDOWED}"))(
    lambda s: windowed(both(s)).select(*KEY, "date_id"))
on_sample("filter_package_allow", query(f"""
  SELECT {KEY_SQL}, pid AS "packageId" FROM dom WHERE seg = 'B2C' AND pid IN (1, 2, 3, 12)"""))(
    lambda s: tables.b2c_events(s.b2c_events).select(*KEY, "packageId"))
on_sample("filter_package_deny", query(f"""
  SELECT {KEY_SQL}, pid AS "packageId" FROM dom WHERE pid NOT IN (5, 7, 10, 97, 98)"""))(
    lambda s: tables.b2b_events(both(s)).select(*KEY, "packageId"))
on_sample("filter_banned", query('SELECT DISTINCT "userId" FROM b2c_user WHERE "isBanned"'))(
    lambda s: tables.banned_users(s.b2c_users))
on_sample("filter_event_type", query(f"SELECT {KEY_SQL} FROM dom WHERE \"eventType\" = 'Subscribe'"))(
    lambda s: both(s).where(F.col("eventType") == domain.SUBSCRIBE).select(*KEY))
on_sample("filter_usage_like", query(f"SELECT {KEY_SQL} FROM dom WHERE \"eventType\" LIKE 'Token Used%'"))(
    lambda s: both(s).where(summary.is_usage()).select(*KEY))
on_sample("flag_trial_like", query("""
  SELECT e.event_id, coalesce(p.name LIKE 'Free Trial%', FALSE) AS is_trial
  FROM dom e LEFT JOIN pkg p ON p.seg = e.seg AND p.pid = e.pid"""))(
    lambda s: summary.segment_events(s.b2c_events, s.b2b_events, "event_id", "packageId").join(
        summary.segment_packages(s.b2c_packages, s.b2b_packages), ["version", "packageId"], "left")
    .select("event_id", summary.is_trial(F.col("packageName")).alias("is_trial"))
    .unionByName(_unlisted(s)))


def _unlisted(s):
    """Events of packages no report lists: never a trial."""
    number = tables.with_package_number
    b2c = number(s.b2c_events).where(~F.coalesce(tables.allowed(domain.B2C_PACKAGES), F.lit(False)))
    b2b = number(s.b2b_events).where(~F.coalesce(tables.not_denied(domain.B2B_EXCLUDED_PACKAGES), F.lit(False)))
    return b2c.unionByName(b2b).select("event_id", F.lit(False).alias("is_trial"))


on_sample("filter_lifecycle_in", query(f"""
  SELECT {KEY_SQL}, "eventType" IN ('Subscribe', 'MainExpired') AS lifecycle FROM dom
  WHERE "eventType" IN ('Subscribe', 'MonthlyReset', 'MainExpired')"""))(
    lambda s: both(s).where(F.col("eventType").isin(*domain.BOUNDARIES))
    .select(*KEY, F.col("eventType").isin(*domain.LIFECYCLE).alias("lifecycle")))
on_sample("qualify_first", query("""
  SELECT "userId", min(("eventTimeStamp", event_id))[2] AS event_id FROM dom GROUP BY "userId" """))(
    lambda s: dedup.first_by(both(s), ["userId"], "eventTimeStamp", "event_id").select("userId", "event_id"))
on_sample("having_countif", query('SELECT "userId" FROM conv', decks.SUBS))(
    lambda s: deck.converted_users(decks.subs(s)).select("userId"))
on_sample("having_alias", query("""
  SELECT "packageName", CAST(sum(new_paid_subscriptions) AS BIGINT) AS subs FROM daily
  GROUP BY ALL HAVING subs > 0""", *facts.FACT_DAILY))(
    lambda s: reported.daily(s).groupBy("packageName").agg(F.sum("new_paid_subscriptions").alias("subs"))
    .where("subs > 0"))


@on_sample("rolling_30d", query(f"""
  SELECT count(*) FILTER (WHERE date_id > mx - {sample.ROLLING_DAYS}) AS cur,
    count(*) FILTER (WHERE date_id > mx - {2 * sample.ROLLING_DAYS} AND date_id <= mx - {sample.ROLLING_DAYS}) AS prev
  FROM dom, (SELECT max(date_id) AS mx FROM dom)"""))
def _(s):
    events = both(s).select("date_id")
    windows = reports.rolling(reports.last_day(events), sample.ROLLING_DAYS)
    return events.agg(*[F.count_if(c).alias(n) for n, c in windows.items()])


on_sample("exclude_trial", query('SELECT date_id, "packageId", new_paid_subscriptions FROM daily WHERE NOT is_trial',
                                 *facts.FACT_DAILY))(
    lambda s: reported.daily(s).where(~F.col("is_trial")).select("date_id", "packageId", "new_paid_subscriptions"))
on_sample("filter_since", query(f"SELECT {KEY_SQL}, date_id FROM dom WHERE date_id >= DATE '{sample.WEEKLY_SINCE}'"))(
    lambda s: both(s).where(F.col("date_id") >= F.lit(sample.WEEKLY_SINCE)).select(*KEY, "date_id"))

# ------------------------------------------------------------------- joins
on_sample("anti_join_banned", query(f"""
  SELECT {KEY_SQL} FROM dom e WHERE seg = 'B2C'
    AND NOT EXISTS (SELECT 1 FROM b2c_user b WHERE b."userId" = e."userId" AND b."isBanned")"""))(
    lambda s: tables.without_banned(s.b2c_events, s.b2c_users).select(*KEY))
on_sample("join_event_package", query(f"""
  SELECT {KEY_SQL}, name AS "packageName" FROM dom e JOIN pkg p ON p.seg = e.seg AND p.pid = e.pid
  WHERE e.seg = 'B2C'"""))(
    lambda s: tables.with_package_number(s.b2c_events).join(b2c_listed(s), "packageId").select(*KEY, "packageName"))


def _b2c_days(s):
    days = tracking.user_day_packages(cycles.window_events(s.b2c_events, sample.START_DATE, sample.AS_OF), b2c_listed(s))
    return tables.without_banned(days, s.b2c_users)


def _b2b_days(s):
    events = tables.with_package_number(windowed(s.b2b_events))
    return tracking.user_day_packages(events, tables.b2b_packages(s.b2b_packages, "packageName").distinct())


on_sample("join_user_packages", query("""
  SELECT DISTINCT r."userId", r.date_id, r.pid AS "packageId", names[1] AS package_1, names[2] AS package_2
  FROM c_rows r JOIN c_user u ON u."userId" = r."userId" """, tracked.B2C))(
    lambda s: tracking.with_user_packages(_b2c_days(s)).select("userId", "date_id", "packageId", "package_1", "package_2"))
on_sample("join_package_by_name", query("""
  SELECT d."userId", d.date_id, d."packageName", p.pid AS "packageId" FROM b_day d
  JOIN pkg p ON p.seg = 'B2B' AND p.name = d."packageName" """, tracked.B2B))(
    lambda s: _b2b_days(s).groupBy("userId", "date_id").agg(F.max("packageName").alias("packageName"))
    .join(tables.b2b_packages(s.b2b_packages, "packageName").distinct(), "packageName"))
on_sample("join_user_team_company", query("SELECT * FROM member"))(
    lambda s: summary.company_members(s.b2b_users, s.team, s.company))
on_sample("join_company_range", query("""
  SELECT m."userId", m."companyId", s.bin AS number_of_user_bin,
    '(' || (bin * 10 - 9) || '-' || (bin * 10) || ')' AS company_size_range
  FROM member m JOIN size s ON s."companyId" = m."companyId" """, tracked.B2B))(
    lambda s: tracking.sized_members(s.b2b_users, s.team, s.company)
    .select("userId", "companyId", "number_of_user_bin", "company_size_range"))
on_sample("join_b2b_dims", query("""
  SELECT d."userId", d.date_id, m."teamId", m."companyId" FROM b_day d JOIN member m ON m."userId" = d."userId" """,
    tracked.B2B))(
    lambda s: _b2b_days(s).select("userId", "date_id").distinct()
    .join(summary.company_members(s.b2b_users, s.team, s.company), "userId")
    .select("userId", "date_id", "teamId", "companyId"))
on_sample("left_join_usage", query("""
  SELECT "userId", cycle_start_ts, consumed, usage_event_cnt, serving_cost_thb FROM cycles""", behaviour.CYCLES))(
    lambda s: behaviour.token_cycles(s).select("userId", "cycle_start_ts", "consumed", "usage_event_cnt",
                                               "serving_cost_thb"))
on_sample("left_join_package", query(f"""
  SELECT event_id, pid AS "packageId", name AS "packageName" FROM dom e
  LEFT JOIN pkg p USING (seg, pid) WHERE seg = 'B2C'"""))(
    lambda s: tables.with_package_number(s.b2c_events).join(b2c_listed(s), "packageId", "left")
    .select("event_id", "packageId", "packageName"))


def cycle_rows(s):
    return cycles.cycle_rows(s.b2c_events, s.b2c_users, **tracked.WINDOW)


on_sample("interval_join_usage", query("""
  SELECT "userId", event_id, began AS cycle_start_ts, quota, used FROM meter""", behaviour.CYCLES))(
    lambda s: cycles.usage_rows(cycle_rows(s)).select("userId", "event_id", "cycle_start_ts", "quota", "used"))
on_sample("cross_join_asof", query('SELECT DISTINCT "userId", (SELECT max(date_id) FROM ev) AS data_end FROM ev',
                                   behaviour.CYCLES))(
    lambda s: b2c_live(s).select("userId").distinct().withColumn("data_end", behavior.data_end(b2c_live(s))))
on_sample("left_join_star", query("""
  SELECT "userId", paid_subscribe_cnt, trial_cnt, "first_paid_packageName", dominant_segment, revenue_thb,
    serving_cost_thb, margin_thb, data_end FROM behavior""", behaviour.CYCLES, behaviour.BEHAVIOR))(
    lambda s: behaviour.repeat_behavior(s).select(
        "userId", "paid_subscribe_cnt", "trial_cnt", "first_paid_packageName", "dominant_segment", "revenue_thb",
        "serving_cost_thb", "margin_thb", "data_end"))
on_sample("left_join_version_package", query("""
  SELECT event_id, seg AS version, pid AS "packageId", name AS "packageName", price AS "priceThb"
  FROM live LEFT JOIN pkg USING (seg, pid)"""))(
    lambda s: summary.without_banned_b2c(
        summary.segment_events(s.b2c_events, s.b2b_events, "event_id", "userId", "packageId"), s.b2c_users)
    .join(summary.segment_packages(s.b2c_packages, s.b2b_packages), ["version", "packageId"], "left")
    .select("event_id", "version", "packageId", "packageName", "priceThb"))
on_sample("left_join_conditional", query("""
  SELECT seg AS version, "userId", seg = 'B2C' OR "userId" IN (SELECT "userId" FROM member) AS has_company_mapping
  FROM (SELECT DISTINCT seg, "userId" FROM live)"""))(
    lambda s: summary.with_mapping_flag(
        summary.without_banned_b2c(summary.segment_events(s.b2c_events, s.b2b_events, "userId").distinct(), s.b2c_users),
        summary.mapped_users(s.b2b_users, s.team, s.company)))
on_sample("join_latest_package", query('SELECT seg AS version, "userId", name AS package FROM cur', decks.SUBS))(
    lambda s: deck.current_packages(decks.subs(s), decks.packages(s)))
on_sample("join_first_paid", query('SELECT "userId", name AS to_package FROM conv_to', decks.SUBS))(
    lambda s: deck.conversion_packages(decks.subs(s), decks.packages(s)))


def paid_subscriptions(s):
    events = dedup.one_per_event(b2c_live(s)).where(
        (F.col("eventType") == domain.SUBSCRIBE) & F.col("packageId").isin(*domain.B2C_PAID_PACKAGES))
    return dedup.one_per_paid_subscription(events)


on_sample("join_paid_price", query("""
  SELECT "userId", "subscriptionId", p.pid AS "packageId", p.price AS "priceThb" FROM paid g
  JOIN pkg p ON p.seg = 'B2C' AND p.pid = g.pid""", behaviour.CYCLES, behaviour.BEHAVIOR))(
    lambda s: paid_subscriptions(s).join(priced(s), "packageId")
    .select("userId", "subscriptionId", "packageId", "priceThb"))


@on_sample("cross_scalar_ctes", query("""
  SELECT count(DISTINCT "userId") AS users, max(date_id) AS data_end,
    CAST(sum("totalCostThb") AS DECIMAL(38,6)) AS cost FROM dom"""))
def _(s):
    """Independent one-row results side by side, as scalar subqueries of one row."""
    events = both(s)
    users = events.agg(F.count_distinct("userId")).scalar()
    cost = events.agg(F.sum("totalCostThb").cast(domain.MONEY_SUM)).scalar()
    return events.agg(F.max("date_id").alias("data_end")).select(users.alias("users"), "data_end", cost.alias("cost"))


on_sample("scalar_subquery", query(f"SELECT {KEY_SQL} FROM dom WHERE date_id = (SELECT max(date_id) FROM dom)"))(
    lambda s: both(s).where(F.col("date_id") == reports.last_day(both(s))).select(*KEY))

# ------------------------------------------------------------ aggregations
on_sample("agg_b2c_user_day", query('SELECT * FROM c_day', tracked.B2C))(
    lambda s: tracked.b2c(s).select("userId", "date_id", "packageName", "trial_conversion_cnt", "token_used",
                                    "totalCostThb", "free_trial_token_used"))
on_sample("agg_b2b_user_day", query("SELECT * FROM b_day", tracked.B2B))(
    lambda s: _b2b_days(s).groupBy("userId", "date_id").agg(
        F.max("packageName").alias("packageName"), F.sum("token_used").alias("token_used"),
        F.sum("totalCostThb").cast(domain.MONEY_SUM).alias("totalCostThb")))
on_sample("agg_user_packages", query("""
  SELECT "userId", names[1] AS package_1, names[2] AS package_2 FROM b_user""", tracked.B2B))(
    lambda s: tracking.with_user_packages(_b2b_days(s)).select("userId", "package_1", "package_2").distinct())
on_sample("agg_company_size", query("""
  SELECT "companyId", bin AS number_of_user_bin, '(' || (bin * 10 - 9) || '-' || (bin * 10) || ')' AS company_size_range
  FROM size""", tracked.B2B))(
    lambda s: tracking.company_sizes(summary.company_members(s.b2b_users, s.team, s.company)))
on_sample("agg_summary_daily", query("""
  SELECT version, date_id, "packageId", has_company_mapping, daily_active_users, usage_events, monthly_resets,
    revenue_thb_est FROM daily""", *facts.FACT_DAILY))(
    lambda s: reported.daily(s).select("version", "date_id", "packageId", "has_company_mapping", "daily_active_users",
                                       "usage_events", "monthly_resets", "revenue_thb_est"))
on_sample("agg_summary_model", query("""
  SELECT version, "aiModel", CAST(sum(usage_events) AS BIGINT) AS usage_events,
    CAST(sum(tokens_used) AS BIGINT) AS tokens_used FROM model_daily GROUP BY ALL""", *reported.MODELS))(
    lambda s: reported.models(s).groupBy("version", "aiModel").agg(
        F.sum("usage_events").alias("usage_events"), F.sum("tokens_used").alias("tokens_used")))
on_sample("agg_segment_counts", query("""
  SELECT count(*) AS total_users, count(*) FILTER (WHERE seg = 'B2C') AS b2c_users,
    count(*) FILTER (WHERE seg = 'B2C' AND name NOT IN ('Starter', 'Standard', 'Pro')) AS b2c_free_trial,
    count(*) FILTER (WHERE seg = 'B2B' AND name = 'Biz Pro') AS b2b_biz_pro FROM cur""", decks.SUBS))(
    lambda s: deck.current_packages(decks.subs(s), decks.packages(s)).agg(
        *[deck.user_counts()[n].alias(n) for n in ("total_users", "b2c_users", "b2c_free_trial", "b2b_biz_pro")]))
on_sample("agg_company_histogram", query("""
  SELECT company_size_range, min(number_of_user_bin) AS bin_order, count(DISTINCT "companyId") AS companies
  FROM tracking_b2b GROUP BY ALL""", tracked.B2B))(
    lambda s: deck.company_size(tracked.b2b(s)).drop("users"))
on_sample("agg_first_subscription", query("""
  SELECT seg AS version, "userId", min(date_id) AS first_date FROM sub GROUP BY ALL""", decks.SUBS))(
    lambda s: deck.first_subscriptions(decks.subs(s)))
on_sample("agg_new_users_week", query("SELECT * FROM weekly_new", decks.SUBS, decks.WEEKS))(
    lambda s: deck.new_users_weekly(decks.subs(s)).select("segment", "week_start", "new_users"))
on_sample("agg_conversion", query('SELECT "userId", ts AS first_paid_ts FROM conv', decks.SUBS))(
    lambda s: deck.converted_users(decks.subs(s)))
on_sample("agg_cycle_usage", query("""
  SELECT "userId", began AS cycle_start_ts, consumed, n AS usage_event_cnt, CAST(cost AS DECIMAL(38,6)) AS cost,
    exhaust_ts FROM bill""", behaviour.CYCLES))(
    lambda s: cycles.usage_rows(cycle_rows(s)).groupBy("userId", "cycle_start_ts").agg(
        F.sum("used").alias("consumed"), F.count(F.lit(1)).alias("usage_event_cnt"),
        F.sum("totalCostThb").cast(domain.MONEY_SUM).alias("cost"),
        F.min(F.when(F.col("cum_used") >= figures.exhaust_level(F.col("quota")), F.col("eventTimeStamp")))
        .alias("exhaust_ts")))


def purchases(s):
    events = b2c_live(s)
    paid = events.where((F.col("eventType") == domain.SUBSCRIBE) & F.col("packageId").isin(*domain.B2C_PAID_PACKAGES))
    cuts = splitting.long_keys(paid, "userId", ("eventTimeStamp", "event_id"))
    return behavior.user_purchases(dedup.one_per_event(events), cuts, priced(s))


PURCHASES = (behaviour.CYCLES, behaviour.BEHAVIOR)
on_sample("agg_paid_subscriptions", query("""
  SELECT "userId", subs AS paid_subscribe_cnt, first_ts AS first_paid_ts, last_ts AS last_paid_ts,
    gap AS avg_days_between_paid FROM payer""", *PURCHASES))(
    lambda s: purchases(s).where("paid_subscribe_cnt > 0").select(
        "userId", "paid_subscribe_cnt", "first_paid_ts", "last_paid_ts",
        behavior.mean_gap_days().alias("avg_days_between_paid")))
on_sample("agg_revenue", query('SELECT "userId", CAST(revenue AS DECIMAL(38,6)) AS revenue_thb FROM payer', *PURCHASES))(
    lambda s: paid_subscriptions(s).join(priced(s), "packageId").groupBy("userId")
    .agg(F.sum("priceThb").cast(domain.MONEY_SUM).alias("revenue_thb")))
on_sample("agg_trials", query('SELECT "userId", trials AS trial_cnt FROM tries', *PURCHASES))(
    lambda s: dedup.one_per_event(b2c_live(s))
    .where((F.col("eventType") == domain.SUBSCRIBE) & (F.col("packageId") == domain.TRIAL_PACKAGE))
    .groupBy("userId").agg(F.count_distinct("subscriptionId").alias("trial_cnt")))
on_sample("agg_cost", query("""
  SELECT "userId", CAST(cost AS DECIMAL(38,6)) AS serving_cost_thb, CAST(tokens AS BIGINT) AS tokens_used_total
  FROM used""", *PURCHASES))(
    lambda s: dedup.one_per_event(b2c_live(s)).where(summary.is_usage()).groupBy("userId").agg(
        F.sum("totalCostThb").cast(domain.MONEY_SUM).alias("serving_cost_thb"),
        F.sum(F.abs("eggToken")).alias("tokens_used_total")))
on_sample("agg_cycle_rollup", query("""
  SELECT "userId", cycles_total, cycles_completed, paid_cycles_completed, paid_cycles_exhausted, ever_exhausted,
    avg_utilization_paid, avg_leftover_at_repurchase, winback_cnt, churned FROM rolled""", *PURCHASES))(
    lambda s: behavior.cycle_rollup(behaviour.token_cycles(s)).select(
        "userId", "cycles_total", "cycles_completed", "paid_cycles_completed", "paid_cycles_exhausted",
        "ever_exhausted", "avg_utilization_paid", "avg_leftover_at_repurchase", "winback_cnt", "churned"))
on_sample("agg_last_non_null", query("""
  SELECT "userId", arg_max("aiModel", ("eventTimeStamp", event_id)) FILTER (WHERE "aiModel" IS NOT NULL) AS last_model
  FROM dom GROUP BY "userId" """))(
    lambda s: both(s).groupBy("userId").agg(
        F.max_by("aiModel", F.when(F.col("aiModel").isNotNull(), F.struct("eventTimeStamp", "event_id")))
        .alias("last_model")))
on_sample("agg_mode_segment", query('SELECT "userId", dominant_segment FROM winner', *PURCHASES))(
    lambda s: behavior.cycle_rollup(behaviour.token_cycles(s)).where(F.col("dominant_segment").isNotNull())
    .select("userId", "dominant_segment"))
on_sample("agg_max_date", query("SELECT max(date_id) AS data_end FROM ev", behaviour.CYCLES))(
    lambda s: b2c_live(s).agg(F.max("date_id").alias("data_end")))
on_sample("agg_kpi_30d", query("""
  SELECT data_end, cur_rev, prev_rev, cur_subs, prev_subs, all_rev, all_cost, first_date FROM kpi""",
    *reported.DAYS, *reported.USERS, reported.KPI))(
    lambda s: reports.kpi(reported.daily(s), tracked.total(s), sample.ROLLING_DAYS).select(
        "data_end", "cur_rev", "prev_rev", "cur_subs", "prev_subs", "all_rev", "all_cost", "first_date"))
on_sample("agg_weekly_money", query(f"""
  SELECT {reported.WEEK}, CAST(round(sum("totalCostThb"), 0) AS BIGINT) AS cost FROM dom GROUP BY ALL"""))(
    lambda s: both(s).groupBy(reports.week_text()).agg(figures.whole(F.sum("totalCostThb")).alias("cost")))
on_sample("agg_weekly_users", query(f"""
  SELECT {reported.WEEK}, count(DISTINCT CASE WHEN seg = 'B2C' THEN "userId" END) AS b2c_users,
    count(DISTINCT CASE WHEN seg = 'B2B' THEN "userId" END) AS b2b_users
  FROM dom WHERE date_id >= DATE '{sample.WEEKLY_SINCE}' GROUP BY ALL"""))(
    lambda s: reports.weekly_users(
        s.b2c_events.select(F.lit("B2C").alias("version"), "date_id", "userId").unionByName(
            s.b2b_events.select(F.lit("B2B").alias("version"), "date_id", "userId")), sample.WEEKLY_SINCE))
on_sample("agg_by_version", query("""
  SELECT seg AS version, CAST(sum("totalCostThb") AS DECIMAL(38,6)) AS "totalCostThb" FROM live GROUP BY ALL"""))(
    lambda s: reports.cost_by(summary.without_banned_b2c(
        summary.segment_events(s.b2c_events, s.b2b_events, "userId", "totalCostThb"), s.b2c_users), "version"))
on_sample("agg_by_package", query("""
  SELECT pid AS "packageId", CAST(sum("totalCostThb") AS DECIMAL(38,6)) AS "totalCostThb" FROM live GROUP BY ALL"""))(
    lambda s: reports.cost_by(summary.without_banned_b2c(
        summary.segment_events(s.b2c_events, s.b2b_events, "userId", "packageId", "totalCostThb"), s.b2c_users),
        "packageId"))
on_sample("agg_by_model", query("""
  SELECT "aiModel", CAST(sum(serving_cost_thb) AS DECIMAL(38,6)) AS serving_cost_thb FROM model_daily
  GROUP BY ALL""", *reported.MODELS))(
    lambda s: reported.models(s).groupBy("aiModel").agg(reports.money_sum("serving_cost_thb")))
on_sample("agg_by_user_type", query("""
  SELECT user_type, count(*) AS users, CAST(sum(revenue_thb) AS DECIMAL(38,6)) AS revenue_thb FROM behavior
  GROUP BY ALL""", *PURCHASES))(
    lambda s: behaviour.repeat_behavior(s).groupBy("user_type").agg(
        F.count(F.lit(1)).alias("users"), reports.money_sum("revenue_thb")))
on_sample("agg_repeat_ratios", query("""
  SELECT count(*) FILTER (WHERE is_repeat) AS repeat_users, count(*) FILTER (WHERE paid_subscribe_cnt >= 1) AS paid_users,
    round(100::DOUBLE * (count(*) FILTER (WHERE is_repeat)::DOUBLE
      / nullif(count(*) FILTER (WHERE paid_subscribe_cnt >= 1), 0)), 2) AS repeat_pct FROM behavior""", *PURCHASES))(
    lambda s: reports.repeat_figures(behaviour.repeat_behavior(s)).select("repeat_users", "paid_users", "repeat_pct"))


@register("distinct_rows", query(f"SELECT DISTINCT {KEY_SQL}, date_id FROM dom"))
def _(spark, sf_dir):
    """Every event is there twice before the duplicates go."""
    events = both(sample.load(spark, sf_dir)).select(*KEY, "date_id")
    return events.unionByName(events).distinct()


# ----------------------------------------------------- sorts, limits, top-k
on_sample("sort_metrics", query("SELECT sort_order, metric_key, value_num FROM metrics ORDER BY sort_order",
                                decks.SUBS, tracked.B2B, decks.METRICS))(
    lambda s: decks.metrics(s).select("sort_order", "metric_key", "value_num").orderBy("sort_order"))
on_sample("sort_company_bins", query("""
  SELECT min(number_of_user_bin) AS bin_order, company_size_range FROM tracking_b2b GROUP BY company_size_range
  ORDER BY bin_order""", tracked.B2B))(
    lambda s: deck.company_size(tracked.b2b(s)).select("bin_order", "company_size_range"))
on_sample("sort_new_users", query("SELECT * FROM weekly_new ORDER BY segment, week_start", decks.SUBS, decks.WEEKS))(
    lambda s: deck.new_users_weekly(decks.subs(s)).select("segment", "week_start", "new_users")
    .orderBy("segment", "week_start"))
on_sample("topk_models", query("""
  SELECT "aiModel", CAST(sum("totalCostThb") AS DECIMAL(38,6)) AS "totalCostThb" FROM dom
  GROUP BY ALL ORDER BY 2 DESC, 1 LIMIT 3"""))(
    lambda s: reports.cost_by(both(s), "aiModel").orderBy(F.desc("totalCostThb"), "aiModel").limit(3))
on_sample("sort_packages_revenue", query(f"""
  SELECT "packageName", {reported.ROUNDED.format('revenue_thb_est')} AS revenue FROM daily WHERE NOT is_trial
  GROUP BY version, "packageName" HAVING sum(new_paid_subscriptions) > 0 ORDER BY revenue DESC""", *facts.FACT_DAILY))(
    lambda s: reports.by_package(reported.daily(s)).select("packageName", "revenue"))
on_sample("sort_user_types", query("SELECT user_type, count(*) AS users FROM behavior GROUP BY ALL ORDER BY users DESC",
                                   *PURCHASES))(
    lambda s: reports.user_health(behaviour.repeat_behavior(s)).select("user_type", "users"))

# ---------------------------------------------------------- set operations
on_sample("union_conversion_as_subscribe", query("""
  SELECT r.event_id, CASE WHEN "eventType" = 'Token Used' THEN 'Active' ELSE "eventType" END AS event_flag FROM c_rows r
  JOIN c_user u ON u."userId" = r."userId"
  UNION ALL
  SELECT r.event_id, 'Trial Conversion' FROM c_rows r JOIN c_user u ON u."userId" = r."userId"
  WHERE (r."eventTimeStamp", r.event_id) = u.paid_at AND u.trial_at < u.paid_at""", tracked.B2C))(
    lambda s: tracking.event_flags(b2c_live(s), b2c_listed(s)).select("event_id", "event_flag"))
on_sample("union_total", query("""
  SELECT version, count(*) AS rows, count(*) FILTER (WHERE "teamId" = 'null') AS no_team,
    count(trial_conversion_cnt) AS with_trials FROM tracking_total GROUP BY ALL""", *reported.USERS))(
    lambda s: tracked.total(s).groupBy("version").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("teamId") == domain.NULL_TEXT).alias("no_team"),
        F.count("trial_conversion_cnt").alias("with_trials")))
on_sample("union_segment_sources", query("""
  SELECT seg AS version, event_id, pid AS "packageId" FROM dom
  WHERE CASE seg WHEN 'B2C' THEN pid IN (1, 2, 3, 12) ELSE pid NOT IN (5, 7, 10, 97, 98) END"""))(
    lambda s: summary.segment_events(s.b2c_events, s.b2b_events, "event_id", "packageId"))
on_sample("union_lifecycle_split", query('SELECT event_id, "eventType" FROM kept', facts.FACT))(
    lambda s: dedup.collapse_lifecycle(summary.without_banned_b2c(
        summary.segment_events(s.b2c_events, s.b2b_events), s.b2c_users)).select("event_id", "eventType"))
on_sample("union_metrics", query("SELECT metric_key, value_num FROM metrics", decks.SUBS, tracked.B2B, decks.METRICS))(
    lambda s: decks.metrics(s).select("metric_key", "value_num"))
