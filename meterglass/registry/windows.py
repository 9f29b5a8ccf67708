"""Window functions, one query each."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from meterglass import domain
from meterglass.operators import dedup, splitting
from meterglass.plans import cycles, deck, summary, tracking
from meterglass.registry import behavior as behaviour
from meterglass.registry import deck as decks
from meterglass.registry import summary as facts
from meterglass.registry import tracking as tracked
from meterglass.registry.common import on_sample
from meterglass.registry.ingest import both
from meterglass.registry.relational import PURCHASES, b2c_live, cycle_rows, paid_subscriptions
from meterglass.registry.sql import query
from meterglass.sources import tables

MOMENT = ["eventTimeStamp", "event_id"]


@on_sample("rank_package_desc", query("""
  SELECT event_id, dense_rank() OVER (PARTITION BY "userId" ORDER BY pid DESC) AS package_row FROM ev""",
    behaviour.CYCLES))
def _(s):
    """Ranked over the few packages of a user, then looked up by user and package."""
    events = b2c_live(s)
    best_first = W.partitionBy("userId").orderBy(F.desc("packageId"))
    ranks = events.select("userId", "packageId").distinct().withColumn(
        "package_row", F.dense_rank().over(best_first).cast("bigint"))
    return events.join(ranks, ["userId", "packageId"]).select("event_id", "package_row")


def running_purchases(s, trial: bool, name: str):
    events = b2c_live(s)
    cuts = splitting.long_keys(events, "userId", MOMENT)
    bought = (F.col("eventType") == domain.SUBSCRIBE) & ((F.col("packageId") == domain.TRIAL_PACKAGE) == F.lit(trial))
    return splitting.with_running_sum(events, cuts, "userId", MOMENT,
                                      F.when(bought, 1).otherwise(0), name).select("event_id", name)


for _name, _trial, _test in (("cum_paid_subscribes", False, "<>"), ("cum_trial_subscribes", True, "=")):
    on_sample(_name, query(f"""
      SELECT event_id, CAST(sum(CASE WHEN "eventType" = 'Subscribe' AND pid {_test} 12 THEN 1 ELSE 0 END) OVER (
        PARTITION BY "userId" ORDER BY "eventTimeStamp", event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS {_name}
      FROM ev""", behaviour.CYCLES))(lambda s, trial=_trial, name=_name: running_purchases(s, trial, name))


def user_days(s):
    return both(s).select("userId", "date_id").distinct()


on_sample("event_row", query("""
  SELECT "userId", date_id, row_number() OVER (PARTITION BY "userId" ORDER BY date_id) AS event_row
  FROM (SELECT DISTINCT "userId", date_id FROM dom)"""))(
    lambda s: user_days(s).withColumn("event_row", tracking.day_rank(F.col("userId"))))
on_sample("current_package_flag", query("""
  SELECT "userId", date_id, CAST(CASE WHEN date_id = max(date_id) OVER (PARTITION BY "userId") THEN 1 ELSE 0 END
    AS BIGINT) AS current_package_flag FROM (SELECT DISTINCT "userId", date_id FROM dom)"""))(
    lambda s: user_days(s).withColumn("current_package_flag", tracking.latest_day_flag()))


def ranked(s, key: str, name: str):
    events = listed_events(s)
    members = tracking.sized_members(s.b2b_users, s.team, s.company)
    days = tracking.active_days(events, tables.b2b_packages(s.b2b_packages, "packageName"), members)
    rows = events.select("userId", "date_id").distinct().join(members.select("userId", key).distinct(), "userId")
    return rows.join(tracking.ranked_days(days, key, name), [key, "date_id"]).select("userId", "date_id", key, name)


def listed_events(s):
    """B2B events of listed packages inside the window."""
    events = s.b2b_events.where(tables.in_window(**tracked.WINDOW))
    listed = tables.b2b_packages(s.b2b_packages).distinct()
    return tables.with_package_number(events).join(listed, "packageId", "left_semi")


for _name, _key in (("company_first_event_row", "companyId"), ("team_first_event_row", "teamId")):
    on_sample(_name, query(f"""
      SELECT DISTINCT "userId", date_id, "{_key}",
        dense_rank() OVER (PARTITION BY "{_key}" ORDER BY date_id) AS {_name} FROM b_full""", tracked.B2B))(
        lambda s, key=_key, name=_name: ranked(s, key, name))


@on_sample("dedup_event_id", query('SELECT event_id, "eventTimeStamp", "userId" FROM dom'))
def _(s):
    """Each event comes twice, a minute apart; the earlier copy stays."""
    events = both(s)
    late = events.withColumn("eventTimeStamp", F.expr("eventTimeStamp + INTERVAL 1 MINUTE"))
    return dedup.one_per_event(events.unionByName(late)).select("event_id", "eventTimeStamp", "userId")


on_sample("dedup_lifecycle", query("""
  SELECT seg AS version, event_id FROM kept WHERE "eventType" IN ('Subscribe', 'MainExpired')""", facts.FACT))(
    lambda s: dedup.one_per_lifecycle(
        summary.without_banned_b2c(summary.segment_events(s.b2c_events, s.b2b_events), s.b2c_users)
        .where(F.col("eventType").isin(*domain.LIFECYCLE))).select("version", "event_id"))
on_sample("dedup_subscription", query('SELECT seg AS version, "subscriptionId", event_id FROM sub', decks.SUBS))(
    lambda s: decks.subs(s).select("version", "subscriptionId", "event_id"))
on_sample("latest_subscription", query("""
  SELECT seg AS version, "userId", max(("eventTimeStamp", event_id))[2] AS event_id FROM sub GROUP BY ALL""",
    decks.SUBS))(lambda s: dedup.latest_per_user(decks.subs(s)).select("version", "userId", "event_id"))


@on_sample("dedup_boundary", query("""
  SELECT "userId", event_id FROM ev WHERE "eventType" IN ('Subscribe', 'MonthlyReset', 'MainExpired')""",
    behaviour.CYCLES))
def _(s):
    """A second boundary of the same instant and type, with a later id, goes away."""
    rows = b2c_live(s).where(F.col("eventType").isin(*domain.BOUNDARIES))
    twin = rows.withColumn("event_id", F.concat("event_id", F.lit("x")))
    return dedup.one_per_boundary(rows.unionByName(twin)).select("userId", "event_id")


on_sample("dedup_paid_subscription", query("""
  SELECT "userId", "subscriptionId", ts AS "eventTimeStamp" FROM paid""", *PURCHASES))(
    lambda s: paid_subscriptions(s).select("userId", "subscriptionId", "eventTimeStamp"))
on_sample("last_grant", query('SELECT event_id, latest_grant AS last_grant FROM edge', behaviour.CYCLES))(
    lambda s: cycles.boundary_rows(cycle_rows(s)).select("event_id", "last_grant"))
on_sample("next_boundary", query("""
  SELECT event_id, until AS next_ts, closed_by AS next_type, closing_egg AS next_egg FROM edge""", behaviour.CYCLES))(
    lambda s: cycles.boundary_rows(cycle_rows(s)).select("event_id", "next_ts", "next_type", "next_egg"))
on_sample("cum_used", query("""
  SELECT "userId", began AS cycle_start_ts, moment AS "eventTimeStamp", CAST(reading AS BIGINT) AS cum_used FROM meter""",
    behaviour.CYCLES))(
    lambda s: cycles.usage_rows(cycle_rows(s)).select("userId", "cycle_start_ts", "eventTimeStamp", "cum_used"))
on_sample("cycle_index", query('SELECT "userId", cycle_start_ts, cycle_index FROM cycles', behaviour.CYCLES))(
    lambda s: behaviour.token_cycles(s).select("userId", "cycle_start_ts", "cycle_index"))


@on_sample("paid_sequence", query("""
  SELECT "userId", "subscriptionId", ts AS "eventTimeStamp", before AS prev_ts,
    row_number() OVER (PARTITION BY "userId" ORDER BY ts, eid) AS sub_seq FROM gaps""", *PURCHASES))
def _(s):
    paid = paid_subscriptions(s)
    cuts = splitting.long_keys(paid, "userId", MOMENT)
    numbered = splitting.with_running_sum(paid, cuts, "userId", MOMENT, F.lit(1), "sub_seq")
    return splitting.with_previous(numbered, cuts, "userId", MOMENT, F.col("eventTimeStamp"),
                                   "prev_ts").select("userId", "subscriptionId", "eventTimeStamp", "prev_ts", "sub_seq")


on_sample("prev_end_type", query("""
  SELECT "userId", cycle_index, prev_end AS prev_end_type FROM flagged""", *PURCHASES))(
    lambda s: splitting.with_neighbour(behaviour.token_cycles(s), "userId", "cycle_index", "end_type", "prev_end_type")
    .select("userId", "cycle_index", "prev_end_type"))


@on_sample("rn_last", query("""
  SELECT "userId", cycle_start_ts, cycle_index,
    row_number() OVER (PARTITION BY "userId" ORDER BY cycle_index DESC) AS rn_last FROM cycles""", behaviour.CYCLES))
def _(s):
    """Counted from the user's highest cycle number; no second sort."""
    rows = behaviour.token_cycles(s).select("userId", "cycle_start_ts", "cycle_index")
    ends = rows.groupBy("userId").agg(F.max("cycle_index").alias("n"))
    return rows.join(ends, "userId").withColumn("rn_last", F.col("n") - F.col("cycle_index") + 1).drop("n")


@on_sample("mode_rank", query("""
  SELECT "userId", segment, n, row_number() OVER (PARTITION BY "userId" ORDER BY n DESC, segment) AS mode_rank
  FROM votes""", *PURCHASES))
def _(s):
    """Eight segments at most per user, so the window is over a handful of rows."""
    rows = behaviour.token_cycles(s).where(
        (F.col("end_type") != "active") & ~F.col("is_trial") & (F.col("segment") != "C9_unknown_quota"))
    order = W.partitionBy("userId").orderBy(F.desc("n"), "segment")
    return rows.groupBy("userId", "segment").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "mode_rank", F.row_number().over(order).cast("bigint"))


on_sample("cumulative_new_users", query("""
  SELECT segment, week_start, CAST(sum(new_users) OVER (PARTITION BY segment ORDER BY week_start) AS BIGINT)
    AS new_users_cumulative FROM weekly_new""", decks.SUBS, decks.WEEKS))(
    lambda s: deck.new_users_weekly(decks.subs(s)).select("segment", "week_start", "new_users_cumulative"))
