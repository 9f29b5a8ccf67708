"""Token cycles: from one grant to the next boundary of the same user.

Usage meets its cycle in one ordered pass per user instead of a range join. Rows
are ordered by instant with boundaries before usage; the last boundary seen so
far is the row's cycle. Cycles of no length therefore get no usage of their own.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from meterglass import domain
from meterglass.functions import calendar, figures
from meterglass.operators import dedup, splitting
from meterglass.operators.splitting import LONG, RUN
from meterglass.plans.summary import is_usage
from meterglass.session import scratch_path
from meterglass.sources import tables

EVENT_COLUMNS = ("event_id", "userId", "eventType", "subscriptionId", "packageId", "eggToken",
                 "eventTimeStamp", "totalCostThb")
COLUMNS = ("userId", "subscriptionId", "packageId", "packageName", "is_trial", "cycle_start_ts", "start_type",
           "cycle_end_ts", "end_type", "cycle_index", "quota", "consumed", "usage_event_cnt", "utilization",
           "exhausted", "exhaust_ts", "days_to_exhaust", "leftover_at_end", "cycle_days", "serving_cost_thb",
           "segment")

_ORDER = ("eventTimeStamp", "is_use", "event_id")


def window_events(events: DataFrame, start_date: date, as_of: date) -> DataFrame:
    return tables.b2c_events(events.where(tables.in_window(start_date, as_of)))


def _ordered(*frame: int) -> W:
    window = W.partitionBy("userId", RUN).orderBy(*_ORDER)
    return window.rowsBetween(*frame) if frame else window


def _rows(events: DataFrame, seen: DataFrame | None) -> DataFrame:
    """Boundaries and usage, each event once; events whose id was seen on an earlier day are copies."""
    kind = F.col("eventType")
    once = dedup.one_per_event(events if seen is None else events.join(seen, "event_id", "left_anti"))
    return (once
            # Usage without a user belongs to nobody's cycle.
            .where(kind.isin(*domain.BOUNDARIES) | (F.col("is_use") & F.col("userId").isNotNull()))
            .withColumn("used", F.when(F.col("is_use"), F.abs("eggToken"))))


def _instant(boundary: str) -> str:
    """Column with the instant of the last such boundary of earlier runs."""
    return f"last_{boundary}"


def _with_instants(rows: DataFrame, any_long: bool, entering: DataFrame | None,
                   store: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The last instant of each kind of boundary before the run, as a cut may part rows of one instant."""
    names = {_instant(b): b for b in domain.BOUNDARIES}
    if entering is not None:
        state = entering.select(F.col("userId").alias("__key"), *names)
        rows = rows.join(state, F.col("userId").eqNullSafe(F.col("__key")), "left").drop("__key")
    else:
        rows = rows.withColumns({n: F.lit(None).cast(rows.schema["eventTimeStamp"].dataType) for n in names})
    if not any_long:
        return rows
    ends = rows.where(LONG).groupBy("userId", RUN).agg(*[
        F.max(F.when(F.col("eventType") == b, F.col("eventTimeStamp"))).alias(n) for n, b in names.items()])
    before = splitting.runs_of("userId").rowsBetween(W.unboundedPreceding, -1)
    ends = ends.select("userId", RUN, *[F.max(n).over(before).alias(f"__{n}") for n in names])
    carried = splitting.with_carry(rows, store(ends), "userId")
    return carried.withColumns({n: F.coalesce(f"__{n}", n) for n in names}).drop(*(f"__{n}" for n in names))


def _marked(rows: DataFrame) -> DataFrame:
    """Boundaries and usage of each run, with running totals and the last and next boundary."""
    up_to_here = _ordered(W.unboundedPreceding, 0)
    before = _ordered(W.unboundedPreceding, -1)
    kind, at = F.col("eventType"), F.col("eventTimeStamp")

    def repeated(boundary: str) -> Column:
        """An earlier row of the same instant already is this kind of boundary."""
        earlier = F.coalesce(F.last(F.when(kind == boundary, at), True).over(before), F.col(_instant(boundary)))
        return (kind == boundary) & earlier.eqNullSafe(at)

    again = repeated(domain.SUBSCRIBE) | repeated(domain.MONTHLY_RESET) | repeated(domain.MAIN_EXPIRED)
    rows = rows.select(
        "*",
        (~F.col("is_use") & ~again).alias("kept"),
        F.last(F.when(kind == domain.SUBSCRIBE, F.col("eggToken")), True).over(up_to_here).alias("grant"),
        F.sum(F.coalesce("used", F.lit(0))).over(up_to_here).alias("run_used"),
        F.count("used").over(up_to_here).alias("run_seen"))
    rows = rows.withColumn("mark", F.when(F.col("kept"), F.struct(
        at.alias("ts"), kind.alias("kind"), F.col("eggToken").alias("egg"), "subscriptionId", "packageId",
        "grant", "run_used", "run_seen")))
    starts = F.count(F.when(F.col("kept") & kind.isin(*domain.CYCLE_STARTS), 1))
    following = F.expr(f"lead(mark) IGNORE NULLS OVER (PARTITION BY userId, {RUN} ORDER BY {', '.join(_ORDER)})")
    return rows.select("*", F.last("mark", True).over(up_to_here).alias("cur"), following.alias("next"),
                       starts.over(up_to_here).alias("starts"))


def _carried(marked: DataFrame, entering: DataFrame | None) -> DataFrame:
    """What enters each run of a long user from the runs around it, and from the days before."""
    order = F.struct(*_ORDER)
    ends = marked.groupBy("userId", RUN).agg(
        F.max_by("grant", order).alias("grant"), F.max_by("cur", order).alias("last"),
        F.min_by("mark", F.when(F.col("kept"), order)).alias("first"),
        F.max("run_used").alias("used"), F.max("run_seen").alias("seen"), F.max("starts").alias("starts"))
    if entering is not None:
        # The days before are a run before all others.
        entered = entering.select("userId", F.lit(-1).cast("bigint").alias(RUN), "grant", "used", "seen", "starts",
                                  _settled("cur", F.col("cur.quota"), F.lit(0), F.lit(0)).alias("entered"))
        ends = ends.unionByName(entered, allowMissingColumns=True)
    runs = splitting.runs_of("userId")
    before = runs.rowsBetween(W.unboundedPreceding, -1)

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name).over(before), F.lit(0))

    ends = ends.select("*", F.last("grant", True).over(before).alias("c_grant"), total("used").alias("used_0"),
                       total("seen").alias("seen_0"), total("starts").alias("c_starts"),
                       F.expr(f"lead(first) IGNORE NULLS OVER (PARTITION BY userId ORDER BY {RUN})").alias("c_next"))
    # The last boundary of a run, with its quota settled and the user's running totals at it.
    settled = _settled("last", _quota("last", F.col("c_grant")), F.col("used_0") + F.col("last.run_used"),
                       F.col("seen_0") + F.col("last.run_seen"))
    ends = ends.withColumn("settled", settled if entering is None else F.coalesce("entered", settled)).withColumn("c_cur", F.last("settled", True).over(before))
    return ends.select("userId", RUN, "c_grant", "c_starts", "c_next", "c_cur",
                       (F.col("used_0") - F.col("c_cur.used")).alias("c_used"),
                       (F.col("seen_0") - F.col("c_cur.seen")).alias("c_seen"))


def _settled(mark: str, quota: Column, used: Column, seen: Column) -> Column:
    """A boundary with its quota, and the user's running totals at it."""
    return F.when(F.col(mark).isNotNull(), F.struct(
        f"{mark}.ts", f"{mark}.kind", f"{mark}.subscriptionId", f"{mark}.packageId", quota.alias("quota"),
        used.cast("bigint").alias("used"), seen.cast("bigint").alias("seen")))


def _entering_carry(entering: DataFrame, cuts: DataFrame | None) -> DataFrame:
    """What enters the only run of all other users from the days before."""
    if cuts is not None:
        entering = entering.join(cuts, F.col("userId").eqNullSafe(F.col("__key")), "left_anti")
    return entering.select("userId", F.lit(0).cast("bigint").alias(RUN), F.col("grant").alias("c_grant"),
                           F.col("starts").alias("c_starts"),
                           _settled("cur", F.col("cur.quota"), F.lit(0), F.lit(0)).alias("c_cur"),
                           F.col("used").alias("c_used"), F.col("seen").alias("c_seen"))


def _quota(mark: str, carried_grant: Column) -> Column:
    """A purchase brings its own quota; a reset repeats the last grant."""
    own = F.col(f"{mark}.kind") == domain.SUBSCRIBE
    return F.when(own, F.col(f"{mark}.egg")).otherwise(F.coalesce(F.col(f"{mark}.grant"), carried_grant))


def cycle_rows(events: DataFrame, users: DataFrame, *, start_date: date, as_of: date,
               rows_per_run: int = splitting.ROWS_PER_RUN) -> DataFrame:
    """Boundaries and usage, each with its cycle: start, kind, quota, use so far, next boundary."""
    return rows_in_cycles(window_events(events, start_date, as_of), lambda rows: tables.without_banned(rows, users), rows_per_run)


def rows_in_cycles(events: DataFrame, chosen: Callable[[DataFrame], DataFrame], rows_per_run: int,
                   entering: DataFrame | None = None, seen: DataFrame | None = None) -> DataFrame:
    """As ``cycle_rows``, for events of some days after those that ``entering`` sums up.

    ``entering``: one row per user (``cycle_state.STATE``); ``seen``: ids of events before these days.
    """
    events = events.select(*EVENT_COLUMNS).withColumn("is_use", is_usage())
    cuts = splitting.long_keys(events, "userId", _ORDER, rows_per_run)
    events = splitting.with_runs(chosen(events), cuts, "userId", _ORDER)
    carry = None if entering is None else _entering_carry(entering, cuts)
    return _in_runs(_rows(events, seen), cuts is not None, entering, carry)


def _in_runs(rows: DataFrame, any_long: bool, entering: DataFrame | None = None, entering_carry: DataFrame | None = None,
             store: Callable[[DataFrame], DataFrame] = lambda frame: frame) -> DataFrame:
    """Boundaries and usage, numbered by run, each with its cycle. ``store``: writes the frames with one row per run."""
    ordered = _with_instants(rows, any_long, entering, store)
    marked = _marked(ordered)
    # Without a long user nothing is carried inside the days, and one pass over the events is all.
    carried = (store(_carried(_marked(ordered.where(LONG)), entering)) if any_long
               else _carried(marked.where(F.lit(False)), None))
    if entering_carry is not None:
        carried = carried.unionByName(entering_carry, allowMissingColumns=True)
    rows = splitting.with_carry(marked, carried, "userId")
    # Inside the run the boundary is known; before the run's first one it is the carried one.
    here = F.col("cur").isNotNull()

    def boundary(field: str) -> Column:
        return F.when(here, F.col(f"cur.{field}")).otherwise(F.col(f"c_cur.{field}"))

    return rows.select(
        *EVENT_COLUMNS, "is_use", "used", "kept",
        F.coalesce("grant", "c_grant").alias("last_grant"),
        boundary("ts").alias("cycle_ts"), boundary("kind").alias("cycle_kind"),
        boundary("subscriptionId").alias("cycle_subscription"), boundary("packageId").alias("cycle_package"),
        F.when(here, _quota("cur", F.col("c_grant"))).otherwise(F.col("c_cur.quota")).alias("cycle_quota"),
        F.when(here, F.col("run_used") - F.col("cur.run_used"))
        .otherwise(F.col("run_used") + F.coalesce("c_used", F.lit(0))).alias("cum_used"),
        F.when(here, F.col("run_seen") - F.col("cur.run_seen"))
        .otherwise(F.col("run_seen") + F.coalesce("c_seen", F.lit(0))).alias("cum_seen"),
        _next().alias("following"),
        (F.col("starts") + F.coalesce("c_starts", F.lit(0))).alias("cycle_index"))


def laid_out(events: DataFrame, *, start_date: date, as_of: date, rows_per_run: int = splitting.ROWS_PER_RUN) -> DataFrame:
    """The window's boundaries and usage, each event once and numbered by run: what a layout by user and run stores."""
    events = window_events(events, start_date, as_of).select(*EVENT_COLUMNS).withColumn("is_use", is_usage())
    cuts = splitting.long_keys(events, "userId", _ORDER, rows_per_run)
    return splitting.with_runs(_rows(events, None).drop("used"), cuts, "userId", _ORDER)


LAYOUT_KEYS, LAYOUT_ORDER = ("userId", RUN), _ORDER


def token_cycles_laid_out(stored: DataFrame, packages: DataFrame, users: DataFrame) -> DataFrame:
    """``token_cycles`` of events stored by ``laid_out`` and bucketed by user and run.

    All ordered work finds its rows in place: no event is shuffled, and a long user's runs lie in several buckets. What
    runs hand on is written, one row per run, so that its measured size decides that it is sent to the events.
    Copies of an event are dropped before bans here, which is the same where copies have one user.
    """
    spark = stored.sparkSession

    def store(frame: DataFrame) -> DataFrame:
        path = scratch_path(spark, "carry")
        frame.write.parquet(path)
        return spark.read.schema(frame.schema).parquet(path)

    any_long = not stored.where(LONG).isEmpty()
    rows = tables.without_banned(stored, users).withColumn("used", F.when(F.col("is_use"), F.abs("eggToken")))
    return measured(shared_start(_cycle_sums(_in_runs(rows, any_long, store=store))),
                    tables.b2c_packages(packages, "packageName").distinct())


def boundary_rows(rows: DataFrame) -> DataFrame:
    """Kept boundaries with the grant in force and the next boundary."""
    return rows.where("kept").select("userId", "event_id", "eventTimeStamp", "eventType", "eggToken", "last_grant",
                                     F.col("following.ts").alias("next_ts"),
                                     F.col("following.kind").alias("next_type"),
                                     F.col("following.egg").alias("next_egg"))


def usage_rows(rows: DataFrame) -> DataFrame:
    """Usage that falls into a cycle, with the cycle's start, quota and use so far."""
    return rows.where(in_cycle()).select(
        "userId", "event_id", "eventTimeStamp", F.col("cycle_ts").alias("cycle_start_ts"),
        F.col("cycle_quota").alias("quota"), "used", "totalCostThb",
        F.when(F.col("cum_seen") > 0, F.col("cum_used")).alias("cum_used"))


def in_cycle() -> Column:
    return F.col("is_use") & F.col("cycle_kind").isin(*domain.CYCLE_STARTS)


def token_cycles(events: DataFrame, packages: DataFrame, users: DataFrame, *, start_date: date, as_of: date,
                 rows_per_run: int = splitting.ROWS_PER_RUN) -> DataFrame:
    """One row per user and cycle."""
    rows = cycle_rows(events, users, start_date=start_date, as_of=as_of, rows_per_run=rows_per_run)
    return measured(shared_start(_cycle_sums(rows)), tables.b2c_packages(packages, "packageName").distinct())


def _next() -> Column:
    """Next boundary: in the run, else the first one of a later run."""
    return F.struct(*[F.when(F.col("next").isNotNull(), F.col(f"next.{f}")).otherwise(F.col(f"c_next.{f}")).alias(f)
                      for f in ("ts", "kind", "egg")])


def _cycle_sums(rows: DataFrame) -> DataFrame:
    """One row per cycle, made of its start row and its usage.

    All rows of a cycle carry the same description of it, so the description is the
    grouping key and only numbers are folded: a hash aggregate, with no further sort
    of the events and one row per cycle and task to shuffle.
    """
    is_start = F.col("kept") & F.col("eventType").isin(*domain.CYCLE_STARTS)
    reached = (F.col("cum_seen") > 0) & (F.col("cum_used") >= figures.exhaust_level(F.col("cycle_quota")))
    return rows.where(in_cycle() | is_start).groupBy(
        "userId", "cycle_index", F.col("cycle_ts").alias("cycle_start_ts"), F.col("cycle_kind").alias("start_type"),
        F.col("cycle_subscription").alias("subscriptionId"), F.col("cycle_package").alias("packageId"),
        F.col("cycle_quota").alias("quota"), F.col("following.ts").alias("cycle_end_ts"),
        F.col("following.kind").alias("next_kind"), F.col("following.egg").alias("next_egg"),
    ).agg(
        F.sum("used").alias("consumed"),
        F.count_if("is_use").alias("usage_event_cnt"),
        F.sum(F.when(F.col("is_use"), F.col("totalCostThb"))).alias("cost"),
        F.min(F.when(F.col("is_use") & reached, F.col("eventTimeStamp"))).alias("exhaust_ts"))


def shared_start(sums: DataFrame) -> DataFrame:
    """A purchase and a reset of the same instant are two cycles with one start; both show the usage found there."""
    same_start = W.partitionBy("userId", "cycle_start_ts")
    return sums.withColumns({
        "consumed": F.coalesce(F.sum("consumed").over(same_start), F.lit(0)),
        "usage_event_cnt": F.sum("usage_event_cnt").over(same_start),
        "serving_cost_thb": F.coalesce(F.sum("cost").over(same_start), F.lit(0)).cast(domain.MONEY_SUM),
        "exhaust_ts": F.min("exhaust_ts").over(same_start),
    })


def measured(cycles: DataFrame, packages: DataFrame) -> DataFrame:
    """Cycles with names and measures."""
    cycles = cycles.join(packages, "packageId", "left")
    next_kind, quota, consumed = F.col("next_kind"), F.col("quota"), F.col("consumed")
    end_type = (F.when(next_kind == domain.SUBSCRIBE, "repurchase")
                .when(next_kind == domain.MONTHLY_RESET, "monthly_reset")
                .when(next_kind == domain.MAIN_EXPIRED, "expired").otherwise("active"))
    clawback = F.when(next_kind == domain.MAIN_EXPIRED, F.abs("next_egg"))
    unused = F.when(quota.isNotNull(), F.greatest(quota - consumed, F.lit(0)))
    start, end, spent = F.col("cycle_start_ts"), F.col("cycle_end_ts"), F.col("exhaust_ts")
    return cycles.select(
        "*", end_type.alias("end_type"),
        (F.col("packageId") == domain.TRIAL_PACKAGE).alias("is_trial"),
        figures.safe_divide(consumed, quota).alias("utilization"),
        F.coalesce(consumed >= figures.exhaust_level(quota), F.lit(False)).alias("exhausted"),
        calendar.days_between(start, spent, 2).alias("days_to_exhaust"),
        calendar.days_between(start, end, 2).alias("cycle_days"),
        F.coalesce(clawback, unused).alias("leftover_at_end"),
    ).withColumn("segment", segment()).select(*COLUMNS)


def segment() -> Column:
    """Eight life-cycle segments; an open cycle comes first, an unknown quota second."""
    end, full = F.col("end_type"), F.col("exhausted")
    return (F.when(end == "active", "C0_active")
            .when(F.col("quota").isNull(), "C9_unknown_quota")
            .when(full & (end == "repurchase"), "A1_exhausted_repurchase")
            .when(full & (end == "expired"), "A2_exhausted_churn")
            .when(full & (end == "monthly_reset"), "A3_exhausted_wait_reset")
            .when(end == "repurchase", "B1_underuse_repurchase")
            .when(end == "expired", "B2_underuse_churn")
            .otherwise("B3_underuse_continue"))
