"""Token cycles day by day: what a user's open cycle is, carried from day to day.

After each day there is one row per user: the grant in force, the last instant of each kind of boundary, the boundary the user
stands in with the use since, and the open cycle with its sums. A run folds the events of its new days only, as one more run of
the ordered pass of ``cycles``, entered with that state. Cycles that these days close are written beside the
state and never change again; users without an event keep their row. A late event is on a day that is read again: the run starts from
the state before that day, and what was written for the days from then on falls away with one commit.

Copies of an event have one id, and ids name the time they were made at, so a copy is at most
``copy_days`` away; of these days only the ids are read. Bans and package names are put on when the cycles are read, so a ban of today
also takes the cycles of earlier days out.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterglass import domain
from meterglass.functions import figures
from meterglass.operators import splitting
from meterglass.plans import cycles
from meterglass.sources import commits, days, tables

#: Days between copies of an event at most: its id's time is near its instant on both sides.
COPY_DAYS = 2 * domain.ID_BUFFER_HOURS // 24 + 1
_KEY = ("cycle_start_ts", "start_type", "subscriptionId", "packageId", "quota")
_CYCLE = ("cycle_index bigint, cycle_start_ts {ts}, start_type string, subscriptionId string, packageId bigint, quota bigint, "
          "cycle_end_ts {ts}, next_kind string, next_egg bigint, consumed bigint, usage_event_cnt bigint, "
          "cost decimal(38,6), exhaust_ts {ts}")
_STATE = ("userId string, grant bigint, starts bigint, last_Subscribe {ts}, last_MonthlyReset {ts}, last_MainExpired {ts}, "
          "cur struct<ts: {ts}, kind: string, subscriptionId: string, packageId: bigint, quota: bigint>, "
          "used bigint, seen bigint, open array<struct<{cycle}>>")
_CLOSED = f"userId string, {_CYCLE}, serving_cost_thb {domain.MONEY_SUM}"


def _schemas(events: DataFrame) -> tuple[str, str]:
    """Of the state and of closed cycles; instants have the type they have in the events."""
    kind = events.schema["eventTimeStamp"].dataType.simpleString()
    inner = _CYCLE.format(ts=kind).replace("(38,6)", "(38_6)").replace(" ", ": ").replace(",: ", ", ").replace("(38_6)", "(38,6)")
    return _STATE.format(ts=kind, cycle=inner), _CLOSED.format(ts=kind)


def _pieces(rows: DataFrame) -> DataFrame:
    """One row per user and boundary in force, with what the days add to it and where the user stands at its end."""
    order = F.struct("eventTimeStamp", "is_use", "event_id")
    at, kind = F.col("eventTimeStamp"), F.col("eventType")
    inside = cycles.in_cycle()
    starts = F.col("kept") & kind.isin(*domain.CYCLE_STARTS)
    reached = (F.col("cum_seen") > 0) & (F.col("cum_used") >= figures.exhaust_level(F.col("cycle_quota")))
    end = F.struct("last_grant", "cycle_ts", "cycle_kind", "cycle_subscription", "cycle_package", "cycle_quota",
                   "cycle_index", "cum_used", "cum_seen")
    return rows.groupBy(
        "userId", "cycle_index", F.col("cycle_ts").alias("cycle_start_ts"), F.col("cycle_kind").alias("start_type"),
        F.col("cycle_subscription").alias("subscriptionId"), F.col("cycle_package").alias("packageId"), F.col("cycle_quota").alias("quota"),
    ).agg(
        F.bool_or(inside | starts).alias("is_cycle"),
        F.max(F.when(F.col("following.ts").isNotNull(), F.col("following"))).alias("following"),
        F.sum(F.when(inside, F.col("used"))).alias("consumed"), F.count_if(inside).alias("usage_event_cnt"),
        F.sum(F.when(inside, F.col("totalCostThb"))).cast("decimal(38,6)").alias("cost"),
        F.min(F.when(inside & reached, at)).alias("exhaust_ts"),
        F.max(F.struct(order.alias("order"), end.alias("end"))).alias("end"),
        F.min(F.when(F.col("kept"), F.struct(at.alias("ts"), F.col("event_id"), kind.alias("kind"), F.col("eggToken").alias("egg")))).alias("first"),
        *[F.max(F.when(kind == b, at)).alias(f"last_{b}") for b in domain.BOUNDARIES])


def _same_user(left: DataFrame, right: DataFrame) -> Column:
    return left["userId"].eqNullSafe(right["userId"])


def advance(events: DataFrame, entering: DataFrame, seen: DataFrame | None, *, rows_per_run: int,
            store: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(closed cycles, state after) of some whole days of events, given the state before.

    ``store`` writes a frame and reads it back: the pass over the events ends there, all that follows is per user and cycle.
    """
    rows = cycles.rows_in_cycles(tables.b2c_events(events), lambda found: found, rows_per_run, entering, seen)
    state, closed = _schemas(events)
    pieces = store(_pieces(rows))
    now = pieces.groupBy("userId").agg(F.max("end").getField("end").alias("end"), F.min("first").alias("first"),
                                       *[F.max(f"last_{b}").alias(f"new_{b}") for b in domain.BOUNDARIES])
    before = entering.withColumnRenamed("userId", "was_user").withColumn("was", F.lit(True))
    now = now.join(before, F.col("userId").eqNullSafe(F.col("was_user")), "left")
    end = F.struct(*(F.col(f"end.cycle_{c}").alias(n) for c, n in (
        ("ts", "ts"), ("kind", "kind"), ("subscription", "subscriptionId"), ("package", "packageId"), ("quota", "quota"))))
    now = now.select(
        "userId", F.col("end.last_grant").alias("grant"), F.col("end.cycle_index").alias("starts"),
        *[F.coalesce(f"new_{b}", f"last_{b}").alias(f"last_{b}") for b in domain.BOUNDARIES],
        F.when(F.col("end.cycle_ts").isNotNull(), end).alias("cur"),
        F.col("end.cum_used").alias("used"), F.col("end.cum_seen").alias("seen"), "first", F.col("open").alias("entered"))
    now = store(now)

    # The cycle that was open ends at the user's first boundary of these days.
    entered = now.select("userId", "first", F.explode("entered").alias("c")).select("userId", "first", "c.*")
    ended = F.col("cycle_end_ts").isNotNull() | F.col("first").isNull()
    entered = entered.withColumns({n: F.when(ended, F.col(n)).otherwise(F.col(f"first.{f}")) for n, f in (
        ("next_kind", "kind"), ("next_egg", "egg"), ("cycle_end_ts", "ts"))}).drop("first")
    fresh = pieces.where("is_cycle").select(
        "userId", "cycle_index", *_KEY, F.col("following.ts").alias("cycle_end_ts"), F.col("following.kind").alias("next_kind"),
        F.col("following.egg").alias("next_egg"), "consumed", "usage_event_cnt", "cost", "exhaust_ts")
    parts = entered.unionByName(fresh)
    whole = parts.groupBy("userId", "cycle_index", *_KEY).agg(
        F.max(F.struct("cycle_end_ts", "next_kind", "next_egg")).alias("ending"), F.sum("consumed").alias("consumed"),
        F.sum("usage_event_cnt").alias("usage_event_cnt"), F.sum("cost").cast("decimal(38,6)").alias("cost"), F.min("exhaust_ts").alias("exhaust_ts"))
    whole = whole.select("userId", "cycle_index", *_KEY, "ending.*", "consumed", "usage_event_cnt", "cost", "exhaust_ts")
    # Cycles of the instant the user stands at are open together: usage to come belongs to all of them.
    standing = now.select(F.col("userId").alias("u"), F.when(F.col("cur.kind").isin(*domain.CYCLE_STARTS), F.col("cur.ts")).alias("open_ts"))
    whole = whole.join(standing, F.col("userId").eqNullSafe(F.col("u")), "left").drop("u")
    still = F.coalesce(F.col("cycle_start_ts") == F.col("open_ts"), F.lit(False))
    names = [c.split()[0] for c in closed.split(", ")]
    done = cycles.shared_start(whole.where(~still)).select(*names)
    left = whole.where(still).groupBy(F.col("userId").alias("u")).agg(
        F.collect_list(F.struct("cycle_index", *_KEY, "cycle_end_ts", "next_kind", "next_egg", "consumed", "usage_event_cnt",
                                "cost", "exhaust_ts")).alias("open"))
    touched = now.drop("first", "entered").join(left, F.col("userId").eqNullSafe(F.col("u")), "left").drop("u")
    # A user who has used tokens only leaves nothing to carry.
    touched = touched.where(F.col("starts").isNotNull() & (F.col("cur").isNotNull() | F.col("grant").isNotNull()))
    names = entering.columns
    others = entering.join(now.select("userId"), _same_user(entering, now), "left_anti")
    return done, touched.select(*names).unionByName(others.select(*names)).to(_typed(events, state))


def _typed(events: DataFrame, schema: str) -> T.StructType:
    return events.sparkSession.createDataFrame([], schema).schema


def empty_state(events: DataFrame) -> DataFrame:
    return events.sparkSession.createDataFrame([], _schemas(events)[0])


# ------------------------------------------------------------------- stored
@dataclass(frozen=True)
class Stored:
    """Which folders hold the cycles that each block of days closed, and the states that are still kept, by the block's last day;
    ``seen``: the version of each day of events that was read."""
    closed: dict[date, str]
    state: dict[date, str]
    seen: dict[date, str]

    @staticmethod
    def of(entries: Mapping[str, str]) -> Stored:
        found: dict[str, dict[date, str]] = {"closed": {}, "state": {}, "seen": {}}
        for key, folder in entries.items():
            kind, day = key.split(" ")
            found[kind][date.fromisoformat(day)] = folder
        return Stored(**found)

    def entries(self) -> dict[str, str]:
        return {f"{kind} {day}": folder for kind in ("closed", "state", "seen") for day, folder in getattr(self, kind).items()}

    def before(self, day: date, first: date) -> Stored:
        """What still holds where days from ``day`` on are read again: all up to the last state before it."""
        base = max((d for d in self.state if first <= d < day), default=first - timedelta(days=1))
        return Stored(*({d: f for d, f in kind.items() if d <= base} for kind in (self.closed, self.state)), dict(self.seen))


def blocks_of(first: date, last: date, single_days: int) -> list[tuple[date, date]]:
    """The days as one block and, at the end, ``single_days`` blocks of a day, before each of which a later run may start."""
    if first > last:
        return []
    edge = max(first, last - timedelta(days=single_days - 1))
    out = [(first, edge - timedelta(days=1))] if edge > first else []
    return out + [(edge + timedelta(days=n),) * 2 for n in range((last - edge).days + 1)]


def update(events: DataFrame, path: str, *, start_date: date, as_of: date, changed_from: date | None = None,
           versions: Mapping[date, str] | None = None,
           single_days: int = 1 + domain.LOOKBACK_DAYS, keep_states: int = 7, copy_days: int = COPY_DAYS, keep: int = 2,
           rows_per_run: int = splitting.ROWS_PER_RUN) -> list[tuple[date, date]]:
    """Bring the stored cycles up to the day before ``as_of``; gives the blocks of days that were read.

    ``changed_from``: the first day that was written since the last run (None: none that it has read); with ``versions`` of the days
    of events (``days.days_of``) it is found from those that the last run has seen, so a run that failed loses no change. The run starts from
    the last state before that day; where none is left, from the start. All blocks of a run become visible with one commit.
    """
    spark = events.sparkSession
    read = commits.last(spark, path)
    have = Stored.of(read.entries)
    last = as_of - timedelta(days=1)
    if versions is not None:
        versions = {d: v for d, v in versions.items() if start_date <= d <= last}
        changed_from = min(days.changed(versions, {d: v for d, v in have.seen.items() if start_date <= d <= last}), default=None)
    kept = have.before(min(changed_from or as_of, as_of), start_date)
    base = max(kept.state, default=None)
    schema = _typed(events, _schemas(events)[0])
    run = uuid.uuid4().hex
    scratch = iter(range(10 ** 9))

    def store(frame: DataFrame) -> DataFrame:
        place = f"{path}/data/work-{run}/{next(scratch)}"
        frame.write.parquet(place)
        return spark.read.schema(frame.schema).parquet(place)

    done = []
    for first, until in blocks_of(base + timedelta(days=1) if base else start_date, last, single_days):
        entering = spark.read.schema(schema).parquet(f"{path}/data/{kept.state[base]}") if base else empty_state(events)
        earlier = max(start_date, first - timedelta(days=copy_days))
        seen = tables.b2c_events(events.where(_between(earlier, first - timedelta(days=1)))).select("event_id")
        closed, state = advance(events.where(_between(first, until)), entering, seen if earlier < first else None,
                                rows_per_run=rows_per_run, store=store)
        for kind, frame, folders in (("closed", closed, kept.closed), ("state", state, kept.state)):
            folders[until] = f"{kind}-{until}-{run}"
            frame.write.parquet(f"{path}/data/{folders[until]}")
        base = until
        done.append((first, until))
    for day in sorted(kept.state)[:-keep_states]:
        del kept.state[day]
    kept.seen.update(versions or {})
    for day in [d for d in kept.seen if versions is not None and d not in versions]:
        del kept.seen[day]
    commits.remove(spark, f"{path}/data/work-{run}")
    if kept != have:
        commits.commit(spark, path, read, kept.entries())
        commits.prune(spark, path, keep, lambda entries: set(entries.values()))
    return done


def _between(first: date, last: date) -> Column:
    """Literals on the partition column, so that other days aren't opened."""
    return (F.col("date_id") >= F.lit(first)) & (F.col("date_id") <= F.lit(last))


def token_cycles(events: DataFrame, path: str, packages: DataFrame, users: DataFrame) -> DataFrame:
    """The stored cycles in the form of ``cycles.token_cycles``: closed ones, and open ones as of the last state.

    ``events`` gives types only and is not read.
    """
    spark = events.sparkSession
    have = Stored.of(commits.last(spark, path).entries)
    state, closed = (_typed(events, s) for s in _schemas(events))
    if not have.state:
        rows = spark.createDataFrame([], closed)
    else:
        rows = spark.read.schema(closed).parquet(*(f"{path}/data/{folder}" for folder in have.closed.values()))
        still = spark.read.schema(state).parquet(f"{path}/data/{have.state[max(have.state)]}")
        still = still.select("userId", F.explode("open").alias("c")).select("userId", "c.*")
        rows = rows.unionByName(cycles.shared_start(still).select(*closed.names))
    named = tables.b2c_packages(packages, "packageName").distinct()
    return cycles.measured(tables.without_banned(rows, users), named)
