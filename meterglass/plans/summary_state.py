"""The daily summaries kept day by day.

Stored per day, before bans, mapping and prices: counts per user and day, usage per user, day and model, and the first lifecycle row of
each (subscription, user) on that day. Over all days, the row that comes first for a subscription is its winner and counts on its
day; winners are stored on the days they count on. A run replaces the days that were written since, finds the subscriptions these
days (or a changed ban) touch, and compares their old winners with the new ones: a late first event takes the count from the day
that had it. Rewritten are the days with new rows, those that lose or gain a winner, and those of users whose ban or company changed; all
of them, in all tables, become visible with one commit. Names and prices are put on when the summary is read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterglass import domain
from meterglass.plans import summary
from meterglass.sources import commits, days, tables

_KEY = ("version", "kind", "subscriptionId")
PEOPLE = "people"


def _schema(spark: SparkSession, text: str) -> T.StructType:
    return spark.createDataFrame([], text).schema


def schemas(spark: SparkSession, instant: str) -> dict[str, T.StructType]:
    money = domain.MONEY_SUM
    first = f"version string, kind string, subscriptionId string, userId string, packageId bigint, eventTimeStamp {instant}, event_id string"
    return {name: _schema(spark, f"{text}, date_id date") for name, text in {
        "user_days": f"version string, packageId bigint, userId string, usage_events bigint, tokens bigint, cost {money}, resets bigint, others bigint",
        "model_days": "version string, aiModel string, packageId bigint, userId string, n bigint, tokens bigint, cost decimal(28,6)",
        "firsts": first, "winners": first,
        "daily": f"version string, packageId bigint, has_company_mapping boolean, active bigint, usage_events bigint, cost {money}, "
                 "resets bigint, others bigint, subs bigint, expirations bigint, tokens bigint",
        "models": f"version string, aiModel string, has_company_mapping boolean, packageId bigint, n bigint, tokens bigint, cost {money}, users bigint",
    }.items()}


def _first_of_day(folded: DataFrame) -> DataFrame:
    rows = folded.where(F.col("kind").isNotNull()).groupBy(*_KEY, "userId", "date_id").agg(
        F.min(F.struct(*summary.MOMENT, "packageId")).alias("first"))
    return rows.select(*_KEY, "userId", "first.packageId", *[f"first.{c}" for c in summary.MOMENT], "date_id")


def _winners(firsts: DataFrame, banned: DataFrame) -> DataFrame:
    """The first row of each subscription by users that aren't banned."""
    rows = firsts.join(banned, ["version", "userId"], "left_anti").groupBy(*_KEY).agg(
        F.min(F.struct(*summary.MOMENT, "date_id", "packageId", "userId")).alias("first"))
    return rows.select(*_KEY, "first.userId", "first.packageId", *[f"first.{c}" for c in summary.MOMENT], "first.date_id")


def _same(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    """Equal keys, missing ones included."""
    out = F.lit(True)
    for n in names:
        out = out & left[n].eqNullSafe(right[n])
    return out


def _people(b2c_users: DataFrame, mapped: DataFrame) -> DataFrame:
    """(version, userId, what): banned and mapped users."""
    banned = tables.banned_users(b2c_users).select(F.lit("B2C").alias("version"), "userId", F.lit("banned").alias("what"))
    return banned.unionByName(mapped.select("version", "userId", F.lit("mapped").alias("what"))).distinct()


def update(b2c_events: DataFrame, b2b_events: DataFrame, b2c_users: DataFrame, b2b_users: DataFrame, team: DataFrame,
           company: DataFrame, path: str, *, changed: Sequence[date] = (), versions: Mapping[str, Mapping[date, str]] | None = None,
           keep: int = 2) -> list[date]:
    """Bring the stored summaries up to the events, of which ``changed`` days were written since the last run; gives the days rewritten.

    ``versions``: of the days of events by segment (``days.days_of``); the changed days are then those whose version the last run has not
    seen, so a run that failed loses no change.
    """
    spark = b2c_events.sparkSession
    read = commits.last(spark, path)
    kinds = schemas(spark, b2c_events.schema["eventTimeStamp"].dataType.simpleString())
    run, entries = days.new_run(), dict(read.entries)
    for segment, now in (versions or {}).items():
        seen = f"seen-{segment}"
        changed = [*changed, *days.changed(now, days.days_of(entries, seen))]
        entries = {k: v for k, v in entries.items() if not k.startswith(f"{seen} ")} | {f"{seen} {d}": v for d, v in now.items()}
    changed = sorted(set(changed))

    def of(table: str, listed: dict[str, str], only: Sequence[date] | None = None) -> DataFrame:
        return days.read(spark, path, {k: v for k, v in listed.items() if not k.startswith(PEOPLE)}, table, kinds[table], only)

    def put(table: str, frame: DataFrame, replaced: Sequence[date]) -> None:
        names = [n for n in kinds[table].names if n != days.DAY] + [days.DAY]
        nonlocal entries
        entries = days.replaced(entries, table, replaced, days.write(frame.select(*names).hint("rebalance", days.DAY), path, table, run))

    # What the changed days hold now.
    inside = F.col("date_id").isin(*changed) if changed else F.lit(False)
    new_b2c, new_b2b = b2c_events.where(inside), b2b_events.where(inside)
    folded = summary.folded_events(new_b2c, new_b2b)
    put("user_days", folded.where(F.col("kind").isNull()), changed)
    put("firsts", _first_of_day(folded), changed)
    put("model_days", summary.model_user_days(new_b2c, new_b2b), changed)

    # Whose ban or company has changed.
    mapped = summary.mapped_users(b2b_users, team, company)
    folder = f"{path}/data/{days.folder_of(run, PEOPLE)}"
    _people(b2c_users, mapped).write.parquet(folder)
    people_type = _schema(spark, "version string, userId string, what string")
    people = spark.read.schema(people_type).parquet(folder)
    had = entries.get(PEOPLE)
    before = spark.read.schema(people_type).parquet(f"{path}/data/{days.folder_of(had, PEOPLE)}") if had else people
    entries[PEOPLE] = run
    moved = people.exceptAll(before).unionByName(before.exceptAll(people)).select("version", "userId").distinct()
    banned = people.where("what = 'banned'").select("version", "userId")

    # Subscriptions whose winner may have changed, and what it was and is.
    listed = dict(read.entries)
    firsts = of("firsts", entries)
    touched = (of("firsts", entries, changed).unionByName(of("firsts", listed, changed)).select(*_KEY)
               .unionByName(firsts.join(moved, ["version", "userId"], "left_semi").select(*_KEY)).distinct())
    stored_winners = of("winners", listed)
    old = stored_winners.join(touched, _same(stored_winners, touched, _KEY), "left_semi")
    new = _winners(firsts.join(touched, _same(firsts, touched, _KEY), "left_semi"), banned)
    new_path = f"{path}/data/{days.folder_of(run, 'work')}"
    (old.withColumn("is_new", F.lit(False)).unionByName(new.select(*old.columns).withColumn("is_new", F.lit(True)))
     .groupBy(*old.columns).agg(F.bool_or("is_new").alias("is_new"), F.count(F.lit(1)).alias("n")).write.parquet(new_path))
    both = spark.read.parquet(new_path)

    # Days to rewrite: a list no longer than the table has days.
    by_people = [of(t, entries).join(moved, ["version", "userId"], "left_semi").select("date_id")
                 for t in ("user_days", "model_days")] + [stored_winners.join(moved, ["version", "userId"], "left_semi").select("date_id")]
    found = both.where("n = 1").select("date_id")
    for frame in by_people:
        found = found.unionByName(frame)
    rewritten = sorted(set(changed) | {r[0] for r in found.distinct().collect()})
    if not rewritten and had and entries == dict(read.entries) | {PEOPLE: run}:
        commits.remove(spark, f"{path}/data/{days.RUN}={run}")
        return []

    on_days = of("winners", listed, rewritten)
    stay = on_days.join(touched, _same(on_days, touched, _KEY), "left_anti")
    now = both.where(F.col("is_new") & F.col("date_id").isin(*rewritten)) if rewritten else both.limit(0)
    put("winners", stay.unionByName(now.select(*stay.columns)), rewritten)

    # The rewritten days, folded from the stored rows.
    winners = of("winners", entries, rewritten).select(
        "version", "date_id", "packageId", "userId", (F.col("kind") == domain.SUBSCRIBE).cast("bigint").alias("subs"),
        (F.col("kind") == domain.MAIN_EXPIRED).cast("bigint").alias("expirations"))
    plain = of("user_days", entries, rewritten).join(banned, ["version", "userId"], "left_anti")
    put("daily", summary.daily_counts(summary.with_mapping_flag(plain.unionByName(winners, allowMissingColumns=True), mapped)), rewritten)
    models = of("model_days", entries, rewritten).join(banned, ["version", "userId"], "left_anti")
    put("models", summary.model_counts(summary.with_mapping_flag(models, mapped)), rewritten)
    commits.remove(spark, new_path)
    commits.commit(spark, path, read, entries)
    days.prune(spark, path, keep)
    return rewritten


def _listed(spark: SparkSession, path: str) -> dict[str, str]:
    return {k: v for k, v in commits.last(spark, path).entries.items() if k != PEOPLE}


def summary_daily(spark: SparkSession, path: str, b2c_packages: DataFrame, b2b_packages: DataFrame) -> DataFrame:
    """The stored days in the form of ``summary.summary_daily``."""
    counts = days.read(spark, path, _listed(spark, path), "daily", schemas(spark, "timestamp")["daily"])
    return summary.priced_daily(counts, summary.segment_packages(b2c_packages, b2b_packages))


def summary_model_daily(spark: SparkSession, path: str, b2c_packages: DataFrame, b2b_packages: DataFrame) -> DataFrame:
    """The stored days in the form of ``summary.summary_model_daily``."""
    counts = days.read(spark, path, _listed(spark, path), "models", schemas(spark, "timestamp")["models"])
    return summary.model_daily(counts, summary.segment_packages(b2c_packages, b2b_packages))
