"""Distinct users of any window, from bitmaps kept by day.

A user gets a number once: the users are dealt to GROUPS by a hash, each is the next of its group, and the numbers of all groups interleave, so
they are dense and no task numbers all users. Each day and segment holds the bits of its users, 32,768 to a bitmap. A week or a rolling window is the OR
of its days' bitmaps: exact, as it counts each user once however many days it was active, and as cheap as its days times users / 8 bytes.

A run replaces the bitmaps of the days that were written since and of the days on which a user whose ban has changed was active,
with one commit.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterglass.plans import reports
from meterglass.sources import commits, days

#: Groups that number their users side by side.
GROUPS = 4096
BITMAPS, NUMBERS, BANNED = "bitmaps", "numbers", "banned"
SCHEMA = T.StructType([T.StructField("version", T.StringType()), T.StructField("bucket", T.LongType()),
                       T.StructField("bitmap", T.BinaryType()), T.StructField("date_id", T.DateType())])
NUMBER_SCHEMA = T.StructType([T.StructField("userId", T.StringType()), T.StructField("number", T.LongType())])
_USERS = T.StructType([T.StructField("userId", T.StringType())])


def next_numbers(users: DataFrame, known: DataFrame) -> DataFrame:
    """(userId, number) of the users that have none yet."""
    group = F.pmod(F.xxhash64("userId"), F.lit(GROUPS))
    new = users.where(F.col("userId").isNotNull()).select("userId").distinct().join(known, "userId", "left_anti").withColumn("group", group)
    # At most a row for each group.
    taken = known.groupBy((F.col("number") % GROUPS).alias("group")).agg(((F.max("number") - F.col("group")) / GROUPS + 1).cast("bigint").alias("taken"))
    rank = F.row_number().over(W.partitionBy("group").orderBy("userId")) - 1
    return new.withColumn("rank", rank).join(taken, "group", "left").select(
        "userId", ((F.coalesce("taken", F.lit(0)) + F.col("rank")) * GROUPS + F.col("group")).alias("number"))


def bitmaps_of(user_days: DataFrame, numbers: DataFrame) -> DataFrame:
    """(version, date_id, bucket, bitmap) of rows (version, date_id, userId); a day without known users has one empty bitmap."""
    rows = user_days.select("version", "date_id", "userId").distinct().join(numbers, "userId", "left")
    return rows.groupBy("version", "date_id", F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bitmap"))


def days_with(bitmaps: DataFrame, users: DataFrame, numbers: DataFrame) -> DataFrame:
    """The days on which any of the users has a bit: there the bits of both are fewer together than one by one."""
    theirs = users.join(numbers, "userId").groupBy(F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("theirs"))
    both = bitmaps.join(theirs, "bucket").select("version", "date_id", "bucket", F.explode(F.array("bitmap", "theirs")).alias("b"))
    return both.groupBy("version", "date_id", "bucket").agg(
        F.sum(F.bitmap_count("b")).alias("each"), F.bitmap_count(F.bitmap_or_agg("b")).alias("together")).where(
        "each > together").select("date_id").distinct()


def active_users(bitmaps: DataFrame, end: Column, window: int) -> DataFrame:
    """As ``reports.active_users``: distinct users of the last ``window`` days and of those before them."""
    flags = reports.rolling(end, window)
    ored = bitmaps.groupBy("bucket").agg(*[F.bitmap_or_agg(F.when(c, F.col("bitmap"))).alias(n) for n, c in flags.items()])
    return ored.agg(*[F.coalesce(F.sum(F.bitmap_count(n)), F.lit(0)).alias(f"{n}_users") for n in flags])


def weekly_users(bitmaps: DataFrame, since: date) -> DataFrame:
    """As ``reports.weekly_users``: distinct users per Monday and segment."""
    ored = bitmaps.where(F.col("date_id") >= F.lit(since)).groupBy(reports.week_text(), "version", "bucket").agg(
        F.bitmap_count(F.bitmap_or_agg("bitmap")).alias("users"))
    return ored.groupBy("wk").agg(*[
        F.coalesce(F.sum(F.when(F.col("version") == v, F.col("users"))), F.lit(0)).alias(f"{v.lower()}_users") for v in ("B2C", "B2B")
    ]).orderBy("wk")


def users_between(bitmaps: DataFrame, first: date, last: date) -> DataFrame:
    """(version, users): distinct users of any span of days."""
    ored = bitmaps.where((F.col("date_id") >= F.lit(first)) & (F.col("date_id") <= F.lit(last))).groupBy("version", "bucket").agg(
        F.bitmap_count(F.bitmap_or_agg("bitmap")).alias("users"))
    return ored.groupBy("version").agg(F.sum("users").alias("users"))


# ------------------------------------------------------------------- stored
def _numbers(spark: SparkSession, path: str, entries: Mapping[str, str]) -> DataFrame:
    folders = [f"{path}/data/{days.folder_of(run, NUMBERS)}" for key, run in entries.items() if key.startswith(f"{NUMBERS} ")]
    return spark.read.schema(NUMBER_SCHEMA).parquet(*folders) if folders else spark.createDataFrame([], NUMBER_SCHEMA)


def update(user_days: DataFrame, banned: DataFrame, path: str, *, changed: Sequence[date] = (),
           versions: Mapping[str, Mapping[date, str]] | None = None, keep: int = 2) -> list[date]:
    """Bring the bitmaps up to ``user_days`` (version, date_id, userId; without banned users); gives the days rewritten.

    ``changed`` or ``versions``: as for ``summary_state.update``; ``banned``: (userId) of banned users.
    """
    spark = user_days.sparkSession
    read = commits.last(spark, path)
    run, entries = days.new_run(), dict(read.entries)
    for segment, now in (versions or {}).items():
        seen = f"seen-{segment}"
        changed = [*changed, *days.changed(now, days.days_of(entries, seen))]
        entries = {k: v for k, v in entries.items() if not k.startswith(f"{seen} ")} | {f"{seen} {d}": v for d, v in now.items()}

    folder = f"{path}/data/{days.folder_of(run, BANNED)}"
    banned.select("userId").distinct().write.parquet(folder)
    now = spark.read.schema(_USERS).parquet(folder)
    had = entries.get(BANNED)
    before = spark.read.schema(_USERS).parquet(f"{path}/data/{days.folder_of(had, BANNED)}") if had else now
    moved = now.exceptAll(before).unionByName(before.exceptAll(now))
    entries[BANNED] = run
    numbers = _numbers(spark, path, entries)
    stored = days.read(spark, path, entries, BITMAPS, SCHEMA)
    found = days_with(stored, moved, numbers).unionByName(user_days.join(moved, "userId", "left_semi").select("date_id"))
    # A list no longer than the table has days.
    rewritten = sorted(set(changed) | {r[0] for r in found.distinct().collect()})
    if not rewritten and had and entries == dict(read.entries) | {BANNED: run}:
        commits.remove(spark, f"{path}/data/{days.RUN}={run}")
        return []
    rows = user_days.where(F.col("date_id").isin(*rewritten) if rewritten else F.lit(False))
    next_numbers(rows, numbers).write.parquet(f"{path}/data/{days.folder_of(run, NUMBERS)}")
    # Runs are numbered, so that their order shows; a number once given stays.
    entries[f"{NUMBERS} {read.number + 1:012d}"] = run
    made = bitmaps_of(rows, _numbers(spark, path, entries)).select(*SCHEMA.names)
    entries = days.replaced(entries, BITMAPS, rewritten, days.write(made.hint("rebalance", days.DAY), path, BITMAPS, run))
    commits.commit(spark, path, read, entries)
    days.prune(spark, path, keep)
    return rewritten


def read(spark: SparkSession, path: str) -> DataFrame:
    return days.read(spark, path, commits.last(spark, path).entries, BITMAPS, SCHEMA)
