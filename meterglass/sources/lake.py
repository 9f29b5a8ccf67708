"""Stored tables: whole-day replacement, full reload, gold rebuild, watermark.

A block of event days is written beside the old days and becomes visible, emptied days included, with one
numbered commit (``days``). Masters and derived
tables are written as a new version beside the old one; one appended pointer row,
and the catalog view of the table, then switch to it. The positions of runs are a table of a few rows, merged by name and
committed only on top of the version that was read. In all cases a lost executor
or a failed job leaves the old rows readable.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from datetime import date, datetime, timedelta

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterglass import domain
from meterglass.sources import commits
from meterglass.sources import days as day_tables

CLUSTER = ("userId", "eventType")


class SchemaDrift(ValueError):
    """Columns differ from the table's schema."""


class WrongDay(ValueError):
    """Rows belong to a day outside the replaced ones."""


class MissingValue(ValueError):
    """A required column has no value."""


def days_of(window: tuple[date, date] | None) -> list[date]:
    if window is None:
        return []
    first, last = window
    return [first + timedelta(days=n) for n in range((last - first).days + 1)]


# ------------------------------------------------------------------- guards
def check_columns(frame: DataFrame, schema: T.StructType) -> None:
    want = schema.names
    if frame.columns != want:
        missing, extra = sorted(set(want) - set(frame.columns)), sorted(set(frame.columns) - set(want))
        raise SchemaDrift(f"schema drift: missing {missing}, extra {extra}")


def rows_per_day(frame: DataFrame) -> DataFrame:
    return frame.groupBy("date_id").agg(F.count(F.lit(1)).alias("rows"))


def validate_days(frame: DataFrame, days: Sequence[date], schema: T.StructType = domain.EVENT_SCHEMA) -> dict[date, int]:
    """Check columns and days; gives the rows of every asked day (zero if empty).

    The pass reads the day only. What comes back has one row per day in the frame,
    and foreign days are cut to a few for the message.
    """
    check_columns(frame, schema)
    counts = rows_per_day(frame)
    inside = F.col("date_id").isin(*days) if days else F.lit(False)
    strays = counts.where(~inside | F.col("date_id").isNull()).limit(5).collect()
    if strays:
        raise WrongDay(f"rows with a date_id outside the replaced days: {[(r.date_id, r.rows) for r in strays]}")
    found = {r.date_id: r.rows for r in counts.where(inside).collect()}
    return {day: found.get(day, 0) for day in days}


# -------------------------------------------------------------------- sinks
def _clustered(frame: DataFrame, partition: str | None, cluster: Sequence[str]) -> DataFrame:
    """Even files, each sorted by the cluster columns.

    ``rebalance`` lets adaptive execution cut a heavy day (or user) into several
    files and join light ones, where hashing on the day would send it to one task.
    """
    frame = frame.hint("rebalance", *([partition] if partition else []))
    return frame.sortWithinPartitions(*([partition] if partition else []), *cluster)


def _or_fail(good: Column, value: Column, kind: type, message: str) -> Column:
    """The value of good rows; any other row fails the job, before anything is committed."""
    return F.when(good, value).otherwise(F.raise_error(F.lit(f"{kind.__name__}: {message}")))


def guarded(frame: DataFrame, schema: T.StructType) -> DataFrame:
    """The frame with its required columns checked as they are written."""
    check_columns(frame, schema)
    return frame.withColumns({
        f.name: _or_fail(F.col(f.name).isNotNull(), F.col(f.name), MissingValue, f"no value in required column {f.name}")
        for f in schema if not f.nullable})


@contextmanager
def _guard_errors() -> Iterator[None]:
    """Failures that a guard raised in a task, as the guard's own error."""
    try:
        yield
    except Exception as error:
        for kind in (WrongDay, MissingValue):
            at = str(error).find(f"{kind.__name__}: ")
            if at >= 0:
                raise kind(str(error)[at:].split(": ", 1)[1].splitlines()[0]) from error
        raise


def _observed(counts: Observation, frame: DataFrame) -> dict[str, int]:
    """What was counted in the pass that wrote the frame; a plan known to be empty counts nothing."""
    try:
        return counts.get
    except Py4JJavaError:
        if not frame.isEmpty():
            raise
        return {}


EVENTS = "events"


def replace_days(frame: DataFrame, path: str, days: Sequence[date],
                 schema: T.StructType = domain.EVENT_SCHEMA) -> dict[date, int]:
    """Replace whole days at once; a day with no rows ends up empty. Gives rows per day.

    The frame is computed once: days and required columns are checked, and rows counted, in the
    pass that writes. Readers see all old or all new days, also after a failure.
    """
    if not days:
        check_columns(frame, schema)
        return {}
    spark = frame.sparkSession
    inside = F.coalesce(F.col("date_id").isin(*days), F.lit(False))
    rows = guarded(frame, schema).withColumn("date_id", _or_fail(
        inside, F.col("date_id"), WrongDay, "rows with a date_id outside the replaced days"))
    counts = Observation()
    rows = rows.observe(counts, *(F.count_if(F.col("date_id") == F.lit(day)).alias(str(day)) for day in days))
    run = day_tables.new_run()
    with _guard_errors():
        new = day_tables.write(_clustered(rows, "date_id", CLUSTER), path, EVENTS, run)
    seen = _observed(counts, frame)
    commits.change(spark, path, lambda entries: day_tables.replaced(entries, EVENTS, days, new))
    return {day: seen.get(str(day), 0) for day in days}


REJECTS, REASON = "rejects", "reject_reason"


class TooManyRejects(ValueError):
    """More rows were rejected than the load may lose."""


def event_rules(days: Sequence[date], schema: T.StructType = domain.EVENT_SCHEMA) -> dict[str, Column]:
    """What makes a row bad, by the reason that is noted: a required column without a value, a day that isn't loaded."""
    rules = {f"no {f.name}": F.col(f.name).isNull() for f in schema if not f.nullable}
    outside = ~F.col("date_id").isin(*days) if days else F.lit(True)
    return rules | {"other day": F.coalesce(outside, F.lit(False))}


def reasons(rules: Mapping[str, Column]) -> Column:
    """All reasons that hold for a row, in the rules' order; null for a good row."""
    text = F.concat_ws("; ", *(F.when(F.coalesce(bad, F.lit(True)), F.lit(name)) for name, bad in rules.items()))
    return F.nullif(text, F.lit(""))


def replace_days_gated(frame: DataFrame, path: str, days: Sequence[date], schema: T.StructType = domain.EVENT_SCHEMA, *,
                       rules: Mapping[str, Column] | None = None, max_rejects: int = 0) -> tuple[dict[date, int], dict[str, int]]:
    """``replace_days`` that sets bad rows aside; gives the good rows per day and the bad ones per reason.

    One job reads the frame, writes good rows and bad ones with their reasons, and counts both. With more than ``max_rejects`` bad
    rows nothing becomes visible. Rejects lie beside the events, on their day, or on the last replaced one if theirs is another, and
    are replaced with these days.
    """
    check_columns(frame, schema)
    if not days:
        return {}, {}
    spark = frame.sparkSession
    rules = rules or event_rules(days, schema)
    rows = frame.withColumn(REASON, reasons(rules))
    good = F.col(REASON).isNull()
    counts = Observation()
    rows = rows.observe(
        counts, F.count_if(~good).alias("bad"), *(F.count_if(good & (F.col("date_id") == F.lit(d))).alias(f"day {d}") for d in days),
        *(F.count_if(F.coalesce(bad, F.lit(True))).alias(f"rule {name}") for name, bad in rules.items()))
    inside = F.coalesce(F.col("date_id").isin(*days), F.lit(False))
    rows = rows.withColumns({"rejected_date_id": F.when(~good, F.col("date_id")),
                             day_tables.TABLE: F.when(good, EVENTS).otherwise(REJECTS),
                             "date_id": F.when(inside, F.col("date_id")).otherwise(F.lit(max(days)))})
    run = day_tables.new_run()
    rows = rows.hint("rebalance", day_tables.TABLE, "date_id").sortWithinPartitions(day_tables.TABLE, "date_id", *CLUSTER)
    new = day_tables.write_tables(rows, path, (EVENTS, REJECTS), run)
    seen = _observed(counts, frame)
    bad = seen.get("bad", 0)
    if bad > max_rejects:
        commits.remove(spark, f"{path}/data/{day_tables.RUN}={run}")
        raise TooManyRejects(f"{bad} rows rejected, {max_rejects} allowed: " + ", ".join(
            f"{n} {name[5:]}" for name, n in seen.items() if name.startswith("rule ") and n))

    def entries(old: Mapping[str, str]) -> dict[str, str]:
        for table in (EVENTS, REJECTS):
            old = day_tables.replaced(old, table, days, new[table])
        return dict(old)
    commits.change(spark, path, entries)
    return ({day: seen.get(f"day {day}", 0) for day in days},
            {name: seen[f"rule {name}"] for name in rules if seen.get(f"rule {name}")})


def read_rejects(spark: SparkSession, path: str, schema: T.StructType = domain.EVENT_SCHEMA) -> DataFrame:
    """Rejected rows with their reasons, under their own ``date_id``."""
    loose = T.StructType([T.StructField(f.name, f.dataType) for f in schema] + [T.StructField(REASON, T.StringType()), T.StructField(
        "rejected_date_id", T.DateType())])
    rows = day_tables.read(spark, path, commits.last(spark, path).entries, REJECTS, loose)
    return rows.withColumn("date_id", F.col("rejected_date_id")).drop("rejected_date_id")


def replace_day(frame: DataFrame, path: str, day: date) -> int:
    return replace_days(frame, path, [day])[day]


def read_events(spark: SparkSession, path: str, schema: T.StructType = domain.EVENT_SCHEMA) -> DataFrame:
    """The event table in schema order; no inference, so a new table reads as empty."""
    listed = commits.last(spark, path)
    if listed.number or commits.names_in(spark, f"{path}/data"):
        return day_tables.read(spark, path, listed.entries, EVENTS, schema)
    return spark.read.schema(schema).parquet(path).select(*schema.names)


VERSIONS = "version string, at timestamp"


def publish(frame: DataFrame, path: str, *, partition: str | None = None, cluster: Sequence[str] = (),
            name: str | None = None) -> int:
    """Write a new version of a table and switch to it; gives its row count, taken as it is written.

    The old version stays until the new one is whole, and readers of it are not disturbed. ``name``: catalog view
    over the current version, so views that read it by name follow.
    """
    spark = frame.sparkSession
    version, counts = uuid.uuid4().hex, Observation()
    folder = f"{path}/data/{version}"
    rows = frame.observe(counts, F.count(F.lit(1)).alias("rows"))
    rows = _clustered(rows, partition, cluster) if partition or cluster else rows
    with _guard_errors():
        (rows.write.partitionBy(partition) if partition else rows.write).parquet(folder)
    spark.range(1).select(F.lit(version).alias("version"), F.current_timestamp().alias("at")).write.mode("append").parquet(f"{path}/versions")
    if name:
        columns = ", ".join(f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in frame.schema)
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {columns} FROM parquet.`{folder}`")
    return _observed(counts, frame).get("rows", 0)


def current_version(spark: SparkSession, path: str) -> str:
    """Folder of the version published last."""
    last = spark.read.schema(VERSIONS).parquet(f"{path}/versions").agg(F.max_by("version", "at")).first()[0]
    return f"{path}/data/{last}"


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(current_version(spark, path))


def drop_old_versions(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Remove all but the versions published last; for use when no reader can still hold an older one."""
    log = spark.read.schema(VERSIONS).parquet(f"{path}/versions").orderBy(F.desc("at")).collect()
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/data")
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    kept = {row.version for row in log[:keep]}
    old = [f.getPath() for f in files.listStatus(folder) if f.getPath().getName() not in kept]
    return sum(files.delete(p, True) for p in old)


def publish_bucketed(frame: DataFrame, name: str, path: str, keys: Sequence[str], order: Sequence[str], buckets: int, keep: int = 2) -> int:
    """A new version of a table whose files are dealt by the keys' hash and sorted in themselves, behind the catalog view ``name``.

    Joins, windows and groupings by these keys read it without a shuffle. The view switches when the version is whole; tables of
    versions before the last ``keep`` are dropped with their files. Gives the row count.
    """
    spark, counts = frame.sparkSession, Observation()
    database, _, short = name.rpartition(".")
    at = f"{database}." if database else ""
    rows = frame.observe(counts, F.count(F.lit(1)).alias("rows")).repartition(buckets, *keys).sortWithinPartitions(*keys, *order)
    number = commits.last(spark, path).number + 1
    table = f"{short}_v{number:06d}_{uuid.uuid4().hex[:8]}"
    (rows.write.bucketBy(buckets, *keys).sortBy(*keys, *order).option("path", f"{path}/data/{table}").format("parquet")
     .saveAsTable(f"{at}{table}"))
    listed = commits.change(spark, path, lambda entries: {f"{number:06d}": table} | dict(sorted(entries.items())[-keep + 1:] if keep > 1 else ()))
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {at}{table}")
    for row in spark.sql(f"SHOW TABLES IN {database or 'default'} LIKE '{short}_v*'").collect():
        if row.tableName not in listed.entries.values():
            spark.sql(f"DROP TABLE IF EXISTS {at}{row.tableName}")
    commits.prune(spark, path, 1, lambda entries: set(entries.values()))
    return _observed(counts, frame).get("rows", 0)


def replace_table(frame: DataFrame, path: str, schema: T.StructType, name: str | None = None) -> int:
    """Full reload of a master table."""
    return publish(guarded(frame, schema), path, name=name)


def rebuild_gold(frame: DataFrame, path: str, *, partition: str | None = None,
                 cluster: Sequence[str] = ("userId",), name: str | None = None) -> int:
    """Create or replace a derived table; gives its row count."""
    return publish(frame, path, partition=partition, cluster=cluster, name=name)


def create_views(spark: SparkSession, views: Mapping[str, str]) -> list[str]:
    """Catalog views by their SQL; they read tables by name, so they follow every rebuild."""
    for name, text in views.items():
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS {text}")
    return list(views)


# ------------------------------------------------------------------ catalog
def ensure_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def _ensure_table(spark: SparkSession, name: str, path: str, schema: T.StructType, partition: str | None) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    by = f" PARTITIONED BY (`{partition}`)" if partition else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{by} LOCATION '{path}'")


def ensure_event_table(spark: SparkSession, name: str, path: str) -> None:
    """Catalog entry over the event days that are listed now, partitioned by local day."""
    _ensure_table(spark, name, path, domain.EVENT_SCHEMA, "date_id")
    listed = day_tables.locations(path, commits.last(spark, path).entries, EVENTS)
    known = [r[0].removeprefix("date_id=") for r in spark.sql(f"SHOW PARTITIONS {name}").collect()]
    if known:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS " + ", ".join(f"PARTITION (date_id = '{day}')" for day in known))
    if listed:
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS " + " ".join(
            f"PARTITION (date_id = '{day}') LOCATION '{folder}'" for day, folder in sorted(listed.items())))


def ensure_state_table(spark: SparkSession, name: str, path: str) -> None:
    _ensure_table(spark, name, path, domain.STATE_SCHEMA, None)


# ---------------------------------------------------------------- watermark
STATE = "state"


def latest_state(log: DataFrame) -> DataFrame:
    """One row per name: the last one written."""
    moment = F.struct("updated_at", "last_processed_date")
    return log.groupBy("pipeline_name").agg(F.max(moment).alias("m")).select(
        "pipeline_name", "m.last_processed_date", "m.updated_at")


def find_watermark(state: DataFrame, name: str) -> DataFrame:
    """Point lookup: at most one row."""
    return state.where(F.col("pipeline_name") == name).select("last_processed_date").limit(1)


def merged_state(state: DataFrame, updates: DataFrame) -> DataFrame:
    """Upsert by name: matched rows take the new values, unmatched ones are added, all others stay."""
    columns = domain.STATE_SCHEMA.names
    both = state.select(*columns, F.lit(0).alias("is_new")).unionByName(updates.select(*columns, F.lit(1).alias("is_new")))
    values = F.max_by(F.struct("last_processed_date", "updated_at"), "is_new").alias("v")
    return both.groupBy("pipeline_name").agg(values).select("pipeline_name", "v.*")


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """One row per name. No rows before the first run; a state that can't be read is an error."""
    return _state_of(spark, path, commits.last(spark, path))


def _state_of(spark: SparkSession, path: str, listed: commits.Commit) -> DataFrame:
    if listed.number:
        return spark.read.schema(domain.STATE_SCHEMA).parquet(f"{path}/data/{listed.entries[STATE]}")
    # A log of positions as older versions kept it. Listed first, as before the first run there is no folder, or one without files.
    if not [n for n in commits.names_in(spark, path) if n not in ("commits", "data") and n[0] not in "._"]:
        return spark.createDataFrame([], domain.STATE_SCHEMA)
    log = spark.read.parquet(path)
    return latest_state(log.select(*domain.STATE_SCHEMA.names))


def get_watermark(spark: SparkSession, path: str, name: str) -> date | None:
    row = find_watermark(read_state(spark, path), name).first()
    return row.last_processed_date if row else None


def merge_state(updates: DataFrame, path: str, expected: Mapping[str, date | None] | None = None, keep: int = 10) -> None:
    """Upsert rows of the state by name. A merge on top of a version that another run has replaced is made again on the new one.

    ``expected``: positions (None: no row) that the names must still have, or the merge fails with ``commits.Conflict``: of two runs that
    started from one position, only one can move it.
    """
    repeated = updates.groupBy("pipeline_name").count().where("count > 1 OR pipeline_name IS NULL").first()
    if repeated:
        raise ValueError(f"an upsert needs one row per name: {repeated.pipeline_name}")
    _merge(updates, path, expected, keep)


def _merge(updates: DataFrame, path: str, expected: Mapping[str, date | None] | None, keep: int) -> None:
    spark = updates.sparkSession
    for _ in range(20):
        read = commits.last(spark, path)
        state = _state_of(spark, path, read)
        for name, day in (expected or {}).items():
            now = find_watermark(state, name).first()
            if (now.last_processed_date if now else None) != day:
                raise commits.Conflict(f"the position of {name} is {now and now.last_processed_date}, not {day}")
        version = uuid.uuid4().hex
        merged_state(state, updates).select(*domain.STATE_SCHEMA.names).coalesce(1).write.parquet(f"{path}/data/{version}")
        try:
            commits.commit(spark, path, read, {STATE: version})
        except commits.Conflict:
            commits.remove(spark, f"{path}/data/{version}")
            continue
        _drop_old_states(spark, path, keep)
        return
    raise commits.Conflict(f"no commit of {path} came through")


def _drop_old_states(spark: SparkSession, path: str, keep: int) -> None:
    """Old versions of these few rows. Another run's version, written and not yet committed, must stay, so only listed ones go."""
    lists = commits.recent(spark, path, 2 * keep)
    if len(lists) == 2 * keep:
        for entries in lists[:keep]:
            commits.remove(spark, f"{path}/data/{entries[STATE]}")
        commits.drop_before(spark, path, keep)


def set_watermark(spark: SparkSession, path: str, name: str, day: date, at: datetime | None = None, *,
                  expected: Mapping[str, date | None] | None = None, keep: int = 10) -> None:
    """Upsert one position; see ``merge_state``."""
    row = spark.range(1).select(
        F.lit(name).alias("pipeline_name"), F.lit(day).alias("last_processed_date"),
        (F.lit(at) if at else F.current_timestamp()).alias("updated_at"))
    _merge(row, path, expected, keep)


def state_view(spark: SparkSession, name: str, path: str) -> None:
    """Catalog view over the positions in force."""
    listed = commits.last(spark, path)
    if listed.number:
        columns = ", ".join(f"`{f.name}`" for f in domain.STATE_SCHEMA)
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {columns} FROM parquet.`{path}/data/{listed.entries[STATE]}`")
