"""The daily run: masters, event days under a watermark, gold tables, views."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date, datetime, timezone
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterglass import domain
from meterglass.functions import calendar
from meterglass.operators import normalize
from meterglass.plans import behavior_state, cycle_state, deck, summary_state, tracking, user_bitmaps
from meterglass.session import scratch_path
from meterglass.sources import commits, documents, lake, tables
from meterglass.sources import days as day_tables
from meterglass.streaming import ingest as streaming

SUMMARY_SCHEMA = "stage string, rows bigint, first_day date, last_day date"
STREAM = "user_usage_event"
DAYS_PER_JOB = 31


def ingest_events(docs: DataFrame, events_path: str, state_path: str, *, name: str = STREAM,
                  start_date: date = domain.START_DATE, lookback_days: int = domain.LOOKBACK_DAYS,
                  today: date, rate: Decimal = domain.EXCHANGE_RATE, tz: str = domain.TIME_ZONE,
                  id_buffer_hours: int = domain.ID_BUFFER_HOURS, ingested_at: datetime | None = None,
                  days_per_job: int = DAYS_PER_JOB,
                  day_docs: Callable[[list[date]], DataFrame] | None = None) -> dict[date, int]:
    """Bring the event table up to yesterday; gives rows per processed day.

    A block of days is read, normalised and replaced as one job, and the watermark moves when the block is in place.
    If a block fails its days are done one by one, so the watermark stands at the day before the one that fails,
    whatever the size of a block. The watermark moves only from where this run has seen it: of two runs at once the second
    fails with ``commits.Conflict``. ``day_docs`` gives the documents of a block of days where they can be had without ``docs``, as from
    a dump that has been landed (``ingest_dump``). Documents that more than one job reads are landed first, by local day.
    """
    spark = docs.sparkSession
    position = lake.get_watermark(spark, state_path, name)
    window = calendar.date_window(watermark=position, start_date=start_date,
                                  lookback_days=lookback_days, today=today)
    days, written = lake.days_of(window), {}
    options = {"tz": tz, "id_buffer_hours": id_buffer_hours}

    def put(found: DataFrame, block: list[date]) -> None:
        rows = normalize.normalize_events(found, rate=rate, tz=tz, ingested_at=ingested_at)
        written.update(lake.replace_days(rows, events_path, block))
        nonlocal position
        lake.set_watermark(spark, state_path, name, block[-1], expected={name: position})
        position = block[-1]

    blocks = [days[at:at + days_per_job] for at in range(0, len(days), days_per_job)]
    landed = None
    if len(blocks) > 1 and day_docs is None:
        landed = documents.land(docs, days[0], days[-1], scratch_path(spark, "landed"), **options)
    for block in blocks:
        found = (day_docs(block) if day_docs else documents.landed_days(landed, block) if landed is not None
                 else documents.extract_days(docs, block[0], block[-1], **options))
        try:
            put(found, block)
        except commits.Conflict:
            raise
        except Exception:
            if len(block) == 1:
                raise
            if day_docs is None and landed is None:
                landed = documents.land(docs, block[0], block[-1], scratch_path(spark, "landed"), **options)
            for day in block:
                put(day_docs([day]) if day_docs else documents.landed_days(landed, [day]), [day])
    return written


def ingest_dump(spark: SparkSession, source_path: str, landed: str, checkpoint: str, events_path: str, state_path: str, *,
                tz: str = domain.TIME_ZONE, id_buffer_hours: int = domain.ID_BUFFER_HOURS, **options) -> dict[date, int]:
    """``ingest_events`` for a dump of JSON lines that grows by files: new files are landed by day, and a block opens its days alone."""
    streaming.land_files(spark, source_path, landed, checkpoint, tz=tz)
    return ingest_events(
        spark.createDataFrame([], "value string"), events_path, state_path, tz=tz, id_buffer_hours=id_buffer_hours,
        day_docs=lambda block: streaming.landed_days(spark, landed, block, tz=tz, id_buffer_hours=id_buffer_hours), **options)


def run_summary(spark: SparkSession, stages: Mapping[str, int | dict[date, int]]) -> DataFrame:
    """Rows per stage, with first and last day for stages counted per day."""
    rows = []
    for stage, count in stages.items():
        if isinstance(count, dict):
            days = sorted(count)
            rows.append((stage, sum(count.values()), days[0] if days else None, days[-1] if days else None))
        else:
            rows.append((stage, count, None, None))
    return spark.createDataFrame(rows, SUMMARY_SCHEMA)


def table_path(root: str, segment: str, table: str) -> str:
    return f"{root}/{segment}/{table}"


MASTERS = {
    ("B2C", "package"): (normalize.normalize_packages, domain.PACKAGE_SCHEMA),
    ("B2C", "users"): (normalize.normalize_users, domain.USERS_SCHEMA),
    ("B2B", "package"): (normalize.normalize_packages, domain.PACKAGE_SCHEMA),
    ("B2B", "users"): (normalize.normalize_b2b_users, domain.B2B_USERS_SCHEMA),
    ("B2B", "company"): (normalize.normalize_b2b_company, domain.COMPANY_SCHEMA),
    ("B2B", "team"): (normalize.normalize_b2b_team, domain.TEAM_SCHEMA),
}


def daily_run(sources: Mapping[tuple[str, str], DataFrame], root: str, *, today: date | None = None,
              start_date: date = domain.START_DATE, lookback_days: int = domain.LOOKBACK_DAYS,
              rate: Decimal = domain.EXCHANGE_RATE, tz: str = domain.TIME_ZONE,
              id_buffer_hours: int = domain.ID_BUFFER_HOURS, mature_days: int = domain.MATURE_DAYS,
              database: str = "usage", keep: int = 3) -> DataFrame:
    """Everything one day needs, in order; gives the run summary.

    ``sources`` holds the document frame of each (segment, collection): ``events`` and
    the masters above. Derived tables and both summaries are written once and read back, so reports
    never repeat the work on events that built them. Cycles and summaries read the days that this run has written and what is stored
    of the days before. Every table has a catalog view, in database ``database``, that follows its versions; versions and days that
    the last ``keep`` runs don't name are removed at the end.
    """
    spark = next(iter(sources.values())).sparkSession
    today = today or calendar.today_local(tz)
    now = datetime.now(timezone.utc)
    stages: dict[str, int | dict[date, int]] = {}

    def path(segment: str, table: str) -> str:
        return table_path(root, segment, table)

    def table(segment: str, name: str) -> DataFrame:
        return lake.read_table(spark, path(segment, name))

    versioned = list(MASTERS)

    def gold(stage: str, segment: str, frame: DataFrame, **options) -> None:
        versioned.append((segment, stage))
        stages[stage] = lake.rebuild_gold(frame, path(segment, stage), name=f"{database}.{stage}", **options)

    lake.ensure_database(spark, database)
    for (segment, collection), (normalizer, schema) in MASTERS.items():
        rows = normalizer(sources[segment, collection], ingested_at=now)
        stages[f"{segment} {collection}"] = lake.replace_table(
            rows, path(segment, collection), schema, name=f"{database}.{collection}_{segment.lower()}")
    for segment in ("B2C", "B2B"):
        stages[f"{segment} events"] = ingest_events(
            sources[segment, "events"], path(segment, STREAM), path(segment, "state"), start_date=start_date,
            lookback_days=lookback_days, today=today, rate=rate, tz=tz, id_buffer_hours=id_buffer_hours,
            ingested_at=now)
        lake.ensure_event_table(spark, f"{database}.{STREAM}_{segment.lower()}", path(segment, STREAM))
        lake.state_view(spark, f"{database}.state_{segment.lower()}", path(segment, "state"))

    versions = {s: day_tables.days_of(commits.last(spark, path(s, STREAM)).entries, lake.EVENTS) for s in ("B2C", "B2B")}
    b2c, b2b = (lake.read_events(spark, path(segment, STREAM)) for segment in ("B2C", "B2B"))
    bounds = {"start_date": start_date, "as_of": today}
    gold("user_tracking_b2c", "B2C", tracking.user_tracking_b2c(
        b2c, table("B2C", "package"), table("B2C", "users"), **bounds), partition="date_id")
    cycle_state.update(b2c, path("B2C", "cycle_state"), versions=versions["B2C"], single_days=1 + lookback_days, **bounds)
    cycle_days = cycle_state.token_cycles(b2c, path("B2C", "cycle_state"), table("B2C", "package"), table("B2C", "users")).withColumn(
        "cycle_start_date", F.to_date("cycle_start_ts"))
    gold("user_token_cycle", "B2C", cycle_days, partition="cycle_start_date", cluster=("userId", "cycle_index"))
    behavior_state.update(b2c, path("B2C", "behavior_state"), versions=versions["B2C"], **bounds)
    gold("user_repeat_behavior", "B2C", behavior_state.repeat_behavior(
        table("B2C", "user_token_cycle"), path("B2C", "behavior_state"), b2c, table("B2C", "package"), table("B2C", "users"),
        tz=tz, mature_days=mature_days, **bounds))
    gold("user_tracking_b2b", "B2B", tracking.user_tracking_b2b(
        b2b, table("B2B", "package"), table("B2B", "users"), table("B2B", "team"), table("B2B", "company"), **bounds),
        partition="date_id", cluster=("companyId", "userId"))

    day_b2b = table("B2B", "user_tracking_b2b")
    base = (b2c, b2b, table("B2C", "package"), table("B2B", "package"), table("B2C", "users"))
    mapping = (table("B2B", "users"), table("B2B", "team"), table("B2B", "company"))
    daily = path("total", "summary_state")
    summary_state.update(b2c, b2b, base[4], *mapping, daily, versions=versions)
    gold("summary_daily", "total", summary_state.summary_daily(spark, daily, *base[2:4]), partition="date_id", cluster=("version",))
    gold("summary_model_daily", "total", summary_state.summary_model_daily(spark, daily, *base[2:4]), partition="date_id", cluster=("version",))
    tracked = table("B2C", "user_tracking_b2c").select(F.lit("B2C").alias("version"), "date_id", "userId").unionByName(
        day_b2b.select(F.lit("B2B").alias("version"), "date_id", "userId"))
    user_bitmaps.update(tracked, tables.banned_users(base[4]), path("total", "user_bitmaps"), versions=versions)
    gold("slide_metrics", "total", deck.slide_metrics(*base, day_b2b), cluster=())
    gold("slide_company_size", "total", deck.company_size(day_b2b), cluster=())
    gold("slide_new_users_weekly", "total", deck.new_users_weekly(deck.subscriptions(b2c, b2b, base[4])), cluster=())
    lake.create_views(spark, tracking_views(database, table("B2C", "user_tracking_b2c").schema, day_b2b.schema))
    for segment in ("B2C", "B2B"):
        day_tables.prune(spark, path(segment, STREAM), keep)
    for (segment, stage) in versioned:
        lake.drop_old_versions(spark, path(segment, stage), keep)
    return run_summary(spark, stages)


def tracking_views(database: str, b2c: T.StructType, b2b: T.StructType) -> dict[str, str]:
    """Union and compatibility views over the stored tracking tables, by name."""
    kinds = {"version": "string"} | {f.name: f.dataType.simpleString() for f in (*b2c, *b2b)}

    def listed(columns: tuple[str, ...], own: tuple[str, ...], segment: str) -> str:
        out = []
        for c in columns:
            value = f"'{segment}'" if c == "version" else f"`{c}`" if c in own else "NULL"
            value = f"CAST({value} AS {kinds[c]})"
            out.append(f"{value} AS `{c}`" if kinds[c] != "string" else f"coalesce({value}, '{domain.NULL_TEXT}') AS `{c}`")
        return ", ".join(out)

    def compat(source: str) -> str:
        columns = (f"try_cast({c} AS BIGINT) AS {c}" if c in ("month_id", "week_id") else f"`{c}`" for c in COMPAT[source])
        return f"SELECT {', '.join(columns)} FROM {database}.{source}"

    total = " UNION ALL ".join(f"SELECT {listed(tracking.TOTAL_COLUMNS, own, segment)} FROM {database}.user_tracking_{segment.lower()}"
                               for segment, own in (("B2C", tracking.B2C_COLUMNS), ("B2B", tracking.B2B_COLUMNS)))
    return {f"{database}.user_tracking_total": total} | {f"{database}.{source}_compat": compat(source) for source in COMPAT}


COMPAT = {"user_tracking_b2c": tracking.B2C_COLUMNS, "user_tracking_b2b": tracking.B2B_COLUMNS, "user_tracking_total": tracking.TOTAL_COLUMNS}
