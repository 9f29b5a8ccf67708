"""Scans, sinks, normalisers and the streaming face."""

from __future__ import annotations

import uuid
from datetime import date, datetime, timezone
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterglass import domain
from meterglass.functions import calendar, figures, values
from meterglass.operators import dedup, normalize
from meterglass.plans import deck, ingest, summary, tracking
from meterglass.registry import behavior as behaviour
from meterglass.registry import deck as decks
from meterglass.registry import summary as facts
from meterglass.registry import tracking as tracked
from meterglass.registry.common import on_sample, plain_time, register
from meterglass.registry.sql import AS_OF, START, WINDOWED, query
from meterglass.session import scratch_path
from meterglass.sources import documents, lake, sample, tables
from meterglass.streaming import ingest as streaming

DAY = date(2024, 1, 15)
NOW = datetime(2024, 2, 1, tzinfo=timezone.utc)
IN_DAY = """"eventTimeStamp" >= TIMESTAMP '2024-01-14 17:00:00' AND "eventTimeStamp" < TIMESTAMP '2024-01-15 17:00:00'"""
EVENT = ('event_id, "eventTimeStamp", date_id, "userId", "eventType", "subscriptionId", "packageId", "eggToken", '
         '"chatToken", "totalCostUsd", "totalCostThb", "aiModel"')


def both(s):
    return s.b2c_events.unionByName(s.b2b_events)


# ------------------------------------------------------------------- scans
on_sample("scan_event_day", query(f"SELECT {EVENT} FROM dom WHERE {IN_DAY}"))(lambda s: tables.scan_day(both(s), DAY))
on_sample("scan_id_range", query(f"""SELECT event_id, "userId", "eventType" FROM dom WHERE {IN_DAY}"""))(
    lambda s: tables.scan_day(both(s), DAY, id_buffer_hours=24, columns=("event_id", "userId", "eventType")))


@register("scan_full_master", "SELECT p_partkey, p_name, p_retailprice FROM part")
def _(spark, sf_dir):
    return documents.read_full(spark, f"{sf_dir}/part.parquet", ("p_partkey", "p_name", "p_retailprice"), "parquet")


@register("project_event_fields", query("""
  SELECT event_id AS _id, "userId", "eventType", "packageId", "eggToken", CAST(NULL AS VARCHAR) AS "agentId"
  FROM dom"""))
def _(spark, sf_dir):
    docs = documents.project(sample.event_documents(spark, sf_dir), domain.EVENT_FIELDS)
    return docs.select(F.col("_id").getField("$oid").alias("_id"), "userId", "eventType", "packageId", "eggToken",
                       "agentId")


@register("project_master_fields", """
  SELECT CAST(c_custkey AS VARCHAR) AS "userId", CAST(c_nationkey AS VARCHAR) AS "teamId", c_mktsegment AS "teamName"
  FROM customer""")
def _(spark, sf_dir):
    return documents.project(sample.user_documents(spark, sf_dir), domain.B2B_USERS_FIELDS)


@on_sample("scan_event_window_b2c", query(f"""
  SELECT DISTINCT event_id, date_id, "eventTimeStamp", "userId", "eventType", pid AS "packageId", "eggToken",
    "chatToken", "totalCostThb" FROM live WHERE seg = 'B2C' AND {WINDOWED}"""))
def _(s):
    events = tables.b2c_events(s.b2c_events.where(tables.in_window(sample.START_DATE, sample.AS_OF)))
    return tables.without_banned(tracking.distinct_events(events), s.b2c_users).select(*tracking.EVENT_COLUMNS)


@on_sample("scan_event_window_b2b", query(f"""
  SELECT DISTINCT event_id, date_id, "eventTimeStamp", "userId", "eventType", pid AS "packageId", "eggToken",
    "chatToken", "totalCostThb" FROM dom WHERE seg = 'B2B' AND {WINDOWED}"""))
def _(s):
    events = s.b2b_events.where(tables.in_window(sample.START_DATE, sample.AS_OF))
    return tracking.distinct_events(tables.with_package_number(events))


@on_sample("scan_event_cycle", query(f"""
  SELECT event_id, "userId", "eventType", "subscriptionId", pid AS "packageId", "eggToken", "eventTimeStamp",
    "totalCostThb" FROM live WHERE seg = 'B2C' AND {WINDOWED}"""))
def _(s):
    # Every event arrives twice here; the earlier copy wins.
    late = s.b2c_events.withColumn("eventTimeStamp", F.expr("eventTimeStamp + INTERVAL 1 MINUTE"))
    events = s.b2c_events.unionByName(late).where(tables.in_window(sample.START_DATE, sample.AS_OF))
    events = tables.without_banned(tables.b2c_events(events), s.b2c_users)
    return dedup.one_per_event(events.select(*behaviour.cycles.EVENT_COLUMNS))


@on_sample("scan_event_all_time", query(f"""
  SELECT seg AS version, event_id, date_id, "userId", "eventType", "subscriptionId", "eventTimeStamp", "eggToken",
    "totalCostThb", "aiModel", pid AS "packageId" FROM live"""))
def _(s):
    return summary.without_banned_b2c(summary.segment_events(s.b2c_events, s.b2b_events), s.b2c_users)


@register("scan_package_master", """
  SELECT DISTINCT CAST(p_partkey % 15 AS BIGINT) AS "packageId", p_name AS "packageName" FROM part
  WHERE p_partkey % 15 IN (1, 2, 3, 12)""")
def _(spark, sf_dir):
    return tables.b2c_packages(sample.package_documents(spark, sf_dir), "packageName").distinct()


@register("scan_derived", query("""
  SELECT "companyId", count(*) AS rows, count(DISTINCT "userId") AS users FROM tracking_b2b GROUP BY ALL""",
                                tracked.B2B))
def _(spark, sf_dir):
    path = scratch_path(spark, "tracking")
    lake.rebuild_gold(tracked.b2b(sample.load(spark, sf_dir)), path, partition="date_id",
                      cluster=("companyId", "userId"))
    return lake.read_table(spark, path).groupBy("companyId").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("userId").alias("users"))


# One watermark per event type: the last local day seen.
STATE = """
state AS (
  SELECT "eventType" AS pipeline_name, max(date_id) AS last_processed_date, max("eventTimeStamp") AS updated_at
  FROM dom GROUP BY ALL
)
"""


def state(s) -> DataFrame:
    return both(s).groupBy(F.col("eventType").alias("pipeline_name")).agg(
        F.max("date_id").alias("last_processed_date"), F.max("eventTimeStamp").alias("updated_at"))


on_sample("read_watermark", query("SELECT last_processed_date FROM state WHERE pipeline_name = 'Subscribe'", STATE))(
    lambda s: lake.find_watermark(state(s), "Subscribe"))
on_sample("limit_one", query("SELECT last_processed_date FROM state WHERE pipeline_name = 'MainExpired' LIMIT 1",
                             STATE))(lambda s: lake.find_watermark(state(s), "MainExpired"))
on_sample("read_metrics", query("SELECT metric_key, value_display, period_display FROM metrics ORDER BY sort_order",
                                decks.SUBS, tracked.B2B, decks.METRICS))(lambda s: deck.read_metrics(decks.metrics(s)))

# ------------------------------------------------------------------- sinks
PER_DAY = "date_id, count(*) AS rows, count(DISTINCT event_id) AS events"


def _per_day(frame: DataFrame) -> DataFrame:
    return frame.groupBy("date_id").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("event_id").alias("events"))


def _stored(spark, sf_dir) -> tuple[DataFrame, str, list[date]]:
    """Normalised events written by day; gives the frame, its folder and its days."""
    rows = normalize.normalize_events(sample.event_documents(spark, sf_dir), ingested_at=NOW)
    path = scratch_path(spark, "events")
    days = lake.days_of((date(2024, 1, 1), date(2024, 1, 31)))
    lake.replace_days(rows, path, days)
    return rows, path, days


@register("replace_day_partition", query(f"""
  SELECT {PER_DAY} FROM dom WHERE date_id <> DATE '2024-01-15' GROUP BY ALL"""))
def _(spark, sf_dir):
    rows, path, _ = _stored(spark, sf_dir)
    # The same day again changes nothing; an empty frame empties its day.
    lake.replace_day(rows.where(F.col("date_id") == F.lit(date(2024, 1, 16))), path, date(2024, 1, 16))
    lake.replace_day(rows.where(F.lit(False)), path, DAY)
    return _per_day(lake.read_events(spark, path))


@register("replace_full_table", """
  SELECT CAST(c_custkey AS VARCHAR) AS "userId",
    CASE c_nationkey % 6 WHEN 5 THEN NULL ELSE c_nationkey % 6 IN (0, 1, 4) END AS "isBanned" FROM customer""")
def _(spark, sf_dir):
    path = scratch_path(spark, "users")
    rows = normalize.normalize_users(sample.user_documents(spark, sf_dir), ingested_at=NOW)
    for _ in range(2):
        lake.replace_table(rows, path, domain.USERS_SCHEMA)
    return lake.read_table(spark, path).drop("_ingested_at")


@register("rebuild_gold_table", query("SELECT segment, count(*) AS rows FROM cycles GROUP BY ALL", behaviour.CYCLES))
def _(spark, sf_dir):
    path = scratch_path(spark, "cycles")
    lake.rebuild_gold(behaviour.token_cycles(sample.load(spark, sf_dir)), path, cluster=("userId", "cycle_index"))
    return lake.read_table(spark, path).groupBy("segment").agg(F.count(F.lit(1)).alias("rows"))


@register("create_views", query("""
  SELECT version, CAST(sum(usage_events) AS BIGINT) AS usage_events FROM daily GROUP BY ALL""", *facts.FACT_DAILY))
def _(spark, sf_dir):
    """The view is made over half of the rows and read after the table's next version."""
    name = "daily_" + uuid.uuid4().hex
    path, rows = scratch_path(spark, "daily"), summary.summary_daily(*facts.args(sample.load(spark, sf_dir)))
    lake.rebuild_gold(rows.where("version = 'B2C'"), path, cluster=(), name=name)
    lake.create_views(spark, {f"{name}_use": f"SELECT version, sum(usage_events) AS usage_events FROM {name} GROUP BY version"})
    lake.rebuild_gold(rows, path, cluster=(), name=name)
    return spark.table(f"{name}_use")


def _merged(spark, sf_dir, *more: tuple[str, date]) -> tuple[DataFrame, DataFrame]:
    """Stored positions before and after an upsert of token positions and of further names."""
    path = scratch_path(spark, "state")
    old = state(sample.load(spark, sf_dir)).withColumn("updated_at", F.col("updated_at").cast("timestamp"))
    lake.merge_state(old, path)
    before = lake.read_state(spark, path)
    moved = before.where(F.col("pipeline_name").startswith("Token")).withColumn("last_processed_date", F.lit(date(2024, 2, 1)))
    added = spark.createDataFrame([(*m, NOW) for m in more], domain.STATE_SCHEMA)
    lake.merge_state(moved.unionByName(added), path)
    return before, lake.read_state(spark, path)


@register("upsert_watermark", query("""
  SELECT pipeline_name, CASE WHEN pipeline_name LIKE 'Token%' THEN DATE '2024-02-01' ELSE last_processed_date END
    AS last_processed_date FROM state""", STATE))
def _(spark, sf_dir):
    return _merged(spark, sf_dir)[1].drop("updated_at")


@register("merge_match", query("""
  SELECT pipeline_name, CASE WHEN pipeline_name LIKE 'Token%' THEN DATE '2024-02-01' ELSE last_processed_date END
    AS last_processed_date, last_processed_date AS previous FROM state
  UNION ALL SELECT 'Refund', DATE '2024-02-02', NULL""", STATE))
def _(spark, sf_dir):
    """Matched rows with the position they had, an inserted row, and rows that the upsert leaves alone."""
    before, after = _merged(spark, sf_dir, ("Refund", date(2024, 2, 2)))
    old = before.select("pipeline_name", F.col("last_processed_date").alias("previous"))
    return after.drop("updated_at").join(old, "pipeline_name", "left")


@register("ensure_event_table", query(f"SELECT {PER_DAY} FROM dom GROUP BY ALL"))
def _(spark, sf_dir):
    _, path, _ = _stored(spark, sf_dir)
    name = "meterglass_events_" + path.rsplit("-", 1)[1]
    for _ in range(2):
        lake.ensure_event_table(spark, name, path)
    return _per_day(spark.table(name))


@register("ensure_state_table", query("SELECT pipeline_name, last_processed_date FROM state", STATE))
def _(spark, sf_dir):
    path = scratch_path(spark, "state")
    name = "meterglass_state_" + path.rsplit("-", 1)[1]
    lake.ensure_state_table(spark, name, path)
    lake.ensure_state_table(spark, name, path)
    rows = state(sample.load(spark, sf_dir)).withColumn("updated_at", F.col("updated_at").cast("timestamp"))
    rows.write.insertInto(name)
    return spark.table(name).drop("updated_at")


FAULTS = """
faulty AS (
  SELECT date_id, concat_ws('; ', CASE WHEN k % 10 IN (3, 4) THEN 'no event_id' END, CASE WHEN k % 10 = 4 THEN 'no totalCostThb' END,
    CASE WHEN date_id > DATE '2024-01-20' THEN 'other day' END) AS found
  FROM dom
)
"""


@register("validate_day", query("""
  SELECT date_id, nullif(found, '') AS reason, count(*) AS rows, count(*) AS counted FROM faulty GROUP BY ALL""", FAULTS))
def _(spark, sf_dir):
    """Rows with planted faults through the gate: what was stored, what was rejected and why, and what the job counted."""
    rows = normalize.normalize_events(sample.event_documents(spark, sf_dir), ingested_at=NOW)
    fault = F.col("websearchToken") % 10
    rows = rows.withColumns({"event_id": F.when(~fault.isin(3, 4), F.col("event_id")), "totalCostThb": F.when(fault != 4, F.col("totalCostThb"))})
    days, path = lake.days_of((date(2024, 1, 1), date(2024, 1, 20))), scratch_path(spark, "gated")
    stored, rejected = lake.replace_days_gated(rows, path, days, max_rejects=10 ** 9)
    good = lake.rows_per_day(lake.read_events(spark, path)).select("date_id", F.lit(None).cast("string").alias("reason"), "rows")
    bad = lake.read_rejects(spark, path).groupBy("date_id", F.col(lake.REASON).alias("reason")).agg(F.count(F.lit(1)).alias("rows"))
    counted = spark.createDataFrame([(d, n) for d, n in stored.items()], "day date, counted long")
    right = lake.read_rejects(spark, path).agg(*[F.count_if(F.contains(lake.REASON, F.lit(r))).alias(r) for r in rejected]).first().asDict() == rejected
    return good.unionByName(bad).join(counted, (F.col("date_id") == F.col("day")) & F.col("reason").isNull(), "left").select(
        "date_id", "reason", "rows", F.when(F.col("reason").isNull(), F.col("counted")).when(F.lit(right), F.col("rows")).alias("counted"))


def _ingested(spark, sf_dir) -> tuple[str, dict[date, int]]:
    """Three runs on JSON documents: a first fill, a run after a gap, a rerun."""
    docs_path, path, state_path = (scratch_path(spark, n) for n in ("docs", "events", "state"))
    sample.event_documents(spark, sf_dir).write.json(docs_path)
    docs = documents.read_json(spark, docs_path, domain.EVENT_FIELDS)
    rows: dict[date, int] = {}
    for today in (date(2024, 1, 10), sample.AS_OF, sample.AS_OF):
        rows |= ingest.ingest_events(docs, path, state_path, start_date=sample.START_DATE, lookback_days=2,
                                     today=today, ingested_at=NOW)
    return path, rows


@register("incremental_ingest", query(f"""
  SELECT {PER_DAY}, CAST(sum("totalCostThb") AS DECIMAL(38,6)) AS cost FROM dom WHERE {WINDOWED} GROUP BY ALL"""))
def _(spark, sf_dir):
    path, _ = _ingested(spark, sf_dir)
    return lake.read_events(spark, path).groupBy("date_id").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("event_id").alias("events"),
        F.sum("totalCostThb").cast(domain.MONEY_SUM).alias("cost"))


@register("ingest_dump", query(f"""
  SELECT {PER_DAY}, CAST(sum("totalCostThb") AS DECIMAL(38,6)) AS cost FROM dom WHERE {WINDOWED} GROUP BY ALL"""))
def _(spark, sf_dir):
    """A dump that grows by files between two runs: each file is parsed once, and the second run opens the landed days of its window."""
    docs_path, landed, progress, path, state_path = (scratch_path(spark, n) for n in ("docs", "landed", "progress", "events", "state"))
    docs, at = sample.event_documents(spark, sf_dir), F.col("eventTimeStamp").getField("$date")
    for part, today in ((at < "2024-01-10", date(2024, 1, 10)), (at >= "2024-01-10", sample.AS_OF)):
        docs.where(part).write.mode("append").json(docs_path)
        ingest.ingest_dump(spark, docs_path, landed, progress, path, state_path, start_date=sample.START_DATE, lookback_days=2,
                           today=today, ingested_at=NOW)
    return lake.read_events(spark, path).groupBy("date_id").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("event_id").alias("events"),
        F.sum("totalCostThb").cast(domain.MONEY_SUM).alias("cost"))


@register("run_summary", query(f"""
  SELECT 'events' AS stage, count(*) AS rows, min(date_id) AS first_day, max(date_id) AS last_day
  FROM dom WHERE {WINDOWED}
  UNION ALL SELECT 'users', (SELECT count(*) FROM customer), NULL, NULL"""))
def _(spark, sf_dir):
    rows = normalize.normalize_events(sample.event_documents(spark, sf_dir), ingested_at=NOW)
    days = lake.days_of((sample.START_DATE, date(2024, 1, 27)))
    path = scratch_path(spark, "users")
    return ingest.run_summary(spark, {
        "events": lake.validate_days(rows.where(tables.in_window(sample.START_DATE, sample.AS_OF)), days),
        "users": lake.replace_table(normalize.normalize_users(sample.user_documents(spark, sf_dir), ingested_at=NOW),
                                    path, domain.USERS_SCHEMA)})


def _streamed(spark, sf_dir, late_after: int | None = None) -> tuple[str, str]:
    """Two streaming runs; the second one's files hold a third of the first one's documents again, and all of January 5th."""
    docs_path, path, checkpoint = (scratch_path(spark, n) for n in ("docs", "events", "progress"))
    docs, at = sample.event_documents(spark, sf_dir), F.col("eventTimeStamp").getField("$date")
    late = at.startswith("2024-01-05")
    second = late | (at >= "2024-01-20") | (F.crc32(F.col("_id").getField("$oid")) % 3 == 0)
    for part in (~late & (at < "2024-01-20"), second):
        docs.where(part).write.mode("append").json(docs_path)
        streaming.stream_events(spark, docs_path, path, checkpoint, late_after=late_after).awaitTermination()
    return path, streaming.landed_beside(checkpoint)


@register("stream_ingest", query(f'SELECT {PER_DAY} FROM dom GROUP BY ALL'))
def _(spark, sf_dir):
    return _per_day(lake.read_events(spark, _streamed(spark, sf_dir)[0]))


@register("stream_late_days", query(f'SELECT {PER_DAY} FROM dom GROUP BY ALL'))
def _(spark, sf_dir):
    """Days more than a week behind wait until the stream has ended and are then replaced once."""
    path, landed = _streamed(spark, sf_dir, late_after=7)
    like = documents.parse_lines(spark.createDataFrame([], "value string"), domain.EVENT_FIELDS)
    streaming.replace_late(like, landed, path)
    return _per_day(lake.read_events(spark, path))


@register("late_events", query(f"""
  SELECT date_id, count(*) AS rows, count(DISTINCT event_id) AS events FROM dom WHERE {WINDOWED} GROUP BY ALL"""))
def _(spark, sf_dir):
    """Usage comes a run later than all else; the lookback re-reads its whole days."""
    path, state_path = scratch_path(spark, "events"), scratch_path(spark, "state")
    docs = sample.event_documents(spark, sf_dir)
    early = docs.where(~F.col("eventType").startswith(domain.TOKEN_USED))
    for source, lookback in ((early, 1), (docs, 25)):
        ingest.ingest_events(source, path, state_path, start_date=sample.START_DATE, lookback_days=lookback,
                             today=sample.AS_OF, ingested_at=NOW)
    return _per_day(lake.read_events(spark, path))


# ------------------------------------------------------------- normalisers
NORMALIZED = """
  SELECT event_id, "eventTimeStamp", date_id, "userId", "eventType", "subscriptionId", "packageId", "eggToken",
    "chatToken", k AS "websearchToken", "totalCostUsd",
    CAST(round(cents * CAST(0.0000015 AS DECIMAL(10,7)), 6) AS DECIMAL(18,6)) AS "chatCostUsd",
    CAST(NULL AS DECIMAL(18,6)) AS "websearchCostUsd", -k AS "externalToken",
    CAST(k * CAST(0.01 AS DECIMAL(5,2)) AS DECIMAL(18,6)) AS "externalCostUsd", raw_type AS "externalCostName",
    'ref-' || event_id AS "externalTransactionReference", CAST(NULL AS VARCHAR) AS "traceId", "aiModel",
    CAST(NULL AS VARCHAR) AS "agentId", CAST(NULL AS VARCHAR) AS "teamId", 'USER_TOKEN' AS "deductType",
    CAST(NULL AS VARCHAR) AS "teamSubscriptionId",
    CASE WHEN "totalCostUsd" IS NOT NULL THEN '{"k": ' || k || ', "parts": [' || cents || ', ' || k || ']}' END
      AS "deductionBreakdown", "totalCostThb", TIMESTAMP '2024-02-01 00:00:00' AS _ingested_at
  FROM dom"""


@register("normalize_events", query(NORMALIZED))
def _(spark, sf_dir):
    return plain_time(normalize.normalize_events(sample.event_documents(spark, sf_dir), ingested_at=NOW))


@register("empty_with_schema", query(
    "SELECT CAST(26 AS BIGINT) AS columns, count(*) AS rows FROM dom"))
def _(spark, sf_dir):
    """The empty frame adds every column and no row to the full one."""
    docs = sample.event_documents(spark, sf_dir)
    both = normalize.normalize_events(docs, ingested_at=NOW).unionByName(normalize.empty(docs))
    return both.agg(F.lit(len(normalize.empty(docs).columns)).cast("bigint").alias("columns"),
                    F.count(F.lit(1)).alias("rows"))


@register("normalize_packages", """
  SELECT CAST(p_partkey % 15 AS BIGINT) AS "packageId", p_name AS "packageName", p_type AS "packageType",
    CAST(NULL AS VARCHAR) AS "tierName", CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS DECIMAL(38,9)) AS "priceThb",
    CAST(p_partkey AS BIGINT) AS "eggToken", CAST(p_size AS BIGINT) AS "durationDay",
    CAST(NULL AS BIGINT) AS "durationMonth", CAST(NULL AS TIMESTAMP) AS "createdAt",
    TIMESTAMP '2025-11-24 13:02:20.481' AS "updatedAt", TIMESTAMP '2024-02-01 00:00:00' AS _ingested_at FROM part""")
def _(spark, sf_dir):
    return plain_time(normalize.normalize_packages(sample.package_documents(spark, sf_dir), ingested_at=NOW))


FLAG = 'CASE c_nationkey % 6 WHEN 5 THEN NULL ELSE c_nationkey % 6 IN (0, 1, 4) END AS "isBanned"'


@register("normalize_users", f"""
  SELECT CAST(c_custkey AS VARCHAR) AS "userId", {FLAG}, TIMESTAMP '2024-02-01 00:00:00' AS _ingested_at
  FROM customer""")
def _(spark, sf_dir):
    return plain_time(normalize.normalize_users(sample.user_documents(spark, sf_dir), ingested_at=NOW))


@register("normalize_b2b_users", """
  SELECT CAST(c_custkey AS VARCHAR) AS "userId", CAST(c_nationkey AS VARCHAR) AS "teamId", c_mktsegment AS "teamName",
    TIMESTAMP '2024-02-01 00:00:00' AS _ingested_at FROM customer""")
def _(spark, sf_dir):
    return plain_time(normalize.normalize_b2b_users(sample.user_documents(spark, sf_dir), ingested_at=NOW))


@register("normalize_b2b_company", """
  SELECT CAST(s_suppkey AS VARCHAR) AS "companyId", s_name AS "companyName",
    TIMESTAMP '2024-02-01 00:00:00' AS _ingested_at FROM supplier""")
def _(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/supplier.parquet").selectExpr("s_suppkey AS companyId", "s_name AS companyName")
    return plain_time(normalize.normalize_b2b_company(docs, ingested_at=NOW))


@register("normalize_b2b_team", """
  SELECT CAST(s_suppkey AS VARCHAR) AS "teamId", CAST(s_nationkey AS VARCHAR) AS "companyId",
    TIMESTAMP '2024-02-01 00:00:00' AS _ingested_at FROM supplier""")
def _(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/supplier.parquet").selectExpr("s_suppkey AS teamId", "s_nationkey AS companyId")
    return plain_time(normalize.normalize_b2b_team(docs, ingested_at=NOW))


def on_documents(name: str, sql: str):
    """Register one value rule over the event documents, keyed by the event id."""
    def keep(build):
        def run(spark, sf_dir):
            docs = sample.event_documents(spark, sf_dir)
            return plain_time(docs.select(values.object_id_string(docs).alias("event_id"),
                                          *[c.alias(n) for n, c in build(docs).items()]))
        return register(name, query(f"SELECT event_id, {sql} FROM dom"))(run)
    return keep


on_documents("object_id_string", "length(event_id) AS digits")(
    lambda d: {"digits": F.length(values.object_id_string(d)).cast("bigint")})
on_documents("to_utc_timestamp", '"eventTimeStamp"')(
    lambda d: {"eventTimeStamp": values.to_utc_timestamp(d, "eventTimeStamp")})
on_documents("to_decimal", 'CAST(cents * CAST(0.0000015 AS DECIMAL(10,7)) AS DECIMAL(38,9)) AS "chatCostUsd"')(
    lambda d: {"chatCostUsd": values.to_decimal(d, "chatCostUsd")})
on_documents("to_money", """CAST(round(cents * CAST(0.0000015 AS DECIMAL(10,7)), 6) AS DECIMAL(18,6)) AS chat,
  CAST(coalesce("totalCostUsd", 0) AS DECIMAL(18,6)) AS total""")(
    lambda d: {"chat": values.to_money(values.to_decimal(d, "chatCostUsd")),
               "total": values.to_money(values.to_decimal(d, "totalCostUsd"))})
on_documents("cost_thb", '"totalCostUsd", "totalCostThb"')(
    lambda d: {"totalCostUsd": values.money_or_null(d, "totalCostUsd"),
               "totalCostThb": values.cost_thb(values.to_decimal(d, "totalCostUsd"))})
on_documents("to_int", '"eggToken", k AS "websearchToken"')(
    lambda d: {n: values.to_int(d, n) for n in ("eggToken", "websearchToken")})
on_documents("to_string", '"userId", CAST("eggToken" AS VARCHAR) AS egg, "aiModel"')(
    lambda d: {"userId": values.to_string(d, "userId"), "egg": values.to_string(d, "eggToken"),
               "aiModel": values.to_string(d, "aiModel")})
on_documents("json_text", """CASE WHEN "totalCostUsd" IS NOT NULL
  THEN '{"k": ' || k || ', "parts": [' || cents || ', ' || k || ']}' END AS breakdown""")(
    lambda d: {"breakdown": values.json_text(d, "deductionBreakdown")})
on_documents("local_date", "date_id")(
    lambda d: {"date_id": calendar.local_date(values.to_utc_timestamp(d, "eventTimeStamp"))})
on_documents("object_id_time", """date_trunc('second', "eventTimeStamp") AS made_at""")(
    lambda d: {"made_at": calendar.object_id_time(values.object_id_string(d))})


@register("to_boolean", f'SELECT CAST(c_custkey AS VARCHAR) AS "userId", {FLAG} FROM customer')
def _(spark, sf_dir):
    docs = sample.user_documents(spark, sf_dir)
    return docs.select("userId", values.to_boolean(docs, "isBanned").alias("isBanned"))


@register("json_value_types", """
  SELECT o_orderkey AS id, CAST(trunc(o_totalprice) AS BIGINT) AS whole, CAST(o_custkey AS BIGINT) AS from_text,
    CASE o_orderkey % 4 WHEN 0 THEN TRUE WHEN 1 THEN o_custkey % 2 = 1 WHEN 2 THEN o_orderstatus = 'O' END AS flag,
    '"[' || o_orderstatus || '] note"' AS plain_text, '{"b": 1, "a": [' || o_custkey || ', null]}' AS nested
  FROM orders""")
def _(spark, sf_dir):
    """Documents whose numbers, flags, texts and objects must stay apart on their way through JSON."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    key = F.col("o_orderkey") % 4
    flag = (F.when(key == 0, F.lit("7")).when(key == 1, (F.col("o_custkey") % 2).cast("string"))
            .when(key == 2, F.when(F.col("o_orderstatus") == "O", '" TRUE "').otherwise('"n"')).otherwise("null"))
    line = F.format_string('{"id": %d, "whole": %s, "from_text": "%d", "flag": %s, "plain": "[%s] note", "deductionBreakdown": {"b":1, "a":[%d,null]}}',
                           "o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").cast("string"), "o_custkey", flag, "o_orderstatus", "o_custkey")
    path = scratch_path(spark, "docs")
    orders.select(line.alias("value")).write.text(path)
    docs = documents.read_json(spark, path, ("id", "whole", "from_text", "flag", "plain", "deductionBreakdown"))
    return docs.select(values.to_int(docs, "id").alias("id"), values.to_int(docs, "whole").alias("whole"),
                       values.to_int(docs, "from_text").alias("from_text"), values.to_boolean(docs, "flag").alias("flag"),
                       values.json_text(docs, "plain").alias("plain_text"), values.json_text(docs, "deductionBreakdown").alias("nested"))


@on_sample("day_bounds_utc", query("""
  SELECT DISTINCT date_id, CAST(date_id AS TIMESTAMP) - INTERVAL 7 HOUR AS day_start,
    CAST(date_id AS TIMESTAMP) + INTERVAL 17 HOUR AS day_end FROM dom"""))
def _(s):
    def to_utc(day):
        return F.convert_timezone(F.lit(domain.TIME_ZONE), F.lit("UTC"), day.cast("timestamp_ntz"))
    return both(s).select("date_id").distinct().select(
        "date_id", to_utc(F.col("date_id")).alias("day_start"), to_utc(F.date_add("date_id", 1)).alias("day_end"))


@on_sample("date_window", query(f"""
  SELECT pipeline_name, CAST(unnest(generate_series(
    greatest({START}, least(last_processed_date + 1, DATE '2024-02-01')), DATE '2024-02-03', INTERVAL 1 DAY)) AS DATE)
    AS date_id
  FROM state""", STATE))
def _(s):
    return calendar.watermark_windows(state(s), start_date=sample.START_DATE, lookback_days=3, today=date(2024, 2, 4))
