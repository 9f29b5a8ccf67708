"""Scalar functions, each over a whole table."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from meterglass import domain
from meterglass.functions import calendar, figures, values
from meterglass.registry import behavior as behaviour
from meterglass.registry.common import on_sample, register
from meterglass.registry.ingest import both
from meterglass.registry.sql import AS_OF, query
from meterglass.sources import sample


def on_orders(name: str, sql: str, **columns):
    """Register expressions over the orders table, keyed by the order."""
    def run(spark, sf_dir):
        orders = spark.read.parquet(f"{sf_dir}/orders.parquet").withColumn("day", F.to_date("o_orderdate"))
        return orders.select("o_orderkey", *[build().alias(n) for n, build in columns.items()])
    register(name, f"SELECT o_orderkey, {sql} FROM (SELECT *, CAST(o_orderdate AS DATE) AS day FROM orders)")(run)


def day():
    return F.col("day")


on_orders("week_key", "strftime(day, '%Y') || lpad(CAST(weekofyear(day) AS VARCHAR), 2, '0') AS week_id",
          week_id=lambda: calendar.week_key(day()))
on_orders("month_key", "strftime(day, '%Y%m') AS month_id", month_id=lambda: calendar.month_key(day()))
on_orders("iso_week_key", "strftime(day, '%G%V') AS week_id", week_id=lambda: calendar.iso_week_key(day()))
on_orders("week_monday", "CAST(date_trunc('week', day) AS DATE) AS week_start", week_start=lambda: calendar.monday(day()))
on_orders("run_date", f"{AS_OF} - 1 AS run_date, day < {AS_OF} AS complete",
          run_date=lambda: calendar.run_date(sample.AS_OF), complete=lambda: day() < F.lit(sample.AS_OF))
on_orders("date_sub_days", "day - 35 AS mature_before", mature_before=lambda: F.date_sub("day", domain.MATURE_DAYS))
on_orders("long_date", "lpad(CAST(day(day) AS VARCHAR), 2, ' ') || ' ' || monthname(day) || ' ' || year(day) AS period",
          period=lambda: figures.long_date(day()))
on_orders("date_text", "strftime(day, '%Y-%m-%d') AS wk", wk=lambda: F.date_format("day", "yyyy-MM-dd"))
on_orders("thousands", "format('{:,}', CAST(round(o_totalprice) AS BIGINT)) AS value_display",
          value_display=lambda: figures.thousands(F.round("o_totalprice").cast("bigint")))
on_orders("placeholder_text", "'{{' || o_orderstatus || '}}' AS placeholder",
          placeholder=lambda: figures.placeholder(F.col("o_orderstatus")))
on_orders("concat_lpad", "lpad(CAST(o_custkey AS VARCHAR), 8, '0') || '-' || o_orderstatus AS code",
          code=lambda: F.concat(F.lpad(F.col("o_custkey").cast("string"), 8, "0"), F.lit("-"), "o_orderstatus"))
on_orders("size_bin_label", """CAST((o_custkey + 9) // 10 AS BIGINT) AS bin,
  '(' || ((o_custkey + 9) // 10 * 10 - 9) || '-' || ((o_custkey + 9) // 10 * 10) || ')' AS label""",
          bin=lambda: figures.size_bin(F.col("o_custkey")),
          label=lambda: figures.size_label(figures.size_bin(F.col("o_custkey"))))
on_orders("percent_change", """round(CASE WHEN o_custkey <> 0 THEN (o_totalprice - o_custkey) / o_custkey * 100
  ELSE 0 END, 6) AS change_pct""",
          change_pct=lambda: F.round(figures.percent_change(F.col("o_totalprice"), F.col("o_custkey")), 6))
on_orders("direction_label", """CASE WHEN o_totalprice / 1e5 - 1 > 0.05 THEN '▲'
  WHEN o_totalprice / 1e5 - 1 < -0.05 THEN '▼' ELSE '—' END AS direction""",
          direction=lambda: figures.direction(F.col("o_totalprice") / 1e5 - 1))


@register("generated_at", "SELECT o_orderkey, TRUE AS one_stamp, TRUE AS in_run FROM orders")
def _(spark, sf_dir):
    """The time of the run: the same on every row, and not before the run began."""
    began = datetime.now(timezone.utc)
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", F.current_timestamp().alias("generated_at"))
    span = rows.agg(F.min("generated_at").alias("first"), F.max("generated_at").alias("last"))
    return rows.select("o_orderkey", (F.col("generated_at") == span.select("first").scalar()).alias("one_stamp"),
                       ((F.col("generated_at") >= F.lit(began)) & (F.col("generated_at") == span.select("last").scalar())).alias("in_run"))


def on_events(name: str, sql: str, source: str = "dom", parts: tuple[str, ...] = (), rows=both, key: str = "event_id"):
    def keep(build):
        def run(s):
            frame = rows(s)
            return frame.select(key, *[c.alias(n) for n, c in build(frame).items()])
        return on_sample(name, query(f'SELECT "{key}", {sql} FROM {source}', *parts))(run)
    return keep


on_events("safe_cast_int", 'pid AS "packageId"')(lambda e: {"packageId": values.safe_bigint(F.col("packageId"))})
on_events("date_in_zone", 'CAST("eventTimeStamp" + INTERVAL 7 HOUR AS DATE) AS local_day')(
    lambda e: {"local_day": calendar.local_date(F.col("eventTimeStamp"), ntz=calendar.is_ntz(e, "eventTimeStamp"))})
on_events("null_model_label", 'coalesce("aiModel", \'(ไม่ระบุ)\') AS "aiModel"')(
    lambda e: {"aiModel": figures.model_label(F.col("aiModel"))})
on_events("case_when", """CASE WHEN "eventType" = 'Token Used' THEN 'Active' ELSE "eventType" END AS event_flag,
  CASE WHEN "eventType" = 'Token Used' THEN -"eggToken" ELSE "eggToken" END AS egg""")(
    lambda e: {"event_flag": F.when(F.col("eventType") == domain.TOKEN_USED, "Active").otherwise(F.col("eventType")),
               "egg": F.when(F.col("eventType") == domain.TOKEN_USED, -F.col("eggToken")).otherwise(F.col("eggToken"))})
on_events("if_null", 'coalesce("totalCostUsd", 0) AS usd, CASE WHEN "aiModel" IS NULL THEN 1 ELSE 0 END AS unnamed')(
    lambda e: {"usd": F.coalesce("totalCostUsd", F.lit(0).cast(domain.MONEY)),
               "unnamed": F.when(F.col("aiModel").isNull(), 1).otherwise(0)})
on_events("abs_greatest_round_div", """abs("eggToken") AS used, greatest(10000 - abs("eggToken"), 0) AS left_over,
  CAST(round("totalCostThb", 2) AS DECIMAL(18,2)) AS cost, abs("eggToken") // 1000 AS thousands""")(
    lambda e: {"used": F.abs("eggToken"), "left_over": F.greatest(10000 - F.abs("eggToken"), F.lit(0)),
               "cost": F.round("totalCostThb", 2).cast("decimal(18,2)"), "thousands": F.expr("abs(eggToken) div 1000")})
on_events("except_replace", """"userId", CASE WHEN "eventType" = 'Token Used' THEN 'Subscribe' ELSE "eventType" END
  AS "eventType" """)(
    lambda e: {"userId": F.col("userId"),
               "eventType": F.when(F.col("eventType") == domain.TOKEN_USED, domain.SUBSCRIBE)
               .otherwise(F.col("eventType"))})
on_events("safe_divide", 'CAST("chatToken" AS DOUBLE) / nullif("eggToken", 0) AS share')(
    lambda e: {"share": figures.safe_divide(F.col("chatToken"), F.col("eggToken"))})


@on_sample("hours_between", query("""
  SELECT "userId", cycle_start_ts, date_sub('hour', cycle_start_ts, cycle_end_ts) AS hours, cycle_days
  FROM cycles""", behaviour.CYCLES))
def _(s):
    start, end = F.col("cycle_start_ts"), F.col("cycle_end_ts")
    return behaviour.token_cycles(s).select("userId", "cycle_start_ts", calendar.whole_hours(start, end).alias("hours"),
                                            calendar.days_between(start, end, 2).alias("cycle_days"))


on_sample("array_subscript", query("""
  SELECT "userId", kinds[1] AS first_kind, kinds[5] AS fifth_kind, kinds[9] AS ninth_kind
  FROM (SELECT "userId", list_sort(list(DISTINCT "eventType")) AS kinds FROM dom GROUP BY "userId")"""))(
    lambda s: both(s).groupBy("userId").agg(F.sort_array(F.collect_set("eventType")).alias("kinds")).select(
        "userId", *[F.get("kinds", F.lit(i)).alias(n) for i, n in ((0, "first_kind"), (4, "fifth_kind"), (8, "ninth_kind"))]))
