"""The shared test tables read as the domain tables (see FIXTURES.md section 3)."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterglass.functions import calendar, values

START_DATE = date(2024, 1, 3)
AS_OF = date(2024, 1, 28)
MATURE_DAYS = 14
ROLLING_DAYS = 10
WEEKLY_SINCE = date(2024, 1, 8)

B2C_MASTER = ((1, "Starter", 259), (2, "Standard", 499), (3, "Pro", 999), (12, "Free Trial", 0))
B2B_MASTER = (
    (4, "Biz Starter", 300), (6, "Biz Standard", 600), (8, "Biz Pro", 1200), (9, "Free Trial VIP", 0),
    (11, "Instructor", 0), (13, "Biz Pro", 1300), (5, "Internal 5", 0), (7, "Internal 7", 0),
    (10, "Internal 10", 0), (97, "Internal 97", 0), (98, "Internal 98", 0),
)
B2B_PACKAGE_ORDER = (4, 6, 8, 9, 11, 13, 5, 7, 10, 97, 98)


@dataclass(frozen=True)
class Sample:
    b2c_events: DataFrame
    b2b_events: DataFrame
    b2c_packages: DataFrame
    b2b_packages: DataFrame
    b2c_users: DataFrame
    b2b_users: DataFrame
    team: DataFrame
    company: DataFrame


@lru_cache(maxsize=4)
def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def events(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """All events of both segments, with the numeric user ``u`` kept beside the columns."""
    b2b_ids = ", ".join(f"'{i}'" for i in B2B_PACKAGE_ORDER)
    return (
        raw_events(spark, sf_dir)
        # A generator reads the JSON once per row; later filters on k stay above it.
        .select("event_id", "ts", "user_id", "event_type", "value", F.json_tuple("props", "k").alias("k"))
        .selectExpr(
            "event_id AS n", "ts", "user_id AS u", "event_type", "CAST(k AS BIGINT) AS k",
            "CAST(round(value * 100) AS BIGINT) AS cents")
        .selectExpr("*", """
            CASE WHEN event_type = 'purchase' AND k < 50 AND u % 11 <> 5 THEN 'Subscribe'
                 WHEN event_type = 'signup' AND k < 30 THEN 'MonthlyReset'
                 WHEN event_type = 'error' AND k < 25 THEN 'MainExpired'
                 WHEN k % 10 = 7 THEN 'Token Used (Unsettled)'
                 ELSE 'Token Used' END AS kind""")
        .selectExpr("*", """
            CASE WHEN startswith(kind, 'Token Used')
                 THEN CAST(cents * CAST('0.00001' AS DECIMAL(10,5)) AS DECIMAL(18,6)) END AS usd""")
        .select(
            F.expr("lpad(lower(hex(timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts))), 8, '0')"
                   " || lpad(lower(hex(n)), 16, '0')").alias("event_id"),
            F.col("ts").alias("eventTimeStamp"),
            calendar.local_date(F.col("ts"), ntz=True).alias("date_id"),
            F.expr("'u-' || u").alias("userId"),
            F.col("kind").alias("eventType"),
            F.expr("'sub-' || u || '-' || IF(u % 4 < 2, 0, k div 10)").alias("subscriptionId"),
            F.expr(f"""
                CASE WHEN u % 3 = 0 THEN get(array({b2b_ids}), CAST(k % 11 AS INT))
                     WHEN u % 4 = 0 THEN '12'
                     WHEN u % 4 = 1 THEN CAST(1 + k % 3 AS STRING)
                     WHEN k % 17 = 0 THEN 'n/a'
                     WHEN k % 5 = 0 THEN '12'
                     ELSE CAST(1 + k % 3 AS STRING) END""").alias("packageId"),
            F.expr("""
                CAST(CASE kind WHEN 'Subscribe' THEN 10000 * (1 + k % 3)
                               WHEN 'MonthlyReset' THEN 0
                               WHEN 'MainExpired' THEN -100 * k
                               ELSE -cents END AS BIGINT)""").alias("eggToken"),
            F.expr("IF(startswith(kind, 'Token Used'), CAST(floor(-cents / 2) AS BIGINT), NULL)").alias("chatToken"),
            F.col("usd").alias("totalCostUsd"),
            values.cost_thb(F.col("usd")).alias("totalCostThb"),
            F.expr("IF(k % 6 <> 5, 'model-' || (k % 6), NULL)").alias("aiModel"),
            "u", *extra,
        )
    )


def event_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as source documents: wrapped ids, instants and decimals, nested breakdown."""
    plain = events(spark, sf_dir, "k", "cents", "event_type")
    return plain.selectExpr(
        "named_struct('$oid', event_id) AS _id",
        "named_struct('$date', date_format(eventTimeStamp, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\")) AS eventTimeStamp",
        "userId", "eventType", "subscriptionId", "packageId", "eggToken", "chatToken", "k AS websearchToken",
        "IF(totalCostUsd IS NULL, NULL, named_struct('$numberDecimal', CAST(totalCostUsd AS STRING))) AS totalCostUsd",
        "named_struct('$numberDecimal', CAST(cents * CAST('0.0000015' AS DECIMAL(10,7)) AS STRING)) AS chatCostUsd",
        "CAST(k * CAST('0.01' AS DECIMAL(5,2)) AS STRING) AS externalCostUsd", "-k AS externalToken",
        "event_type AS externalCostName", "'ref-' || event_id AS externalTransactionReference", "aiModel",
        "'USER_TOKEN' AS deductType",
        "IF(totalCostUsd IS NULL, NULL, named_struct('k', k, 'parts', array(cents, k))) AS deductionBreakdown")


def package_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts read as package documents; numbers repeat and the price is a wrapped decimal."""
    return spark.read.parquet(f"{sf_dir}/part.parquet").selectExpr(
        "CAST(p_partkey % 15 AS STRING) AS packageId", "p_name AS packageName", "p_type AS packageType",
        "CAST(NULL AS STRING) AS tierName",
        "named_struct('$numberDecimal', CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS STRING)) AS priceThb",
        "p_partkey AS eggToken", "CAST(p_size AS BIGINT) AS durationDay",
        "named_struct('$date', '2025-11-24T13:02:20.481Z') AS updatedAt")


def user_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers read as user documents with flags in several spellings."""
    return spark.read.parquet(f"{sf_dir}/customer.parquet").selectExpr(
        "CAST(c_custkey AS STRING) AS userId",
        "element_at(array('TRUE', ' yes ', 'false', 'y', '1', NULL), CAST(c_nationkey % 6 AS INT) + 1) AS isBanned",
        "CAST(c_nationkey AS STRING) AS teamId", "c_mktsegment AS teamName")


def _values(spark: SparkSession, rows: list[tuple], *names: str) -> DataFrame:
    text = ", ".join("(" + ", ".join(map(str, row)) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {text} AS t({', '.join(names)})")


@lru_cache(maxsize=4)
def load(spark: SparkSession, sf_dir: str) -> Sample:
    both = events(spark, sf_dir)
    people = raw_events(spark, sf_dir).selectExpr("user_id AS u").distinct()
    b2c = people.where("u % 3 <> 0").selectExpr(
        "'u-' || u AS userId",
        "CASE WHEN u % 17 = 0 THEN TRUE WHEN u % 19 = 0 THEN NULL ELSE FALSE END AS isBanned")
    b2b = people.where("u % 3 = 0").selectExpr("u", "u div 3 AS g").selectExpr(
        "'u-' || u AS userId",
        "IF(g % 5 <> 0, 't-' || (g % 12), NULL) AS teamId",
        "IF(g % 5 <> 0, 'Team ' || (g % 12), NULL) AS teamName")
    # VALUES gives a relation of known size, so the planner can weigh it.
    b2c_packages, b2b_packages = (
        _values(spark, [(f"{i}L", f"'{name}'", f"CAST({price} AS DECIMAL(18,2))") for i, name, price in rows],
                "packageId", "packageName", "priceThb")
        for rows in (B2C_MASTER, B2B_MASTER)
    )
    team = _values(spark, [(f"'t-{t}'", "'c-0'" if t < 2 else "'c-1'" if t < 5 else "'c-2'") for t in range(12)],
                   "teamId", "companyId")
    company = _values(spark, [(f"'c-{c}'", f"'Company {c}'") for c in range(3)], "companyId", "companyName")
    return Sample(
        b2c_events=both.where("u % 3 <> 0").drop("u"), b2b_events=both.where("u % 3 = 0").drop("u"),
        b2c_packages=b2c_packages, b2b_packages=b2b_packages,
        b2c_users=b2c, b2b_users=b2b, team=team, company=company,
    )
