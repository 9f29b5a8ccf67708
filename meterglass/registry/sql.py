"""DuckDB text of the sample mapping, written apart from the Spark code."""

from __future__ import annotations

DOM = """
parsed AS (
  SELECT event_id AS n, ts, user_id AS u, event_type AS raw_type,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         CAST(round(value * 100) AS BIGINT) AS cents
  FROM events
),
kinds AS (
  SELECT *,
    CASE WHEN raw_type = 'purchase' AND k < 50 AND u % 11 <> 5 THEN 'Subscribe'
         WHEN raw_type = 'signup' AND k < 30 THEN 'MonthlyReset'
         WHEN raw_type = 'error' AND k < 25 THEN 'MainExpired'
         WHEN k % 10 = 7 THEN 'Token Used (Unsettled)'
         ELSE 'Token Used' END AS kind
  FROM parsed
),
dom AS (
  SELECT
    lpad(lower(to_hex(CAST(floor(epoch(ts)) AS BIGINT))), 8, '0') || lpad(lower(to_hex(n)), 16, '0') AS event_id,
    ts AS "eventTimeStamp",
    CAST(ts + INTERVAL 7 HOUR AS DATE) AS date_id,
    'u-' || u AS "userId",
    kind AS "eventType",
    'sub-' || u || '-' || (CASE WHEN u % 4 < 2 THEN 0 ELSE k // 10 END) AS "subscriptionId",
    CASE WHEN u % 3 = 0 THEN CAST([4, 6, 8, 9, 11, 13, 5, 7, 10, 97, 98][k % 11 + 1] AS VARCHAR)
         WHEN u % 4 = 0 THEN '12'
         WHEN u % 4 = 1 THEN CAST(1 + k % 3 AS VARCHAR)
         WHEN k % 17 = 0 THEN 'n/a'
         WHEN k % 5 = 0 THEN '12'
         ELSE CAST(1 + k % 3 AS VARCHAR) END AS "packageId",
    TRY_CAST(CASE WHEN u % 3 = 0 THEN CAST([4, 6, 8, 9, 11, 13, 5, 7, 10, 97, 98][k % 11 + 1] AS VARCHAR)
         WHEN u % 4 = 0 THEN '12'
         WHEN u % 4 = 1 THEN CAST(1 + k % 3 AS VARCHAR)
         WHEN k % 17 = 0 THEN 'n/a'
         WHEN k % 5 = 0 THEN '12'
         ELSE CAST(1 + k % 3 AS VARCHAR) END AS BIGINT) AS pid,
    CAST(CASE kind WHEN 'Subscribe' THEN 10000 * (1 + k % 3)
                   WHEN 'MonthlyReset' THEN 0
                   WHEN 'MainExpired' THEN -100 * k
                   ELSE -cents END AS BIGINT) AS "eggToken",
    CASE WHEN kind LIKE 'Token Used%' THEN CAST(floor(-cents / 2) AS BIGINT) END AS "chatToken",
    CASE WHEN kind LIKE 'Token Used%'
         THEN CAST(cents * CAST(0.00001 AS DECIMAL(10,5)) AS DECIMAL(18,6)) END AS "totalCostUsd",
    CAST(round(CASE WHEN kind LIKE 'Token Used%'
         THEN CAST(cents * CAST(0.00001 AS DECIMAL(10,5)) AS DECIMAL(18,6)) ELSE 0 END
         * CAST(32.67 AS DECIMAL(4,2)), 6) AS DECIMAL(18,6)) AS "totalCostThb",
    CASE WHEN k % 6 <> 5 THEN 'model-' || (k % 6) END AS "aiModel",
    u, k, n, cents, raw_type, CASE WHEN u % 3 = 0 THEN 'B2B' ELSE 'B2C' END AS seg
  FROM kinds
),
people AS (SELECT DISTINCT user_id AS u FROM events),
b2c_user AS (
  SELECT 'u-' || u AS "userId",
         CASE WHEN u % 17 = 0 THEN TRUE WHEN u % 19 = 0 THEN NULL ELSE FALSE END AS "isBanned"
  FROM people WHERE u % 3 <> 0
),
b2b_user AS (
  SELECT 'u-' || u AS "userId",
         CASE WHEN (u // 3) % 5 <> 0 THEN 't-' || ((u // 3) % 12) END AS "teamId",
         CASE WHEN (u // 3) % 5 <> 0 THEN 'Team ' || ((u // 3) % 12) END AS "teamName"
  FROM people WHERE u % 3 = 0
),
team AS (
  SELECT 't-' || t AS "teamId", CASE WHEN t < 2 THEN 'c-0' WHEN t < 5 THEN 'c-1' ELSE 'c-2' END AS "companyId"
  FROM range(12) r(t)
),
company AS (SELECT 'c-' || c AS "companyId", 'Company ' || c AS "companyName" FROM range(3) r(c)),
master(seg, pid, name, price) AS (
  VALUES ('B2C', 1, 'Starter', 259), ('B2C', 2, 'Standard', 499), ('B2C', 3, 'Pro', 999),
         ('B2C', 12, 'Free Trial', 0), ('B2B', 4, 'Biz Starter', 300), ('B2B', 6, 'Biz Standard', 600),
         ('B2B', 8, 'Biz Pro', 1200), ('B2B', 9, 'Free Trial VIP', 0), ('B2B', 11, 'Instructor', 0),
         ('B2B', 13, 'Biz Pro', 1300), ('B2B', 5, 'Internal 5', 0), ('B2B', 7, 'Internal 7', 0),
         ('B2B', 10, 'Internal 10', 0), ('B2B', 97, 'Internal 97', 0), ('B2B', 98, 'Internal 98', 0)
),
pkg AS (
  SELECT seg, CAST(pid AS BIGINT) AS pid, name, CAST(price AS DECIMAL(18,2)) AS price FROM master
  WHERE (seg = 'B2C' AND pid IN (1, 2, 3, 12)) OR (seg = 'B2B' AND pid NOT IN (5, 7, 10, 97, 98))
),
-- events that survive the ban and package rules, any date
live AS (
  SELECT * FROM dom
  WHERE CASE seg WHEN 'B2C' THEN pid IN (1, 2, 3, 12)
                   AND "userId" NOT IN (SELECT "userId" FROM b2c_user WHERE "isBanned")
             ELSE pid NOT IN (5, 7, 10, 97, 98) END
),
member AS (
  SELECT b."userId", b."teamId", b."teamName", t."companyId", c."companyName"
  FROM b2b_user b JOIN team t ON t."teamId" = b."teamId" JOIN company c ON c."companyId" = t."companyId"
)
"""

START = "DATE '2024-01-03'"
AS_OF = "DATE '2024-01-28'"
WINDOWED = f"date_id >= {START} AND date_id < {AS_OF}"


def query(final: str, *parts: str) -> str:
    """The sample mapping, then further named parts, then the final select."""
    return "WITH " + ",\n".join([DOM.strip(), *[p.strip() for p in parts]]) + "\n" + final.strip()
