"""User-day tracking products."""

from __future__ import annotations

from meterglass.plans import tracking
from meterglass.registry.common import on_sample
from meterglass.registry.sql import AS_OF, WINDOWED, query
from meterglass.sources.sample import AS_OF as TODAY
from meterglass.sources.sample import START_DATE

WINDOW = {"start_date": START_DATE, "as_of": TODAY}

KEYS = """strftime(date_id, '%Y%m') AS month_id,
    strftime(date_id, '%Y') || lpad(CAST(weekofyear(date_id) AS VARCHAR), 2, '0') AS week_id, date_id, "userId" """

B2C = f"""
c_rows AS (
  SELECT e.*, p.name FROM live e JOIN pkg p ON p.seg = e.seg AND p.pid = e.pid
  WHERE e.seg = 'B2C' AND {WINDOWED}
),
c_user AS (
  SELECT "userId", list_sort(list(DISTINCT name)) AS names, max(pid) AS top,
         max(date_id) AS last_day,
         min(("eventTimeStamp", event_id)) FILTER (WHERE "eventType" = 'Subscribe' AND pid = 12) AS trial_at,
         min(("eventTimeStamp", event_id)) FILTER (WHERE "eventType" = 'Subscribe' AND pid <> 12) AS paid_at
  FROM c_rows GROUP BY "userId"
),
c_day AS (
  SELECT r."userId", r.date_id, max(r.name) AS "packageName",
    CAST(max(CASE WHEN ("eventTimeStamp", event_id) = paid_at AND trial_at < paid_at THEN 1 ELSE 0 END) AS BIGINT)
      AS trial_conversion_cnt,
    CAST(sum(-"eggToken") FILTER (WHERE "eventType" = 'Token Used') AS BIGINT) AS token_used,
    CAST(sum("totalCostThb") FILTER (WHERE "eventType" = 'Token Used') AS DECIMAL(38,6)) AS "totalCostThb",
    CAST(sum(-"eggToken") FILTER (WHERE "eventType" = 'Token Used' AND names[1] = 'Free Trial' AND pid = top)
      AS BIGINT) AS free_trial_token_used
  FROM c_rows r JOIN c_user u ON u."userId" = r."userId" GROUP BY r."userId", r.date_id
),
tracking_b2c AS (
  SELECT {KEYS.replace('"userId"', 'd."userId"')}, "packageName", trial_conversion_cnt, token_used, "totalCostThb",
    free_trial_token_used, names[1] AS package_1, names[2] AS package_2,
    (SELECT count(*) FROM c_day o WHERE o."userId" = d."userId" AND o.date_id <= d.date_id) AS event_row,
    CAST(CASE WHEN date_id = last_day THEN 1 ELSE 0 END AS BIGINT) AS current_package_flag,
    p.pid AS "packageId", {AS_OF} - 1 AS run_date
  FROM c_day d JOIN c_user u ON u."userId" = d."userId" JOIN pkg p ON p.seg = 'B2C' AND p.name = d."packageName"
)
"""

B2B = f"""
b_rows AS (
  SELECT e.*, p.name FROM dom e JOIN pkg p ON p.seg = e.seg AND p.pid = e.pid
  WHERE e.seg = 'B2B' AND {WINDOWED}
),
b_user AS (
  SELECT "userId", list_sort(list(DISTINCT name)) AS names, max(date_id) AS last_day FROM b_rows GROUP BY "userId"
),
b_day AS (
  SELECT "userId", date_id, max(name) AS "packageName",
    CAST(sum(-"eggToken") FILTER (WHERE "eventType" = 'Token Used') AS BIGINT) AS token_used,
    CAST(sum("totalCostThb") FILTER (WHERE "eventType" = 'Token Used') AS DECIMAL(38,6)) AS "totalCostThb"
  FROM b_rows GROUP BY "userId", date_id
),
size AS (
  SELECT "companyId", CAST((count(DISTINCT "userId") + 9) // 10 AS BIGINT) AS bin FROM member GROUP BY "companyId"
),
b_full AS (
  SELECT d.*, m."teamId", m."teamName", m."companyId", m."companyName", s.bin, u.names, u.last_day, p.pid
  FROM b_day d JOIN b_user u ON u."userId" = d."userId" JOIN member m ON m."userId" = d."userId"
  JOIN size s ON s."companyId" = m."companyId" JOIN pkg p ON p.seg = 'B2B' AND p.name = d."packageName"
),
tracking_b2b AS (
  SELECT {KEYS}, "packageName", token_used, "totalCostThb", names[1] AS package_1, names[2] AS package_2,
    "teamId", "teamName", "companyId", "companyName", bin AS number_of_user_bin,
    '(' || (bin * 10 - 9) || '-' || (bin * 10) || ')' AS company_size_range,
    dense_rank() OVER (PARTITION BY "userId" ORDER BY date_id) AS event_row,
    dense_rank() OVER (PARTITION BY "companyId" ORDER BY date_id) AS company_first_event_row,
    dense_rank() OVER (PARTITION BY "teamId" ORDER BY date_id) AS team_first_event_row,
    CAST(CASE WHEN date_id = last_day THEN 1 ELSE 0 END AS BIGINT) AS current_package_flag,
    pid AS "packageId", {AS_OF} - 1 AS run_date
  FROM b_full
)
"""

TOTAL = """
tracking_total AS (
  SELECT 'B2C' AS version, * REPLACE (coalesce(package_2, 'null') AS package_2), 'null' AS "teamId", 'null' AS "teamName", 'null' AS "companyId",
         'null' AS "companyName", 'null' AS company_size_range, CAST(NULL AS BIGINT) AS number_of_user_bin,
         CAST(NULL AS BIGINT) AS company_first_event_row, CAST(NULL AS BIGINT) AS team_first_event_row
  FROM tracking_b2c
  UNION ALL BY NAME
  SELECT 'B2B' AS version, * REPLACE (coalesce(package_2, 'null') AS package_2) FROM tracking_b2b
)
"""

NUMERIC = 'SELECT * REPLACE (TRY_CAST(month_id AS BIGINT) AS month_id, TRY_CAST(week_id AS BIGINT) AS week_id) FROM '


def b2c(s):
    return tracking.user_tracking_b2c(s.b2c_events, s.b2c_packages, s.b2c_users, **WINDOW)


def b2b(s):
    return tracking.user_tracking_b2b(s.b2b_events, s.b2b_packages, s.b2b_users, s.team, s.company, **WINDOW)


def total(s):
    return tracking.user_tracking_total(b2c(s), b2b(s))


on_sample("user_tracking_b2c", query("SELECT * FROM tracking_b2c", B2C))(b2c)
on_sample("user_tracking_b2b", query("SELECT * FROM tracking_b2b", B2B))(b2b)
on_sample("user_tracking_total", query("SELECT * FROM tracking_total", B2C, B2B, TOTAL))(total)
on_sample("compat_b2c", query(NUMERIC + "tracking_b2c", B2C))(lambda s: tracking.numeric_keys(b2c(s)))
on_sample("compat_b2b", query(NUMERIC + "tracking_b2b", B2B))(lambda s: tracking.numeric_keys(b2b(s)))
on_sample("compat_total", query(NUMERIC + "tracking_total", B2C, B2B, TOTAL))(
    lambda s: tracking.numeric_keys(total(s)))
