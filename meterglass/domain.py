"""Schemas and fixed business values shared by every builder."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import types as T

# ---------------------------------------------------------------- fixed values
# These must stay as they are: stored tables and reports depend on them.
TIME_ZONE = "Asia/Bangkok"
START_DATE = date(2026, 1, 1)
EXCHANGE_RATE = Decimal("32.67")
LOOKBACK_DAYS = 1
ID_BUFFER_HOURS = 24
MATURE_DAYS = 35
ROLLING_DAYS = 30
WEEKLY_SINCE = date(2026, 3, 1)
EXHAUST_SHARE = 0.95

TRIAL_PACKAGE = 12
B2C_PAID_PACKAGES = (1, 2, 3)
B2C_PACKAGES = (1, 2, 3, 12)
B2B_EXCLUDED_PACKAGES = (5, 7, 10, 97, 98)
B2C_SUBSCRIBER_NAMES = ("Starter", "Standard", "Pro")
B2B_SUBSCRIBER_NAMES = ("Biz Starter", "Biz Standard", "Biz Pro")
FREE_TRIAL_NAME = "Free Trial"
COMPANY_BIN = 10

SUBSCRIBE = "Subscribe"
MONTHLY_RESET = "MonthlyReset"
MAIN_EXPIRED = "MainExpired"
TOKEN_USED = "Token Used"
TRIAL_CONVERSION = "Trial Conversion"
LIFECYCLE = (SUBSCRIBE, MAIN_EXPIRED)
BOUNDARIES = (SUBSCRIBE, MONTHLY_RESET, MAIN_EXPIRED)
CYCLE_STARTS = (SUBSCRIBE, MONTHLY_RESET)

NULL_TEXT = "null"
UNKNOWN_MODEL = "(ไม่ระบุ)"

# metric key, label, sort order of the headline metrics
METRICS = (
    ("total_users", "ผู้ใช้ทั้งหมด", 1),
    ("b2c_users", "ผู้ใช้ B2C", 2),
    ("b2b_users", "ผู้ใช้ B2B", 3),
    ("b2c_subscriber", "B2C ผู้สมัครแบบเสียเงิน", 10),
    ("b2c_starter", "B2C Starter", 11),
    ("b2c_standard", "B2C Standard", 12),
    ("b2c_pro", "B2C Pro", 13),
    ("b2c_free_trial", "B2C Free Trial", 14),
    ("free_trial_conversion", "Free Trial Conversion", 20),
    ("to_starter", "แปลงเป็น Starter", 21),
    ("to_standard", "แปลงเป็น Standard", 22),
    ("to_pro", "แปลงเป็น Pro", 23),
    ("b2b_subscriber", "B2B ผู้สมัครแบบเสียเงิน", 30),
    ("b2b_biz_starter", "B2B Biz Starter", 31),
    ("b2b_biz_standard", "B2B Biz Standard", 32),
    ("b2b_biz_pro", "B2B Biz Pro", 33),
    ("b2b_others", "B2B อื่น ๆ (trial/ภายใน)", 34),
    ("b2b_companies", "จำนวนบริษัท B2B", 40),
)

# tile label and the figure it shows, in page order
TILES = (
    ("รายได้ (ประมาณการ)", "revenue"),
    ("ต้นทุน AI", "cost"),
    ("กำไรขั้นต้น", "profit"),
    ("ผู้ใช้ที่ใช้งานจริง", "users"),
    ("สมัครใหม่ (จ่ายเงิน)", "subs"),
    ("เริ่มทดลองใช้ฟรี", "trials"),
)

# --------------------------------------------------------------------- schemas
MONEY = T.DecimalType(18, 6)
PRICE = T.DecimalType(38, 9)
MONEY_SUM = "decimal(38,6)"


def _schema(spec: str) -> T.StructType:
    """``name type`` pairs, one per line; a trailing ``!`` marks a required column."""
    kinds = {
        "string": T.StringType(), "bigint": T.LongType(), "boolean": T.BooleanType(),
        "date": T.DateType(), "timestamp": T.TimestampType(), "money": MONEY, "price": PRICE,
    }
    fields = []
    for line in spec.strip().splitlines():
        name, kind = line.split()
        fields.append(T.StructField(name, kinds[kind.rstrip("!")], not kind.endswith("!")))
    return T.StructType(fields)


EVENT_SCHEMA = _schema("""
    event_id string!
    eventTimeStamp timestamp!
    date_id date!
    userId string
    eventType string
    subscriptionId string
    packageId string
    eggToken bigint
    chatToken bigint
    websearchToken bigint
    totalCostUsd money
    chatCostUsd money
    websearchCostUsd money
    externalToken bigint
    externalCostUsd money
    externalCostName string
    externalTransactionReference string
    traceId string
    aiModel string
    agentId string
    teamId string
    deductType string
    teamSubscriptionId string
    deductionBreakdown string
    totalCostThb money!
    _ingested_at timestamp!
""")

PACKAGE_SCHEMA = _schema("""
    packageId bigint!
    packageName string
    packageType string
    tierName string
    priceThb price
    eggToken bigint
    durationDay bigint
    durationMonth bigint
    createdAt timestamp
    updatedAt timestamp
    _ingested_at timestamp!
""")

USERS_SCHEMA = _schema("""
    userId string!
    isBanned boolean
    _ingested_at timestamp!
""")

B2B_USERS_SCHEMA = _schema("""
    userId string
    teamId string
    teamName string
    _ingested_at timestamp!
""")

COMPANY_SCHEMA = _schema("""
    companyId string
    companyName string
    _ingested_at timestamp!
""")

TEAM_SCHEMA = _schema("""
    teamId string
    companyId string
    _ingested_at timestamp!
""")

STATE_SCHEMA = _schema("""
    pipeline_name string!
    last_processed_date date!
    updated_at timestamp!
""")

# Source fields of each document collection (the columns a reader must ask for).
_DERIVED = {"event_id", "date_id", "totalCostThb", "_ingested_at"}
EVENT_FIELDS = ("_id",) + tuple(n for n in EVENT_SCHEMA.names if n not in _DERIVED)
PACKAGE_FIELDS = tuple(PACKAGE_SCHEMA.names[:-1])
USERS_FIELDS = tuple(USERS_SCHEMA.names[:-1])
B2B_USERS_FIELDS = tuple(B2B_USERS_SCHEMA.names[:-1])
COMPANY_FIELDS = tuple(COMPANY_SCHEMA.names[:-1])
TEAM_FIELDS = tuple(TEAM_SCHEMA.names[:-1])
