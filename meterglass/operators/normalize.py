"""Documents to typed rows; every normaliser is one select in schema order."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterglass import domain
from meterglass.functions import calendar, values

MONEY_FIELDS = ("totalCostUsd", "chatCostUsd", "websearchCostUsd", "externalCostUsd")


def _ingest_time(at: datetime | None) -> Column:
    return F.lit(at) if at is not None else F.current_timestamp()


def _in_order(docs: DataFrame, schema: T.StructType, columns: dict[str, Column]) -> DataFrame:
    """Schema order and types; plain fields are read by their type."""
    def plain(field: T.StructField) -> Column:
        if isinstance(field.dataType, T.LongType):
            return values.to_int(docs, field.name)
        return values.to_string(docs, field.name)

    return docs.select(*[
        (columns[f.name] if f.name in columns else plain(f)).cast(f.dataType).alias(f.name) for f in schema
    ])


def normalize_events(docs: DataFrame, *, rate: Decimal = domain.EXCHANGE_RATE, tz: str = domain.TIME_ZONE,
                     ingested_at: datetime | None = None) -> DataFrame:
    """Event documents to the 26-column event table.

    A missing dollar amount stays missing in dollars and is zero in local currency.
    A document without an id or an instant fails the job.
    """
    instant = values.to_utc_timestamp(docs, "eventTimeStamp")
    money = {name: values.money_or_null(docs, name) for name in MONEY_FIELDS}
    return _in_order(docs, domain.EVENT_SCHEMA, {
        "event_id": values.object_id_string(docs),
        "eventTimeStamp": instant,
        "date_id": calendar.local_date(instant, tz),
        **money,
        "deductionBreakdown": values.json_text(docs, "deductionBreakdown"),
        "totalCostThb": values.cost_thb(money["totalCostUsd"], rate),
        "_ingested_at": _ingest_time(ingested_at),
    })


def normalize_packages(docs: DataFrame, *, ingested_at: datetime | None = None) -> DataFrame:
    """Package master; the list price is not rounded to money places."""
    return _in_order(docs, domain.PACKAGE_SCHEMA, {
        "priceThb": values.to_decimal(docs, "priceThb"),
        "createdAt": values.to_utc_timestamp(docs, "createdAt", required=False),
        "updatedAt": values.to_utc_timestamp(docs, "updatedAt", required=False),
        "_ingested_at": _ingest_time(ingested_at),
    })


def normalize_users(docs: DataFrame, *, ingested_at: datetime | None = None) -> DataFrame:
    """User and ban flag; a missing flag stays missing."""
    return _in_order(docs, domain.USERS_SCHEMA, {
        "isBanned": values.to_boolean(docs, "isBanned"), "_ingested_at": _ingest_time(ingested_at)})


def _text_master(schema: T.StructType):
    def normalize(docs: DataFrame, *, ingested_at: datetime | None = None) -> DataFrame:
        return _in_order(docs, schema, {"_ingested_at": _ingest_time(ingested_at)})
    return normalize


normalize_b2b_users = _text_master(domain.B2B_USERS_SCHEMA)
normalize_b2b_company = _text_master(domain.COMPANY_SCHEMA)
normalize_b2b_team = _text_master(domain.TEAM_SCHEMA)


def empty(docs: DataFrame, normalize=normalize_events) -> DataFrame:
    """No rows, but every column of the normalised table."""
    return normalize(docs.where(F.lit(False)))


def split_rejects(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable, rejected) event documents, for loads that must not stop on a bad one."""
    usable = values.to_string(docs, "_id").isNotNull() & values.to_string(docs, "eventTimeStamp").isNotNull()
    return docs.where(usable), docs.where(~usable)
