"""Streaming face of the ingest: new document files, whole days replaced.

Every micro-batch lands its documents by local day and replaces the days it touches from all that has landed for
them, so a late event never leaves half a day behind, a repeated batch changes nothing, and only the touched days are
read again. A document that is sent again within ``resend_window`` of its first arrival is dropped by the stream itself, with state no longer than
that. Arrival, not event time, bounds that state, so no late document is lost; days far behind event time are
counted and left to ``replace_late``.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from meterglass import domain
from meterglass.functions import calendar, values
from meterglass.operators import normalize
from meterglass.sources import documents, lake, landing

ARRIVED, ID = "__arrived", "__id"


def _replace(spark: SparkSession, landed: str, schema: T.StructType, path: str, days: Sequence[date], tz: str, rate: Decimal) -> dict:
    if not days:
        return {}
    found = landing.read(spark, landed, schema, days)
    return lake.replace_days(normalize.normalize_events(found, rate=rate, tz=tz), path, days)


def _dated(docs: DataFrame, tz: str) -> DataFrame:
    """With the local day; a document without a time fails the job, as it has no day."""
    return docs.withColumn(documents.DAY, calendar.local_date(values.to_utc_timestamp(docs, "eventTimeStamp"), tz))


def replace_touched(batch: DataFrame, number: int, landed: str, path: str, *, tz: str = domain.TIME_ZONE,
                    rate: Decimal = domain.EXCHANGE_RATE, late_after: int | None = None) -> dict:
    rows = _dated(batch, tz)
    return _replace(batch.sparkSession, landed, rows.schema, path, landing.add(rows, landed, number, late_after), tz, rate)


def replace_late(like: DataFrame, landed: str, path: str, *, tz: str = domain.TIME_ZONE, rate: Decimal = domain.EXCHANGE_RATE) -> dict:
    """Replace the late days that wait, each once however many late batches it had. ``like``: documents as the stream parses them."""
    spark = like.sparkSession
    days = landing.waiting(spark, landed)
    done = _replace(spark, landed, _dated(like, tz).schema, path, days, tz, rate)
    if days:
        landing.settle(spark, landed, days)
    return done


def once(docs: DataFrame, window: str) -> DataFrame:
    """Documents of a stream, each id once within the window of its first arrival."""
    arrived = docs.withColumns({ARRIVED: F.current_timestamp(), ID: values.object_id_string(docs)})
    return arrived.withWatermark(ARRIVED, window).dropDuplicatesWithinWatermark([ID]).drop(ARRIVED, ID)


def stream_events(spark: SparkSession, source_path: str, events_path: str, checkpoint: str, *, landed: str | None = None,
                  tz: str = domain.TIME_ZONE, rate: Decimal = domain.EXCHANGE_RATE, resend_window: str | None = "1 day",
                  late_after: int | None = None) -> StreamingQuery:
    """Process all files not seen yet, then stop. ``landed``: folder of the landed documents, beside the checkpoint if not given.

    ``late_after``: days that are further behind the newest one wait for ``replace_late``.
    """
    landed = landed or landed_beside(checkpoint)
    docs = documents.parse_lines(spark.readStream.text(source_path), domain.EVENT_FIELDS)

    def on_batch(batch: DataFrame, number: int) -> None:
        replace_touched(batch, number, landed, events_path, tz=tz, rate=rate, late_after=late_after)

    return ((once(docs, resend_window) if resend_window else docs).writeStream
            .foreachBatch(on_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def land_files(spark: SparkSession, source_path: str, landed: str, checkpoint: str, *, tz: str = domain.TIME_ZONE,
               resend_window: str | None = None) -> None:
    """Land all document files not seen yet, by local day, and return when they lie there.

    Each file of a dump is parsed once, ever; whoever wants some days of it opens their folders alone.
    """
    docs = documents.parse_lines(spark.readStream.text(source_path), domain.EVENT_FIELDS)
    query = ((once(docs, resend_window) if resend_window else docs).writeStream
             .foreachBatch(lambda batch, number: landing.add(_dated(batch, tz), landed, number) and None)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()


def landed_days(spark: SparkSession, landed: str, days: Sequence[date], *, tz: str = domain.TIME_ZONE,
                id_buffer_hours: int = domain.ID_BUFFER_HOURS) -> DataFrame:
    """Landed documents of neighbouring days, as ``documents.extract_days`` gives those of a dump."""
    like = documents.parse_lines(spark.createDataFrame([], "value string"), domain.EVENT_FIELDS)
    found = landing.read(spark, landed, _dated(like, tz).schema, days)
    return documents.extract_days(found, min(days), max(days), tz=tz, id_buffer_hours=id_buffer_hours)


def landed_beside(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}-landed"
