"""Reading raw documents: JSON lines or parquet, one local day at a time.

JSON values keep their types: each asked field is a variant, so a number, a flag, a text and an object stay apart. A line that isn't
a JSON document fails the job; ``split_lines`` sets such lines aside where that is wanted.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterglass import domain
from meterglass.functions import calendar, values


#: Fields of which the source's own JSON text is kept as well, for the order of their keys.
NESTED_FIELDS = ("deductionBreakdown",)
_BROKEN = "malformed JSON document"


def text_schema(fields: Sequence[str]) -> T.StructType:
    """Every field as text, for frames that never were JSON."""
    return T.StructType([T.StructField(name, T.StringType()) for name in fields])


def parse_lines(lines: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Documents of the text lines in ``value``: a variant for each field, NULL where a document lacks it."""
    value = F.col("value")
    names = ", ".join(f"`{name}` variant" for name in fields)
    whole = F.from_json(value, names, {"mode": "FAILFAST"})
    raw = {values.raw_name(n): F.from_json(value, f"`{n}` string", {"mode": "FAILFAST"})[n] for n in NESTED_FIELDS if n in fields}
    return lines.where(F.trim(value) != "").select(whole.alias("doc"), *(c.alias(n) for n, c in raw.items())).select("doc.*", *raw)


def read_json(spark: SparkSession, path: str, fields: Sequence[str]) -> DataFrame:
    return parse_lines(spark.read.text(path), fields)


def split_lines(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents, rejected lines) of text lines, for loads that must not stop on a bad one."""
    good = F.schema_of_variant(F.try_parse_json("value")).startswith("OBJECT")
    filled = lines.where(F.trim("value") != "")
    return filled.where(good), filled.where(~F.coalesce(good, F.lit(False)))


def read_full(spark: SparkSession, path: str, fields: Sequence[str], form: str = "json") -> DataFrame:
    """A whole collection, reduced to the asked columns at the scan."""
    if form == "json":
        return read_json(spark, path, fields)
    return project(spark.read.format(form).load(path), fields)


def project(docs: DataFrame, fields: Sequence[str]) -> DataFrame:
    """The asked fields in order; a field the source lacks is NULL text."""
    return docs.select(*[
        F.col(f"`{name}`") if name in docs.columns else F.lit(None).cast("string").alias(name)
        for name in fields
    ], *[name for name in map(values.raw_name, fields) if name in docs.columns])


def day_range(ts: Column, first: date, last: date, tz: str, *, ntz: bool = False) -> Column:
    """Instants of the local days first..last, as a half-open range on the stored column."""
    start, _ = calendar.day_bounds_utc(first, tz)
    _, end = calendar.day_bounds_utc(last, tz)
    return (ts >= calendar.instant_literal(start, ntz=ntz)) & (ts < calendar.instant_literal(end, ntz=ntz))


def id_range(object_id: Column, first: date, last: date, tz: str, buffer_hours: int) -> Column:
    """Coarse range on the id, so that row groups outside it are skipped.

    Correct as long as an event is stored within ``buffer_hours`` of its own time.
    """
    start, _ = calendar.day_bounds_utc(first, tz)
    _, end = calendar.day_bounds_utc(last, tz)
    room = timedelta(hours=buffer_hours)
    return ((object_id >= calendar.object_id_floor(start - room))
            & (object_id < calendar.object_id_floor(end + room)))


def _id_in_range(docs: DataFrame, first: date, last: date, tz: str, buffer_hours: int) -> Column:
    """Id range on the stored column where it is plain text, so that the files can skip on it."""
    bare = id_range(values.object_id_string(docs, required=False), first, last, tz, buffer_hours)
    if not isinstance(docs.schema["_id"].dataType, T.StringType):
        return bare
    wrapped = F.col("_id").startswith("{")
    return (id_range(F.col("_id"), first, last, tz, buffer_hours) | wrapped) & bare


def extract_days(docs: DataFrame, first: date, last: date, *, tz: str = domain.TIME_ZONE,
                 id_buffer_hours: int = domain.ID_BUFFER_HOURS) -> DataFrame:
    """Event documents of the local days first..last (``id_buffer_hours=0`` drops the id range)."""
    ntz = calendar.is_ntz(docs, "eventTimeStamp")
    ts = F.col("eventTimeStamp") if ntz else values.to_utc_timestamp(docs, "eventTimeStamp", required=False)
    keep = day_range(ts, first, last, tz, ntz=ntz)
    if id_buffer_hours > 0:
        keep = _id_in_range(docs, first, last, tz, id_buffer_hours) & keep
    return project(docs.where(keep), domain.EVENT_FIELDS)


def extract_day(docs: DataFrame, day: date, **options) -> DataFrame:
    return extract_days(docs, day, day, **options)


DAY = "__local_day"


def _with_day(docs: DataFrame, tz: str) -> DataFrame:
    return docs.withColumn(DAY, calendar.local_date(values.to_utc_timestamp(docs, "eventTimeStamp", required=False), tz))


def land(docs: DataFrame, first: date, last: date, path: str, *, tz: str = domain.TIME_ZONE,
         id_buffer_hours: int = domain.ID_BUFFER_HOURS) -> DataFrame:
    """The documents of some days as parquet by local day, for readers of one day at a time."""
    found = _with_day(extract_days(docs, first, last, tz=tz, id_buffer_hours=id_buffer_hours), tz)
    found.write.partitionBy(DAY).parquet(path)
    return docs.sparkSession.read.schema(found.schema).parquet(path)


def landed_days(landed: DataFrame, days: Sequence[date]) -> DataFrame:
    """Landed documents of those days; other days' files are not read."""
    return landed.where(F.col(DAY).isin(*days)).drop(DAY)
