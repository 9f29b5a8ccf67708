"""Registration of queries beside their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterglass.sources.sample import Sample, load

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(query: Query) -> Query:
        assert name not in QUERIES, name
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return query
    return keep


def on_sample(name: str, sql: str | None = None) -> Callable[[Callable[[Sample], DataFrame]], Query]:
    """Register a query over the domain tables of the sample mapping."""
    def keep(build: Callable[[Sample], DataFrame]) -> Query:
        return register(name, sql)(lambda spark, sf_dir: build(load(spark, sf_dir)))
    return keep


def plain_time(frame: DataFrame) -> DataFrame:
    """Instants as zone-less UTC times, so that any session shows the same text."""
    instants = [f.name for f in frame.schema if isinstance(f.dataType, T.TimestampType)]
    return frame.withColumns({
        n: F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col(n).cast("timestamp_ntz")) for n in instants})
