"""Tables kept by local day, whose days become visible together.

A write goes to a folder of its own; which folder holds which day of which table is listed in a commit (``commits``). A block
of days, of one table or several, is thus replaced at once for every reader, with emptied days left out of the list, and a
write that fails midway changes nothing. A reader opens the listed day folders in one scan, pruned by ``date_id``.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from meterglass.sources import commits

DAY = "date_id"
#: Levels of folders above the days; no column of a table may have these names.
RUN, TABLE = "in_run", "in_table"


def new_run() -> str:
    return uuid.uuid4().hex


def folder_of(run: str, table: str) -> str:
    return f"{RUN}={run}/{TABLE}={table}"


def write(frame: DataFrame, path: str, table: str, run: str) -> dict[str, str]:
    """Write the frame's days; gives the entries that name them. Nothing is visible before a commit that has them."""
    folder = f"{path}/data/{folder_of(run, table)}"
    frame.write.partitionBy(DAY).parquet(folder)
    found = (n.removeprefix(f"{DAY}=") for n in commits.names_in(frame.sparkSession, folder) if n.startswith(f"{DAY}="))
    return {f"{table} {day}": run for day in found}


def write_tables(frame: DataFrame, path: str, tables: Sequence[str], run: str) -> dict[str, dict[str, str]]:
    """Write the days of several tables in one job; the column ``TABLE`` says whose a row is. Gives the entries of each table."""
    folder = f"{path}/data/{RUN}={run}"
    frame.write.partitionBy(TABLE, DAY).parquet(folder)
    names = {t: commits.names_in(frame.sparkSession, f"{folder}/{TABLE}={t}") for t in tables}
    return {t: {f"{t} {n.removeprefix(f'{DAY}=')}": run for n in found if n.startswith(f"{DAY}=")} for t, found in names.items()}


def replaced(entries: Mapping[str, str], table: str, days: Iterable[date], new: Mapping[str, str]) -> dict[str, str]:
    """The list with these days of the table taken from ``new`` alone; days that it lacks are empty."""
    gone = {f"{table} {day}" for day in days}
    return {k: v for k, v in entries.items() if k not in gone} | dict(new)


def days_of(entries: Mapping[str, str], table: str) -> dict[date, str]:
    return {date.fromisoformat(key.split(" ")[1]): run for key, run in entries.items() if key.split(" ")[0] == table}


def read(spark: SparkSession, path: str, entries: Mapping[str, str], table: str, schema: T.StructType,
         days: Sequence[date] | None = None) -> DataFrame:
    """The table as listed, in schema order; ``days``: no others are opened."""
    listed = locations(path, entries, table)
    folders = [folder for day, folder in sorted(listed.items()) if days is None or day in set(days)]
    if not folders:
        return spark.createDataFrame([], schema)
    whole = T.StructType([*schema.fields, T.StructField(RUN, T.StringType()), T.StructField(TABLE, T.StringType())])
    return spark.read.schema(whole).option("basePath", f"{path}/data").parquet(*folders).select(*schema.names)


def locations(path: str, entries: Mapping[str, str], table: str) -> dict[date, str]:
    """The folder of each day."""
    return {day: f"{path}/data/{folder_of(run, table)}/{DAY}={day}" for day, run in days_of(entries, table).items()}


def changed(now: Mapping[date, str], seen: Mapping[date, str]) -> list[date]:
    """Days that were written, or emptied, since they were seen: those held by another run."""
    return sorted(day for day in {*now, *seen} if now.get(day) != seen.get(day))


def prune(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Remove the commits before the last ``keep``, and the folders of runs and days that these don't name; see ``commits.prune``."""
    lists = commits.recent(spark, path, keep)
    removed = commits.prune(spark, path, keep, lambda entries: {f"{RUN}={run}" for run in entries.values()})
    runs = {run for entries in lists for run in entries.values()}
    named = {(run, *key.split(" ")) for entries in lists for key, run in entries.items()}
    for run in runs:
        for table in commits.names_in(spark, f"{path}/data/{RUN}={run}"):
            folder = f"{path}/data/{RUN}={run}/{table}"
            for day in commits.names_in(spark, folder):
                if day.startswith(f"{DAY}=") and (run, table.removeprefix(f"{TABLE}="), day.removeprefix(f"{DAY}=")) not in named:
                    removed += commits.remove(spark, f"{folder}/{day}")
    return removed
