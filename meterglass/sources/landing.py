"""Documents landed by local day, from batches that may come again.

Which folders hold a day is listed in a commit (``commits``), so a reader of some days opens these alone, however many batches there were. A
day that many batches have touched is rewritten as one. Each batch also says how far event time has come: days that lie more than
an allowance behind it are late, are counted, and wait in the list for a run of their own instead of being replaced with every straggler.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from meterglass.sources import commits
from meterglass.sources.days import RUN
from meterglass.sources.documents import DAY

#: Folders of a day that are rewritten as one.
COMPACT = 8


@dataclass(frozen=True)
class Landed:
    """The list: folders of each day, the last batch with the days it touched, the newest day, late days that wait, and late rows."""
    folders: Mapping[str, list[str]] = field(default_factory=dict)
    batch: int = -1
    touched: list[str] = field(default_factory=list)
    newest: str = ""
    waiting: list[str] = field(default_factory=list)
    late_rows: int = 0

    @staticmethod
    def of(entries: Mapping[str, str]) -> Landed:
        return Landed(**json.loads(entries["landed"])) if entries else Landed()

    def entries(self) -> dict[str, str]:
        return {"landed": json.dumps(self.__dict__)}

    def with_(self, **changes) -> Landed:
        return Landed(**{**self.__dict__, **changes})


def listed(spark: SparkSession, path: str) -> Landed:
    return Landed.of(commits.last(spark, path).entries)


def _days(names: Iterable[str]) -> list[str]:
    return sorted(n.removeprefix(f"{DAY}=") for n in names if n.startswith(f"{DAY}="))


def add(rows: DataFrame, path: str, batch: int, allowance: int | None = None) -> list[date]:
    """Land a batch of documents with their local day (column ``DAY``); gives the days to replace now.

    A batch that comes again changes nothing and gives the same days. ``allowance``: days that are further than this behind the newest
    day so far wait as late ones (None: no day is late).
    """
    spark = rows.sparkSession
    have = listed(spark, path)
    if batch > have.batch:
        run = f"batch-{batch}"
        folder = f"{path}/data/{RUN}={run}"
        rows.write.mode("overwrite").partitionBy(DAY).parquet(folder)
        touched = _days(commits.names_in(spark, folder))
        late = [d for d in touched if allowance is not None and have.newest and
                date.fromisoformat(d) < date.fromisoformat(have.newest) - timedelta(days=allowance)]
        n_late = read(spark, path, rows.schema, [], {d: [run] for d in late}).count() if late else 0

        def landed(entries: Mapping[str, str]) -> dict[str, str]:
            now = Landed.of(entries)
            return now.with_(folders={**now.folders, **{d: [*now.folders.get(d, []), run] for d in touched}}, batch=batch,
                             touched=[d for d in touched if d not in late], newest=max([now.newest, *touched]),
                             waiting=sorted({*now.waiting, *late}), late_rows=now.late_rows + n_late).entries()
        have = Landed.of(commits.change(spark, path, landed).entries)
        _compact(spark, path, rows.schema, have)
    return [date.fromisoformat(d) for d in have.touched]


def read(spark: SparkSession, path: str, schema: T.StructType, days: Sequence[date], folders: Mapping[str, list[str]] | None = None) -> DataFrame:
    """Landed documents of those days, without the day; no other day's files are listed. ``folders``: these instead of the listed ones."""
    found = folders or {str(d): listed(spark, path).folders.get(str(d), []) for d in days}
    paths = [f"{path}/data/{RUN}={run}/{DAY}={d}" for d, runs in found.items() for run in runs]
    if not paths:
        return spark.createDataFrame([], schema).drop(DAY)
    whole = T.StructType([*schema.fields, T.StructField(RUN, T.StringType())])
    return spark.read.schema(whole).option("basePath", f"{path}/data").parquet(*paths).drop(DAY, RUN)


def _compact(spark: SparkSession, path: str, schema: T.StructType, have: Landed) -> None:
    """Rewrite days of many folders as one folder each; the files they came from go when the list has changed."""
    long = {d: runs for d, runs in have.folders.items() if len(runs) >= COMPACT}
    if not long:
        return
    run = f"days-{uuid.uuid4().hex}"
    whole = T.StructType([*schema.fields, T.StructField(RUN, T.StringType())])
    paths = [f"{path}/data/{RUN}={r}/{DAY}={d}" for d, runs in long.items() for r in runs]
    rows = spark.read.schema(whole).option("basePath", f"{path}/data").parquet(*paths).drop(RUN)
    rows.hint("rebalance", DAY).write.partitionBy(DAY).parquet(f"{path}/data/{RUN}={run}")

    def compacted(entries: Mapping[str, str]) -> dict[str, str]:
        now = Landed.of(entries)
        return now.with_(folders={d: [run, *(r for r in runs if r not in long[d])] if d in long else runs for d, runs in now.folders.items()}).entries()
    commits.change(spark, path, compacted)
    for gone in paths:
        commits.remove(spark, gone)
    commits.drop_before(spark, path, 2)


def settle(spark: SparkSession, path: str, days: Sequence[date]) -> None:
    """Take days that have been replaced off the late ones that wait."""
    done = {str(d) for d in days}
    commits.change(spark, path, lambda entries: Landed.of(entries).with_(
        waiting=[d for d in Landed.of(entries).waiting if d not in done]).entries())


def waiting(spark: SparkSession, path: str) -> list[date]:
    return [date.fromisoformat(d) for d in listed(spark, path).waiting]
