"""Numbered commits: which folders make up a table at a time.

A commit is one small file with the whole list of (key, value) pairs. It is written beside the others under a
passing name and then renamed to the next number, which fails if another run has taken that number:
whoever read number n may only write n + 1. A reader takes the highest number and sees all of a commit or nothing of it, so any
number of day folders (or emptied days) become visible at once. The list is as long as the table has days, not rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from py4j.java_gateway import JavaObject
from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

DIGITS = 12


class Conflict(RuntimeError):
    """Another run has committed since the list was read."""


@dataclass(frozen=True)
class Commit:
    number: int = 0
    entries: Mapping[str, str] = field(default_factory=dict)


def _hadoop(spark: SparkSession) -> JavaObject:
    return spark.sparkContext._jvm.org.apache.hadoop.fs


def _path(spark: SparkSession, path: str) -> JavaObject:
    return _hadoop(spark).Path(path)


def _files(spark: SparkSession, path: str) -> JavaObject:
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _name(number: int) -> str:
    return f"{number:0{DIGITS}d}.json"


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files and folders in a folder; a folder that isn't there has none."""
    files = _files(spark, folder)
    if not files.exists(_path(spark, folder)):
        return []
    return sorted(f.getPath().getName() for f in files.listStatus(_path(spark, folder)))


def remove(spark: SparkSession, path: str) -> bool:
    return _files(spark, path).delete(_path(spark, path), True)


def _numbers(spark: SparkSession, path: str) -> list[str]:
    return [n for n in names_in(spark, f"{path}/commits") if n.endswith(".json")]


def _entries(spark: SparkSession, path: str, name: str) -> dict[str, str]:
    stream = _files(spark, path).open(_path(spark, f"{path}/commits/{name}"))
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def last(spark: SparkSession, path: str) -> Commit:
    """The commit in force; number 0 and no entries before the first."""
    numbers = _numbers(spark, path)
    if not numbers:
        return Commit()
    return Commit(int(numbers[-1].removesuffix(".json")), _entries(spark, path, numbers[-1]))


def commit(spark: SparkSession, path: str, read: Commit, entries: Mapping[str, str]) -> Commit:
    """The next commit after the one that was read; ``Conflict`` if there already is one."""
    folder, files = f"{path}/commits", _files(spark, path)
    files.mkdirs(_path(spark, folder))
    draft = f"{folder}/.{uuid.uuid4().hex}"
    out = files.create(_path(spark, draft))
    try:
        out.write(bytearray(json.dumps(dict(entries), sort_keys=True).encode()))
    finally:
        out.close()
    target = _path(spark, f"{folder}/{_name(read.number + 1)}")
    context = _hadoop(spark).FileContext.getFileContext(files.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    never = spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(_path(spark, draft), target, never)
    except Py4JJavaError as error:
        files.delete(_path(spark, draft), False)
        if files.exists(target):
            raise Conflict(f"commit {read.number + 1} of {path} was made by another run") from error
        raise
    return Commit(read.number + 1, dict(entries))


def change(spark: SparkSession, path: str, update: Callable[[Mapping[str, str]], Mapping[str, str]], tries: int = 20) -> Commit:
    """A change that may be made again on a newer list, where another run has come first."""
    for attempt in range(tries):
        read = last(spark, path)
        try:
            return commit(spark, path, read, update(read.entries))
        except Conflict:
            if attempt == tries - 1:
                raise
    raise AssertionError("unreachable")


def recent(spark: SparkSession, path: str, keep: int) -> list[dict[str, str]]:
    """The lists of the last ``keep`` commits."""
    return [_entries(spark, path, name) for name in _numbers(spark, path)[-keep:]]


def drop_before(spark: SparkSession, path: str, keep: int) -> None:
    """Remove the lists of all but the last ``keep`` commits."""
    for name in _numbers(spark, path)[:-keep]:
        remove(spark, f"{path}/commits/{name}")


def prune(spark: SparkSession, path: str, keep: int, folders: Callable[[Mapping[str, str]], set[str]]) -> int:
    """Remove all but the last ``keep`` commits, and the folders below ``path/data`` that none of these names.

    For use when no reader holds an older list and no other run writes. Gives the number of folders removed.
    """
    used = set().union(*(folders(entries) for entries in recent(spark, path, keep)))
    drop_before(spark, path, keep)
    old = [n for n in names_in(spark, f"{path}/data") if n not in used]
    return sum(remove(spark, f"{path}/data/{n}") for n in old)
