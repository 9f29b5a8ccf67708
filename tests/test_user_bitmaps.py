"""Distinct users from bitmaps beside distinct counts."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from meterglass.plans import reports, user_bitmaps
from meterglass.sources import commits

JANUARY = [date(2024, 1, d) for d in range(1, 21)]


def user_days(spark, rows):
    return spark.createDataFrame(rows, "version string, date_id date, userId string")


def story(seed, n=600, users=120):
    pick = random.Random(seed)
    return [(pick.choice(("B2C", "B2B")), pick.choice(JANUARY), pick.choice([None, *(f"u{i}" for i in range(users))])) for _ in range(n)]


def counts(frame):
    return [tuple(r) for r in frame.collect()]


def plain(rows, first, last):
    out = {}
    for version, day, user in rows:
        if first <= day <= last:
            out.setdefault(version, set()).add(user)
    return sorted((v, len(u - {None})) for v, u in out.items())


def same(spark, rows, path):
    frame, maps = user_days(spark, rows), user_bitmaps.read(spark, path)
    assert counts(user_bitmaps.weekly_users(maps, date(2024, 1, 3))) == counts(reports.weekly_users(frame, date(2024, 1, 3)))
    for window in (1, 7):
        end = F.lit(date(2024, 1, 18))
        assert counts(user_bitmaps.active_users(maps, end, window)) == counts(reports.active_users(frame, end, window))
    assert sorted(counts(user_bitmaps.users_between(maps, JANUARY[4], JANUARY[9]))) == plain(rows, JANUARY[4], JANUARY[9])


@pytest.mark.parametrize("groups", [user_bitmaps.GROUPS, 1])
def test_windows_equal_distinct_counts(spark, tmp_path, monkeypatch, groups):
    monkeypatch.setattr(user_bitmaps, "GROUPS", groups)
    path, rows = str(tmp_path), story(1)
    none = spark.createDataFrame([], "userId string")
    early = [r for r in rows if r[1] <= JANUARY[9] and len(r[2] or "") != 3]
    user_bitmaps.update(user_days(spark, early), none, path, changed=JANUARY[:10])
    same(spark, early, path)
    user_bitmaps.update(user_days(spark, rows), none, path, changed=JANUARY)
    same(spark, rows, path)
    numbers = user_bitmaps._numbers(spark, path, commits.last(spark, path).entries).collect()
    assert len(numbers) == len({r.userId for r in numbers}) == len({r.number for r in numbers}) == len({r[2] for r in rows} - {None})


def test_bans_take_a_user_out_and_bring_it_back(spark, tmp_path):
    path, rows = str(tmp_path), story(2, n=200, users=40)
    none, bad = (spark.createDataFrame(r, "userId string") for r in ([], [("u7",), ("nobody",)]))
    assert user_bitmaps.update(user_days(spark, rows), none, path, changed=JANUARY) == JANUARY
    without = [r for r in rows if r[2] != "u7"]
    theirs = sorted({r[1] for r in rows if r[2] == "u7"})
    assert user_bitmaps.update(user_days(spark, without), bad, path) == theirs
    same(spark, without, path)
    assert user_bitmaps.update(user_days(spark, rows), none, path) == theirs
    same(spark, rows, path)
    assert user_bitmaps.update(user_days(spark, rows), none, path) == []


def test_without_rows(spark, tmp_path):
    none = spark.createDataFrame([], "userId string")
    user_bitmaps.update(user_days(spark, []), none, str(tmp_path))
    maps = user_bitmaps.read(spark, str(tmp_path))
    assert counts(user_bitmaps.active_users(maps, F.lit(date(2024, 1, 5)), 3)) == [(0, 0)]
