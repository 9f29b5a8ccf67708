"""Summaries kept by day beside a rebuild from all events."""

import random
from datetime import date

import pytest
from helpers import events, packages, rows, users

from meterglass.plans import summary, summary_state
from meterglass.sources import commits, days

SUB, RESET, END, USE = "Subscribe", "MonthlyReset", "MainExpired", "Token Used"
JANUARY = [date(2024, 1, d) for d in range(1, 11)]


class Lake:
    """Masters that may change, and events of both segments."""

    def __init__(self, spark, path):
        self.spark, self.path = spark, path
        self.b2c_packages = packages(spark, (1, "Starter", 259), (2, "Standard", 499), (2, "Standard", 499), (12, "Free Trial", 0))
        self.b2b_packages = packages(spark, (4, "Biz", 300), (9, "Free Trial VIP", 0))
        self.users = users(spark)
        self.team = spark.createDataFrame([("t", "c")], "teamId string, companyId string")
        self.company = spark.createDataFrame([("c", "C")], "companyId string, companyName string")
        self.members = spark.createDataFrame([("a", "t", "T")], "userId string, teamId string, teamName string")

    def masters(self):
        return self.users, self.members, self.team, self.company

    def update(self, b2c, b2b, changed):
        return summary_state.update(b2c, b2b, *self.masters(), self.path, changed=changed)

    def stored(self):
        return tuple(rows(f.select(*sorted(f.columns))) for f in (
            summary_state.summary_daily(self.spark, self.path, self.b2c_packages, self.b2b_packages),
            summary_state.summary_model_daily(self.spark, self.path, self.b2c_packages, self.b2b_packages)))

    def rebuilt(self, b2c, b2b):
        args = (b2c, b2b, self.b2c_packages, self.b2b_packages, *self.masters())
        return tuple(rows(f.select(*sorted(f.columns))) for f in (summary.summary_daily(*args), summary.summary_model_daily(*args)))


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "summary"))


def story(seed, numbers, n=150):
    pick = random.Random(seed)
    out = []
    for i in range(n):
        kind = pick.choice((SUB, SUB, END, RESET, USE, USE, None))
        out.append((f"e{i:03d}", f"{pick.randint(1, 10):02d} {pick.choice((1, 9)):02d}:00", pick.choice(("a", "b", "c", None)), kind,
                    pick.choice(("s", "t", "v", None)), pick.choice(numbers), -pick.randint(1, 9), "1.5"))
    return out


def test_a_late_first_event_takes_the_count(spark, lake):
    """The subscription first seen on the 4th turns out to begin on the 2nd."""
    known = [("b", "04 10:00", "u", SUB, "s", "1", 100), ("c", "05 10:00", "u", SUB, "s", "1", 100), ("d", "06 10:00", "w", USE, "s", "1", -5)]
    whole = [*known, ("a", "02 10:00", "u", SUB, "s", "2", 100)]
    none = events(spark)
    assert lake.update(events(spark, *known), none, JANUARY) == JANUARY
    first = commits.last(spark, lake.path).entries
    assert lake.update(events(spark, *whole), none, [date(2024, 1, 2)]) == [date(2024, 1, 2), date(2024, 1, 4)]
    found = {(r.date_id, r.packageId): r.new_subscriptions for r in summary_state.summary_daily(
        spark, lake.path, lake.b2c_packages, lake.b2b_packages).collect()}
    assert found[date(2024, 1, 2), 2] == 2 and (date(2024, 1, 4), 1) not in found   # the master lists number 2 twice
    now = commits.last(spark, lake.path).entries
    assert {k for k in first if now.get(k) != first[k]} <= {"people", *(f"{t} 2024-01-04" for t in ("winners", "daily", "models"))}
    assert lake.stored() == lake.rebuilt(events(spark, *whole), none)
    # The row goes again: the 4th has its count back.
    assert lake.update(events(spark, *known), none, [date(2024, 1, 2)]) == [date(2024, 1, 2), date(2024, 1, 4)]
    assert lake.stored() == lake.rebuilt(events(spark, *known), none)


def test_days_in_any_order_equal_the_rebuild(spark, lake, seed=1):
    pick = random.Random(seed)
    b2c, b2b = story(seed, ("1", "2", "12", "7")), story(seed + 10, ("4", "9", "5"))
    late = [r for r in b2c + b2b if r[1][:2] in ("03", "04") and pick.random() < .6]

    def frames(last, missing=()):
        return [events(spark, *(r for r in part if int(r[1][:2]) <= last and r not in missing)) for part in (b2c, b2b)]

    lake.update(*frames(6, late), JANUARY[:6])
    assert lake.stored() == lake.rebuilt(*frames(6, late))
    lake.update(*frames(10), [JANUARY[2], JANUARY[3], *JANUARY[6:]])
    assert lake.stored() == lake.rebuilt(*frames(10))


def test_bans_companies_and_prices_change(spark, lake):
    b2c, b2b = events(spark, *story(5, ("1", "2", "12"))), events(spark, *story(6, ("4", "9")))
    lake.update(b2c, b2b, JANUARY)
    lake.users = users(spark, ("a", True), ("b", False))
    assert lake.update(b2c, b2b, []) != []
    assert lake.stored() == lake.rebuilt(b2c, b2b)
    lake.users, lake.members = users(spark), spark.createDataFrame([("b", "t", "T")], "userId string, teamId string, teamName string")
    lake.b2c_packages = packages(spark, (1, "Starter", 1000), (12, "Free Trial", 0))
    lake.update(b2c, b2b, [])
    assert lake.stored() == lake.rebuilt(b2c, b2b)
    assert lake.update(b2c, b2b, []) == []


def test_a_failed_run_changes_nothing(spark, lake, monkeypatch):
    b2c, none = events(spark, *story(7, ("1", "12"))), events(spark)
    lake.update(b2c, none, JANUARY)
    want = lake.stored()
    real, calls = days.write, []

    def failing(frame, path, table, run):
        calls.append(table)
        if table == "daily":
            raise RuntimeError("lost")
        return real(frame, path, table, run)

    monkeypatch.setattr(days, "write", failing)
    with pytest.raises(RuntimeError):
        lake.update(none, none, JANUARY)
    monkeypatch.undo()
    assert calls and lake.stored() == want
    assert lake.update(none, none, JANUARY) == JANUARY
    assert lake.stored() == ([], [])
    assert all(n.startswith(days.RUN) for n in commits.names_in(spark, f"{lake.path}/data"))


def test_versions_of_days_show_what_changed(spark, lake):
    b2c, none = events(spark, *story(9, ("1", "12"))), events(spark)
    seen = {d: "v1" for d in JANUARY}

    def run(versions):
        return summary_state.update(b2c, none, *lake.masters(), lake.path, versions={"B2C": versions, "B2B": {}})

    assert run(seen) == JANUARY
    assert run(seen) == []
    assert JANUARY[4] in run(seen | {JANUARY[4]: "v2"})
    assert run(seen | {JANUARY[4]: "v2"}) == []
    assert lake.stored() == lake.rebuilt(b2c, none)
