"""Behaviour from merged days beside a rebuild from all events."""

import random
from datetime import date

import pytest
from helpers import b2c_packages, events, rows, users

from meterglass.plans import behavior, behavior_state, cycles

BOUNDS = {"start_date": date(2024, 1, 2), "as_of": date(2024, 1, 20)}
JANUARY = [date(2024, 1, d) for d in range(1, 22)]


def story(seed, n=260):
    pick = random.Random(seed)
    out = []
    for i in range(n):
        kind = pick.choice(("Subscribe", "Subscribe", "MainExpired", "MonthlyReset", "Token Used"))
        day = pick.randint(1, 21)
        row = (f"e{i:03d}", f"{day:02d} {pick.choice((1, 9)):02d}:00", pick.choice(("a", "b", "c", "d", None)), kind,
               pick.choice(("s", "t", "v", None)), pick.choice(("1", "2", "12", "4")), pick.choice((50, -5)), "1.5")
        out.append(row)
        if i % 9 == 0 and day < 19:   # a copy on a later day, within the reach of copies
            out.append((row[0], f"{day + pick.randint(1, 3):02d} 05:00", *row[2:]))
    return out


def both(spark, frame, path, people, limit=10_000):
    made = cycles.token_cycles(frame, b2c_packages(spark), people, **BOUNDS)
    want = behavior.repeat_behavior(made, frame, b2c_packages(spark), people, mature_days=6, rows_per_run=limit, **BOUNDS)
    got = behavior_state.repeat_behavior(made, path, frame, b2c_packages(spark), people, mature_days=6, rows_per_run=limit, **BOUNDS)
    return rows(got), rows(want)


@pytest.mark.parametrize("seed,limit", [(1, 10_000), (2, 3)])
def test_merged_days_equal_the_rebuild(spark, tmp_path, seed, limit):
    whole, path, people = story(seed), str(tmp_path), users(spark, ("d", True), ("a", False))
    some = [r for r in whole if r[1][:2] not in ("05", "06") and r[1][:2] < "15"]
    behavior_state.update(events(spark, *some), path, changed=JANUARY[:14], **BOUNDS)
    got, want = both(spark, events(spark, *some), path, people, limit)
    assert got == want and got
    again = behavior_state.update(events(spark, *whole), path, changed=[JANUARY[4], JANUARY[5], *JANUARY[14:]], **BOUNDS)
    assert again == [date(2024, 1, d) for d in (*range(5, 10), *range(15, 20))]
    got, want = both(spark, events(spark, *whole), path, people, limit)
    assert got == want
    # Another ban: nothing is folded again.
    got, want = both(spark, events(spark, *whole), path, users(spark, ("b", True)), limit)
    assert got == want


def test_versions_and_no_events(spark, tmp_path):
    path, none = str(tmp_path), events(spark)
    seen = {d: "v1" for d in JANUARY}
    assert behavior_state.update(none, path, versions=seen, **BOUNDS) == JANUARY[1:19]
    assert behavior_state.update(none, path, versions=seen, **BOUNDS) == []
    assert both(spark, none, path, users(spark)) == ([], [])
    assert behavior_state.update(none, path, versions=seen | {JANUARY[17]: "v2"}, **BOUNDS) == JANUARY[17:19]
