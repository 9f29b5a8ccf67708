"""Cycles carried from day to day beside a rebuild from all events."""

import random
from datetime import date, timedelta

import pytest
from helpers import b2c_packages, events, rows, users

from meterglass.plans import cycle_state, cycles
from meterglass.sources import commits, sample

START = date(2024, 1, 1)
SUB, RESET, END, USE, LATE = "Subscribe", "MonthlyReset", "MainExpired", "Token Used", "Token Used (Unsettled)"


def rebuilt(spark, frame, as_of, people=None):
    return rows(cycles.token_cycles(frame, b2c_packages(spark), people or users(spark), start_date=START, as_of=as_of))


def carried(spark, frame, path, people=None):
    return rows(cycle_state.token_cycles(frame, path, b2c_packages(spark), people or users(spark)))


def story(seed, n=400, days=14):
    """Users with boundaries of all kinds in few instants, long silences, copies of events and a hot user."""
    pick = random.Random(seed)
    out = []
    for i in range(n):
        user = "hot" if i % 3 == 0 else pick.choice([None, "a", "b", "c", "d", "e"])
        kind = pick.choice((SUB, RESET, END, USE, USE, USE, LATE))
        day = pick.choice((1, 2, 3, 5, 5, 6, 9, 10, 11, 12, 13, days))
        egg = {SUB: pick.choice((100, 40, None)), RESET: 0, END: -pick.randint(0, 30)}.get(kind, -pick.randint(1, 30))
        row = (f"e{i:03d}", f"{day:02d} {pick.choice((0, 10, 23)):02d}:{pick.choice((0, 0, 30)):02d}", user, kind,
               pick.choice(("s", None)), pick.choice(("1", "2", "12", "4")), egg, pick.choice(("0.5", "1.25")))
        out.append(row)
        if i % 17 == 0:   # the same event once more, the day after
            out.append((row[0], f"{min(day + 1, days):02d} 12:00", *row[2:]))
    return out


@pytest.mark.parametrize("seed,limit", [(1, 10_000), (3, 4)])
def test_day_by_day_equals_the_rebuild(spark, tmp_path, seed, limit):
    frame = events(spark, *story(seed))
    path = str(tmp_path / "state")
    for as_of in (date(2024, 1, 4), date(2024, 1, 10), date(2024, 1, 16)):
        cycle_state.update(frame, path, start_date=START, as_of=as_of, rows_per_run=limit, single_days=1)
        assert carried(spark, frame, path) == rebuilt(spark, frame, as_of)


def test_late_events_are_read_again(spark, tmp_path):
    pick = random.Random(4)
    whole = story(5)
    late = [r for r in whole if r[1][:2] in ("09", "10") and pick.random() < .5]
    early = [r for r in whole if r not in late]
    path = str(tmp_path / "state")
    first, second = events(spark, *early), events(spark, *whole)
    cycle_state.update(first, path, start_date=START, as_of=date(2024, 1, 11), single_days=3)
    assert carried(spark, first, path) == rebuilt(spark, first, date(2024, 1, 11))
    done = cycle_state.update(second, path, start_date=START, as_of=date(2024, 1, 13), changed_from=date(2024, 1, 9), single_days=3)
    assert done[0][0] == date(2024, 1, 9)
    assert carried(spark, second, path) == rebuilt(spark, second, date(2024, 1, 13))
    # Nothing new: nothing is read; a day before all states: all is.
    assert cycle_state.update(second, path, start_date=START, as_of=date(2024, 1, 13)) == []
    done = cycle_state.update(second, path, start_date=START, as_of=date(2024, 1, 13), changed_from=START)
    assert done[0][0] == START
    assert carried(spark, second, path) == rebuilt(spark, second, date(2024, 1, 13))


def test_a_run_reads_its_day_and_the_state_only(spark, tmp_path, sf_dir):
    """The folders of days beyond the reach of copies are gone before the last run."""
    data = sample.load(spark, sf_dir)
    table, path = str(tmp_path / "events"), str(tmp_path / "state")
    data.b2c_events.write.partitionBy("date_id").parquet(table)
    frame = spark.read.schema(data.b2c_events.schema).parquet(table)
    want = rows(cycles.token_cycles(frame, data.b2c_packages, data.b2c_users, start_date=sample.START_DATE, as_of=sample.AS_OF))
    cycle_state.update(frame, path, start_date=sample.START_DATE, as_of=sample.AS_OF - timedelta(days=1))
    edge = sample.AS_OF - timedelta(days=2 + cycle_state.COPY_DAYS)
    for name in commits.names_in(spark, table):
        if name.startswith("date_id=") and date.fromisoformat(name[8:]) < edge:
            commits.remove(spark, f"{table}/{name}")
    frame = spark.read.schema(data.b2c_events.schema).parquet(table)
    assert cycle_state.update(frame, path, start_date=sample.START_DATE, as_of=sample.AS_OF) == [(sample.AS_OF - timedelta(days=1),) * 2]
    assert rows(cycle_state.token_cycles(frame, path, data.b2c_packages, data.b2c_users)) == want


def test_bans_count_when_cycles_are_read(spark, tmp_path):
    frame, path = events(spark, *story(6)), str(tmp_path / "state")
    cycle_state.update(frame, path, start_date=START, as_of=date(2024, 1, 16))
    people = users(spark, ("hot", True), ("a", False))
    assert carried(spark, frame, path, people) == rebuilt(spark, frame, date(2024, 1, 16), people)


def test_two_runs_at_once_and_a_failed_run(spark, tmp_path, monkeypatch):
    frame, path = events(spark, *story(7)), str(tmp_path / "state")
    cycle_state.update(frame, path, start_date=START, as_of=date(2024, 1, 8))
    want = carried(spark, frame, path)
    real = commits.commit

    def overtaken(spark_, path_, read, entries):
        real(spark_, path_, read, read.entries)
        return real(spark_, path_, read, entries)

    monkeypatch.setattr(commits, "commit", overtaken)
    with pytest.raises(commits.Conflict):
        cycle_state.update(frame, path, start_date=START, as_of=date(2024, 1, 10))
    monkeypatch.undo()
    assert carried(spark, frame, path) == want
    cycle_state.update(frame, path, start_date=START, as_of=date(2024, 1, 10))
    assert carried(spark, frame, path) == rebuilt(spark, frame, date(2024, 1, 10))
    # What failed runs and old states left is gone.
    named = set(commits.last(spark, path).entries.values())
    assert named <= set(commits.names_in(spark, f"{path}/data")) and len(commits.names_in(spark, f"{path}/commits")) == 2


def test_without_events(spark, tmp_path):
    frame, path = events(spark), str(tmp_path / "state")
    assert carried(spark, frame, path) == []
    cycle_state.update(frame, path, start_date=START, as_of=date(2024, 1, 4))
    assert carried(spark, frame, path) == []


def test_versions_of_days_show_what_changed(spark, tmp_path):
    """A day written again before a run that failed is read again by the next one; unchanged days are not."""
    frame, path = events(spark, *story(8)), str(tmp_path / "state")
    seen = {date(2024, 1, d): "v1" for d in range(1, 11)}
    cycle_state.update(frame, path, start_date=START, as_of=date(2024, 1, 11), versions=seen, single_days=3)
    assert cycle_state.update(frame, path, start_date=START, as_of=date(2024, 1, 11), versions=seen, single_days=3) == []
    later = seen | {date(2024, 1, 9): "v2", date(2024, 1, 11): "v2", date(2024, 1, 12): "v2"}
    done = cycle_state.update(frame, path, start_date=START, as_of=date(2024, 1, 12), versions=later, single_days=3)
    assert [first for first, _ in done] == [date(2024, 1, d) for d in (9, 10, 11)]
    assert carried(spark, frame, path) == rebuilt(spark, frame, date(2024, 1, 12))
