"""Cycle and behaviour rules on hand-made rows, with and without split users."""

from datetime import date, datetime

import pytest
from helpers import b2c_packages, events, rows, users

from meterglass.plans import behavior, cycles
from meterglass.sources import sample

BOUNDS = {"start_date": date(2024, 1, 1), "as_of": date(2024, 2, 1)}
SUB, RESET, END, USE, LATE = "Subscribe", "MonthlyReset", "MainExpired", "Token Used", "Token Used (Unsettled)"


def run(spark, *event_rows, rows_per_run=cycles.splitting.ROWS_PER_RUN, banned=()):
    return cycles.token_cycles(events(spark, *event_rows), b2c_packages(spark), users(spark, *banned),
                               rows_per_run=rows_per_run, **BOUNDS)


@pytest.fixture(params=[10_000, 1], ids=["whole", "split"])
def limit(request):
    return request.param


def test_tied_purchase_and_reset_share_usage(spark, limit):
    found = rows(run(spark,
                     ("a", "05 10:00", "u", SUB, "s", "1", 100), ("b", "05 10:00", "u", RESET, "s", "1", 0),
                     ("c", "05 11:00", "u", USE, "s", "1", -96), ("d", "06 11:00", "u", END, "s", "1", -4),
                     rows_per_run=limit),
                 "start_type", "cycle_index", "quota", "consumed", "end_type", "segment")
    assert found == [("MonthlyReset", 2, 100, 96, "expired", "A2_exhausted_churn"),
                     ("Subscribe", 1, 100, 96, "monthly_reset", "A3_exhausted_wait_reset")]


def test_usage_at_the_edges(spark, limit):
    found = rows(run(spark,
                     ("a", "05 10:00", "u", SUB, "s", "1", 100), ("0", "05 10:00", "u", USE, "s", "1", -10),
                     ("b", "05 12:00", "u", SUB, "t", "1", 200), ("9", "05 12:00", "u", LATE, "t", "1", -20),
                     ("c", "05 13:00", "u", END, "t", "1", -180), ("z", "05 13:00", "u", USE, "t", "1", -5),
                     ("y", "04 13:00", "u", USE, "t", "1", -7), rows_per_run=limit),
                 "cycle_index", "consumed", "usage_event_cnt", "end_type", "leftover_at_end")
    assert found == [(1, 10, 1, "repurchase", 90), (2, 20, 1, "expired", 180)]


def test_unknown_and_zero_quota(spark, limit):
    found = rows(run(spark,
                     ("a", "05 10:00", "u", RESET, "s", "1", 0), ("b", "05 11:00", "u", USE, "s", "1", -5),
                     ("c", "06 10:00", "u", SUB, "s", "1", 0), ("d", "06 11:00", "u", USE, "s", "1", -1),
                     ("e", "07 10:00", "u", SUB, "s", "1", None), ("f", "08 10:00", "u", RESET, "s", "1", 0),
                     rows_per_run=limit),
                 "cycle_index", "quota", "utilization", "exhausted", "leftover_at_end", "segment")
    assert found == [
        (1, None, None, False, None, "C9_unknown_quota"), (2, 0, None, True, 0, "A1_exhausted_repurchase"),
        (3, None, None, False, None, "C9_unknown_quota"), (4, 0, None, True, 0, "C0_active")]


def test_exhaust_time_and_share(spark, limit):
    found = run(spark, ("a", "05 10:00", "u", SUB, "s", "1", 100), ("b", "06 10:00", "u", USE, "s", "1", -50, "1.5"),
                ("c", "07 11:30", "u", USE, "s", "1", -45, "2.5"), ("d", "08 10:00", "u", USE, "s", "1", -5),
                rows_per_run=limit).first()
    assert found.exhaust_ts == datetime(2024, 1, 7, 11, 30)
    assert (found.days_to_exhaust, found.exhausted, found.segment) == (2.04, True, "C0_active")
    assert (found.cycle_end_ts, found.cycle_days, float(found.serving_cost_thb)) == (None, None, 4.0)


def test_repeated_rows_collapse(spark, limit):
    found = rows(run(spark,
                     ("a", "05 10:00", "u", SUB, "s", "1", 100), ("a", "05 10:00", "u", SUB, "s", "1", 100),
                     ("b", "05 10:00", "u", SUB, "s", "2", 300),   # same instant and type, later id: no cycle
                     ("c", "05 11:00", "u", RESET, "s", "1", 0),   # but its grant counts from here on
                     ("d", "05 12:00", "u", USE, "s", "1", -7), ("d", "05 13:00", "u", USE, "s", "1", -7),
                     rows_per_run=limit),
                 "cycle_index", "packageId", "quota", "consumed")
    assert found == [(1, 1, 100, 0), (2, 1, 300, 7)]


def test_rows_without_user(spark, limit):
    found = rows(run(spark, ("a", "05 10:00", None, SUB, "s", "1", 100), ("b", "05 11:00", None, USE, "s", "1", -7),
                     ("c", "05 12:00", None, END, "s", "1", -9), rows_per_run=limit),
                 "userId", "consumed", "leftover_at_end")
    assert found == [(None, 0, 9)]


def test_bans_packages_and_window(spark, limit):
    found = rows(run(spark,
                     ("a", "05 10:00", "bad", SUB, "s", "1", 100), ("b", "05 10:00", "maybe", SUB, "t", "1", 100),
                     ("c", "05 10:00", "u", SUB, "v", "4", 100), ("d", "05 10:00", "u", SUB, "v", " 2 ", 100),
                     ("e", "05 11:00", "u", SUB, "w", "2.5", 100), ("f", "05 12:00", "u", SUB, "w", "", 100),
                     rows_per_run=limit, banned=[("bad", True), ("maybe", None), ("u", False)]),
                 "userId", "packageId", "packageName")
    assert found == [("maybe", 1, "Starter"), ("u", 2, "Standard")]


def behave(spark, *event_rows, limit=10_000, **options):
    frame = events(spark, *event_rows)
    packages, people = b2c_packages(spark), users(spark)
    made = cycles.token_cycles(frame, packages, people, rows_per_run=limit, **BOUNDS)
    return behavior.repeat_behavior(made, frame, packages, people, rows_per_run=limit, **BOUNDS, **options)


def test_repeat_win_back_and_gaps(spark, limit):
    row = behave(spark,
                 ("a", "02 10:00", "u", SUB, "t0", "12", 50), ("b", "03 10:00", "u", SUB, "p1", "1", 100),
                 ("c", "05 09:00", "u", SUB, "p1", "1", 100), ("d", "06 10:00", "u", END, "p1", "1", -30),
                 ("e", "07 10:00", "u", SUB, "p2", "2", 200), ("f", "08 11:30", "u", SUB, "p3", "3", 300),
                 ("g", "08 12:00", "u", USE, "p3", "3", -299, "10"), ("h", "09 10:00", "u", END, "p3", "3", -1),
                 limit=limit, mature_days=6).first()
    assert (row.user_type, row.paid_subscribe_cnt, row.trial_cnt, row.is_repeat) == ("repeat", 3, 1, True)
    assert row.avg_days_between_paid == 2.5          # (96 h + 25 h) / 48 = 2.52
    assert (row.winback_cnt, row.churned, row.last_leftover_at_churn) == (1, True, 1)
    assert (row.first_paid_packageName, float(row.revenue_thb), float(row.margin_thb)) == ("Starter", 1757.0, 1747.0)
    assert (row.first_paid_date, row.is_mature_cohort, row.data_end) == (date(2024, 1, 3), True, date(2024, 1, 9))
    assert row.dominant_segment == "B1_underuse_repurchase"


def test_missing_subscription_ids_are_one(spark, limit):
    row = behave(spark, ("a", "02 10:00", "u", SUB, None, "1", 50), ("b", "03 10:00", "u", SUB, None, "2", 50),
                 ("c", "04 10:00", "u", SUB, None, "12", 50), limit=limit).first()
    assert (row.user_type, row.paid_subscribe_cnt, row.trial_cnt) == ("paid_once", 1, 0)
    assert (row.first_paid_packageId, row.is_mature_cohort) == (1, False)


@pytest.mark.parametrize("size", [1, 7, 50])
def test_split_users_match_on_the_sample(spark, sf_dir, size):
    data = sample.load(spark, sf_dir)
    bounds = {"start_date": sample.START_DATE, "as_of": sample.AS_OF}

    def build(**limit):
        made = cycles.token_cycles(data.b2c_events, data.b2c_packages, data.b2c_users, **bounds, **limit)
        users_ = behavior.repeat_behavior(made, data.b2c_events, data.b2c_packages, data.b2c_users, mature_days=14,
                                          **bounds, **limit)
        return rows(made), rows(users_)

    assert build(rows_per_run=size) == build()


@pytest.mark.parametrize("size", [1, 5, 40])
def test_split_instants_match(spark, size):
    """Boundaries of all kinds and usage pile up in a few instants; some boundaries repeat in one."""
    kinds = (SUB, USE, RESET, USE, END, USE, SUB, LATE)
    piled = [(f"e{n:03d}", f"{5 + n // 60:02d} 10:0{n % 3}", "u", kinds[n % 8], "s", str(1 + n % 3), 100 if kinds[n % 8] == SUB else -7)
             for n in range(180)]
    assert rows(run(spark, *piled, rows_per_run=size)) == rows(run(spark, *piled))
