from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from meterglass.functions import calendar, figures

START = date(2024, 2, 1)


def window(watermark, today, lookback=1):
    return calendar.date_window(watermark=watermark, start_date=START, lookback_days=lookback, today=today)


@pytest.mark.parametrize("watermark, today, lookback, expected", [
    (None, date(2024, 2, 4), 1, (START, date(2024, 2, 3))),
    (date(2024, 2, 27), date(2024, 3, 1), 1, (date(2024, 2, 28), date(2024, 2, 29))),
    (date(2024, 2, 29), date(2024, 3, 1), 2, (date(2024, 2, 28), date(2024, 2, 29))),
    (date(2024, 2, 10), date(2024, 2, 20), 0, (date(2024, 2, 11), date(2024, 2, 19))),
    (None, START, 1, None),
    (None, date(2024, 2, 6), 60, (START, date(2024, 2, 5))),
])
def test_window(spark, watermark, today, lookback, expected):
    assert window(watermark, today, lookback) == expected
    state = spark.createDataFrame([("a", watermark)], "pipeline_name string, last_processed_date date")
    days = calendar.watermark_windows(state, start_date=START, lookback_days=lookback, today=today)
    found = sorted(r.date_id for r in days.collect())
    assert (found[0], found[-1]) == expected if expected else found == []
    assert sorted(r.date_id for r in calendar.date_spine(spark, expected).collect()) == found


def test_day_bounds():
    start, end = calendar.day_bounds_utc(date(2026, 6, 23))
    assert start == datetime(2026, 6, 22, 17, tzinfo=timezone.utc)
    assert end == datetime(2026, 6, 23, 17, tzinfo=timezone.utc)


def test_keys_at_year_end(spark):
    day = F.lit(date(2025, 12, 29))
    row = spark.range(1).select(calendar.week_key(day), calendar.iso_week_key(day), calendar.month_key(day),
                                calendar.monday(F.lit(date(2026, 1, 1))), figures.long_date(F.lit(date(2026, 8, 1)))).first()
    assert tuple(row) == ("202501", "202601", "202512", date(2025, 12, 29), " 1 August 2026")


def test_whole_hours_and_halves(spark):
    a, b = F.lit(datetime(2026, 1, 1, 0, 30)), F.lit(datetime(2026, 1, 2, 0, 29))
    row = spark.range(1).select(
        calendar.whole_hours(a, b), calendar.days_between(a, b, 2), figures.whole(F.lit(2.5)),
        figures.whole(F.lit(-2.5)), figures.safe_divide(F.lit(1), F.lit(0)),
        figures.percent_change(F.lit(5), F.lit(0)), figures.direction(F.lit(0.05)), figures.direction(F.lit(-0.06)),
        figures.size_label(figures.size_bin(F.lit(10))), figures.size_label(figures.size_bin(F.lit(11))),
        figures.size_bin(F.lit(21))).first()
    assert tuple(row) == (23, 0.96, 3, -3, None, 0.0, "—", "▼", "(1-10)", "(11-20)", 3)


def test_object_id_round_trip(spark):
    at = datetime(2026, 6, 21, 17, tzinfo=timezone.utc)
    text = calendar.object_id_floor(at)
    assert len(text) == 24
    assert spark.range(1).select(calendar.object_id_time(F.lit(text))).first()[0] == at.replace(tzinfo=None)


def test_local_date_ignores_the_session_zone(spark):
    frame = spark.createDataFrame([(datetime(2026, 6, 22, 17, 30, tzinfo=timezone.utc),)], "t timestamp")
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            assert frame.select(calendar.local_date(F.col("t"))).first()[0] == date(2026, 6, 23)
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
