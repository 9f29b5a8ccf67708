"""Ratios, rounding and display text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterglass import domain

UP, DOWN, FLAT = "▲", "▼", "—"
FLAT_BAND = 0.05


def whole(value: Column) -> Column:
    """Nearest whole number, halves away from zero."""
    return F.round(value, 0).cast("bigint")


def safe_divide(top: Column, bottom: Column) -> Column:
    """Double quotient; NULL on a zero or missing divisor."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def exact_mean(total: Column, n: Column, places: int) -> Column:
    """Mean rounded half up in decimals, so that a tie never depends on a double's last bit."""
    quotient = F.try_divide(total.cast("decimal(38,12)"), n.cast("decimal(20,0)"))
    return F.round(quotient, places).cast("double")


def share_percent(part: Column, total: Column) -> Column:
    return F.round(F.lit(100.0) * safe_divide(part, total), 2)


def percent_change(current: Column, previous: Column) -> Column:
    """Change against the previous figure; zero where there is none."""
    cur, prev = (F.coalesce(c.cast("double"), F.lit(0.0)) for c in (current, previous))
    return F.when(prev != 0, (cur - prev) / prev * 100).otherwise(F.lit(0.0))


def margin_percent(profit: Column, revenue: Column) -> Column:
    profit, revenue = (F.coalesce(c.cast("double"), F.lit(0.0)) for c in (profit, revenue))
    return F.when(revenue != 0, profit / revenue * 100).otherwise(F.lit(0.0))


def direction(change: Column) -> Column:
    return F.when(change > FLAT_BAND, UP).when(change < -FLAT_BAND, DOWN).otherwise(FLAT)


def exhaust_level(quota: Column) -> Column:
    """Tokens from which a grant counts as used up (double arithmetic)."""
    return F.lit(domain.EXHAUST_SHARE) * quota.cast("double")


def thousands(value: Column) -> Column:
    return F.format_number(value, 0)


def long_date(day: Column) -> Column:
    """Day padded with a blank, month name, year."""
    return F.concat(F.lpad(F.dayofmonth(day).cast("string"), 2, " "), F.date_format(day, " MMMM yyyy"))


def placeholder(key: Column) -> Column:
    return F.concat(F.lit("{{"), key, F.lit("}}"))


def model_label(model: Column) -> Column:
    return F.coalesce(model, F.lit(domain.UNKNOWN_MODEL))


def size_bin(users: Column, width: int = domain.COMPANY_BIN) -> Column:
    return F.floor((users - 1) / F.lit(width)).cast("bigint") + 1


def size_label(number: Column, width: int = domain.COMPANY_BIN) -> Column:
    low = ((number - 1) * width + 1).cast("string")
    return F.concat(F.lit("("), low, F.lit("-"), (number * width).cast("string"), F.lit(")"))
