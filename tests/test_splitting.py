"""Ordered operators against a plain loop over random rows."""

import itertools
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from meterglass.operators import dedup, splitting

ORDER = ["ts", "id"]


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(7)
    start = datetime(2024, 1, 1)
    rows = [(rng.choice(["hot"] * 6 + ["a", "b", None]), start + timedelta(minutes=rng.randrange(500)), n, rng.randrange(9))
            for n in range(400)]
    return rows, spark.createDataFrame(rows, "k string, ts timestamp, id int, v int")


def expected(rows, pick):
    out = {}
    for key in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[2]))
        for n, r in enumerate(mine):
            out[r[2]] = pick(mine, n)
    return out


@pytest.mark.parametrize("limit", [1, 5, 40, 10_000])
@pytest.mark.parametrize("operator, pick", [
    (splitting.with_previous, lambda rows, n: rows[n - 1][3] if n else None),
    (splitting.with_next, lambda rows, n: rows[n + 1][3] if n + 1 < len(rows) else None),
    (splitting.with_running_sum, lambda rows, n: sum(r[3] for r in rows[:n + 1])),
], ids=["previous", "next", "running"])
def test_ordered_operators(data, operator, pick, limit):
    rows, frame = data
    cuts = splitting.long_keys(frame, "k", ORDER, limit)
    assert (cuts is None) == (limit == 10_000)
    found = operator(frame, cuts, "k", ORDER, F.col("v"), "out")
    assert {r.id: r.out for r in found.collect()} == expected(rows, pick)


def test_cuts_are_bounded(data):
    rows, frame = data
    for limit in (5, 40, 100):
        cuts = splitting.long_keys(frame, "k", ORDER, limit)
        assert cuts.count() <= len(rows) / limit
        runs = splitting.with_runs(frame, cuts, "k", ORDER)
        long = runs.where(splitting.LONG).select("k", splitting.RUN).distinct().count()
        assert long <= 2 * splitting.FINER * (len(rows) / limit + len({r[0] for r in rows}))


def test_a_burst_is_cut_too(spark):
    """99 of 100 rows of a key in one second, most of them in one instant."""
    start, limit = datetime(2024, 1, 1), 400
    rows = [("bot", start + (timedelta(days=n) if n % 100 == 0 else timedelta(days=50, milliseconds=n % 3)), n, n % 9) for n in range(20_000)]
    frame = spark.createDataFrame(rows, "k string, ts timestamp, id int, v int")
    cuts = splitting.long_keys(frame, "k", ORDER, limit)
    sizes = [r["count"] for r in splitting.with_runs(frame, cuts, "k", ORDER).groupBy(splitting.RUN).count().collect()]
    assert max(sizes) <= 3 * limit and sum(sizes) == len(rows)
    found = splitting.with_running_sum(frame, cuts, "k", ORDER, F.col("v"), "out")
    rows.sort(key=lambda r: (r[1], r[2]))
    assert {r.id: r.out for r in found.collect()} == dict(zip((r[2] for r in rows), itertools.accumulate(r[3] for r in rows)))


@pytest.mark.parametrize("block", [1, 2, 7, 1000])
def test_neighbour(spark, block):
    frame = spark.createDataFrame([(k, n, f"{k}{n}") for k in "xy" for n in range(1, 31)], "k string, n bigint, v string")
    found = splitting.with_neighbour(frame, "k", "n", "v", "before", block=block).collect()
    assert len(found) == 60
    assert {(r.k, r.n): r.before for r in found} == {
        (k, n): f"{k}{n - 1}" if n > 1 else None for k in "xy" for n in range(1, 31)}


def test_first_rows_are_cut_before_the_shuffle(spark, data):
    _, frame = data
    plan = dedup.first_by(frame, ["k"], "ts", "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange")
    assert plan.count("WindowGroupLimit") >= 2
