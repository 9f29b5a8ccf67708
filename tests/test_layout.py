"""Events stored by user and run: no event is shuffled again, and a hot user is still cut."""

import re

import pytest
from helpers import rows

from meterglass.operators.splitting import LONG, RUN
from meterglass.plans import cycles
from meterglass.sources import lake, sample

BOUNDS = {"start_date": sample.START_DATE, "as_of": sample.AS_OF}


def exchanged(frame):
    """The columns that pass each shuffle of the plan."""
    mode = frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = frame._jdf.queryExecution().explainString(mode)
    return re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*?)\]\n", text)


@pytest.mark.parametrize("limit", [10_000, 20], ids=["whole", "cut"])
def test_no_event_is_shuffled(spark, sf_dir, tmp_path, limit):
    data = sample.load(spark, sf_dir)
    name = f"by_user_{limit}"
    want = rows(cycles.token_cycles(data.b2c_events, data.b2c_packages, data.b2c_users, **BOUNDS))
    stored = cycles.laid_out(data.b2c_events, rows_per_run=limit, **BOUNDS)
    for _ in range(3):
        n = lake.publish_bucketed(stored, name, str(tmp_path), cycles.LAYOUT_KEYS, cycles.LAYOUT_ORDER, 4, keep=1)
    table = spark.table(name)
    assert table.count() == n > 0
    assert len([t.name for t in spark.catalog.listTables() if t.name.startswith(f"{name}_v")]) == 1 and len(list((tmp_path / "data").iterdir())) == 1
    made = cycles.token_cycles_laid_out(table, data.b2c_packages, data.b2c_users)
    moved = exchanged(made)
    assert moved and not [c for c in moved if "event_id" in c]
    assert [c for c in exchanged(cycles.token_cycles(data.b2c_events, data.b2c_packages, data.b2c_users, **BOUNDS)) if "event_id" in c]
    assert rows(made) == want
    if limit == 20:
        longest = table.where(LONG).groupBy("userId").agg({RUN: "max"}).collect()
        assert longest and max(r[1] for r in longest) > 0
