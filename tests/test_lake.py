from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timezone
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from meterglass import domain
from meterglass.functions import values
from meterglass.operators import normalize
from meterglass.plans import ingest
from meterglass.registry import ORACLES, QUERIES
from meterglass.session import scratch_path
from meterglass.sources import commits, documents, lake, landing, sample, tables
from meterglass.sources import days as day_tables
from meterglass.streaming import ingest as streaming

DAY = date(2024, 1, 15)


@pytest.fixture(scope="module")
def typed(spark, sf_dir):
    return normalize.normalize_events(sample.event_documents(spark, sf_dir),
                                      ingested_at=datetime(2024, 2, 1, tzinfo=timezone.utc))


def day_rows(frame, day=DAY):
    return frame.where(F.col("date_id") == F.lit(day))


def per_day(spark, path):
    return {r.date_id: r.rows for r in lake.rows_per_day(lake.read_events(spark, path)).collect()}


def test_replace_is_idempotent_and_empties(spark, typed):
    path = scratch_path(spark, "events")
    days = [date(2024, 1, 14), DAY, date(2024, 1, 16)]
    block = typed.where(F.col("date_id").isin(*days))
    first = lake.replace_days(block, path, days)
    assert per_day(spark, path) == first and all(first.values())
    assert lake.replace_day(day_rows(block), path, DAY) == first[DAY]
    assert per_day(spark, path) == first
    assert lake.replace_day(block.limit(0), path, DAY) == 0
    assert per_day(spark, path) == {d: n for d, n in first.items() if d != DAY}
    assert lake.replace_day(day_rows(block), path, DAY) == first[DAY]
    assert per_day(spark, path) == first
    assert lake.read_events(spark, path).columns == domain.EVENT_SCHEMA.names


def test_guards_run_before_the_write(spark, typed):
    path = scratch_path(spark, "events")
    with pytest.raises(lake.SchemaDrift, match="traceId"):
        lake.replace_day(day_rows(typed).drop("traceId"), path, DAY)
    with pytest.raises(lake.WrongDay):
        lake.replace_day(typed, path, DAY)
    with pytest.raises(lake.SchemaDrift):
        lake.replace_table(typed, path, domain.USERS_SCHEMA)
    with pytest.raises(Exception):
        lake.read_events(spark, path).count()


def test_watermark(spark):
    path = scratch_path(spark, "state")
    assert lake.get_watermark(spark, path, "a") is None
    for n, (name, day) in enumerate([("a", DAY), ("b", DAY), ("a", date(2024, 1, 16)), ("a", date(2024, 1, 12))]):
        lake.set_watermark(spark, path, name, day, datetime(2024, 2, 1, n, tzinfo=timezone.utc))
    assert lake.get_watermark(spark, path, "a") == date(2024, 1, 12)
    assert lake.get_watermark(spark, path, "b") == DAY
    assert lake.get_watermark(spark, path, "c") is None
    assert lake.read_state(spark, path).count() == 2


def test_a_reader_sees_all_old_or_all_new_days(spark, typed, monkeypatch):
    """While a block is replaced, after a failure between the days, and after the commit, with an emptied day."""
    path = scratch_path(spark, "events")
    block = [date(2024, 1, 14), DAY, date(2024, 1, 16)]
    rows = typed.where(F.col("date_id").isin(*block))
    old = lake.replace_days(rows, path, block)
    half = rows.where("hash(event_id) % 2 = 0 AND date_id <> '2024-01-15'")
    want = {r.date_id: r.rows for r in lake.rows_per_day(half).collect()}
    opened = lake.read_events(spark, path)
    real, seen = day_tables.write, []

    def watched(frame, *args):
        new = real(frame, *args)
        seen.append(per_day(spark, path))   # all files of the new days are written
        return new

    def lost(frame, *args):
        real(frame, *args)
        raise RuntimeError("lost between the days")

    monkeypatch.setattr(day_tables, "write", lost)
    with pytest.raises(RuntimeError):
        lake.replace_days(half, path, block)
    assert per_day(spark, path) == old
    monkeypatch.setattr(day_tables, "write", watched)
    lake.replace_days(half, path, block)
    assert seen == [old] and per_day(spark, path) == want
    assert {r.date_id: r.rows for r in lake.rows_per_day(opened).collect()} == old   # a reader from before still has its files
    assert day_tables.prune(spark, path, keep=1) >= 1
    assert per_day(spark, path) == want
    with pytest.raises(Exception):
        lake.replace_days(failing(half).select(half.columns), path, block)
    assert per_day(spark, path) == want


def test_days_of_old_runs_are_pruned(spark, typed):
    path = scratch_path(spark, "events")
    block = [date(2024, 1, 14), DAY]
    lake.replace_days(typed.where(F.col("date_id").isin(*block)), path, block)
    lake.replace_day(day_rows(typed), path, DAY)
    want = per_day(spark, path)
    assert day_tables.prune(spark, path, keep=1) == 1   # the first run's folder of the day that the second replaced
    assert per_day(spark, path) == want


def test_of_two_runs_one_moves_the_watermark(spark):
    path = scratch_path(spark, "state")
    lake.set_watermark(spark, path, "a", DAY, expected={"a": None})
    start = lake.get_watermark(spark, path, "a")
    lake.set_watermark(spark, path, "a", date(2024, 1, 20), expected={"a": start})
    with pytest.raises(commits.Conflict):
        lake.set_watermark(spark, path, "a", date(2024, 1, 16), expected={"a": start})
    with pytest.raises(commits.Conflict):
        lake.set_watermark(spark, path, "a", date(2024, 1, 16), expected={"a": None})
    lake.set_watermark(spark, path, "b", DAY, expected={"b": None})
    assert lake.get_watermark(spark, path, "a") == date(2024, 1, 20)


def test_runs_at_once(spark, sf_dir):
    """Both start from one position; the slower one fails and moves nothing back."""
    docs = sample.event_documents(spark, sf_dir)
    path, state = scratch_path(spark, "events"), scratch_path(spark, "state")
    options = {"start_date": sample.START_DATE, "lookback_days": 1}
    ingest.ingest_events(docs, path, state, today=date(2024, 1, 10), **options)
    real = lake.replace_days

    def overtaken(rows, where, block, *args):
        lake.replace_days = real
        ingest.ingest_events(docs, path, state, today=date(2024, 1, 20), **options)
        return real(rows, where, block, *args)

    lake.replace_days = overtaken
    try:
        with pytest.raises(commits.Conflict):
            ingest.ingest_events(docs, path, state, today=date(2024, 1, 15), **options)
    finally:
        lake.replace_days = real
    assert lake.get_watermark(spark, state, ingest.STREAM) == date(2024, 1, 19)


def test_merges_of_state(spark):
    path, at = scratch_path(spark, "state"), datetime(2024, 2, 1)
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda n: lake.set_watermark(spark, path, f"p{n}", DAY, at), range(8)))
    assert lake.read_state(spark, path).count() == 8
    for n in range(1, 26):
        lake.set_watermark(spark, path, "p0", date(2024, 1, n), at)
    assert lake.get_watermark(spark, path, "p0") == date(2024, 1, 25) and lake.read_state(spark, path).count() == 8
    assert len(commits.names_in(spark, f"{path}/data")) == len(commits.names_in(spark, f"{path}/commits")) <= 20
    twice = spark.createDataFrame([("p0", DAY, at), ("p0", DAY, at)], domain.STATE_SCHEMA)
    with pytest.raises(ValueError):
        lake.merge_state(twice, path)


def test_positions_of_an_older_log_are_read(spark):
    path = scratch_path(spark, "state")
    spark.createDataFrame([("a", DAY, datetime(2024, 1, 2)), ("a", date(2024, 1, 16), datetime(2024, 1, 3))],
                          domain.STATE_SCHEMA).write.parquet(path)
    assert lake.get_watermark(spark, path, "a") == date(2024, 1, 16)
    lake.set_watermark(spark, path, "b", DAY)
    assert lake.get_watermark(spark, path, "a") == date(2024, 1, 16)


def test_unreadable_state_is_an_error(spark):
    path = scratch_path(spark, "state")
    spark.range(1).write.parquet(path)
    with pytest.raises(Exception):
        lake.get_watermark(spark, path, "a")


def failing(frame):
    return frame.withColumn(frame.columns[0], F.when(F.lit(True), F.raise_error(F.lit("late"))).cast(frame.schema[0].dataType))


def test_failed_replacement_keeps_the_old_table_and_views_follow(spark):
    path, name = scratch_path(spark, "users"), "kept_users"
    old = spark.createDataFrame([("a", True, datetime(2024, 1, 1))], domain.USERS_SCHEMA)
    assert lake.replace_table(old, path, domain.USERS_SCHEMA, name=name) == 1
    lake.create_views(spark, {"banned_users": f"SELECT userId FROM {name} WHERE isBanned"})
    with pytest.raises(Exception):
        lake.replace_table(failing(old), path, domain.USERS_SCHEMA, name=name)
    assert [r.userId for r in lake.read_table(spark, path).collect()] == ["a"]
    with pytest.raises(Exception):
        lake.rebuild_gold(failing(old), path, name=name)
    assert [r.userId for r in spark.table("banned_users").collect()] == ["a"]
    new = spark.createDataFrame([("b", True, datetime(2024, 1, 1)), ("c", False, datetime(2024, 1, 1))], domain.USERS_SCHEMA)
    assert lake.replace_table(new, path, domain.USERS_SCHEMA, name=name) == 2
    assert [r.userId for r in spark.newSession().table("banned_users").collect()] == ["b"]
    lake.replace_table(new, path, domain.USERS_SCHEMA, name=name)
    assert lake.drop_old_versions(spark, path) >= 1
    assert lake.read_table(spark, path).count() == 2


def test_required_columns(spark, typed):
    docs = spark.createDataFrame([("a",), (None,)], "userId string")
    with pytest.raises(lake.MissingValue, match="userId"):
        lake.replace_table(normalize.normalize_users(docs), scratch_path(spark, "users"), domain.USERS_SCHEMA)
    broken = day_rows(typed).withColumn("totalCostThb", F.lit(None).cast(domain.MONEY))
    with pytest.raises(lake.MissingValue, match="totalCostThb"):
        lake.replace_day(broken, scratch_path(spark, "events"), DAY)


def test_the_gate_sets_bad_rows_aside_or_stops(spark, typed):
    path = scratch_path(spark, "events")
    block = [date(2024, 1, 14), DAY, date(2024, 1, 16)]
    rows = typed.where(F.col("date_id").isin(*block))
    whole = lake.replace_days(rows, path, block)
    bad = F.col("date_id") == F.lit(DAY)
    broken = rows.withColumns({"event_id": F.when(~bad, F.col("event_id")), "date_id": F.when(
        F.col("date_id") == F.lit(block[2]), F.lit(date(2024, 3, 1))).otherwise(F.col("date_id"))})
    n = whole[DAY] + whole[block[2]]
    with pytest.raises(lake.TooManyRejects, match=f"{n} rows rejected, {n - 1} allowed"):
        lake.replace_days_gated(broken, path, block, max_rejects=n - 1)
    assert per_day(spark, path) == whole and lake.read_rejects(spark, path).count() == 0
    stored, rejected = lake.replace_days_gated(broken, path, block, max_rejects=n)
    assert stored == {block[0]: whole[block[0]], DAY: 0, block[2]: 0}
    assert rejected == {"no event_id": whole[DAY], "other day": whole[block[2]]}
    assert per_day(spark, path) == {block[0]: whole[block[0]]}
    found = {(r.date_id, r.reject_reason): r["count"] for r in lake.read_rejects(spark, path).groupBy("date_id", lake.REASON).count().collect()}
    assert found == {(DAY, "no event_id"): whole[DAY], (date(2024, 3, 1), "other day"): whole[block[2]]}
    # The days again, now good: their rejects go with them.
    assert lake.replace_days_gated(rows, path, block) == (whole, {})
    assert per_day(spark, path) == whole and lake.read_rejects(spark, path).count() == 0
    assert lake.replace_days_gated(rows.limit(0), path, block) == (dict.fromkeys(block, 0), {})


def test_a_block_reads_its_documents_once(spark, sf_dir):
    docs = sample.event_documents(spark, sf_dir)
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    counted = docs.mapInArrow(count, docs.schema)
    ingest.ingest_events(counted, scratch_path(spark, "events"), scratch_path(spark, "state"), start_date=sample.START_DATE,
                         today=sample.AS_OF)
    assert seen.value == docs.count()


def test_failed_block_leaves_the_watermark(spark, sf_dir):
    docs = sample.event_documents(spark, sf_dir)
    broken = docs.withColumn("eggToken", F.when(
        F.col("eventTimeStamp").getField("$date") > "2024-01-20", "many").otherwise(F.col("eggToken").cast("string")))
    path, state = scratch_path(spark, "events"), scratch_path(spark, "state")
    options = {"start_date": sample.START_DATE, "today": sample.AS_OF, "days_per_job": 10}
    with pytest.raises(Exception):
        ingest.ingest_events(broken, path, state, **options)
    # The first bad day is the 20th; its block began on the 13th.
    assert lake.get_watermark(spark, state, ingest.STREAM) == date(2024, 1, 19)
    rows = ingest.ingest_events(docs, path, state, **options)
    assert (min(rows), max(rows)) == (date(2024, 1, 20), date(2024, 1, 27))
    assert lake.get_watermark(spark, state, ingest.STREAM) == date(2024, 1, 27)
    assert ingest.ingest_events(docs, path, state, **{**options, "today": sample.START_DATE}) == {}


def test_day_scan_reaches_the_files(spark, typed):
    path = scratch_path(spark, "events")
    typed.write.parquet(path)
    stored = spark.read.parquet(path)
    found = tables.scan_day(stored, DAY, id_buffer_hours=24, columns=("event_id", "userId"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(event_id" in plan and "LessThan(eventTimeStamp" in plan
    schema = plan[plan.index("ReadSchema"):].splitlines()[0]
    assert "aiModel" not in schema
    assert found.count() == day_rows(typed).count() == tables.scan_day(stored, DAY).count()


def test_window_prunes_partitions(spark, typed):
    path = scratch_path(spark, "events")
    lake.replace_days(typed.where(tables.in_window(sample.START_DATE, sample.AS_OF)), path,
                      lake.days_of((sample.START_DATE, date(2024, 1, 27))))
    frame = lake.read_events(spark, path).where(tables.in_window(DAY, date(2024, 1, 17)))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date_id" in plan


def test_extract_reaches_the_files(spark, sf_dir):
    path = scratch_path(spark, "docs")
    docs = sample.event_documents(spark, sf_dir)
    plain = docs.withColumn("_id", F.col("_id").getField("$oid")).withColumn(
        "eventTimeStamp", F.to_timestamp(F.col("eventTimeStamp").getField("$date")))
    plain.write.parquet(path)
    found = documents.extract_day(spark.read.parquet(path), DAY)
    plan = found._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):].splitlines()[0]
    assert "GreaterThanOrEqual(eventTimeStamp" in pushed and "GreaterThanOrEqual(_id" in pushed
    assert found.count() == documents.extract_day(docs, DAY).count() > 0


def test_catalog_tables(spark, typed):
    lake.ensure_database(spark, "usage")
    path = scratch_path(spark, "events")
    lake.replace_day(day_rows(typed), path, DAY)
    for _ in range(2):
        lake.ensure_event_table(spark, "usage.events", path)
    assert spark.table("usage.events").count() == day_rows(typed).count()
    assert spark.catalog.listColumns("usage.events")[-1].isPartition


def test_extract_uses_ids_only_inside_the_buffer(spark, sf_dir):
    docs = sample.event_documents(spark, sf_dir)
    early = docs.withColumn("_id", F.struct(F.lit("5" + "0" * 23).alias("$oid")))
    assert documents.extract_day(docs, DAY).count() > 0
    assert documents.extract_day(docs, DAY).columns == list(domain.EVENT_FIELDS)
    assert documents.extract_day(early, DAY).count() == 0
    assert documents.extract_day(early, DAY, id_buffer_hours=0).count() == documents.extract_day(docs, DAY).count()


def test_stream_reruns_change_nothing(spark, sf_dir):
    docs = sample.event_documents(spark, sf_dir)
    source, path, progress = (scratch_path(spark, n) for n in ("docs", "events", "progress"))
    early = F.col("eventTimeStamp").getField("$date") < "2024-01-15"
    docs.where(early).write.json(source)
    streaming.stream_events(spark, source, path, progress).awaitTermination()
    docs.where(~early).write.mode("append").json(source)
    for _ in range(2):
        streaming.stream_events(spark, source, path, progress).awaitTermination()
    assert lake.read_events(spark, path).count() == docs.count()
    assert lake.read_events(spark, path).select("event_id").distinct().count() == docs.count()


def test_stream_drops_resent_documents_and_lets_late_days_wait(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(landing, "COMPACT", 3)
    docs, at = sample.event_documents(spark, sf_dir), F.col("eventTimeStamp").getField("$date")
    source, path, progress = (scratch_path(spark, n) for n in ("docs", "events", "progress"))
    late = at.startswith("2024-01-05")
    parts = (~late & (at < "2024-01-20"), at >= "2024-01-20", late, at >= "2024-01-18")
    for part in parts:
        docs.where(part).write.mode("append").json(source)
        streaming.stream_events(spark, source, path, progress, late_after=5).awaitTermination()
    landed = streaming.landed_beside(progress)
    n_late = docs.where(late).count()
    state = landing.listed(spark, landed)
    days = [date.fromisoformat(d) for d in state.waiting]
    assert state.late_rows == n_late > 0 and set(days) <= {date(2024, 1, 5), date(2024, 1, 6)}   # a UTC day is two local ones
    assert lake.read_events(spark, path).count() < docs.count()
    like = documents.parse_lines(spark.createDataFrame([], "value string"), domain.EVENT_FIELDS)
    assert sorted(streaming.replace_late(like, landed, path)) == days and streaming.replace_late(like, landed, path) == {}
    found = lake.read_events(spark, path)
    assert found.count() == found.select("event_id").distinct().count() == docs.count()
    # Days of many batches lie in one folder, and a reader of a day lists that day alone.
    assert max(len(f) for f in landing.listed(spark, landed).folders.values()) < 3
    one = landing.read(spark, landed, streaming._dated(like, domain.TIME_ZONE).schema, [DAY])
    assert {f.split("/")[-2] for f in one.inputFiles()} == {f"{documents.DAY}={DAY}"}


def test_a_day_of_a_dump_opens_its_own_bytes(spark, sf_dir):
    source, landed, progress = (scratch_path(spark, n) for n in ("docs", "landed", "progress"))
    docs = sample.event_documents(spark, sf_dir)
    docs.write.json(source)
    streaming.land_files(spark, source, landed, progress)
    before = landing.listed(spark, landed)
    found = streaming.landed_days(spark, landed, [DAY])
    sizes = {f: Path(f.removeprefix("file:")).stat().st_size for f in landing_files(landed)}
    opened = [f.removeprefix("file://") for f in found.inputFiles()]
    assert 0 < sum(sizes[f] for f in opened) < 2 * sum(sizes.values()) / len(before.folders)
    want = documents.extract_day(documents.read_json(spark, source, domain.EVENT_FIELDS), DAY)
    ids = lambda f: sorted(r[0] for r in f.select(values.object_id_string(f)).collect())
    assert ids(found) == ids(want) != []
    # No new files: nothing is parsed or landed again; a missing day has no documents.
    streaming.land_files(spark, source, landed, progress)
    assert landing.listed(spark, landed) == before
    assert streaming.landed_days(spark, landed, [date(2030, 1, 1)]).count() == 0


def landing_files(landed):
    return [str(p) for p in Path(landed.removeprefix("file:")).glob("data/*/*/*.parquet")]


def test_daily_run(spark, sf_dir):
    data = sample.load(spark, sf_dir)
    docs = sample.event_documents(spark, sf_dir)
    b2b = F.expr("CAST(substring(userId, 3) AS BIGINT) % 3 = 0")
    sources = {("B2C", "events"): docs.where(~b2b), ("B2B", "events"): docs.where(b2b),
               ("B2C", "package"): data.b2c_packages, ("B2B", "package"): data.b2b_packages,
               ("B2C", "users"): data.b2c_users, ("B2B", "users"): data.b2b_users,
               ("B2B", "company"): data.company, ("B2B", "team"): data.team}
    root = scratch_path(spark, "lake")
    options = {"today": sample.AS_OF, "start_date": sample.START_DATE, "mature_days": sample.MATURE_DAYS}
    first = {r.stage: r.rows for r in ingest.daily_run(sources, root, **options).collect()}
    again = {r.stage: r.rows for r in ingest.daily_run(sources, root, keep=1, **options).collect()}
    for folder in ("total/summary_daily", "B2C/users", "B2C/user_token_cycle"):
        assert len(commits.names_in(spark, f"{root}/{folder}/data")) == 1   # nothing of the run before is left
    for stage in ("user_tracking_b2c", "user_token_cycle", "user_repeat_behavior", "user_tracking_b2b"):
        assert first[stage] == again[stage] == QUERIES[stage](spark, sf_dir).count() > 0
    assert again["B2C events"] < first["B2C events"]
    names = ["version", "userId", "date_id", "token_used", "totalCostThb"]
    view = spark.table("usage.user_tracking_total").select(names).exceptAll(QUERIES["user_tracking_total"](spark, sf_dir).select(names))
    assert view.count() == 0
    assert spark.table("usage.slide_metrics").count() == 18
    assert isinstance(spark.table("usage.summary_daily").first().serving_cost_thb, Decimal)
    assert spark.table("usage.user_tracking_total_compat").count() == spark.table("usage.user_tracking_total").count()
    folder = lake.current_version(spark, f"{root}/B2C/user_token_cycle")
    cycles = spark.read.parquet(folder)
    assert cycles.columns[-1] == "cycle_start_date" and "PartitionFilters: [isnotnull(cycle_start_date" in \
        cycles.where("cycle_start_date = '2024-01-15'")._jdf.queryExecution().executedPlan().toString()
    assert {"user_usage_event_b2c", "state_b2b"} <= {t.name for t in spark.catalog.listTables("usage")}
    # Reports read the stored summary, by date, and not the events.
    plan = spark.table("usage.summary_daily").where("date_id >= '2024-01-10'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "user_usage_event" not in plan


def test_registry_is_consistent():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLES)
