"""Ordered work on keys that hold a large part of all rows.

A window partitioned by user sorts one user in one task. Where a user has more
rows than ``rows_per_run``, the user's rows are cut by rank into runs and the
window is partitioned by (user, run); what a run needs from its neighbours is
carried over from a frame with one row per run.

Cuts are rows of the key itself, drawn by a hash of their place in the order, so runs
hold about the same number of rows however these are spread over time: a burst, and even
one instant, is cut like any other part. A recomputed task always finds the same cuts. Cuts
are written to the shared folder; their measured size decides how they are joined, and where no key is long, no plan
carries anything.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from meterglass.session import scratch_path

ROWS_PER_RUN = 5_000_000
FINER = 4  # runs per full load: the longest of many runs is a few times the mean

RUN, LONG = "__run", "__long"


def _place(order: Sequence[str]) -> Column:
    return F.struct(*(F.col(c).alias(f"o{i}") for i, c in enumerate(order)))


def long_keys(rows: DataFrame, key: str, order: Sequence[str], rows_per_run: int = ROWS_PER_RUN) -> DataFrame | None:
    """(key, cuts) of every key with more than ``rows_per_run`` rows, or None if there is no such key.

    Counted now and not when the plan runs. Rows of one place in the order stay together.
    """
    spark = rows.sparkSession
    counts = rows.groupBy(F.col(key).alias("__key")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > rows_per_run)
    path = scratch_path(spark, "long-keys")
    counts.write.parquet(path)
    counts = spark.read.schema(counts.schema).parquet(path)
    if counts.isEmpty():
        return None
    step = max(1, rows_per_run // FINER)
    drawn = rows.where(F.pmod(F.xxhash64(*order), F.lit(step)) == 0).select(key, _place(order).alias("__place")).distinct()
    cuts = drawn.join(counts, F.col(key).eqNullSafe(F.col("__key"))).groupBy("__key").agg(
        F.sort_array(F.collect_list("__place")).alias("__cuts"))
    path = scratch_path(spark, "cuts")
    cuts.write.parquet(path)
    return spark.read.schema(cuts.schema).parquet(path)


def _rank() -> Column:
    """How many cuts are at or before the row's place, by halving."""
    def narrowed(at: Column, _: Column) -> Column:
        middle = F.floor((at["lo"] + at["hi"]) / 2).cast("int")
        passed = F.get("__cuts", middle) <= F.col("__place")
        return (F.when(at["lo"] >= at["hi"], at)
                .when(passed, F.struct((middle + 1).alias("lo"), at["hi"].alias("hi")))
                .otherwise(F.struct(at["lo"].alias("lo"), middle.alias("hi"))))

    size = F.size("__cuts")
    steps = F.sequence(F.lit(0), F.ceil(F.log2(size + 1)).cast("int"))
    return F.aggregate(steps, F.struct(F.lit(0).alias("lo"), size.alias("hi")), narrowed, lambda at: at["lo"].cast("bigint"))


def with_runs(rows: DataFrame, cuts: DataFrame | None, key: str, order: Sequence[str]) -> DataFrame:
    """Add the run number and the long-key flag; a missing key counts as a key."""
    if cuts is None:
        return rows.withColumns({RUN: F.lit(0).cast("bigint"), LONG: F.lit(False)})
    cut = F.col("__cuts").isNotNull()
    return (rows.withColumn("__place", _place(order))
            .join(cuts, F.col(key).eqNullSafe(F.col("__key")), "left")
            .withColumns({RUN: F.when(cut, _rank()).otherwise(F.lit(0).cast("bigint")), LONG: cut})
            .drop("__place", "__key", "__cuts"))


def with_carry(rows: DataFrame, carry: DataFrame, key: str) -> DataFrame:
    """Bring each run the values carried into it (columns of ``carry`` besides key and run)."""
    side = carry.withColumnsRenamed({key: "__key", RUN: "__to"})
    match = F.col(key).eqNullSafe(F.col("__key")) & (F.col(RUN) == F.col("__to"))
    return rows.join(side, match, "left").drop("__key", "__to")


def runs_of(key: str) -> W:
    """Window over the runs of a key: one row per run, so it stays small."""
    return W.partitionBy(key).orderBy(RUN)


def _with_inside_and_carry(rows: DataFrame, cuts: DataFrame | None, key: str, order: list[str], name: str,
                           inside, of_run: Column, carried, merge=F.coalesce) -> DataFrame:
    """``inside`` over the rows of a run, merged with what ``carried`` brings from other runs."""
    if cuts is None:
        return rows.withColumn(name, inside(W.partitionBy(key).orderBy(*order)))
    rows = with_runs(rows, cuts, key, order)
    carry = rows.where(LONG).groupBy(key, RUN).agg(of_run.alias("__run_value")).select(
        key, RUN, carried(F.col("__run_value"), runs_of(key)).alias("__carried"))
    local = W.partitionBy(key, RUN).orderBy(*order)
    return (with_carry(rows.withColumn(name, inside(local)), carry, key)
            .withColumn(name, merge(F.col(name), F.col("__carried"))).drop("__carried", RUN, LONG))


def with_previous(rows: DataFrame, cuts: DataFrame | None, key: str, order: list[str],
                  value: Column, name: str) -> DataFrame:
    """``value`` (never missing) of the preceding row of the key."""
    return _with_inside_and_carry(
        rows, cuts, key, order, name, lambda w: F.lag(value).over(w),
        F.max_by(value, F.struct(*order)), lambda v, w: F.lag(v).over(w))


def with_next(rows: DataFrame, cuts: DataFrame | None, key: str, order: list[str],
              value: Column, name: str) -> DataFrame:
    """``value`` (never missing) of the following row of the key."""
    return _with_inside_and_carry(
        rows, cuts, key, order, name, lambda w: F.lead(value).over(w),
        F.min_by(value, F.struct(*order)), lambda v, w: F.lead(v).over(w))


def with_running_sum(rows: DataFrame, cuts: DataFrame | None, key: str, order: list[str],
                     value: Column, name: str) -> DataFrame:
    """Sum of ``value`` (never missing) over the key's rows up to this one."""
    return _with_inside_and_carry(
        rows, cuts, key, order, name,
        lambda w: F.sum(value).over(w.rowsBetween(W.unboundedPreceding, 0)), F.sum(value),
        lambda v, w: F.sum(v).over(w.rowsBetween(W.unboundedPreceding, -1)),
        lambda inside, carried: inside + F.coalesce(carried, F.lit(0)))


def with_neighbour(rows: DataFrame, key: str, index: str, value: str, name: str,
                   block: int = 1_000_000) -> DataFrame:
    """``value`` at ``index - 1`` for rows numbered 1, 2, 3 … per key.

    The numbering is cut into equal blocks; the last row of a block is also sent to
    the next one, so no block needs more than its own rows.
    """
    home = F.expr(f"{index} div {block}")
    edge = (F.col(index) + 1) % block == 0
    copies = rows.withColumn("__block", F.explode(
        F.when(edge, F.array(home, home + 1)).otherwise(F.array(home))))
    before = F.lag(value).over(W.partitionBy(key, "__block").orderBy(index))
    return copies.withColumn(name, before).where(F.col("__block") == home).drop("__block")
