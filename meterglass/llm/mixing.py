"""Temperature mixing of sources, with DataFrame functions only.

A source's weight is its token share to the power of an exponent between 0 (all equal) and 1 (as they are), normalised.
The exponent's interval is narrowed until the weights have the target entropy, or until no source
repeats more often than the limit; by default both hold. A budget of tokens times the weights gives each source's quota, which is filled
with whole permutations of the source and a last part of one. The stream is laid out in blocks of equal
budget: each block holds the same share of every source's quota, in an order of its own.

Running sums never pass one task: a source is cut into slices by the hash of its ids, as many as its rows need.

Defined cases: a null text has no words and counts as one token, so that it can be placed; a null source is a source of its own; repeated rows
are mixed as rows of their own; one source, or an empty table, is left as it is; limits that no
exponent up to 1 meets (shares nearly equal already, say) leave the shares as they are; a quota below one token takes nothing; other columns are kept by ``mixed``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterglass.llm.common import register, stored, table

#: Rows of a slice of a source, about.
ROWS_PER_SLICE = 2000
#: Parts of the exponent's interval in each round of the bisection, and rounds: 2 ** 40 parts in all.
WAYS, ROUNDS = 32, 8


def tokens(text_col: str) -> Column:
    """Words of a text, at least one."""
    return F.greatest(F.coalesce(F.regexp_count(F.col(text_col), F.lit(r"[^ \t-\r]+")), F.lit(0)), F.lit(1)).cast("long")


def source_weights(shares: DataFrame, target_entropy: float | None = 0.95, max_repeats: float | None = None,
                   budget_share: float = 1.0) -> DataFrame:
    """(source, tokens, exponent, weight) from (source, tokens).

    ``target_entropy``: of the weights, as a share of the entropy of equal weights; ``max_repeats``: of any source under a budget
    of budget_share times all tokens. Where both are given both hold; the exponent is the smallest that does.
    The sums for WAYS - 1 exponents at a time are one aggregate over all sources, so their number may grow; each round keeps
    one of WAYS parts of the interval.
    """
    row = shares.agg(F.sum("tokens"), F.count("*"), F.min("tokens")).first()
    whole, n, least = row[0] or 1, row[1], (row[2] or 1) / (row[0] or 1)
    share = F.col("tokens") / F.lit(float(whole))

    def fits(exponents: list[float]) -> list[bool]:
        """Whether the weights of each exponent are within the limits."""
        sums = shares.agg(*(F.sum(F.pow(share, F.lit(a))) for a in exponents),
                          *(F.sum(F.pow(share, F.lit(a)) * F.log(share)) for a in exponents)).first()
        out = []
        for a, z, e in zip(exponents, sums[:len(exponents)], sums[len(exponents):]):
            entropy, repeats = math.log(z) - a * e / z, least ** (a - 1) * budget_share / z
            out.append((target_entropy is None or entropy <= target_entropy * math.log(n))
                       and (max_repeats is None or repeats <= max_repeats))
        return out

    low = exponent = 0.0
    if n and not fits([0.0])[0]:
        exponent = 1.0
        for _ in range(ROUNDS):
            grid = [low + (exponent - low) * i / WAYS for i in range(1, WAYS)]
            first = next((i for i, fit in enumerate(fits(grid)) if fit), len(grid))
            low, exponent = ([low, *grid][first], [*grid, exponent][first])
    z = shares.agg(F.sum(F.pow(share, F.lit(exponent)))).first()[0] or 1.0
    return shares.select("source", "tokens", F.lit(exponent).alias("exponent"), (F.pow(share, F.lit(exponent)) / F.lit(z)).alias("weight"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                target_entropy: float | None = 0.95, max_repeats: float | None = 4.0, budget_share: float = 1.0,
                blocks: int = 64, seed: int = 7, also: tuple[str, ...] = ()) -> DataFrame:
    """One row for each appearance of a document in the mixed stream:
    (doc_id, source, n_tokens, epoch, block, block_key, weight, *also).

    The stream is the order of (block, block_key, doc_id, epoch). ``epoch`` counts a document's appearances from 0.
    Within an epoch a document stands at its place in the source's permutation. A document is taken in the
    last, partial epoch when the part ends behind its first token's middle.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), tokens(text_col).alias("n_tokens"), *also)
    counted = rows if also else stored(rows, "tokens")
    sums = stored(counted.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("n")), "sources")
    whole = sums.agg(F.sum("tokens")).first()[0] or 0
    budget = int(whole * budget_share)
    weights = source_weights(sums.select("source", "tokens"), target_entropy, max_repeats, budget_share)
    # Written, so that its size is known when the join is planned: a small one moves no row of the documents.
    plan = stored(sums.select("source", "n").withColumnRenamed("source", "w_source").join(
        weights, F.col("w_source").eqNullSafe(F.col("source"))).select(
        "w_source", F.col("tokens").alias("source_tokens"), "weight",
        F.floor(F.col("weight") * F.lit(budget)).cast("long").alias("quota"),
        (F.expr("n div %d" % ROWS_PER_SLICE) + 1).alias("slices")), "plan")

    def draw(*columns: object) -> Column:
        """A pseudo-random number from 0 to 2 ** 62 - 1."""
        return F.xxhash64(F.lit(seed), *columns).bitwiseAND((1 << 62) - 1)

    known = counted.join(plan, F.col("source").eqNullSafe(F.col("w_source"))).drop("w_source")
    # Never null, so that the join with the slices finds the rows where the window has put them and moves none.
    known = known.withColumn("source_key", F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")))
    known = known.withColumn("place", draw("doc_id", "n_tokens")).withColumn(
        "slice", F.floor(F.col("place") / F.lit(float(1 << 62)) * F.col("slices")))
    before = (Window.unboundedPreceding, -1)
    slices = known.groupBy("source_key", "slice").agg(F.sum("n_tokens").alias("t"))
    slices = slices.select("source_key", "slice", F.coalesce(
        F.sum("t").over(Window.partitionBy("source_key").orderBy("slice").rowsBetween(*before)), F.lit(0)).alias("slice_at"))
    order = Window.partitionBy("source_key", "slice").orderBy("place", "doc_id", "n_tokens").rowsBetween(*before)
    at = (known.withColumn("inside", F.coalesce(F.sum("n_tokens").over(order), F.lit(0)))
          .join(slices, ["source_key", "slice"]).withColumn("at", F.col("slice_at") + F.col("inside")))
    # Appearances: epoch e begins e * source_tokens into the source's quota.
    left = F.col("quota") - F.col("at") - F.expr("n_tokens div 2")
    times = F.when(left > 0, F.expr("(quota - at - n_tokens div 2 - 1) div source_tokens") + 1).otherwise(F.lit(0))
    shown = at.withColumn("times", times).where("times > 0").withColumn(
        "epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1)))
    share = (F.col("epoch") * F.col("source_tokens") + F.col("at")) / F.col("quota")
    return shown.select("doc_id", "source", "n_tokens", F.col("epoch").cast("int").alias("epoch"),
                        F.least(F.floor(share * blocks), F.lit(blocks - 1)).cast("int").alias("block"),
                        draw("doc_id", "epoch", F.lit("block")).alias("block_key"), "weight", *also)


def mixed(docs: DataFrame, **options: object) -> DataFrame:
    """The mixed stream: all columns of the documents, a row for each appearance, in the order of the stream.

    Written, the files' names follow the order, so a reader of the files one after the other gets each block's permutation.
    """
    whole = docs.withColumn("whole", F.struct(*docs.columns))
    return mix_sources(whole, also=("whole",), **options).orderBy("block", "block_key", "doc_id", "epoch").select("whole.*")


@register("op4_mix_sources")
def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))
