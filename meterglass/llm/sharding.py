"""Sharding along a Hilbert curve, with DataFrame functions only.

Source, language and size are quantised to a few bits each by the rows below a value, so that levels hold equal numbers of rows and a
frequent value has one for itself. A row's cell gets its number on the Hilbert curve through all
cells, and the curve is cut into runs of nearly equal bytes. Neighbouring runs are near in every
dimension, so the files' minima and maxima prune by any of them.

Equal texts go to one shard, in the first of their cells, if together they aren't longer than the longest row: then shards are as even as
rows alone allow. Larger groups are dealt row by row.

Running sums never pass one task: cells (their number is bounded by the bits) are summed first, then slices of each
cell, and only the rows of one slice are ordered together. The number of slices follows the number of rows.

Defined cases: a null text has size 1 and no bytes; null or empty dimensions are quantised to 0; texts that differ only behind the bytes looked at share a level; rows that repeat an id are rows of their
own; no rows give no rows; a row longer than a shard's share leaves that shard alone too large; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterglass.llm.common import register, stored, table

#: Bits of each of the three dimensions: 2 ** 15 cells at most.
BITS = 5
#: Rows of a slice of a cell, about.
ROWS_PER_SLICE = 2000


#: Bytes of a text looked at, behind what all have in common: whole numbers of that size are exact in doubles.
LEVEL_BYTES = 6
#: Accuracy of the ranks: one part in so many.
RANKS = 10_000


def text_number(column: str, low: str | None, high: str | None) -> Column:
    """A text's bytes behind those that the smallest and the largest text, and so all, begin with; of null 0."""
    a, b = (low or "").encode(), (high or "").encode()
    same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    found = F.hex(F.substring(F.col(column).cast("string").cast("binary"), same + 1, LEVEL_BYTES))
    return F.coalesce(F.conv(F.rpad(found, 2 * LEVEL_BYTES, "0"), 16, 10).cast("long"), F.lit(0).cast("long"))


def cuts(number: Column, bits: int) -> Column:
    """Between the levels: the numbers that each next share of all rows lies up to."""
    return F.percentile_approx(number, [i / (1 << bits) for i in range(1, 1 << bits)], RANKS)


def level(number: Column, between: list[int] | None) -> Column:
    """How many cuts lie below a number."""
    return F.size(F.filter(F.array(*(F.lit(c).cast("long") for c in between or [])).cast("array<bigint>"), lambda c: c < number))


def hilbert_index(levels: list[Column], bits: int) -> Column:
    """The number of a cell on the Hilbert curve: the axes are turned into the curve's transpose, whose bits interleave.

    One fold over (bit, axis), from the highest bit on, with the axes as an array.
    """
    n = len(levels)
    steps = F.array(*(F.struct(F.lit(1 << bit).alias("bit"), F.lit(axis).alias("axis"))
                      for bit in range(bits - 1, 0, -1) for axis in range(n)))

    def turned(xs: Column, step: Column) -> Column:
        bit, axis = step["bit"], step["axis"]
        own = F.get(xs, axis)
        is_set = own.bitwiseAND(bit) != 0
        swap = F.when(is_set, F.lit(0)).otherwise(F.get(xs, F.lit(0)).bitwiseXOR(own).bitwiseAND(bit - 1))
        first = F.when(is_set, bit - 1).otherwise(swap)
        return F.transform(xs, lambda x, i: F.when(i == 0, x.bitwiseXOR(first)).when(i == axis, x.bitwiseXOR(swap)).otherwise(x))

    def coded(xs: Column) -> Column:
        gray = F.transform(xs, lambda _, i: F.aggregate(F.slice(xs, 1, i + 1), F.lit(0), lambda a, x: a.bitwiseXOR(x)))
        turn = F.aggregate(F.sequence(F.lit(1), F.lit(bits - 1)), F.lit(0), lambda t, bit: F.when(
            F.call_function("shiftright", F.element_at(gray, n), bit).bitwiseAND(1) != 0,
            t.bitwiseXOR(F.call_function("shiftleft", F.lit(1), bit) - 1)).otherwise(t)) if bits > 1 else F.lit(0)
        places = F.array(*(F.struct(F.lit(bit).alias("bit"), F.lit(axis).alias("axis"))
                           for bit in range(bits - 1, -1, -1) for axis in range(n)))
        return F.aggregate(places, F.lit(0), lambda out, p: out * 2 + F.call_function(
            "shiftright", F.get(gray, p["axis"]).bitwiseXOR(turn), p["bit"]).bitwiseAND(1))

    return coded(F.aggregate(steps, F.array(*levels), turned) if bits > 1 else F.array(*levels))


def hilbert_shards(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text",
                   source_col: str = "source", lang_col: str = "lang", bits: int = BITS, carried: bool = False) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, curve, source, lang) of all rows; law ``bytes``.

    Cells in order of the curve, in a cell first single rows in slices by the id's hash, then groups of equal texts. A row or group belongs
    to the shard in which the middle of its bytes lies. ``carried`` adds the whole row as the struct ``whole``.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    whole = [F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("whole")] if carried else []
    rows = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("text_hash"),
                       F.col(source_col).alias("source"), F.col(lang_col).alias("lang"), *whole)
    # One row for all: scales, bytes and the number of slices.
    scale = rows.agg(F.min("source").alias("s0"), F.max("source").alias("s1"), F.min("lang").alias("l0"), F.max("lang").alias("l1"),
                     cuts(F.col("size"), bits).alias("by_size"), F.max("size").alias("longest"), F.count("*").alias("n"),
                     F.sum("size").alias("all_bytes")).first()
    numbers = {"by_source": text_number("source", scale["s0"], scale["s1"]), "by_lang": text_number("lang", scale["l0"], scale["l1"])}
    ranks = rows.agg(*(cuts(number, bits).alias(name) for name, number in numbers.items())).first()
    n_slices = scale["n"] // ROWS_PER_SLICE + 1
    total = max(scale["all_bytes"] or 0, 1)
    cell = ((level(numbers["by_source"], ranks["by_source"]) * (1 << bits) + level(numbers["by_lang"], ranks["by_lang"])) * (1 << bits)
            + level(F.col("size"), scale["by_size"]))
    key = ["text_hash", "text_crc32", "size"]
    placed = stored(rows.select("*", cell.alias("cell"), F.pmod(F.xxhash64("doc_id"), F.lit(n_slices)).alias("slice")), "placed")
    # Groups that stay together; a frequent text is counted before the shuffle, and its rows are joined with one short row or none.
    groups = stored(placed.groupBy(*key).agg(F.count("*").alias("n"), F.min("cell").alias("group_cell"))
                    .where((F.col("n") > 1) & (F.col("n") * F.col("size") <= F.lit(scale["longest"] or 0)))
                    .withColumn("group_slice", F.pmod(F.xxhash64(*key), F.lit(n_slices)) + n_slices), "groups")
    single = placed.join(groups, key, "left_anti")
    group = groups.select(*key, F.col("group_cell").alias("cell"), F.col("group_slice").alias("slice"), (F.col("n") * F.col("size")).alias("bytes"))

    before = (Window.unboundedPreceding, -1)
    slices = (single.select("cell", "slice", F.col("size").alias("bytes")).unionByName(group.select("cell", "slice", "bytes"))
              .groupBy("cell", "slice").agg(F.sum("bytes").alias("bytes")))
    # At most 2 ** (3 * bits) rows, whatever the input: one task may order them and all tasks may hold them.
    low = (1 << bits) - 1
    levels = [F.shiftright("cell", 2 * bits), F.shiftright("cell", bits).bitwiseAND(low), F.col("cell").bitwiseAND(low)]
    cells = slices.groupBy("cell").agg(F.sum("bytes").alias("bytes")).withColumn("curve", hilbert_index(levels, bits))
    along = Window.orderBy("curve").rowsBetween(*before)
    cells = cells.select("cell", "curve", F.coalesce(F.sum("bytes").over(along), F.lit(0)).alias("cell_at"))
    within = Window.partitionBy("cell").orderBy("slice").rowsBetween(*before)
    slices = slices.select("cell", "slice", F.coalesce(F.sum("bytes").over(within), F.lit(0)).alias("slice_at"))

    def sharded(items: DataFrame, size: str, *order: str) -> DataFrame:
        """Items of a slice in an order, with the shard where their middles lie."""
        rank = Window.partitionBy("cell", "slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        ends = items.withColumn("end", F.sum(size).over(rank)).join(slices, ["cell", "slice"]).join(F.broadcast(cells), "cell")
        middle = F.col("end") + F.col("slice_at") + F.col("cell_at") - F.expr(f"{size} div 2") - 1
        return (ends.withColumn("shard", F.least(F.floor(middle.cast("decimal(38,0)") * shards / total), F.lit(shards - 1)).cast("int"))
                .drop("end", "slice_at", "cell_at"))

    members = placed.drop("cell").join(sharded(group, "bytes", *key).select(*key, "cell", "curve", "shard"), key)
    cut = sharded(single, "size", "doc_id", "text_crc32", "size").unionByName(members)

    # Rows of a shard before a slice: again cells first, then slices, then rows.
    counts = cut.groupBy("curve", "slice", "shard").agg(F.count("*").alias("n"))
    by_cell = counts.groupBy("curve", "shard").agg(F.sum("n").alias("n"))
    # At most a row for each cell and for each cut.
    by_cell = by_cell.select("curve", "shard", F.coalesce(
        F.sum("n").over(Window.partitionBy("shard").orderBy("curve").rowsBetween(*before)), F.lit(0)).alias("cell_slot"))
    counts = counts.select("curve", "slice", "shard", F.coalesce(
        F.sum("n").over(Window.partitionBy("shard", "curve").orderBy("slice").rowsBetween(*before)), F.lit(0)).alias("slice_slot"))
    order = Window.partitionBy("curve", "slice", "shard").orderBy("doc_id", "text_crc32", "size")
    numbered = (cut.withColumn("place", F.row_number().over(order) - 1)
                .join(counts, ["curve", "slice", "shard"]).join(F.broadcast(by_cell), ["curve", "shard"]))
    return numbered.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                           (F.col("place") + F.col("slice_slot") + F.col("cell_slot")).cast("long").alias("slot"),
                           F.lit(None).cast("int").alias("grown_shard"), "curve", "source", "lang", *(["whole"] if carried else []))


def write_shards(docs: DataFrame, path: str, shards: int = 16, **columns: object) -> None:
    """The documents as one folder for each shard (column ``shard``), each sorted along the curve.

    Rows travel with their places, so null and repeated ids are rows like others; a column ``shard`` of the documents is replaced.
    """
    placed = hilbert_shards(docs, shards, carried=True, **columns)
    rest = [F.col("whole")[c].alias(c) for c in docs.columns if c.lower() != "shard"]
    (placed.repartition("shard", F.floor(F.col("slot") / 100_000)).sortWithinPartitions("shard", "slot")
     .select(*rest, "shard").write.partitionBy("shard").parquet(path))


@register("op10_hilbert_shards")
def op10_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_shards(table(spark, sf_dir, "documents"))
