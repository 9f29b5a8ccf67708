"""Hard negatives by segment summaries.

Each vector is stored beside the mean and the deviation (the length of what is left after the mean) of each of its segments. Over a
segment of m components the product of two vectors is m times their means' product, give or take their deviations'
product; summed over the segments this bounds the score from both sides. A search works through levels of finer segments: of
a rectangle of anchors and rows only the lines and columns that some pair still needs go to the next level, and what the
last level leaves is scored exactly. Bounds are widened by more than their rounding error, so they drop no pair that counts.

Two searches: the first keeps each anchor's best rows of its own label, the second, for each of these positives, the best rows of other
labels whose score lies in the positive's window. The best found so far raise the bar for all later rows.

Anchors are a stated part of all rows and meet every row: rows are dealt to groups of bounded size, and each anchor is sent to each
group. In a group the rows come first and are held, the anchors follow and stream past in batches, ``CHUNK_ROWS`` of
them against ``BLOCK_ROWS`` rows at a time. A group answers each anchor with its best few, and those of all groups are ranked. No group holds the
rows of one label, so a label with a third of all rows is no heavier than others.

Defined cases: rows without a label or a vector, or with a null or non-finite component, take no part; vectors shorter than the longest
are filled with zeros; rows that repeat a vec_id are rows of their own (each an anchor, each a candidate, ties between them in no stated order);
a null vec_id is no anchor, and comes last among ties; an anchor without positives has no rows; no rows give no rows; scores
beyond 64 bits are held at the ends of their range; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterglass.llm.common import register, stored, table

#: Segments of a vector at each level.
SEGMENTS = (2, 8)
#: Rows that a task holds, rows and anchors of a rectangle.
GROUP_ROWS, BLOCK_ROWS, CHUNK_ROWS = 1 << 18, 4096, 256
#: Groups are smaller than that while there are fewer than this, of so many rows at least.
LEAST_GROUPS, LEAST_ROWS = 24, 2048
#: Share of the product of two lengths by which bounds are widened: several times the error of sums in single precision.
SLACK = 4e-5
LONG = np.iinfo(np.int64)


def finite(vector: Column) -> Column:
    return F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """The lists of a column as lines of a matrix, filled with zeros to a width."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values, counts = column.flatten().to_numpy(zero_copy_only=False), column.value_lengths().to_numpy(zero_copy_only=False)
    if len(values) == width * len(column):
        return values.reshape(len(column), width)
    out = np.zeros((len(column), width), values.dtype)
    out[np.arange(width) < counts[:, None]] = values
    return out


def segment_edges(width: int, segments: int) -> np.ndarray:
    return np.linspace(0, width, min(segments, width) + 1).astype(int)


def summaries(x: np.ndarray) -> np.ndarray:
    """For each level the means (by the root of the segment's length) and the deviations of each line's segments, side by side."""
    parts = []
    for segments in SEGMENTS:
        edges = segment_edges(x.shape[1], segments)
        size = np.diff(edges)
        total = np.add.reduceat(x, edges[:-1], axis=1) if len(size) else np.zeros((len(x), 0))
        mean = total / np.maximum(size, 1)
        left = x - np.repeat(mean, size, axis=1)
        parts += [mean * np.sqrt(size), np.sqrt(np.add.reduceat(left * left, edges[:-1], axis=1) if len(size) else total)]
    return np.concatenate(parts, axis=1)


@dataclass
class Side:
    """Rows or anchors of a rectangle: numbers, ids (null: flagged), labels, integer components and summaries."""
    row: np.ndarray
    id: np.ndarray
    no_id: np.ndarray
    label: np.ndarray
    x: np.ndarray
    summary: np.ndarray
    length: np.ndarray

    @staticmethod
    def of(batch: pa.RecordBatch | pa.Table, width: int) -> Side:
        ids = batch.column("vec_id")
        x = matrix(batch.column("x"), width).astype(np.float64)
        longest = np.sqrt((x * x).sum(axis=1))
        # Sums of products stay whole numbers in the type chosen here; beyond both, see products().
        kind = np.float32 if longest.max(initial=0) < 2 ** 12 else np.float64
        summary = np.stack(batch.column("summary").to_numpy(zero_copy_only=False)) if len(ids) else np.zeros((0, 0))
        return Side(batch.column("row").to_numpy(), ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False),
                    batch.column("label").to_numpy(), x.astype(kind), summary.astype(np.float32), longest.astype(np.float32))

    def take(self, which: np.ndarray | slice) -> Side:
        return Side(*(getattr(self, name)[which] for name in self.__dataclass_fields__))

    @staticmethod
    def together(parts: list[Side]) -> Side:
        return Side(*(np.concatenate([getattr(p, name) for p in parts]) for name in Side.__dataclass_fields__))


def bounds(a: Side, b: Side, level: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of all scores of two sides by the segments of a level."""
    at = 2 * sum(min(s, width) for s in SEGMENTS[:level])
    n = min(SEGMENTS[level], width)
    middle = a.summary[:, at:at + n] @ b.summary[:, at:at + n].T
    spread = a.summary[:, at + n:at + 2 * n] @ b.summary[:, at + n:at + 2 * n].T
    spread += SLACK * np.outer(a.length, b.length) + 1
    return middle - spread, middle + spread


def products(a: Side, b: Side) -> np.ndarray:
    """Exact scores as 64-bit integers."""
    largest = float(a.length.max(initial=0)) * float(b.length.max(initial=0))
    if largest < 2 ** 23:
        return (a.x @ b.x.T).astype(np.int64)
    if largest < 2 ** 52:
        return (a.x.astype(np.float64) @ b.x.T.astype(np.float64)).astype(np.int64)
    whole = [np.array([[int(v) for v in line] for line in side.x], object).reshape(side.x.shape) for side in (a, b)]
    exact = whole[0] @ whole[1].T if a.x.shape[1] else np.zeros((len(a.x), len(b.x)))
    return np.clip(exact, LONG.min, LONG.max).astype(np.int64)


def outwards(values: np.ndarray, to: float) -> np.ndarray:
    """Integers as single-precision limits that are not nearer than they."""
    return np.nextafter(values.astype(np.float32), np.float32(to))


class Best:
    """The best rows of each of some searches: by falling score, then by id (null last), then by row number."""

    def __init__(self, searches: int, keep: int):
        self.searches, self.keep = searches, keep
        self.found = [np.zeros(0, np.int64)] * 3 + [np.zeros(0, bool), np.zeros(0, np.int64)]
        #: A row must score this much to matter.
        self.bar = np.full(searches, LONG.min, np.int64)

    def add(self, search: np.ndarray, score: np.ndarray, side: Side, column: np.ndarray) -> None:
        new = (search, score, side.id[column], side.no_id[column], side.row[column])
        search, score, ids, no_id, row = (np.concatenate(pair) for pair in zip(self.found, new))
        order = np.lexsort((row, ids, no_id, ~score, search))
        ordered = search[order]
        rank = np.arange(len(order)) - np.searchsorted(ordered, ordered)
        order = order[rank < self.keep]
        self.found = [c[order] for c in (search, score, ids, no_id, row)]
        last = rank[rank < self.keep] == self.keep - 1
        self.bar[self.found[0][last]] = self.found[1][last]

    def rows(self) -> tuple[np.ndarray, ...]:
        return tuple(self.found)


def search(anchors: Side, rows: Side, width: int, may: Callable[[Side, Side], np.ndarray], low: np.ndarray, high: np.ndarray,
           keep: int) -> tuple[np.ndarray, ...]:
    """The ``keep`` best allowed rows of each search, with scores from ``low`` to ``high``.

    ``low``, ``high``: (anchors, searches of an anchor); a search's number is anchor * searches + place.
    """
    per = low.shape[1]
    best = Best(low.size, keep)
    pruned = max(float(anchors.length.max(initial=0)), float(rows.length.max(initial=0))) < 2 ** 40
    for at in range(0, len(rows.row), BLOCK_ROWS):
        block = rows.take(slice(at, at + BLOCK_ROWS))
        need = np.maximum(low, best.bar.reshape(low.shape))
        lines, columns = np.arange(len(anchors.row)), np.arange(len(block.row))
        allowed = may(anchors, block) & (need <= high).any(axis=1)[:, None]
        a, b = anchors, block
        for level in range(len(SEGMENTS) + 1):
            some, others = allowed.any(axis=1), allowed.any(axis=0)
            if not some.any():
                break
            if not (some.all() and others.all()):
                allowed, lines, columns = allowed[some][:, others], lines[some], columns[others]
                a, b = a.take(some), b.take(others)
            if level == len(SEGMENTS):
                scores = products(a, b)
                for place in range(per):
                    good = allowed & (scores >= need[lines, place][:, None]) & (scores <= high[lines, place][:, None])
                    if good.shape[1] > keep:
                        # Of one block no more than the best and their ties.
                        ranked = np.where(good, scores, LONG.min)
                        good &= scores >= np.partition(ranked, -keep, axis=1)[:, -keep][:, None]
                    i, j = np.nonzero(good)
                    if len(i):
                        best.add(lines[i] * per + place, scores[i, j], b, j)
            elif pruned:
                below, above = bounds(a, b, level, width)
                fits = np.zeros(allowed.shape, bool)
                for place in range(per):
                    fits |= (above >= outwards(need[lines, place], -np.inf)[:, None]) & (below <= outwards(high[lines, place], np.inf)[:, None])
                allowed &= fits
    return best.rows()


def own_label(a: Side, b: Side) -> np.ndarray:
    return (a.label[:, None] == b.label) & (a.row[:, None] != b.row)


def other_label(a: Side, b: Side) -> np.ndarray:
    return a.label[:, None] != b.label


FOUND = "anchor_row long, place int, score long, id long, row long"


def searched(rows: DataFrame, anchors: DataFrame, groups: int, width: int, may: Callable[[Side, Side], np.ndarray], keep: int) -> DataFrame:
    """FOUND: the best of all groups for each search. Anchors have lists ``low`` and ``high``, with an entry for each search."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], None
        for batch in batches:
            kind = batch.column("kind").to_numpy()
            for part in (batch.filter(pa.array(kind == k)) for k in (0, 1)):
                if not part.num_rows:
                    continue
                if part.column("kind")[0].as_py() == 0:
                    if rows is not None:
                        raise RuntimeError("rows of a group must come before its anchors")
                    held.append(Side.of(part, width))
                    continue
                if rows is None:
                    rows = Side.together(held) if held else False
                for at in range(0, part.num_rows if rows else 0, CHUNK_ROWS):
                    chunk = part.slice(at, CHUNK_ROWS)
                    a = Side.of(chunk, width)
                    per = len(chunk.column("low")[0])
                    low, high = (chunk.column(c).flatten().to_numpy().reshape(-1, per) for c in ("low", "high"))
                    which, score, ids, no_id, row = search(a, rows, width, may, low, high, keep)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(a.row[which // per]), pa.array((which % per).astype(np.int32)), pa.array(score),
                         pa.array(ids, mask=no_id), pa.array(row)], ["anchor_row", "place", "score", "id", "row"])

    columns = ["row", "vec_id", "label", "x", "summary"]
    empty = F.array().cast("array<long>")
    sides = rows.select(F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int").alias("group"), F.lit(0).alias("kind"), *columns,
                        empty.alias("low"), empty.alias("high"))
    sides = sides.unionByName(anchors.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"), F.lit(1).alias("kind"),
                                             *columns, "low", "high"))
    # The order by kind holds within a group, as groups need no other sort; by label, most rectangles of foreign labels end at once.
    found = sides.repartition("group").sortWithinPartitions("group", "kind", "label").groupBy("group").applyInArrow(work, FOUND)
    rank = F.row_number().over(Window.partitionBy("anchor_row", "place").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row"))
    return found.withColumn("rank", rank).where(F.col("rank") <= keep)


def segment_rows(vectors: DataFrame, scale: float, id_col: str, label: Column, vector_col: str) -> tuple[DataFrame, int, int]:
    """The stored rows (row, vec_id, label, x, summary) that take part, their number and the longest vector's length."""
    chosen = vectors.select(F.col(id_col).cast("long").alias("vec_id"), label.cast("int").alias("label"), F.col(vector_col).alias("v"))
    chosen = chosen.where(F.col("label").isNotNull() & F.col("v").isNotNull() & finite(F.col("v")))
    sizes = chosen.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width"),
                       F.max(F.array_max(F.transform("v", lambda x: F.abs(x.cast("double"))))).alias("largest")).first()
    n, width = sizes["n"], sizes["width"] or 0
    # The smallest type that holds all components.
    largest = (sizes["largest"] or 0.0) * scale + 1
    kind, dtype = ("short", np.int16) if largest < 2 ** 15 else ("int", np.int32) if largest < 2 ** 31 else ("double", np.float64)

    def summarised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                x = np.floor(np.clip(matrix(part.column("v"), width).astype(np.float64), -1e300, 1e300) * scale)
                lists = [pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * values.shape[1], pa.array(values.ravel()))
                         for values in (x.astype(dtype), summaries(x).astype(np.float32))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(number, number + len(x))), part.column("vec_id"), part.column("label"), *lists],
                    ["row", "vec_id", "label", "x", "summary"])
                number += len(x)

    rows = chosen.mapInArrow(summarised, f"row long, vec_id long, label int, x array<{kind}>, summary array<float>")
    return stored(rows, "segments"), n, width


def hard_negatives(vectors: DataFrame, is_anchor: Column, label: Column, scale: float = 256.0, positives: int = 5, negatives: int = 10,
                   window: tuple[int, int] = (30, 90), id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``is_anchor``: of ``vec_id``. A negative's score is between the two percentages of its positive's.
    """
    rows, n, width = segment_rows(vectors, scale, id_col, label, vector_col)
    groups = max(-(-n // GROUP_ROWS), min(LEAST_GROUPS, -(-n // LEAST_ROWS)), 1)
    anchors = rows.where(is_anchor)

    whole = anchors.withColumns({"low": F.array(F.lit(int(LONG.min))), "high": F.array(F.lit(int(LONG.max)))})
    near = searched(rows, whole, groups, width, own_label, positives)
    near = stored(near.select("anchor_row", (F.col("rank") - 1).alias("place"), F.col("id").alias("positive_id"),
                              F.col("score").alias("positive_score")), "positives")

    # An anchor has a handful of positives; missing ones are windows that nothing fits.
    score = F.col("positive_score").cast("decimal(38,0)")
    low, high = F.ceil(score * window[0] / 100).cast("long"), F.floor(score * window[1] / 100).cast("long")
    windows = near.groupBy("anchor_row").agg(F.map_from_entries(F.collect_list(F.struct("place", F.struct(low.alias("low"), high.alias("high"))))).alias("of"))
    limits = {name: F.array(*(F.coalesce(F.try_element_at("of", F.lit(i))[name], F.lit(int(none))) for i in range(positives)))
              for name, none in (("low", LONG.max), ("high", LONG.min))}
    ready = anchors.join(windows, anchors["row"] == windows["anchor_row"]).withColumns(limits)
    far = searched(rows, ready, groups, width, other_label, negatives)
    far = far.select("anchor_row", "place", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    names = anchors.select(F.col("row").alias("anchor_row"), F.col("vec_id").alias("anchor_id"))
    return far.join(near, ["anchor_row", "place"]).join(names, "anchor_row").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


@register("op11_hard_negatives", """
WITH valid AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS DOUBLE)) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
    CAST(list_dot_product(a.x, b.x) AS BIGINT) AS score
  FROM valid a, valid b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
  other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN pairs USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) <= 10
""")
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)
