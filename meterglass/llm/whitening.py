"""Embedding whitening from bit-sliced cross-products.

Components become whole numbers. A task takes the rows of a batch, shifts each dimension by its least value there, and packs the bits of
equal weight of 64 rows into a word: a dimension is a handful of bit planes. The sum of products of two dimensions is then the sum over their
planes of the number of common bits, by the planes' weights, and a dimension's sum is that of its planes alone: exact, whatever the number of rows. Shifts are undone
in whole numbers of any size, each task sends one matrix in limbs of 32 bits, and Spark adds the limbs.

The driver holds a matrix of dimensions by dimensions: it is centred as whole numbers (n times the sum of products, less the product of the sums)
and only then rounded for the eigenvectors. Rows are projected where they lie; the check on the result is an aggregate over the written rows.

Defined cases: rows without a vector or with a null or non-finite component are dropped; shorter vectors are filled with zeros to the longest
one's length; rows that repeat an id are rows of their own, null ids stay; a component of no variance has null ``whitened`` (and no part in
``identity_error``, which is null without any), and ``explained`` 0 where there is no variance at all; fewer dimensions than components
give as many components; components beyond 2 ** 62 in size are held there; ``deviation`` is null where it needs more than 64 bits,
``deviation_text`` has its digits in any case; no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterglass.llm.common import register, stored, table
from meterglass.llm.hard_negatives import finite, matrix

COMPONENTS, SCALE, OFFSET = 8, 1024.0, 100_000
#: Rows whose planes are built at a time; a multiple of 64.
PLANE_ROWS = 1 << 14
LIMB = 32
WIDEST = 2.0 ** 62


def whole(column: pa.Array, width: int, scale: float) -> np.ndarray:
    """floor(scale * c) of a column of vectors, as 64-bit integers; the offset is added by those who need it."""
    values = np.floor(np.clip(matrix(column, width).astype(np.float64) * scale, -WIDEST, WIDEST))
    return values.astype(np.int64)


def bit_planes(shifted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, dimension, bit) of all planes that hold a bit: a line of words for each, 64 rows a word."""
    rows = len(shifted)
    padded = np.zeros((-rows % 64 + rows, shifted.shape[1]), np.uint64)
    padded[:rows] = shifted
    words, dimension, bit = [], [], []
    for d in range(shifted.shape[1]):
        values = padded[:, d]
        for b in range(int(values.max(initial=np.uint64(0))).bit_length()):
            plane = np.packbits(((values >> np.uint64(b)) & np.uint64(1)).astype(bool)).view(np.uint64)
            if plane.any():
                words.append(plane)
                dimension.append(d)
                bit.append(b)
    return np.array(words, np.uint64).reshape(len(words), len(padded) // 64), np.array(dimension, np.int64), np.array(bit, np.int64)


def cross_products(shifted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sums, sums of products) of the columns of nonnegative integers, exact, as Python integers.

    The products are those of planes: weighted counts of common bits.
    """
    width = shifted.shape[1]
    planes, dimension, bit = bit_planes(shifted)
    sums, products = np.zeros(width, object), np.zeros((width, width), object)
    counts = np.bitwise_count(planes).sum(axis=1, dtype=np.int64)
    for count, d, b in zip(counts.tolist(), dimension.tolist(), bit.tolist()):
        sums[d] += count << b
    starts = np.searchsorted(dimension, np.arange(width + 1))
    top = int(bit.max(initial=0))
    # Sums of weighted counts of one pair of dimensions stay in 64 bits, or are taken in Python's integers.
    small = 2 * (top + 1) + len(shifted).bit_length() < 62
    weights = np.left_shift(1, bit) if small else np.array([1 << b for b in bit.tolist()], object)
    for i in range(width):
        line = np.zeros(len(planes) - starts[i], np.int64 if small else object)
        for p in range(starts[i], starts[i + 1]):
            common = np.bitwise_count(planes[starts[i]:] & planes[p]).sum(axis=1, dtype=np.int64)
            line = line + (common if small else common.astype(object)) * weights[p]
        line = line * weights[starts[i]:]
        for j in range(i, width):
            products[i, j] = products[j, i] = int(line[starts[j] - starts[i]:starts[j + 1] - starts[i]].sum())
    return sums, products


def limbs(value: int) -> list[int]:
    """Digits to the base 2 ** 32, all of the value's sign."""
    sign, value, out = (-1 if value < 0 else 1), abs(value), []
    while value:
        out.append(sign * (value & ((1 << LIMB) - 1)))
        value >>= LIMB
    return out


def moments(vectors: DataFrame, vector_col: str, width: int, scale: float) -> tuple[int, np.ndarray, np.ndarray]:
    """(n, sums, sums of products) of the whole numbers without offset."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0, np.zeros(width, object), np.zeros((width, width), object)
        for batch in batches:
            for at in range(0, batch.num_rows, PLANE_ROWS):
                x = whole(batch.column(0).slice(at, PLANE_ROWS), width, scale)
                least = x.min(axis=0)
                own, crossed = cross_products((x - least).view(np.uint64))
                low = np.array([int(v) for v in least], object)
                n += len(x)
                sums += own + low * len(x)
                products += crossed + np.multiply.outer(low, own) + np.multiply.outer(own, low) + np.multiply.outer(low, low) * len(x)
        rows = [(-1, -1, k, v) for k, v in enumerate(limbs(n))]
        for i in range(width):
            rows += [(i, -1, k, v) for k, v in enumerate(limbs(sums[i]))]
            rows += [(i, j, k, v) for j in range(i, width) for k, v in enumerate(limbs(products[i, j]))]
        columns = list(zip(*rows)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.int32(), pa.int64()))],
                                         ["i", "j", "limb", "value"])

    # At most a few numbers for each pair of dimensions.
    parts = (vectors.select(vector_col).mapInArrow(partial, "i int, j int, limb int, value long")
             .groupBy("i", "j", "limb").agg(F.sum("value").alias("value")).collect())
    n, sums, products = 0, np.zeros(width, object), np.zeros((width, width), object)
    for i, j, limb, value in parts:
        if i < 0:
            n += value << (LIMB * limb)
        elif j < 0:
            sums[i] += value << (LIMB * limb)
        else:
            products[i, j] += value << (LIMB * limb)
    return n, sums, np.where(np.tri(width, k=-1, dtype=bool), products.T, products)


def principal(n: int, sums: np.ndarray, products: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(eigenvectors as columns, variances (0: none), shares of all variance) of the first components."""
    width = len(sums)
    centred = n * products - np.multiply.outer(sums, sums)
    covariance = np.array([[int(v) / (n * n) for v in line] for line in centred], np.float64).reshape(width, width)
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:components]
    trace = sum(int(centred[i, i]) for i in range(width)) / (n * n)
    values = values[order]
    values[values <= width * np.finfo(float).eps * max(trace, 0.0)] = 0.0
    return vectors[:, order], values, values / trace if trace else np.zeros(len(order))


def deviations(z: np.ndarray) -> tuple[list[int | None], list[str]]:
    """Sums of squares of the lines of integers: as far as 64 bits hold them, and their digits."""
    largest = max(abs(int(z.min(initial=0))), abs(int(z.max(initial=0))))
    sums = (z * z).sum(axis=1).tolist() if z.dtype != object and largest ** 2 * max(z.shape[1], 1) < 2 ** 63 else [
        sum(int(v) * int(v) for v in line) for line in z.tolist()]
    return [s if s < 2 ** 63 else None for s in sums], [str(s) for s in sums]


def whiten(vectors: DataFrame, components: int = COMPONENTS, scale: float = SCALE, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error, deviation_text) of all rows with a vector.

    An offset that is added to all components changes none of these.
    """
    kind = vectors.schema[id_col].dataType.simpleString()
    chosen = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("v")).where(F.col("v").isNotNull() & finite(F.col("v")))
    width = chosen.agg(F.max(F.size("v"))).first()[0] or 0
    n, sums, products = moments(chosen, "v", width, scale)
    axes, variances, shares = principal(n, sums, products, components) if n else (np.zeros((width, 0)), np.zeros(0), np.zeros(0))
    count = len(variances)
    scales = np.sqrt(np.where(variances > 0, variances, 1.0))
    widest = max((abs(int(s)) for s in sums), default=0)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, PLANE_ROWS):
                part = batch.slice(at, PLANE_ROWS)
                x = whole(part.column("v"), width, scale)
                reach = max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0)))) * n + widest
                # n * x - S, exact.
                z = x * n - sums.astype(np.int64) if reach < 2 ** 62 else x.astype(object) * n - sums
                held, digits = deviations(z)
                values = (z.astype(np.float64) / n) @ axes / scales
                values[:, variances == 0] = np.nan
                flat = values.ravel()
                lists = [pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * count, pa.array(flat, mask=np.isnan(flat)))]
                yield pa.RecordBatch.from_arrays([part.column("vec_id"), pa.array(held, pa.int64()), pa.array(digits, pa.string()), *lists],
                                                 ["vec_id", "deviation", "deviation_text", "whitened"])

    rows = stored(chosen.mapInArrow(project, f"vec_id {kind}, deviation long, deviation_text string, whitened array<double>"), "whitened")
    live = [k for k in range(count) if variances[k] > 0]
    pairs = [(a, b) for a in live for b in live if a <= b]
    error = None
    if pairs:
        got = rows.agg(*(F.covar_pop(F.get("whitened", F.lit(a)), F.get("whitened", F.lit(b))).alias(f"c{a}_{b}") for a, b in pairs)).first()
        error = float(max(abs(got[f"c{a}_{b}"] - (a == b)) for a, b in pairs))
    shown = F.array(*(F.struct(F.lit(k + 1).alias("component"), F.get("whitened", F.lit(k)).alias("whitened"),
                               F.lit(float(shares[k])).alias("explained")) for k in range(count)))
    if not count:
        shown = F.array().cast("array<struct<component:int,whitened:double,explained:double>>")
    return rows.withColumn("c", F.explode(shown)).select(
        "vec_id", "c.component", F.lit(n).cast("long").alias("n"), "deviation", "c.whitened", "c.explained",
        F.lit(error).cast("double").alias("identity_error"), "deviation_text")


@register("op12_whitening")
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
