"""Hard negatives and whitening beside plain code."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterglass.llm import hard_negatives, whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(seed=3, n=700, width=12):
    """Clustered vectors with a label that holds a third of them, copies, and rows that take no part."""
    pick = np.random.default_rng(seed)
    centres = pick.normal(size=(7, width))
    out = []
    for i in range(n):
        label = 0 if i % 3 == 0 else int(pick.integers(0, 10))
        v = centres[i % 7] * pick.uniform(0, 1) + pick.normal(size=width) * .4
        v = v / np.linalg.norm(v)
        out.append((i, [float(np.float32(c)) for c in v], label))
    out[10:14] = [(10 + i, out[7][1], 3) for i in range(4)]
    out[20] = (20, None, 1)
    out[21] = (21, out[21][1][:-1] + [float("nan")], 1)
    out[22] = (22, out[22][1][:-1] + [float("inf")], 1)
    out[23] = (23, out[23][1][:-1] + [None], 1)
    out[24] = (24, out[24][1], None)
    out[25] = (25, out[25][1][:5], 4)
    out[26] = (26, [], 4)
    out[27] = (None, out[27][1], 4)
    return out


def usable(rows, with_label=True):
    out = []
    for vec_id, v, label in rows:
        if v is None or any(c is None or not math.isfinite(c) for c in v) or (with_label and label is None):
            continue
        out.append((vec_id, v, label))
    return out


def plain_negatives(rows, scale=256):
    kept = usable(rows)
    width = max((len(v) for _, v, _ in kept), default=0)
    x = [[math.floor(scale * c) for c in v] + [0] * (width - len(v)) for _, v, _ in kept]
    labels = [(lab + 1) % 10 if i is not None and i % 7 == 0 else lab for i, _, lab in kept]
    ids = [i for i, _, _ in kept]
    by = lambda p: (-p[0], ids[p[1]] is None, ids[p[1]] or 0)
    out = []
    for a, anchor in enumerate(ids):
        if anchor is None or anchor % 100:
            continue
        scored = sorted(((sum(p * q for p, q in zip(x[a], x[b])), b) for b in range(len(ids)) if b != a), key=by)
        for ps, b in [p for p in scored if labels[p[1]] == labels[a]][:5]:
            fit = [p for p in scored if labels[p[1]] != labels[a] and 30 * ps <= 100 * p[0] <= 90 * ps][:10]
            out += [(anchor, ids[b], r, ids[c], ps, ns) for r, (ns, c) in enumerate(fit, 1)]
    return out


def negatives(spark, rows, schema=SCHEMA):
    frame = spark.createDataFrame(rows, schema).repartition(3).withColumns({c: F.lit(c) for c in ("row", "group", "kind", "x", "rank", "low")})
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(frame, F.col("vec_id") % 100 == 0, label)


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((c is None, c or 0) for c in r))


def test_hard_negatives_beside_plain_code(spark):
    rows = vectors()
    assert ordered(negatives(spark, rows).collect()) == ordered(plain_negatives(rows))


def test_hard_negatives_with_tiny_rectangles(spark, monkeypatch):
    """Many groups and blocks, so that bars rise and rectangles shrink."""
    for name, value in (("BLOCK_ROWS", 16), ("CHUNK_ROWS", 2), ("LEAST_ROWS", 64)):
        monkeypatch.setattr(hard_negatives, name, value)
    rows = vectors(seed=5)
    assert ordered(negatives(spark, rows).collect()) == ordered(plain_negatives(rows))


@pytest.mark.parametrize("rows", [[], [(0, None, 1)], [(0, [1.0, 2.0], 3)], [(0, [], 1), (1, [], 1), (2, [], 2)]])
def test_hard_negatives_on_edges(spark, rows):
    assert ordered(negatives(spark, rows).collect()) == ordered(plain_negatives(rows))


def test_hard_negatives_of_repeated_ids(spark):
    """Each row of an id is an anchor and a candidate: both have the other as a positive."""
    rows = [(0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (1, [0.5, 0.0], 2)]
    got = negatives(spark, [(i, v, 9 if i == 0 else lab) for i, v, lab in rows]).collect()
    assert [tuple(r) for r in got] == [(0, 0, 1, 1, 65536, 32768)] * 2


def test_hard_negatives_of_large_components(spark):
    """Components beyond small integers, and beyond all that sums in doubles hold."""
    for size in (1e3, 1e6, 1e12):
        pick = random.Random(1)
        rows = [(i, [pick.uniform(-1, 1) * size for _ in range(6)], i % 3) for i in range(240)]
        got, want = ordered(negatives(spark, rows, "vec_id long, embedding array<double>, label int").collect()), ordered(plain_negatives(rows))
        if size < 1e12:
            assert got == want
        else:
            assert all(r[4] <= 2 ** 63 - 1 for r in got)


def test_bounds_hold_scores():
    pick = np.random.default_rng(2)
    for width in (1, 3, 8, 64):
        x = np.floor(pick.normal(size=(40, width)) * 300 + pick.normal(size=(40, 1)) * 500)
        side = hard_negatives.Side(np.arange(40), np.arange(40), np.zeros(40, bool), np.zeros(40), x,
                                   hard_negatives.summaries(x).astype(np.float32), np.sqrt((x * x).sum(1)).astype(np.float32))
        exact, last = x @ x.T, np.inf
        for level in range(len(hard_negatives.SEGMENTS)):
            low, high = hard_negatives.bounds(side, side, level, width)
            assert (low <= exact).all() and (exact <= high).all()
            assert (high - low).mean() <= last + 1e-6
            last = (high - low).mean()


def test_planes_give_exact_products():
    pick = np.random.default_rng(4)
    for top in (2, 2 ** 11, 2 ** 40, 2 ** 63):
        x = pick.integers(0, top, size=(131, 5), dtype=np.uint64, endpoint=False)
        x[:, 2] = 0
        sums, products = whitening.cross_products(x)
        plain = np.array([[int(v) for v in line] for line in x], object)
        assert sums.tolist() == plain.sum(axis=0).tolist()
        assert products.tolist() == (plain.T @ plain).tolist()


def plain_whitened(rows, components=8):
    kept = usable(rows, with_label=False)
    width = max((len(v) for _, v, _ in kept), default=0)
    x = np.array([[math.floor(1024 * c) + 100_000 for c in v + [0.0] * (width - len(v))] for _, v, _ in kept], object)
    n, sums = len(x), x.sum(axis=0)
    z = n * x - sums
    covariance = np.array([[int(v) / n ** 3 for v in line] for line in (z.T @ z)])
    values, axes = np.linalg.eigh(covariance)
    order = np.argsort(-values)[:components]
    scores = (z.astype(float) / n) @ axes[:, order] / np.sqrt(values[order])
    return [i for i, _, _ in kept], n, [sum(int(c) ** 2 for c in line) for line in z], scores, values[order] / values.sum()


def whitened(spark, rows, schema=SCHEMA):
    frame = spark.createDataFrame(rows, schema).repartition(3).withColumns({c: F.lit(c) for c in ("v", "c", "component", "n", "whitened")})
    return whitening.whiten(frame)


@pytest.mark.parametrize("batch", [whitening.PLANE_ROWS, 64])
def test_whitening_beside_plain_code(spark, monkeypatch, batch):
    monkeypatch.setattr(whitening, "PLANE_ROWS", batch)
    rows = vectors()
    ids, n, deviation, scores, shares = plain_whitened(rows)
    got = {(r.vec_id, r.component): r for r in whitened(spark, rows).collect()}
    assert len(got) == 8 * len(ids)
    for k in range(8):
        own = np.array([got[i, k + 1].whitened for i in ids])
        assert min(abs(own - scores[:, k]).max(), abs(own + scores[:, k]).max()) < 1e-9
        assert abs(got[ids[0], k + 1].explained - shares[k]) < 1e-9
    assert [got[i, 1].deviation for i in ids] == deviation
    assert {r.n for r in got.values()} == {n} and max(r.identity_error for r in got.values()) < 1e-9


def test_whitening_on_edges(spark):
    assert whitened(spark, []).collect() == []
    assert whitened(spark, [(1, None, 1), (2, [], 1)]).collect() == []
    same = whitened(spark, [(1, [0.5, 0.25], None), (2, [0.5, 0.25], 1)]).collect()
    assert {(r.vec_id, r.component, r.whitened, r.explained, r.identity_error, r.deviation) for r in same} == {
        (i, k, None, 0.0, None, 0) for i in (1, 2) for k in (1, 2)}
    line = whitened(spark, [(1, [0.0, 0.0], 1), (1, [1.0, 1.0], 1), (None, [2.0, 2.0], 1)]).collect()
    assert sorted(abs(r.whitened) for r in line if r.component == 1) == pytest.approx([0, math.sqrt(1.5), math.sqrt(1.5)])
    assert all(r.whitened is None and r.explained == 0 for r in line if r.component == 2)
    assert {r.identity_error < 1e-9 for r in line} == {True}


def test_whitening_of_wide_components(spark):
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())), T.StructField("label", T.IntegerType())])
    pick = random.Random(5)
    rows = [(i, [pick.uniform(-1, 1) * 1e12, pick.uniform(-1, 1)], 0) for i in range(90)]
    _, _, deviation, scores, _ = plain_whitened(rows)
    got = {(r.vec_id, r.component): r for r in whitened(spark, rows, schema).collect()}
    assert [got[i, 1].deviation_text for i in range(90)] == [str(d) for d in deviation]
    assert [got[i, 1].deviation for i in range(90)] == [d if d < 2 ** 63 else None for d in deviation]
    own = np.array([got[i, 1].whitened for i in range(90)])
    assert min(abs(own - scores[:, 0]).max(), abs(own + scores[:, 0]).max()) < 1e-9
