import math
import zlib
from collections import Counter, defaultdict

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from small import corpus, documents, edges, words_of

from meterglass.llm import mixing, sharding


def has_python(frame):
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return any(x in plan for x in ("Python", "Pandas", "Arrow"))


@pytest.mark.parametrize("rows", [corpus(n=200), edges(), []], ids=["corpus", "edges", "empty"])
def test_mixed_stream(spark, rows):
    options = {"target_entropy": 0.9, "max_repeats": None, "blocks": 8}
    shown = mixing.mix_sources(documents(spark, rows), **options)
    assert not has_python(shown)
    got = shown.collect()
    tokens = Counter()
    for r in rows:
        tokens[r[3]] += max(1, len(words_of(r[1])))
    whole = sum(tokens.values())
    weights = {r.source: r.weight for r in got}
    if not rows:
        assert got == []
        return
    # A plain bisection over the same shares.
    shares = {s: t / whole for s, t in tokens.items()}

    def at(a):
        z = sum(p ** a for p in shares.values())
        return {s: p ** a / z for s, p in shares.items()}

    def entropy(a):
        return -sum(w * math.log(w) for w in at(a).values())

    low, high = 0.0, 1.0
    if entropy(1.0) < 0.9 * math.log(len(shares)):
        for _ in range(60):
            middle = (low + high) / 2
            low, high = (middle, high) if entropy(middle) > 0.9 * math.log(len(shares)) else (low, middle)
    plain = at(high)
    for s, w in weights.items():
        assert w == pytest.approx(plain[s], rel=1e-6)
    per_source = Counter()
    for r in got:
        per_source[r.source] += r.n_tokens
    longest = max(max(1, len(words_of(r[1]))) for r in rows)
    for s, t in per_source.items():
        assert abs(t - plain[s] * whole) <= longest + 1
    # Whole permutations first: a document's appearances differ by at most one within a source.
    if rows[0][0] == 0:
        times = defaultdict(Counter)
        for r in rows:
            times[r[3]][r[0]] = 0
        for r in got:
            times[r.source][r.doc_id] += 1
            assert 0 <= r.block < 8
        assert all(max(c.values()) - min(c.values()) <= 1 for c in times.values())


def test_repetition_limit(spark):
    shares = spark.createDataFrame([("a", 1000), ("b", 100), ("c", 10)], "source string, tokens long")
    got = {r.source: r for r in mixing.source_weights(shares, None, 2.0).collect()}
    assert got["c"].weight * 1110 / 10 == pytest.approx(2.0, rel=1e-6)
    assert sum(r.weight for r in got.values()) == pytest.approx(1)


def test_limits_that_nothing_meets_leave_the_shares(spark):
    shares = spark.createDataFrame([("a", 100), ("b", 100), ("c", 101)], "source string, tokens long")
    got = {r.source: r for r in mixing.source_weights(shares, 0.95).collect()}
    assert all(r.exponent == 1 and r.weight == pytest.approx(r.tokens / 301) for r in got.values())


def test_mixed_is_in_stream_order(spark, tmp_path):
    docs = documents(spark, corpus(n=200), clashes=False)
    stream = [r.doc_id for r in mixing.mix_sources(docs, blocks=8).orderBy("block", "block_key", "doc_id", "epoch").collect()]
    mixing.mixed(docs, blocks=8).write.parquet(str(tmp_path / "out"))
    files = sorted((tmp_path / "out").glob("*.parquet"))
    assert [i for f in files for i in pq.read_table(f).column("doc_id").to_pylist()] == stream != sorted(stream)


def test_small_sources_repeat_up_to_the_limit(spark):
    rows = [(i, "a b c d", "en", "big", 7) for i in range(200)] + [(1000, "a b c d", "en", "small", 7)]
    times = Counter(r.source for r in mixing.mix_sources(documents(spark, rows)).collect())
    assert times["small"] == 4 and abs(times["big"] - 197) <= 1


def test_mixed_keeps_columns(spark):
    docs = documents(spark, edges())
    assert mixing.mixed(docs).columns == docs.columns
    assert mixing.mixed(docs).count() == mixing.mix_sources(docs).count()


def plain_hilbert(point, bits):
    """Number of a cell, by walking down the octants with the curve's turns."""
    x, n = list(point), len(point)
    q = 1 << (bits - 1)
    while q > 1:
        for i in range(n):
            if x[i] & q:
                x[0] ^= q - 1
            else:
                t = (x[0] ^ x[i]) & (q - 1)
                x[0] ^= t
                x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t, q = 0, 1 << (bits - 1)
    while q > 1:
        if x[-1] & q:
            t ^= q - 1
        q >>= 1
    out = 0
    for bit in range(bits - 1, -1, -1):
        for v in x:
            out = out << 1 | (v ^ t) >> bit & 1
    return out


def test_hilbert_curve(spark):
    bits = 3
    low = (1 << bits) - 1
    cells = spark.range(1 << 3 * bits).withColumn("id", F.col("id").cast("int"))
    axes = [F.shiftright("id", 2 * bits), F.shiftright("id", bits).bitwiseAND(low), F.col("id").bitwiseAND(low)]
    got = {tuple(r[:3]): r[3] for r in cells.select(*axes, sharding.hilbert_index(axes, bits)).collect()}
    assert sorted(got.values()) == list(range(1 << 3 * bits))
    order = sorted(got, key=got.get)
    assert all(sum(abs(a - b) for a, b in zip(p, q)) == 1 for p, q in zip(order, order[1:]))
    assert all(plain_hilbert(p, bits) == v for p, v in got.items())


@pytest.mark.parametrize("rows", [corpus(n=400), edges(), []], ids=["corpus", "edges", "empty"])
def test_shards(spark, rows):
    frame = sharding.hilbert_shards(documents(spark, rows), shards=5)
    assert not has_python(frame)
    got = frame.collect()
    assert len(got) == len(rows)
    size = {(r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows}
    assert {(r.doc_id, r["size"], r.text_crc32) for r in got} == size
    by_shard = defaultdict(list)
    for r in got:
        by_shard[r.shard].append(r)
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < 5
    total, longest = sum(r["size"] for r in got), max([r["size"] for r in got], default=0)
    for rs in by_shard.values():
        assert sorted(r.slot for r in rs) == list(range(len(rs)))
        assert abs(sum(r["size"] for r in rs) - total / 5) <= longest + 1
        curve = [r.curve for r in sorted(rs, key=lambda r: r.slot)]
        assert curve == sorted(curve)
    runs = [[r.curve for r in by_shard[s]] for s in sorted(by_shard)]
    assert all(max(a) <= min(b) for a, b in zip(runs, runs[1:]))


def test_written_shards(spark, tmp_path):
    docs = documents(spark, corpus(), clashes=False)
    sharding.write_shards(docs, str(tmp_path / "out"), shards=3)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 60


def test_written_shards_hold_null_and_repeated_ids(spark, tmp_path):
    rows = edges()
    sharding.write_shards(documents(spark, rows), str(tmp_path / "out"), shards=3)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(repr, (tuple(r) for r in got.select("doc_id", "text", "lang", "source", "n_chars").collect()))) == sorted(map(repr, rows))


def test_equal_texts_share_a_shard_if_no_longer_than_the_longest_row(spark):
    rows = corpus(n=400) + [(1000 + i, "many " * 40, "en", "src%d" % (i % 5), 200) for i in range(60)]
    got = sharding.hilbert_shards(documents(spark, rows), shards=5).collect()
    longest, groups = max(r["size"] for r in got), defaultdict(list)
    text = {r[0]: r[1] for r in rows}
    for r in got:
        groups[text[r.doc_id]].append(r)
    together = [rs for rs in groups.values() if len(rs) > 1 and sum(r["size"] for r in rs) <= longest]
    assert len(together) > 10
    assert all(len({(r.shard, r.curve) for r in rs}) == 1 for rs in together)
    assert len({r.shard for r in groups["many " * 40]}) > 1


def test_levels_hold_equal_rows_and_shards_prune(spark):
    """Twenty names with one beginning, one of them with a third of the rows: each has a level, and a shard few of them."""
    names = ["common-crawl/%02d" % (0 if i % 3 == 0 else i % 19 + 1) for i in range(3000)]
    rows = [(i, "x" * (i * 7 % 50), "en", name, 1) for i, name in enumerate(names)]
    docs = documents(spark, rows, clashes=False)
    number = sharding.text_number("source", min(names), max(names))
    between = docs.agg(sharding.cuts(number, 5)).first()[0]
    level = docs.select("source", sharding.level(number, between).alias("level")).distinct().collect()
    assert len(level) == 20 and len({r.level for r in level}) == 20
    held = defaultdict(set)
    for r in sharding.hilbert_shards(docs).collect():
        held[r.shard].add(r.source)
    assert sum(len(v) for v in held.values()) / len(held) < 8
