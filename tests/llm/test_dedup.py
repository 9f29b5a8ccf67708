import hashlib
import random
from collections import defaultdict

import pytest
from small import corpus, documents, edges, lowered, rows_of, words_of

from meterglass.llm import exact_dedup, ngram_join, substring_dedup
from meterglass.llm.components import components


def same(got, expected):
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(got, key=key) == sorted(expected, key=key)


@pytest.mark.parametrize("rows", [corpus(), edges(), []], ids=["corpus", "edges", "empty"])
@pytest.mark.parametrize("primes", [exact_dedup.PRIMES, (3, 5)], ids=["strong", "colliding"])
def test_exact_groups(spark, rows, primes):
    got = rows_of(exact_dedup.exact_groups(documents(spark, rows), primes=primes, huge_bytes=100_000),
                  "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    groups = defaultdict(list)
    for r in rows:
        groups[r[1] or ""].append(r[0])
    expected = []
    for text, ids in groups.items():
        keep = max(ids, key=lambda i: (i is not None, i or 0))
        kept = False
        for i in ids:
            first = i == keep and not kept
            kept = kept or first
            expected.append((i, keep, len(ids), first, hashlib.sha256(text.encode()).hexdigest()))
    same(got, expected)


def test_fingerprints_compose():
    data = bytes(range(256)) * 1500
    for p, b in zip(exact_dedup.PRIMES, exact_dedup.BASES):
        whole = sum((x + 1) * pow(b, len(data) - 1 - i, p) for i, x in enumerate(data[:3000])) if False else None
        left, right = (exact_dedup.text_fingerprint(d, p, b) for d in (data[:100_001], data[100_001:]))
        assert exact_dedup.combine(left, right, len(data) - 100_001, p, b) == exact_dedup.text_fingerprint(data, p, b)
        plain = 0
        for x in data[:3000]:
            plain = (plain * b + x + 1) % p
        assert plain == exact_dedup.text_fingerprint(data[:3000], p, b) and whole is None


def test_without_copies_keeps_columns(spark):
    docs = documents(spark, edges())
    left = exact_dedup.without_copies(docs)
    assert left.columns == docs.columns
    assert left.count() == len({r[1] or "" for r in edges()})


def plain_removed(rows, length):
    seen = defaultdict(int)
    all_words = [words_of(r[1]) for r in rows]
    for ws in all_words:
        for i in range(len(ws) - length + 1):
            seen[tuple(ws[i:i + length])] += 1
    for r, ws in zip(rows, all_words):
        gone = {j for i in range(len(ws) - length + 1) if seen[tuple(ws[i:i + length])] > 1 for j in range(i, i + length)}
        kept = " ".join(w for i, w in enumerate(ws) if i not in gone)
        yield r[0], len(ws), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept


@pytest.mark.parametrize("rows,length,base", [(corpus(), 35, None), (corpus(2), 7, 1), (corpus(3), 20, 5), (edges(), 35, 9), ([], 35, None)])
def test_substring_dedup(spark, rows, length, base):
    got = substring_dedup.remove_repeats(documents(spark, rows), length=length, base=base, with_text=True)
    same(rows_of(got, "doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"), list(plain_removed(rows, length)))


def test_lengths_double():
    assert substring_dedup.lengths(35) == [18, 35]
    assert substring_dedup.lengths(35, 9) == [9, 18, 35]
    assert substring_dedup.lengths(1) == [1]


def plain_components(rows, n, percent):
    sets = []
    for r in rows:
        ws = words_of(lowered(r[1]))
        sets.append({tuple(ws[i:i + n]) for i in range(len(ws) - n + 1)} if len(ws) >= n else {("whole", *ws)} if ws else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)].append(r[0])
    return [(r[0], len(s), min(least[find(i)], default=None) if s else r[0]) for i, (r, s) in enumerate(zip(rows, sets))]


@pytest.mark.parametrize("rows,n,percent,group", [
    (corpus(), 4, 85, 512), (corpus(4, 90), 2, 40, 2), (corpus(5, 90), 1, 30, 4), (edges(), 4, 85, 512), ([], 4, 85, 512)])
def test_jaccard_components(spark, rows, n, percent, group):
    got = ngram_join.jaccard_components(documents(spark, rows), n=n, percent=percent, group_classes=group)
    same(rows_of(got, "doc_id", "n_shingles", "component_id"), plain_components(rows, n, percent))


def near_copies():
    """Copies of one text with edits of their own: the base links most, others are too far from it and from each other."""
    pick = random.Random(8)
    base = ["w%d" % i for i in range(80)]
    out = [(0, " ".join(base), "en", "a", 0)]
    for i in range(1, 150):
        words = base[:]
        for j in pick.sample(range(80), pick.choice((1, 1, 2, 3))):
            words[j] = "e%d" % pick.randrange(40)
        out.append((i, " ".join(words), "en", "a", i))
    return out


def chained_passages():
    """Texts of eight passages, each passage in about three texts: one chain of regions, and no two texts linked."""
    pick = random.Random(9)
    passages = [" ".join("p%d.%d" % (i, j) for j in range(30)) for i in range(400)]
    return [(i, "\n".join(pick.sample(passages, 8)), "en", "a", i) for i in range(150)]


@pytest.mark.parametrize("rows,percent", [(near_copies(), 85), (chained_passages(), 40)], ids=["near", "chained"])
def test_large_groups_move_no_copies_of_sets(spark, monkeypatch, rows, percent):
    moved, kept = [], ngram_join.stored

    def counted(frame, name):
        out = kept(frame, name)
        if "grams" in out.columns:
            moved.append(out.count())
        return out

    monkeypatch.setattr(ngram_join, "stored", counted)
    got = ngram_join.jaccard_components(documents(spark, rows), n=4, percent=percent, group_classes=8)
    same(rows_of(got, "doc_id", "n_shingles", "component_id"), plain_components(rows, 4, percent))
    assert sum(moved) <= 3 * len(rows)


def test_components(spark):
    links = [(1, 2), (3, 2), (4, 5), (9, 9)] + [(100 + i, 101 + i) for i in range(40)]
    got = rows_of(components(spark.createDataFrame(links, "a long, b long")), "node", "label")
    assert got == [(1, 1), (2, 1), (3, 1), (4, 4), (5, 4)] + [(100 + i, 100) for i in range(41)]
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_copies_go(spark):
    docs = documents(spark, corpus())
    left = ngram_join.without_near_copies(docs)
    assert left.columns == docs.columns
    expected = {i for i, n, c in plain_components(corpus(), 5, 80) if n == 0 or i == c}
    assert {r.doc_id for r in left.collect()} == expected
