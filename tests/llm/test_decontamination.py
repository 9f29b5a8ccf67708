"""Winnowing beside plain code."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F
from small import CLASHES, documents, edges, lowered

from meterglass.llm import decontamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall(lowered(text))


def plain(docs, items, span=10):
    wanted = {}
    for item, text in items:
        words = words_of(text)
        n = min(len(words), span)
        for i in range(len(words) - n + 1 if n else 0):
            wanted.setdefault(tuple(words[i:i + n]), set()).add(item)
    out = []
    for doc_id, text, *_ in docs:
        words = words_of(text)
        hit, found = set(), set()
        for n in {len(w) for w in wanted}:
            for i in range(len(words) - n + 1):
                met = wanted.get(tuple(words[i:i + n]))
                if met:
                    hit.update(range(i, i + n))
                    found |= met
        ids = sorted(str(i) for i in found if i is not None)
        out.append((doc_id, len(words), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def benchmark(spark, items):
    return spark.createDataFrame(items, "item_id long, text string").repartition(2).withColumns({c: F.lit(c) for c in CLASHES})


def found(spark, docs, items, **options):
    rows, _ = decontamination.decontaminate(documents(spark, docs), benchmark(spark, items), **options)
    return sorted((tuple(r)[:6] for r in rows.collect()), key=str)


def leaky(seed, n=150, vocabulary=12, size=80):
    """Few distinct words, so that spans of all lengths are shared by chance; items cut from texts, with edits at their edges."""
    pick = random.Random(seed)
    known = ["Ab", "cd", "É", "é", "x1", "σς", "Σ", "straße", "ab", "K", "K", "İz"][:vocabulary] + ["w%d" % i for i in range(max(0, vocabulary - 12))]
    docs = []
    for i in range(n):
        text = "".join(pick.choice(known) + pick.choice((" ", ". ", "\n", "-", "__", "  ")) for _ in range(pick.randint(0, size)))
        docs.append((i, text if i % 11 else docs[-1][1] if docs else "", "en", "a", len(text)))
    items = []
    for i in range(40):
        words = re.split(r"[^\w]+", pick.choice(docs)[1])
        at = pick.randrange(max(1, len(words) - 20))
        body = words[at:at + pick.choice((1, 3, 7, 8, 9, 10, 11, 14, 25))]
        items.append((i % 37, " ".join(["edge", *body, "brink"][i % 2:len(body) + 2 - i % 3 % 2])))
    return docs, items


@pytest.mark.parametrize("seed,vocabulary", [(1, 12), (2, 40), (3, 400)])
def test_beside_plain_code(spark, seed, vocabulary):
    docs, items = leaky(seed, vocabulary=vocabulary)
    want = plain(docs, items)
    assert any(r[5] for r in want)
    assert found(spark, docs, items) == want


@pytest.mark.parametrize("span,gram", [(10, 3), (10, 10), (6, 4), (4, 1)])
def test_other_spans_and_grams(spark, span, gram):
    docs, items = leaky(7, n=60, vocabulary=60)
    items = [i for i in items if len(words_of(i[1])) >= span]
    assert found(spark, docs, items, span=span, gram=gram) == plain(docs, items, span)


def test_on_edges(spark):
    items = [(1, None), (2, ""), (3, "..."), (4, "one"), (None, "four <|endoftext|> five"), (5, " ".join("w%d" % i for i in range(4990, 5010))),
             (5, "three"), (6, " ".join("w%d" % (i % 5000) for i in range(4995, 5010)))]
    assert found(spark, edges(), items) == plain(edges(), items)
    assert found(spark, edges(), []) == plain(edges(), [])
    assert found(spark, [], items) == []


def test_a_passage_of_many_items_and_documents(spark):
    """A third of the documents are copies, and a third of the items share the passage: no row for each pair is written."""
    pick = random.Random(9)
    passage = " ".join("p%d" % i for i in range(12))
    docs = [(i, passage + (" tail%d" % (i % 4) if i % 3 else " tail"), "en", "a", 0) for i in range(300)]
    items = [(i, (passage if i % 3 == 0 else " ".join("q%d" % pick.randrange(10 ** 6) for _ in range(12))) + " i%d" % i) for i in range(90)]
    rows, spans = decontamination.decontaminate(documents(spark, docs), benchmark(spark, items))
    assert sorted((tuple(r)[:6] for r in rows.collect()), key=str) == plain(docs, items)
    assert spans.count() < 5 * 30 * 6


def test_native_plan(spark):
    rows, spans = decontamination.decontaminate(documents(spark, leaky(1)[0]), benchmark(spark, leaky(1)[1]))
    for frame in (rows, spans):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_spans_are_the_words(spark):
    docs, items = leaky(3, vocabulary=400)
    rows, spans = decontamination.decontaminate(documents(spark, docs), benchmark(spark, items))
    texts = {hashlib.sha256((t or "").encode()).hexdigest(): words_of(t) for _, t, *_ in docs}
    benched = [" %s " % " ".join(words_of(t)) for _, t in items]
    for span in spans.collect():
        words = " %s " % " ".join(texts[span.text_sha256][span.start:span.end])
        assert any(words in b for b in benched)
