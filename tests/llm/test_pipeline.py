import math
from collections import Counter

import corpus_pipeline
import public_tokenizers
from small import CLASHES, corpus, documents, edges, words_of
from tokenizers import Tokenizer

from meterglass.llm.common import stored
from test_dedup import plain_components
from test_text_models import plain_kept


def plain_weights(tokens, target=0.95, repeats=4.0):
    """By the smallest exponent, on a fine grid, with which both limits hold; 1 if none does."""
    whole = sum(tokens.values())
    shares = {s: t / whole for s, t in tokens.items()}
    for step in range(20_001):
        powers = {s: p ** (step / 20_000) for s, p in shares.items()}
        weights = {s: p / sum(powers.values()) for s, p in powers.items()}
        entropy = -sum(w * math.log(w) for w in weights.values())
        if entropy <= target * math.log(len(shares)) and max(weights[s] / shares[s] for s in shares) <= repeats:
            break
    return weights


def prose(n=80):
    """Longer texts than the rules ask for."""
    return [(i, " ".join([t, f"unique{i}"] * 3 if i % 7 == 0 else [t, t[::-1], f"end{i % 3}"]), lang, source, c) for i, t, lang, source, c in corpus(9, n)]


def test_stages_against_plain_code(spark):
    rows = prose()
    docs = documents(spark, rows)
    kept = {i for i, is_kept in plain_kept(rows, 256) if is_kept}
    assert kept
    stage = dict(corpus_pipeline.STAGES)
    out = stored(stage["quality"](spark, docs, ""), "t")
    assert out.columns == docs.columns and {r.doc_id for r in out.collect()} == kept
    by_text = {}
    for r in rows:
        if r[0] in kept:
            by_text[r[1]] = max(by_text.get(r[1], -1), r[0])
    out = stored(stage["exact_dedup"](spark, out, ""), "t")
    assert sorted(r.doc_id for r in out.collect()) == sorted(by_text.values())
    left = [r for r in rows if r[0] in set(by_text.values())]
    out = stored(stage["near_duplicates"](spark, out, ""), "t")
    one = sorted(i for i, n, c in plain_components(left, 5, 80) if n == 0 or i == c)
    assert sorted(r.doc_id for r in out.collect()) == one
    by_id = {r[0]: r for r in left if r[0] in set(one)}
    out = stored(stage["mixing"](spark, out, ""), "t")
    shown = out.collect()
    assert out.columns == docs.columns and all(tuple(r)[:5] == by_id[r.doc_id] for r in shown)
    # Quotas are filled to within the longest text; a document appears as often as the others of its source, or once more or less.
    size = {i: max(1, len(words_of(r[1]))) for i, r in by_id.items()}
    tokens, mixed, times = Counter(), Counter(), {}
    for i, r in by_id.items():
        tokens[r[3]] += size[i]
        times.setdefault(r[3], Counter())[i] = 0
    for r in shown:
        mixed[r.source] += size[r.doc_id]
        times[r.source][r.doc_id] += 1
    for source, weight in plain_weights(tokens).items():
        assert abs(mixed[source] - weight * sum(tokens.values())) <= max(size.values()) + 1
        assert max(times[source].values()) - min(times[source].values()) <= 1
    final = stage["encoding"](spark, out, "").collect()
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = Counter((r.doc_id, *library.encode(r.text, add_special_tokens=False).ids) for r in shown)
    assert Counter((r.doc_id, *r.ids) for r in final) == expected and all(len(r.ids) == r.n_tokens for r in final)


def test_stages_on_edges(spark):
    for rows in (edges(), []):
        docs = documents(spark, rows)
        for _, stage in corpus_pipeline.STAGES[1:4]:
            out = stage(spark, docs, "")
            assert out.columns == docs.columns
            assert out.count() <= 5 * len(rows)
        assert corpus_pipeline.STAGES[0][1](spark, docs, "").columns == docs.columns
        assert corpus_pipeline.STAGES[4][1](spark, docs, "").count() == len(rows)
    assert len(CLASHES) > 10


def test_registered(spark):
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names and all(any(k.startswith(f"op{n}_") for k in names) for n in range(1, 11))
