import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from small import corpus, documents, edges, lowered, rows_of, words_of
from tokenizers import Tokenizer

from meterglass.llm import bpe, lm, quality, toxicity


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.mark.parametrize("rows", [corpus(), edges(), []], ids=["corpus", "edges", "empty"])
def test_encoding_is_the_library_s(spark, library, rows):
    got = bpe.encode_texts(documents(spark, rows), with_ids=True).collect()
    expected = []
    for r in rows:
        ids = library.encode(r[1] or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        expected.append((r[0], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest(), ids))
    key = lambda r: tuple(str(x) for x in r[:3])
    assert sorted((tuple(r) for r in got), key=key) == sorted(expected, key=key)


def test_joins_are_repaired(library, monkeypatch):
    """Many small chunks, cut inside words, marks, special tokens and runs of blanks."""
    monkeypatch.setattr(bpe, "MEAN_BYTES", 8)
    monkeypatch.setattr(bpe, "LARGEST_BYTES", 24)
    pick = random.Random(3)
    parts = ["alpha", " beta", "  ", "\n\n", "'s", "'re", "<|endoftext|>", "é", "漢字仮名", "123", " 45", "!!", " ...", " ", "\U0001f600", "x y", "<|end"]
    codec = bpe.Encoder(public_tokenizers.path(bpe.VOCABULARY), public_tokenizers.PATTERN, bpe.SPECIAL)
    for _ in range(300):
        text = "".join(pick.choice(parts) for _ in range(pick.randint(0, 60)))
        found = list(codec.text(text.encode()))
        ids = np.frombuffer(b"".join(p[1] for p in found), "<u4").tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids
        assert b"".join(p[2] for p in found).decode() == text
    assert codec.reused > 0


def plain_lm(rows, folds=7, held=2):
    tokens = [words_of(lowered(r[1])) + [None] for r in rows]
    train = [r[0] is None or zlib.crc32(str(r[0]).encode()) % folds != held for r in rows]
    counts = Counter(t for ts, use in zip(tokens, train) if use for t in ts)
    n, v = sum(counts.values()), len(counts)
    for r, ts, use in zip(rows, tokens, train):
        yield r[0], not use, len(ts), sum(counts[t] > 0 for t in ts), n, sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in ts)


@pytest.mark.parametrize("rows", [corpus(), edges(), []], ids=["corpus", "edges", "empty"])
def test_lm_base(spark, rows):
    got = lm.lm_scores(documents(spark, rows)).collect()
    key = lambda r: tuple(str(x) for x in r[:5])
    expected = sorted(plain_lm(rows), key=key)
    assert len(got) == len(expected)
    for g, e in zip(sorted((tuple(r) for r in got), key=key), expected):
        assert g[:5] == e[:5] and g[5] == pytest.approx(e[5]) and g[6] < 0


def test_lm_learns_context(spark):
    """Words that follow one another: the model beats counting on held-out texts."""
    pick = random.Random(5)
    rows = [(i, " ".join(f"{a} {a}x" for a in (pick.choice("abcdefgh") for _ in range(80))), "en", "s", 1) for i in range(200)]
    got = [r for r in lm.lm_scores(documents(spark, rows), rounds=2).collect() if r.held_out]
    assert sum(r.score for r in got) > 0.7 * sum(r.base_score for r in got)


def lm_model(bits=12, seed=0):
    pick = np.random.default_rng(seed)
    return lm.Model((np.array([lm.END]), np.array([0])), pick.normal(size=(1 + lm.WIDTH, lm.WIDTH)).astype(np.float32), None, None,
                    pick.normal(size=(1 << bits, lm.WIDTH)).astype(np.float32))


def test_lm_member_probabilities_sum_to_one():
    tokens, model = lm.Tokens(["a b c a", "", None]), lm_model()
    model.weights *= 40
    every = [model.member_logs(tokens, np.full(len(tokens.hashes), m)) for m in range(lm.MEMBERS)]
    assert np.allclose(np.exp(every).sum(axis=0), 1, atol=1e-5)


@pytest.mark.parametrize("bits", [12, 18])
def test_lm_gradient_step_is_the_plain_one(bits):
    """One batch: both softmaxes of each token, gaps summed by slot, each feature's step after that of the one before."""
    model = lm_model(bits)
    model.weights *= 0.1
    tokens = lm.Tokens(["a b a b a c", "b a b", None])
    members = tokens.members(model.top)
    weights, squares = model.weights.copy(), np.full(1 << bits, 0.5, np.float32)
    assert lm.learned(model, weights, squares, tokens) == len(members) == 12

    every, expected, seen = model.choices(tokens, members), model.weights.astype(float), np.full(1 << bits, 0.5)
    gaps = []
    for choice in range(2):
        for t, m in enumerate(members):
            taken, row = (m // lm.WIDTH, 0) if choice == 0 else (m % lm.WIDTH, 1 + m // lm.WIDTH)
            energy = model.bias[row].astype(float) + sum(expected[every.slots[f, choice, t]] for f in range(lm.FEATURES))
            odds = np.exp(energy - energy.max())
            gap = -odds / odds.sum()
            gap[taken] += 1
            gaps.append(gap)
    for f in range(lm.FEATURES):
        sums = {}
        for slot, gap in zip(every.slots[f].ravel().tolist(), gaps):
            sums[slot] = sums.get(slot, 0) + gap
        for slot, total in sums.items():
            seen[slot] += total @ total
            expected[slot] += lm.RATE * total / np.sqrt(seen[slot] + 1)
    assert np.allclose(weights, expected, atol=1e-5) and np.allclose(squares, seen, atol=1e-5)


def test_lm_grows_with_the_corpus():
    assert [lm.slot_bits(n) for n in (0, 1, 10 ** 6, 10 ** 9)] == [12, 12, 14, 17]


def plain_rules(text):
    ws = words_of(text)
    places = {}
    for i in range(len(ws) - 2):
        places.setdefault(tuple(ws[i:i + 3]), []).append(i)
    repeated = {j for at in places.values() if len(at) > 1 for i in at for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if words_of(x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    failed = len(ws) < 50 or 100 * len(repeated) > 50 * len(ws)
    return len(ws), sum(map(len, ws)), symbols, len(lines) - len(set(lines)), len(repeated), failed


@pytest.mark.parametrize("rows", [corpus(), edges(), []], ids=["corpus", "edges", "empty"])
def test_quality_base(spark, rows):
    got = rows_of(quality.quality(documents(spark, rows)), "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(got, key=key) == sorted(((r[0], *plain_rules(r[1])) for r in rows), key=key)


def plain_distance(p, q):
    m = [(a + b) / 2 for a, b in zip(p, q)]
    kl = lambda x: sum(a * math.log2(a / b) for a, b in zip(x, m) if a > 0)
    return math.sqrt((kl(p) + kl(q)) / 2)


def test_distance():
    p, q = np.array([2, 0, 6]), np.array([.5, .25, .25])
    assert quality.distance(p[None], q)[0] == pytest.approx(plain_distance([.25, 0, .75], q))
    assert quality.distance(np.zeros((1, 3)), q)[0] == 0


def test_junk_goes_and_prose_stays(spark, sf_dir):
    # References need more texts than the smallest tables hold of each language.
    docs, labels = (spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.01')}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.quality(docs).join(labels, "doc_id").where("NOT base_failed").collect()
    assert all(r.kept for r in got if r.quality == 1)
    junk = [r.kept for r in got if r.quality == 0]
    assert sum(junk) <= 0.1 * len(junk)


def prose(pick, vocabulary, n, weights=None):
    """Words by Zipf's law."""
    return " ".join(pick.choices(vocabulary, weights or [1 / (i + 1) for i in range(len(vocabulary))], k=n))


def vocabulary(pick, n=2000):
    return ["".join(pick.choices("abcdefghijklmnopqrstuvwxyz", k=pick.randint(2, 8))) for _ in range(n)]


@pytest.mark.parametrize("tiny", [[], [(900, "hello new world", None, "s", 1)], [(900, "abc " * 40 + "abc def" * 40, "xx", "s", 1)]], ids=["none", "null", "xx"])
def test_tiny_tags_are_no_references(spark, tiny):
    pick = random.Random(8)
    words = vocabulary(pick)
    rows = [(i, prose(pick, words, 200), "en", "s", 1) for i in range(80)]
    # Nothing but a few of the common words, which the word rule is for; tagged like the rest, like the tiny tag, or not.
    junk = [(100 + i, " ".join(pick.choices(words[20:40], k=300)), lang, "s", 1) for i, lang in enumerate(("en", "xx", None))]
    got = {r.doc_id: r for r in quality.quality(documents(spark, rows + junk + tiny)).collect()}
    assert all(got[r[0]].kept for r in rows)
    assert not any(got[r[0]].base_failed or got[r[0]].kept for r in junk)


def test_a_tag_without_common_words_judges_its_own(spark):
    """A script without blanks has no list of common words; its documents go by their classes, others by other languages."""
    pick = random.Random(9)
    words = vocabulary(pick)
    rows = [(i, prose(pick, words, 200), "en", "s", 1) for i in range(80)]
    rows += [(200 + i, " ".join("".join(pick.choices("漢字仮名交文章語言学習", k=12)) for _ in range(150)), "ja", "s", 1) for i in range(80)]
    junk = [(400, " ".join(pick.choices(words[20:40], k=300)), "ja", "s", 1)]
    got = {r.doc_id: r for r in quality.quality(documents(spark, rows + junk)).collect()}
    assert all(got[r[0]].kept for r in rows) and not got[400].kept


@pytest.mark.parametrize("lengths, weights", [
    # The common words are 40 % of all, about as in real text; flatter ones tell longer texts only.
    ((50, 65, 100, 300, 1000, 2000), [0.4 / 3.75 / (i + 2) for i in range(64)] + [0.6 / 1936] * 1936),
    ((300, 1000, 2000), [1 / (i + 10) for i in range(2000)])], ids=["real", "flat"])
def test_gibberish_goes_at_any_length_and_short_prose_stays(spark, lengths, weights):
    pick = random.Random(10)
    words = vocabulary(pick)
    rows = [(i, prose(pick, words, n, weights), "en", "s", 1) for i, n in enumerate([200] * 160 + list(range(50, 110)))]
    odd = [(1000 + i, " ".join("".join(pick.choices("abcdefghijklmnopqrstuvwxyz", k=pick.randint(5, 9))) for _ in range(n)), lang, "s", 1)
           for i, (n, lang) in enumerate((n, lang) for n in lengths for lang in ("fr", None))]
    # Lists of words without the common ones.
    odd += [(2000 + n, " ".join(pick.choices(words[300:], k=n)), None, "s", 1) for n in lengths[::2]]
    got = {r.doc_id: r for r in quality.quality(documents(spark, rows + odd)).where("NOT base_failed").collect()}
    assert all(got[r[0]].kept for r in rows if r[0] in got) and sum(r[0] in got for r in rows) >= 215
    assert all(r[0] in got and not got[r[0]].kept for r in odd)


def plain_kept(rows, max_langs):
    """The verdict of each text that passes the base rules, text by text."""
    marks = ".,;:!?'\"-()"

    def bare(word):
        word = lowered(word)
        for _ in range(4):
            word = word[:-1] if word and word[-1] in marks else word
        return word[1:] if word and word[0] in marks else word

    def classes(text):
        kinds = [0 if "a" <= c <= "z" else 1 if "A" <= c <= "Z" else 2 if "0" <= c <= "9" else 3 if c > "\x7f" else 4 if c in " \t\n\r\x0b\x0c"
                 else 5 if c in marks else 6 for c in (text or "") + " "]
        return np.bincount(kinds, minlength=7)

    tags = {}
    for _, text, lang, *_ in rows:
        tags.setdefault(lang or "", []).append(text)
    refs, sizes = {}, {}
    for lang, texts in tags.items():
        words = [bare(w) for t in texts for w in words_of(t)]
        counts = Counter(w for w in words if w)
        sizes[lang] = sum(counts.values())
        if sizes[lang] < quality.MIN_REFERENCE_WORDS:
            continue
        key = {w: int(quality.Words([w]).hashes().view(np.int64)[0]) for w in counts}
        common = [w for w in sorted(counts, key=lambda w: (-counts[w], key[w]))[:64] if counts[w] * 1000 >= sizes[lang]]
        shares = np.array([counts[w] for w in common] + [len(words) - sum(counts[w] for w in common)]) / len(words)
        total = sum(classes(lowered(t)) for t in texts)
        refs[lang] = common, shares, total / total.sum(), quality.Reference(None, np.zeros(len(common)), shares)
    largest = sorted(refs, key=lambda x: (-sizes[x], x))[:max_langs]

    def gap(counts, shares):
        return plain_distance((counts / counts.sum()).tolist(), shares.tolist())

    for i, text, lang, *_ in rows:
        if plain_rules(text)[-1]:
            continue
        lang, n, words, own = lang or "", len(words_of(text)), Counter(bare(w) for w in words_of(text)), classes(text)
        excess, class_gap, nearest_class = math.inf, 0.0, math.inf
        for name in dict.fromkeys([*largest, *([lang] if lang in refs else [])]):
            common, shares, by_class, ref = refs[name]
            if len(common) < 64:
                continue
            nearest_class = min(nearest_class, gap(own, by_class))
            noise = ref.expected(np.array([n]))[0]
            if noise <= quality.MOST_NOISE * ref.bare:
                found = np.array([words[w] for w in common] + [n - sum(words[w] for w in common)])
                here = (gap(found, shares) ** 2 - noise) / (ref.bare - noise)
                if here < excess:
                    excess, class_gap = here, gap(own, by_class)
        kept = class_gap <= quality.CLASS_LIMIT and (math.isinf(excess) or excess <= quality.WORD_EXCESS)
        if not kept and lang in refs:
            common, _, by_class, ref = refs[lang]
            is_open = len(common) == 64 and ref.expected(np.array([n]))[0] <= quality.MOST_NOISE * ref.bare
            kept = not is_open and (len(common) == 64 or nearest_class > quality.CLASS_LIMIT) and gap(own, by_class) <= quality.CLASS_LIMIT
        yield i, kept


@pytest.mark.parametrize("max_langs", [256, 2, 1])
def test_verdicts_are_the_plain_ones(spark, monkeypatch, max_langs):
    """Also with tags beyond the largest."""
    monkeypatch.setattr(quality, "MAX_LANGS", max_langs)
    pick = random.Random(11)
    rows = []
    for lang, n in (("en", 60), ("de", 50), (None, 45), ("zz", 40), ("tiny", 3)):
        words = vocabulary(pick)
        rows += [(len(rows) + i, "(" + prose(pick, words, pick.randint(45, 300)).replace(" a", " A") + "!).", lang, "s", 1) for i in range(n)]
        rows += [(len(rows) + i, " ".join(pick.choices(words[20:40], k=300)), lang, "s", 1) for i in range(2)]
    rows += [(900 + i, " ".join("".join(pick.choices("漢字仮名交文章言語学習", k=12)) for _ in range(150)), "ja", "s", 1) for i in range(40)]
    rows += [(950 + i, "#### $$$ 123 " * 30 + prose(pick, words, 60), lang, "s", 1) for i, lang in enumerate(("en", "zz", "ja", "none"))]
    got = {r.doc_id: r.kept for r in quality.quality(documents(spark, rows)).where("NOT base_failed").collect()}
    expected = dict(plain_kept(rows, max_langs))
    assert got == expected and len(set(expected.values())) == 2


def test_counts_are_merged_and_handed_on(monkeypatch):
    """Small holds tell a key more than once; the sums are those of one hold."""
    import pyarrow as pa
    batch = pa.RecordBatch.from_pydict({"lang": ["a", "b", None, "a"] * 20, "text": ["x y, x", None, "y 9", "z %d" % 7] * 20})

    def sums():
        out = Counter()
        for found in quality.counted(iter([batch, batch])):
            for r in found.to_pylist():
                out[r["lang"], r["kind"], r["key"]] += r["n"]
        return out

    expected = sums()
    monkeypatch.setattr(quality, "HELD_COUNTS", 10)
    monkeypatch.setattr(quality, "GROUP_BYTES", 20)
    assert sums() == expected
    assert expected["a", quality.ALL, 0] == 200 and expected["b", quality.ALL, 0] == 0 and expected["", quality.BARE, 0] == 80


def test_expected_divergence_of_samples():
    reference = np.array([.3, .05, .001, .649])
    drawn = np.random.default_rng(4)
    for n, expected in zip(quality.NOISE_AT, quality.sample_divergence(reference)):
        assert (quality.distance(drawn.multinomial(n, reference, 4000), reference) ** 2).mean() == pytest.approx(expected, rel=0.06)


def test_kept_documents_have_all_columns(spark):
    docs = documents(spark, corpus())
    left = quality.kept_documents(docs)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {r.doc_id for r in quality.quality(docs).where("kept").collect()}


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_toxicity_edges(spark):
    docs = documents(spark, edges())
    for marks in ([], [(1, 1, None), (None, 1, 1)], [(4, 1, 0), (4, 1, 1), (6, 1, 0), (9, 1, 0), (7, 0, 1)]):
        got = toxicity.toxicity(docs, labels(spark, marks)).collect()
        assert len(got) == len(edges())
        assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert toxicity.toxicity(documents(spark, []), labels(spark, [])).count() == 0


def test_toxicity_held_out(spark):
    pick = random.Random(2)
    clean, bad = ["w%d" % i for i in range(300)], ["vile", "nastyable", "nastying", "nastyest"]
    rows, marks = [], []
    for i in range(600):
        words = [pick.choice(clean) for _ in range(60)]
        toxic = i % 5 == 0
        if toxic:
            words[pick.randrange(60)] = pick.choice(bad)
        rows.append((i, " ".join(words), "en", "s", 1))
        marks.append((i, 1, int(toxic)))
    got = {r.doc_id: r for r in toxicity.toxicity(documents(spark, rows), labels(spark, marks)).collect()}
    held = [(got[i], t) for i, _, t in marks if got[i].held_out]
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    assert sum(r.predicted == t for r, t in held) >= 0.97 * len(held)
