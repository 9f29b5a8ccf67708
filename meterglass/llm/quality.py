"""Quality rules by distribution divergence.

Each language of the corpus gets two references, gathered over all its documents: a histogram of character classes and
one of its most common words (and all others together). A document is compared with the references by
Jensen-Shannon distance, and its distances to the language nearest in words are judged, so a wrong or missing language tag does no harm.
A tag is a language to compare any document with if it has enough words and a full list of common words, and from the length on at
which these tell a sample from a text without them; otherwise its few words would be near to anything.
Short documents have ragged histograms, so words are judged on a scale that depends on their number: 0 is the divergence that a
sample of so many words is expected to have from its own reference, 1 that of a text without a single common word, and a
document above ``word_excess`` goes. Below ``min_words`` words none is judged, and below ``min_common`` words common words aren't.

The common words of a tag are the COMMON_WORDS most frequent of those that make up NAMED_SHARE of its words. All words are counted, in one
pass with the characters: tasks count what they hold, hand on counts when they hold much, and a shuffle adds them up. The references of the MAX_LANGS
largest tags, a bounded number, judge any document; a document of another tag meets its tag's reference as well, which a join brings to it.

Defined cases: a null text has no words and fails the base rule; a null language counts as the empty tag; tags of
fewer than MIN_REFERENCE_WORDS words have no reference of their own, and their documents are judged by the others'; a tag of enough words whose list isn't full (a script without blanks, say) or can't tell texts of a document's length
serves its own documents only, by character classes, and without a full list only those whose classes no other language has; without any reference the base rules decide alone; repeated rows are judged each; an empty table has no references and
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterglass.llm.common import U64, Words, mix, register, stored, table, window_hashes, word_hashes

#: Bytes by class: lower, upper, digit, beyond ASCII, white space, sentence marks, other marks; 7: not the first byte of a character.
CLASSES = np.full(256, 6, np.uint8)
CLASSES[ord("a"):ord("z") + 1] = 0
CLASSES[ord("A"):ord("Z") + 1] = 1
CLASSES[ord("0"):ord("9") + 1] = 2
CLASSES[0xC0:] = 3
CLASSES[[0x20, *range(0x09, 0x0E)]] = 4
CLASSES[list(b".,;:!?'\"-()")] = 5
CLASSES[0x80:0xC0] = 7
N_CLASSES = 7
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
MARKS = np.zeros(256, bool)
MARKS[list(b".,;:!?'\"-()")] = True

COMMON_WORDS, MAX_LANGS = 64, 256
#: Share of a tag's words that a common word makes up at least.
NAMED_SHARE = 1e-3
#: Words of a tag that has a reference.
MIN_REFERENCE_WORDS = 5000
MIN_WORDS, MIN_COMMON = 50, 50
#: Largest Jensen-Shannon distance (0 to 1) of the character classes of a document that is kept.
CLASS_LIMIT = 0.28
#: Largest word divergence, from 0 (expected of a sample) to 1 (no common word), of a document that is kept.
WORD_EXCESS = 0.8
#: Share of a text's divergence without common words that the noise of its length may reach, for a reference to judge it by words:
#: there a clean sample spreads by 0.3 on the scale.
MOST_NOISE = 0.72
#: Numbers of words for which the noise is computed; it is interpolated between them, and beyond falls with the number.
NOISE_AT = 1 << np.arange(4, 12)
#: Counts that a task holds before it hands them on.
HELD_COUNTS = 1 << 20
#: Kinds of counts of a tag: of a word (by its hash), of a character class, of all words, of words that aren't only marks.
WORD, CLASS, ALL, BARE = range(4)
#: Bytes of text looked at together.
GROUP_BYTES = 1 << 20


def groups(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of bounded bytes."""
    sizes = pa.compute.binary_length(batch.column("text")).fill_null(0).to_pylist()
    at, total = 0, 0
    for i, n in enumerate(sizes):
        if i > at and total + n > GROUP_BYTES:
            yield batch.slice(at, i - at)
            at, total = i, 0
        total += n
    if at < len(sizes):
        yield batch.slice(at)


class Bare(Words):
    """Words in lower case without the sentence marks around them; what is left may be empty."""

    def __init__(self, texts: list[str | None]):
        super().__init__(texts, lower=True)
        for _ in range(4):
            self.ends = self.ends - ((self.ends > self.starts) & MARKS[self.data[self.ends - 1]])
        self.starts = self.starts + ((self.ends > self.starts) & MARKS[self.data[np.minimum(self.starts, len(self.data) - 1)]])


def distance(counts: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distances (base 2) of rows of counts and one distribution; of empty rows 0."""
    total = counts.sum(axis=1, keepdims=True)
    p = counts / np.maximum(total, 1)
    m = (p + reference) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / m), 0).sum(axis=1)
        right = np.where(reference > 0, reference * np.log2(reference / m), 0).sum(axis=1)
    return np.where(total[:, 0] > 0, np.sqrt(np.maximum((left + right) / 2, 0)), 0.0)


def class_counts(words: Words, n_texts: int) -> np.ndarray:
    """Characters by class of each text; the blanks between texts count with the text before."""
    classes = CLASSES[words.data]
    marks = words.text_of_byte()
    return np.bincount(marks * 8 + classes, minlength=n_texts * 8).reshape(n_texts, 8)[:, :N_CLASSES]


def common_counts(words: Words, n_texts: int, known: np.ndarray) -> np.ndarray:
    """Occurrences in each text of the words with those sorted hashes, and of all others."""
    hashes = word_hashes(words.data, words.starts, words.ends) if len(words.starts) else np.empty(0, U64)
    at = np.minimum(np.searchsorted(known, hashes), max(len(known) - 1, 0))
    at = np.where(known[at] == hashes, at, len(known)) if len(known) else np.zeros(len(hashes), np.int64)
    width = len(known) + 1
    return np.bincount(words.of * width + at, minlength=n_texts * width).reshape(n_texts, width)


def repeat_words(words: Words, n_texts: int, length: int = 3) -> np.ndarray:
    """Words in windows that a text holds twice or more."""
    hashes = words.hashes()
    at = words.windows(hashes, length)
    if not len(at):
        return np.zeros(n_texts, np.int64)
    keys = window_hashes(hashes, at, length) ^ mix(words.of[at].astype(U64) + U64(1))
    _, which, counts = np.unique(keys, return_inverse=True, return_counts=True)
    steps = np.zeros(len(hashes) + 1, np.int64)
    starts = at[counts[which] > 1]
    steps[starts] += 1
    steps[starts + length] -= 1
    covered = np.cumsum(steps[:-1]) > 0
    return np.bincount(words.of[covered], minlength=n_texts)


def dup_lines(text: str | None) -> int:
    lines = [line for line in (text or "").split("\n") if line.strip(" \t\n\r\x0b\x0c")]
    return len(lines) - len(set(lines))


@dataclass
class Reference:
    """Share of each character class, the common words' sorted hashes, and their shares (last: all others)."""

    classes: np.ndarray
    known: np.ndarray
    words: np.ndarray

    def __post_init__(self) -> None:
        #: Word divergence of a text without any of the common words, and of samples of NOISE_AT words.
        self.bare = float(distance(np.eye(1, len(self.words), len(self.known)), self.words)[0] ** 2)
        self.noise = sample_divergence(self.words)

    def expected(self, n_words: np.ndarray) -> np.ndarray:
        """Word divergence expected of a sample of so many words."""
        n = np.maximum(n_words, 1)
        return np.interp(np.log(n), np.log(NOISE_AT), self.noise) * np.minimum(1, NOISE_AT[-1] / n)

    @property
    def is_full(self) -> bool:
        return len(self.known) == COMMON_WORDS

    def is_open(self, n_words: np.ndarray) -> np.ndarray:
        """Whether it may judge any text of so many words, not only those of its tag."""
        return self.is_full & (self.expected(n_words) <= MOST_NOISE * self.bare)


def sample_divergence(reference: np.ndarray) -> np.ndarray:
    """Expected Jensen-Shannon divergence from the reference of samples of NOISE_AT words: the sum over words and binomial counts."""
    q = np.clip(reference[reference > 0], 0, 1 - 1e-12)[:, None]
    out = []
    for n in NOISE_AT.tolist():
        x = np.arange(n + 1)
        logs = np.concatenate(([0.0], np.cumsum(np.log(np.arange(1, n + 1)))))
        chance = np.exp(logs[n] - logs - logs[::-1] + x * np.log(q) + (n - x) * np.log1p(-q))
        p = x / n
        m = (p + q) / 2
        left = p * np.log2(np.maximum(p, 1e-300) / m)
        out.append((chance * (left + q * np.log2(q / m))).sum() / 2)
    return np.array(out)


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, kind, key, n): all counts of a task's texts, a key once or more."""
    held: dict[tuple[str, int], list[tuple[np.ndarray, np.ndarray]]] = {}
    size = 0

    def merged() -> int:
        """How many counts are held once each key is."""
        for at, parts in held.items():
            keys, which = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
            # Sums of integers below 2 ** 53 are exact in doubles.
            held[at] = [(keys, np.bincount(which, np.concatenate([n for _, n in parts])).astype(np.int64))]
        return sum(len(parts[0][0]) for parts in held.values())

    def told() -> Iterator[pa.RecordBatch]:
        for (lang, kind), [(keys, n)] in held.items():
            yield pa.RecordBatch.from_arrays([pa.repeat(lang, len(keys)), pa.repeat(pa.scalar(kind, pa.int32()), len(keys)),
                                              pa.array(keys.view(np.int64)), pa.array(n)], ["lang", "kind", "key", "n"])
        held.clear()

    for batch in batches:
        for part in groups(batch):
            langs, at = np.unique(np.array([x or "" for x in part.column("lang").to_pylist()], object).astype(str), return_inverse=True)
            words = Bare(part.column("text").to_pylist())
            hashes = word_hashes(words.data, words.starts, words.ends) if len(words.starts) else np.empty(0, U64)
            by_class, bare, of_lang = class_counts(words, len(at)), words.ends > words.starts, at[words.of]
            for i, lang in enumerate(langs.tolist()):
                own = of_lang == i
                classes, n_bare = by_class[at == i].sum(axis=0), int((own & bare).sum())
                found = {WORD: np.unique(hashes[own & bare], return_counts=True), CLASS: (np.arange(N_CLASSES, dtype=U64), classes),
                         ALL: (np.zeros(1, U64), np.array([own.sum()])), BARE: (np.zeros(1, U64), np.array([n_bare]))}
                for kind, (keys, n) in found.items():
                    held.setdefault((lang, kind), []).append((keys, n))
                    size += len(keys)
            if size > HELD_COUNTS:
                size = merged()
                if 2 * size > HELD_COUNTS:
                    yield from told()
                    size = 0
    merged()
    yield from told()


def reference(rows: list[tuple[int, int, int]]) -> Reference:
    """From a tag's (kind, key, n)."""
    classes, n_all, n_bare = np.zeros(N_CLASSES), 0, 0
    for kind, key, n in rows:
        if kind == CLASS:
            classes[key] = n
        elif kind == ALL:
            n_all = n
        elif kind == BARE:
            n_bare = n
    words = [(key, n) for kind, key, n in rows if kind == WORD and n >= NAMED_SHARE * n_bare]
    known, n = np.array([k for k, _ in words], np.int64).view(U64), np.array([n for _, n in words], float)
    order = np.argsort(known)
    shares = np.append(n[order], n_all - n.sum())
    return Reference(classes / max(classes.sum(), 1), known[order], shares / max(n_all, 1))


def references(docs: DataFrame) -> tuple[dict[str, Reference], DataFrame | None]:
    """The largest tags' references, and (own_lang, own) with the counts of all other tags that have one; None if there are none."""
    counts = docs.mapInArrow(counted, "lang string, kind int, key long, n long").groupBy("lang", "kind", "key").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "key"))
    # A bounded number of rows for each tag.
    top = stored(counts.withColumn("rank", rank).where(F.col("rank") <= COMMON_WORDS).drop("rank"), "counts")
    sizes = top.where((F.col("kind") == BARE) & (F.col("n") >= MIN_REFERENCE_WORDS)).select("lang", "n")
    # MAX_LANGS tags with COMMON_WORDS + N_CLASSES + 2 rows each at most reach the driver.
    first = sizes.orderBy(F.desc("n"), "lang").limit(MAX_LANGS + 1).collect()
    large = [r["lang"] for r in first[:MAX_LANGS]]
    rows: dict[str, list[tuple[int, int, int]]] = {lang: [] for lang in large}
    for r in top.where(F.col("lang").isin(large)).collect() if large else []:
        rows[r["lang"]].append((r["kind"], r["key"], r["n"]))
    rare = None
    if len(first) > MAX_LANGS:
        others = sizes.where(~F.col("lang").isin(large)).select(F.col("lang").alias("own_lang"))
        rare = stored(top.join(others, F.col("lang") == F.col("own_lang")).groupBy("own_lang")
                      .agg(F.collect_list(F.struct("kind", "key", "n")).alias("own")), "rare_references")
    return {lang: reference(rows[lang]) for lang in large}, rare


def nearest(refs: list[Reference], by_class: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Class distance, word distance and word excess of each text to one reference, that of the smallest word excess, and
    the smallest class distance to any full one.

    All but the last 0 where no reference is open to the text's length.
    """
    n = len(by_class)
    class_gap, word_gap, least, any_class = np.zeros(n), np.zeros(n), np.full(n, np.inf), np.full(n, np.inf)
    for ref in refs:
        if not ref.is_full:
            continue
        # Texts too short to be judged are as long as the shortest that is.
        length = np.maximum(words.counts, MIN_COMMON)
        gap, noise, is_open = distance(common_counts(words, n, ref.known), ref.words), ref.expected(length), ref.is_open(length)
        excess = np.where(is_open, (gap ** 2 - noise) / np.where(is_open, ref.bare - noise, 1), np.inf)
        nearer = excess < least
        least = np.where(nearer, excess, least)
        word_gap = np.where(nearer, gap, word_gap)
        classes = distance(by_class, ref.classes)
        class_gap, any_class = np.where(nearer, classes, class_gap), np.minimum(any_class, classes)
    return class_gap, word_gap, np.where(np.isinf(least), 0.0, least), any_class


def with_own(part: pa.RecordBatch, refs: dict[str, Reference], cache: dict[str, Reference]) -> Iterator[tuple[pa.RecordBatch, dict[str, Reference]]]:
    """The rows by the references that they meet: those of the largest tags, and where a join brought one their own tag's."""
    if "own" not in part.schema.names or part.column("own").null_count == len(part):
        yield part, refs
        return
    here = np.array([x or "" for x in part.column("lang").to_pylist()], object).astype(str)
    has = part.column("own").is_valid().to_numpy(zero_copy_only=False)
    if not has.all():
        yield part.take(pa.array(np.flatnonzero(~has))), refs
    for lang in np.unique(here[has]).tolist():
        rows = np.flatnonzero(has & (here == lang))
        if lang not in cache:
            if len(cache) >= MAX_LANGS:
                cache.clear()
            cache[lang] = reference([(r["kind"], r["key"], r["n"]) for r in part.column("own")[int(rows[0])].as_py()])
        yield part.take(pa.array(rows)), {**refs, lang: cache[lang]}


def judged(docs: DataFrame, known: tuple[dict[str, Reference], DataFrame | None], min_words: int = MIN_WORDS, min_common: int = MIN_COMMON,
           class_limit: float = CLASS_LIMIT, word_excess: float = WORD_EXCESS, also: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, class_distance, word_distance, *also)."""
    largest, rare = known

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, Reference] = {}
        for batch in batches:
            for part, refs in (x for g in groups(batch) for x in with_own(g, largest, cache)):
                texts = part.column("text").to_pylist()
                n = len(texts)
                words, bare = Words(texts), Bare(texts)
                n_words = words.counts
                # Characters by their first bytes; the blank after each text is white space.
                lead = (words.data & 0xC0) != 0x80
                of_byte = words.text_of_byte()
                chars = np.bincount(of_byte[lead & (CLASSES[words.data] != 4)], minlength=n)
                symbols = np.bincount(of_byte[SYMBOLS[words.data]], minlength=n)
                repeats = repeat_words(words, n)
                lines = np.array([dup_lines(t) for t in texts], np.int64)
                failed = (n_words < 50) | (100 * repeats > 50 * n_words)
                by_class = class_counts(words, n)
                class_gap, word_gap, excess, any_class = nearest(list(refs.values()), by_class, bare)
                odd = (n_words >= min_words) & (class_gap > class_limit) | (n_words >= min_common) & (excess > word_excess)
                langs = np.array([x or "" for x in part.column("lang").to_pylist()], object).astype(str)
                for lang in set(langs.tolist()) & set(refs):
                    ref = refs[lang]
                    gap = distance(by_class, ref.classes)
                    alone = ~ref.is_open(np.maximum(n_words, MIN_COMMON)) & (ref.is_full | (any_class > class_limit))
                    fits = odd & (langs == lang) & alone & (gap <= class_limit)
                    class_gap = np.where(fits, gap, class_gap)
                    word_gap = np.where(fits, distance(common_counts(bare, n, ref.known), ref.words), word_gap)
                    odd &= ~fits
                columns = [part.column("doc_id"), *(pa.array(x.astype(np.int64)) for x in (n_words, chars, symbols, lines, repeats)),
                           pa.array(failed), pa.array(~failed & ~odd), pa.array(class_gap), pa.array(word_gap), *(part.column(c) for c in also)]
                yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
             "class_distance", "word_distance", *also]
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = (f"doc_id {kinds['doc_id']}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
              "base_failed boolean, kept boolean, class_distance double, word_distance double" + "".join(f", `{c}` {kinds[c]}" for c in also))
    if rare is not None:
        docs = docs.join(rare, F.coalesce("lang", F.lit("")) == F.col("own_lang"), "left").drop("own_lang")
    return docs.mapInArrow(judge, schema)


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **limits: object) -> DataFrame:
    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    return judged(chosen, references(chosen.select("text", "lang")), **limits)


def kept_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The documents that the rules keep, with all their columns, whatever their names."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text_col] or [F.lit(0).alias("none")]
    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                         F.col(lang_col).cast("string").alias("lang"), F.struct(*rest).alias("rest"))
    kept = judged(chosen, references(chosen.select("text", "lang")), also=("text", "rest")).where("kept")
    kind = docs.schema[text_col].dataType
    # Texts go through once, beside the other columns.
    return kept.select(*(F.col("text").cast(kind).alias(c) if c == text_col else F.col("rest")[c].alias(c) for c in docs.columns))


@register("op5_quality_divergence")
def op5_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"))
