"""Substring dedup by level-wise doubling.

All windows of a first length are hashed, and a window is repeated if its hash occurs twice anywhere. Only a start whose window is repeated, and
whose window at the other end of twice the length is repeated too, is a candidate at twice that length;
the lengths double until the one asked for is reached. So all windows are sent once, at a few bytes each, and the longer hashes
that make the last level exact are sent for candidates only.

Hashes travel packed between blocks of texts and buckets (see ``blocks``): a passage that many texts share is
one entry for each block. Early levels send 40 bits within a bucket of about a million windows; a collision there only keeps a candidate. The
last level compares 96 bits within a bucket.

Defined cases: a null or empty text has no words and keeps none (the digest of nothing); texts shorter than the window
keep all; rows that repeat an id are texts of their own, so equal rows of the length remove each other's words; no rows give no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from meterglass.llm import blocks as B
from meterglass.llm.common import SPACE, Words, register, stored, table, window_hashes

LENGTH = 35
#: Bytes sent for a hash at the levels before the last, and at the last (of two hashes).
EARLY, LAST = (5,), (8, 4)


def lengths(length: int, base: int | None = None) -> list[int]:
    """Window lengths of the levels; each at most twice the one before."""
    out = [min(base or -(-length // 2), length)]
    while out[-1] < length:
        out.append(min(2 * out[-1], length))
    return out


class Levels:
    """The levels of one block, as far as their answers are known."""

    def __init__(self, texts: list[str | None], sizes: list[int], n_buckets: int):
        self.words, self.sizes, self.n = Words(texts), sizes, n_buckets
        self.hashes = self.words.hashes()

    def run(self, answers: dict[tuple[int, int], bytes], known: int) -> np.ndarray | tuple:
        """After the last known level: which starts have repeated windows, if it is the last of all; else (values,
        cuts, candidates, their first places) to ask for."""
        at = self.words.windows(self.hashes, self.sizes[0])
        for level, size in enumerate(self.sizes):
            values, first, which, counts = np.unique(window_hashes(self.hashes, at, size),
                                                     return_index=True, return_inverse=True, return_counts=True)
            cuts = B.split(values, self.n)
            if level == known:
                return values, cuts, at[first]
            repeated = (B.bits(answers, level, cuts) | (counts > 1))[which]
            starts = np.zeros(len(self.hashes) + 1, bool)
            starts[at[repeated]] = True
            if level + 1 < len(self.sizes):
                longer = self.sizes[level + 1]
                at = at[repeated]
                at = at[at + longer <= self.words.first[1:][self.words.of[at]]]
                at = at[starts[at + longer - size]]
        return starts[:-1]

    def ask(self, block: int, answers: dict[tuple[int, int], bytes], level: int) -> Iterator[tuple[int, int, int, bytes]]:
        values, cuts, at = self.run(answers, level)
        if level + 1 < len(self.sizes):
            return B.asked(block, level, cuts, (values, EARLY[0]))
        second = window_hashes(self.hashes, at, self.sizes[-1], base=1)
        return B.asked(block, level, cuts, (values, LAST[0]), (second, LAST[1]))


def kept_texts(words: Words, removed: np.ndarray) -> list[bytes]:
    """Each text's words that aren't removed, joined by blanks."""
    steps = np.zeros(len(words.data) + 2, np.int8)
    # A word and the byte after it, which is white space.
    np.add.at(steps, words.starts[~removed], 1)
    np.add.at(steps, words.ends[~removed] + 1, -1)
    mask = np.cumsum(steps[:len(words.data)], dtype=np.int8) > 0
    out = words.data[mask]
    out = np.where(SPACE[out], np.uint8(0x20), out).tobytes()
    places = np.concatenate(([0], np.cumsum(mask)))[words.offsets].tolist()
    return [out[a:max(a, b - 1)] for a, b in zip(places, places[1:])]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   base: int | None = None, with_text: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256[, kept_text]) of all rows."""
    staged = B.stage(docs, id_col, text_col)
    n, sizes = B.bucket_count(staged), lengths(length, base)
    answers = None
    for level in range(len(sizes)):
        def ask(rows: pa.Table, told: dict | None = None, level: int = level) -> pa.Table:
            levels = Levels(rows["text"].to_pylist(), sizes, n)
            return B.ask_rows(levels.ask(rows["block"][0].as_py(), told or {}, level))

        questions = B.per_block(staged, ask, B.ASK) if answers is None else B.with_answers(staged, answers, ask, B.ASK)
        last = level + 1 == len(sizes)
        told = stored(B.answered(questions, B.shared_elsewhere(*(LAST if last else EARLY))), "repeats")
        answers = told if answers is None else answers.unionByName(told)

    def clean(rows: pa.Table, told: dict[tuple[int, int], bytes]) -> pa.Table:
        levels = Levels(rows["text"].to_pylist(), sizes, n)
        words, starts = levels.words, levels.run(told, len(sizes))
        steps = np.zeros(len(starts) + length + 1, np.int64)
        at = np.flatnonzero(starts)
        np.add.at(steps, at, 1)
        np.add.at(steps, at + length, -1)
        removed = np.cumsum(steps)[:len(starts)] > 0
        kept = kept_texts(words, removed)
        columns = {"doc_id": rows["doc_id"], "n_words": pa.array(words.counts.astype(np.int64)),
                   "n_removed": pa.array(np.bincount(words.of[removed], minlength=len(kept)).astype(np.int64)),
                   "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept])}
        if with_text:
            columns["kept_text"] = pa.array([k.decode("utf-8", "replace") for k in kept])
        return pa.table(columns)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    return B.with_answers(staged, answers, clean, schema)


SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, i, array_to_string(ws[i:i + 34], ' ') AS win FROM w, range(1, len(ws) - 33) t(i) WHERE len(ws) >= 35),
r AS (SELECT doc_id, i FROM s WHERE win IN (SELECT win FROM s GROUP BY win HAVING count(*) > 1)),
gone AS (SELECT DISTINCT doc_id, i + k AS pos FROM r, range(0, 35) u(k)),
kept AS (SELECT w.doc_id, pos, ws[pos] AS word FROM w, range(1, len(ws) + 1) t(pos)
         WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.doc_id = w.doc_id AND g.pos = t.pos)),
text_of AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS body FROM kept GROUP BY doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(body, '')) AS kept_sha256
FROM w LEFT JOIN text_of USING (doc_id)
"""


@register("op1_substring_dedup", SQL)
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))
