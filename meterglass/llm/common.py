"""What several operators of this subpackage share: registration, scratch tables, words and their hashes."""

from __future__ import annotations

import functools
import os
import tempfile
import zipfile
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from meterglass.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

U64 = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32

#: Odd multipliers of the polynomial hashes (modulo 2 ** 64), one for bytes and two for words.
BYTE_BASE, WORD_BASES = 0x9E3779B97F4A7C15, (0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)
#: Bytes hashed at a time; cut at white space.
PIECE = 1 << 20


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Gives this package to the Python workers, wherever they run; once for each application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    name = os.path.join(tempfile.mkdtemp(), "meterglass.zip")
    with zipfile.ZipFile(name, "w") as out:
        for folder, _, files in os.walk(top):
            for f in files:
                if f.endswith(".py"):
                    out.write(os.path.join(folder, f), os.path.relpath(os.path.join(folder, f), os.path.dirname(top)))
    context.addPyFile(name)
    _shipped.add(context.applicationId)


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(query: Query) -> Query:
        assert name not in QUERIES, name

        @functools.wraps(query)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return query(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return query
    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read back: its lineage ends there."""
    spark = frame.sparkSession
    ship(spark)
    path = scratch_path(spark, name)
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit values, so that any bits of a hash may pick its bucket."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base ** i and base ** -i modulo 2 ** 64 for i in 0 .. n-1."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            steps = np.full(size, b, U64)
            steps[0] = 1
            out.append(np.cumprod(steps, dtype=U64))
        have = _powers[base] = (out[0], out[1])
    return have


def prefix_hash(values: np.ndarray, base: int) -> np.ndarray:
    """Sums of values[j] * base ** j over j < i, for i in 0 .. n."""
    out = np.empty(len(values) + 1, U64)
    out[0] = 0
    np.cumsum(values * powers(base, len(values) + 1)[0][:len(values)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    return mix((prefix[ends] - prefix[starts]) * powers(base, len(prefix))[1][starts])


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes other than 0x20 and 0x09-0x0D."""
    edge = np.diff(SPACE[data].view(np.int8), prepend=1, append=1)
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words; they depend on a word's bytes only."""
    out = np.empty(len(starts), U64)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + PIECE, "right")))
        low = starts[at]
        prefix = prefix_hash(data[low:ends[to - 1]].astype(U64) + U64(1), BYTE_BASE)
        out[at:to] = span_hash(prefix, starts[at:to] - low, ends[at:to] - low, BYTE_BASE)
        at = to
    return mix(out + (ends - starts).astype(U64) * U64(0xA0761D6478BD642F))


class Words:
    """The words of some texts, laid end to end.

    ``data``: the texts' UTF-8 bytes with a blank after each; ``starts``, ``ends``: of words in it;
    ``first[i] .. first[i + 1]``: the words of text i.
    """

    def __init__(self, texts: list[str | None], lower: bool = False):
        encoded = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        self.data = np.frombuffer(b" ".join([*encoded, b""]), np.uint8)
        if lower:
            self.data = LOWER[self.data]
        self.starts, self.ends = word_spans(self.data)
        offsets = np.cumsum([0] + [len(t) + 1 for t in encoded])
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)
        self.of = np.repeat(np.arange(len(texts)), self.counts)
        self.offsets = offsets

    def text_of_byte(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), np.diff(self.offsets))

    def hashes(self) -> np.ndarray:
        return word_hashes(self.data, self.starts, self.ends)

    def windows(self, hashes: np.ndarray, length: int) -> np.ndarray:
        """Starts (word numbers) of the windows of that many words that lie in one text."""
        at = np.arange(len(hashes))
        return at[at + length <= self.first[1:][self.of]]


def window_hashes(hashes: np.ndarray, at: np.ndarray, length: int | np.ndarray, base: int = 0) -> np.ndarray:
    """Hashes of the windows of words that begin at those words."""
    return span_hash(prefix_hash(hashes, WORD_BASES[base]), at, at + length, WORD_BASES[base])
