"""Byte-pair encoding with reuse of content-defined chunks.

Texts are cut into chunks where a rolling hash of the last bytes says so, so equal passages are cut alike wherever they stand. The
inside of a chunk, from its first safe place to its last, is encoded once in each task and reused for every text that holds the chunk. The
split pattern and the merges reach over a cut, so what lies around it is no chunk's own: each join is repaired by encoding the stretch from the last safe
place before it to the first one after it, however many chunks that takes. At a safe place (a blank between two letters) the
pattern begins anew whatever surrounds it, so the parts agree exactly with the ids of the whole text.

Chunks are shared within a task and not across tasks: an exchange would move every chunk and its ids (more bytes than the
input) to save the encoding of the repeated part.

Defined cases: a null text counts as empty and has no ids; rows that repeat an id are encoded each; a text of any length is
encoded chunk by chunk; special tokens written out in a text get their own ids, as the vocabulary's library does; no
rows give no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterglass.llm.common import BYTE_BASE, U64, powers, prefix_hash, register, table

VOCABULARY = "byte_bpe_50k.tiktoken"
SPECIAL = (("<|endoftext|>", 50256),)
#: Bytes that the rolling hash looks at; mean and largest bytes of a chunk.
ROLL, MEAN_BYTES, LARGEST_BYTES = 16, 1024, 16384
#: Bytes of chunks, ids and decoded text that a task keeps; the oldest chunks go first.
KEPT_BYTES = 48 << 20
#: Bytes cut at a time.
PIECE = 1 << 20
#: The pattern ends a piece before a blank between two ASCII letters, and no special token spans such a blank.
SAFE = re.compile(rb"(?<=[A-Za-z]) (?=[A-Za-z])")


def cuts(data: bytes) -> list[int]:
    """Ends of the chunks of UTF-8 bytes: where the hash of the ROLL bytes before is small, or at the largest size."""
    n = len(data)
    ends: list[int] = []
    for at in range(0, n, PIECE):
        values = np.frombuffer(data, np.uint8, min(n, at + PIECE + ROLL - 1) - at, at)
        m = len(values) - ROLL + 1
        if m <= 0:
            break
        prefix = prefix_hash(values.astype(U64) + U64(1), BYTE_BASE)
        rolled = (prefix[ROLL:] - prefix[:m]) * powers(BYTE_BASE, m)[1][:m] * U64(0x9E3779B97F4A7C15)
        ends.extend((np.flatnonzero(rolled < U64((1 << 64) // MEAN_BYTES)) + at + ROLL).tolist())
    out, last = [], 0
    for end in [*ends, n]:
        while end - last > LARGEST_BYTES:
            last = _whole(data, last + LARGEST_BYTES)
            out.append(last)
        end = _whole(data, end)
        if end > last:
            out.append(end)
            last = end
    return out


def _whole(data: bytes, at: int) -> int:
    """The first place at or after ``at`` that doesn't split a character."""
    while at < len(data) and data[at] & 0xC0 == 0x80:
        at += 1
    return at


Part = tuple[int, bytes, bytes]


class Encoder:
    """Encodes texts with the ranks of a vocabulary; keeps what it has found for the chunks it has met."""

    def __init__(self, path: str, pattern: str, special: tuple[tuple[str, int], ...]):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.codec = tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens=dict(special))
        self.special = re.compile("|".join(re.escape(s) for s, _ in special)) if special else None
        self.pieces = [b""] * (max([*ranks.values(), *(i for _, i in special)]) + 1)
        for piece, i in ranks.items():
            self.pieces[i] = piece
        for text, i in special:
            self.pieces[i] = text.encode()
        self.chunks: dict[bytes, tuple[int, int, Part]] = {}
        self.kept = self.reused = 0

    def piece(self, data: bytes) -> Part:
        """Number of ids, ids as little-endian 32-bit integers, and the text that the ids decode to, in UTF-8.

        A piece ends at a safe place or with its text, so no character of the decoded text reaches over its end.
        """
        if not data:
            return 0, b"", b""
        text = data.decode("utf-8", "surrogatepass")
        ids = (self.codec.encode(text, allowed_special="all") if self.special and self.special.search(text)
               else self.codec.encode_ordinary(text))
        return len(ids), np.array(ids, "<u4").tobytes(), b"".join(map(self.pieces.__getitem__, ids)).decode("utf-8", "replace").encode()

    def chunk(self, data: bytes) -> tuple[int, int, Part]:
        """First and last safe place (0, 0: none) and what lies between them."""
        found = self.chunks.get(data)
        if found is not None:
            self.reused += 1
            return found
        places = [m.start() for m in SAFE.finditer(data)]
        a, b = (places[0], places[-1]) if places else (0, 0)
        found = a, b, self.piece(data[a:b])
        self.chunks[data] = found
        self.kept += 8 * len(data)
        while self.kept > KEPT_BYTES:
            oldest = next(iter(self.chunks))
            del self.chunks[oldest]
            self.kept -= 8 * len(oldest)
        return found

    def text(self, data: bytes) -> Iterator[Part]:
        start, open_part = 0, []
        for end in cuts(data):
            chunk = data[start:end]
            a, b, inner = self.chunk(chunk)
            if a == b:
                open_part.append(chunk)
            else:
                yield self.piece(b"".join([*open_part, chunk[:a]]))
                yield inner
                open_part = [chunk[b:]]
            start = end
        yield self.piece(b"".join(open_part))


@cache
def encoder(path: str, pattern: str, special: tuple[tuple[str, int], ...]) -> Encoder:
    """One for each worker process; its chunks are dropped when a task begins."""
    return Encoder(path, pattern, special)


def encode_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
                 pattern: str = public_tokenizers.PATTERN, special: tuple[tuple[str, int], ...] = SPECIAL,
                 with_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids]), a row for each row; ``path``: a file of ranks."""
    path = path or public_tokenizers.path(VOCABULARY)
    kind = docs.schema[id_col].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoder(path, pattern, special)
        codec.chunks, codec.kept = {}, 0
        for batch in batches:
            n, marks, decoded, ids = [], [], [], []
            for value in batch.column("text"):
                body = value.as_buffer().to_pybytes() if value.is_valid else b""
                count, mark, back, kept = 0, hashlib.sha256(), hashlib.sha256(), []
                for k, part, piece in codec.text(body):
                    count += k
                    mark.update(part)
                    back.update(piece)
                    if with_ids:
                        kept.append(part)
                n.append(count)
                marks.append(mark.hexdigest())
                decoded.append(back.hexdigest())
                ids.append(np.frombuffer(b"".join(kept), "<i4"))
            columns = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(marks), pa.array(decoded)]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(encode, schema)


@register("op7_bpe_chunks")
def op7_bpe_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_texts(table(spark, sf_dir, "documents"))
