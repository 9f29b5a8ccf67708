"""Questions about all texts that no task can answer alone: is this window elsewhere, how frequent is this word?

Texts are staged once in blocks of bounded size, in a table bucketed by block. A block sends its distinct hashes, packed,
to buckets of the hash space; a bucket answers each block in the order of what it was sent; the answers come
back to the block by a join that moves only them, as the texts are already placed by block. A frequent
word or passage is one entry for each block, so it makes no heavy group; a bucket's size is set by the number of buckets.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterglass.llm.common import ship
from meterglass.session import scratch_path

#: Bytes of text in a block; a longer text is a block of its own.
BLOCK_BYTES = 4 << 20
#: Bytes of text for each bucket of hashes: about a million words.
BUCKET_BYTES = 6 << 20
LEAST_BUCKETS = 48


def stage(docs: DataFrame, id_col: str, text_col: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rows (block, row, n_bytes, doc_id, text) in a table bucketed by block, in the shared folder.

    ``row`` numbers the texts of a block, so equal ids stay apart.
    """
    spark = docs.sparkSession
    ship(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, row, size = TaskContext.get().partitionId() << 20, 0, 0
        for batch in batches:
            blocks, rows = [], []
            sizes = pa.compute.binary_length(batch.column(1)).cast(pa.int64()).fill_null(0)
            for n in sizes.to_pylist():
                if size and size + n + 1 > block_bytes:
                    block, row, size = block + 1, 0, 0
                blocks.append(block)
                rows.append(row)
                row, size = row + 1, size + n + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(blocks, pa.int64()), pa.array(rows, pa.int32()), sizes, *batch.columns],
                ["block", "row", "n_bytes", "doc_id", "text"])

    name = f"blocks_{uuid.uuid4().hex}"
    (chosen.mapInArrow(number, f"block long, row int, n_bytes long, doc_id {kind}, text string")
        .write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "block").sortBy("block")
        .option("compression", "zstd").option("path", scratch_path(spark, "blocks")).saveAsTable(name))
    return spark.table(name)


def bucket_count(blocks: DataFrame) -> int:
    return max(LEAST_BUCKETS, -(-(blocks.agg(F.sum("n_bytes")).first()[0] or 0) // BUCKET_BYTES))


def split(hashes: np.ndarray, n: int) -> np.ndarray:
    """Where each of n buckets begins and ends in sorted 64-bit hashes."""
    cuts = np.array([(i << 64) // n for i in range(1, n)], np.uint64)
    return np.concatenate(([0], np.searchsorted(hashes, cuts), [len(hashes)]))


def asked(block: int, level: int, cuts: np.ndarray, *columns: tuple[np.ndarray, int]) -> Iterator[tuple[int, int, int, bytes]]:
    """(level, bucket, block, payload) of what a block asks; columns: 64-bit values, and how many of their low bytes to send."""
    low = [np.ascontiguousarray(v).view(np.uint8).reshape(len(v), 8)[:, :width] for v, width in columns]
    for bucket, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
        if b > a:
            yield level, bucket, block, b"".join(np.ascontiguousarray(x[a:b]).tobytes() for x in low)


def unpack(payload: bytes, *widths: int) -> list[np.ndarray]:
    """The columns of a payload, as 64-bit values."""
    data = np.frombuffer(payload, np.uint8)
    n, at, out = len(data) // sum(widths), 0, []
    for width in widths:
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :width] = data[at:at + n * width].reshape(n, width)
        out.append(wide.view(np.uint64).ravel())
        at += n * width
    return out


ASK = "level int, bucket int, block long, payload binary"
_ASK = pa.schema([("level", pa.int32()), ("bucket", pa.int32()), ("block", pa.int64()), ("payload", pa.binary())])


def ask_rows(rows: Iterator[tuple[int, int, int, bytes]]) -> pa.Table:
    rows = list(rows)
    return pa.table([pa.array(c, t.type) for c, t in zip(zip(*rows) if rows else ([],) * 4, _ASK)], schema=_ASK)


def in_order(rows: pa.Table) -> pa.Table:
    """The rows of a block by number. A side of a cogroup that has no rows has no columns either."""
    return rows.take(pa.compute.sort_indices(rows["row"]))


def per_block(blocks: DataFrame, fn: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """fn over the rows of each block."""
    return blocks.groupBy("block").applyInArrow(lambda rows: fn(in_order(rows)), schema)


def answered(questions: DataFrame, fn: Callable[[list[bytes]], list[bytes | None]]) -> DataFrame:
    """Each bucket's answers, one for each payload; None: nothing to tell."""
    def answer(bucket: pa.Table) -> pa.Table:
        told = fn(bucket["payload"].to_pylist())
        return ask_rows((level, b, block, a) for level, b, block, a in zip(
            bucket["level"].to_pylist(), bucket["bucket"].to_pylist(), bucket["block"].to_pylist(), told) if a is not None)
    return questions.groupBy("bucket").applyInArrow(answer, ASK)


def with_rows(blocks: DataFrame, marks: DataFrame, fn: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """fn over the rows of each block and the marks that name it."""
    return (blocks.groupBy("block").cogroup(marks.groupBy("block"))
            .applyInArrow(lambda rows, own: fn(in_order(rows), own), schema))


def with_answers(blocks: DataFrame, answers: DataFrame, fn: Callable[[pa.Table, dict[tuple[int, int], bytes]], pa.Table],
                 schema: str) -> DataFrame:
    """fn over the rows of each block and its answers by (level, bucket)."""
    def both(rows: pa.Table, told: pa.Table) -> pa.Table:
        if not told.num_rows:
            return fn(in_order(rows), {})
        keys = zip(told["level"].to_pylist(), told["bucket"].to_pylist())
        return fn(in_order(rows), dict(zip(keys, told["payload"].to_pylist())))
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(both, schema)


def shared_elsewhere(*widths: int) -> Callable[[list[bytes]], list[bytes | None]]:
    """For each hash of a payload a bit: whether another payload has it too. A payload holds a hash once."""
    def answer(payloads: list[bytes]) -> list[bytes | None]:
        parts = [unpack(p, *widths) for p in payloads]
        columns = [np.concatenate(c) for c in zip(*parts)]
        order = np.lexsort(columns[::-1]) if len(columns) > 1 else np.argsort(columns[0], kind="stable")
        same = np.ones(len(order) - 1, bool)
        for c in columns:
            same &= c[order[1:]] == c[order[:-1]]
        found = np.zeros(len(order), bool)
        found[order[1:]] |= same
        found[order[:-1]] |= same
        ends = np.cumsum([0] + [len(p[0]) for p in parts])
        return [np.packbits(found[a:b]).tobytes() if found[a:b].any() else None for a, b in zip(ends[:-1], ends[1:])]
    return answer


def bits(answers: dict[tuple[int, int], bytes], level: int, cuts: np.ndarray) -> np.ndarray:
    """The bits of all buckets, in the order of the hashes that were sent."""
    out = np.zeros(cuts[-1], bool)
    for bucket, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
        told = answers.get((level, bucket))
        if told is not None:
            out[a:b] = np.unpackbits(np.frombuffer(told, np.uint8), count=b - a).view(bool)
    return out
