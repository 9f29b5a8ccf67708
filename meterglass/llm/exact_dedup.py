"""Exact dedup by composable polynomial fingerprints.

A text is cut into chunks of bytes. A chunk's fingerprint is its bytes as a polynomial modulo two primes; fingerprints of
neighbouring chunks combine by shifting the left one by the right one's length, so the chunks of a huge text are
hashed in parallel. Equal fingerprints only propose a group: each text is then compared with the group's keeper chunk by
chunk, in a sorted stream that holds one chunk of the keeper at a time. Texts that differ form groups of their own.

Defined cases: a null text counts as empty, all empty texts are one group; rows that repeat an id are
rows of their own, of which one stays; a null id sorts before all others; no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterglass.llm.common import register, stored, table

#: Two primes below 2 ** 31 and a base for each.
PRIMES, BASES = (2147483647, 2147483629), (911382323, 972663749)
CHUNK_BYTES = 1 << 16
#: Rows of a group that one task compares.
ROWS_PER_SALT = 500


def chunk_fingerprint(data: bytes, prime: int, base: int) -> int:
    """Sum of (byte + 1) * base ** (bytes after it), modulo prime; at most CHUNK_BYTES bytes."""
    values = np.frombuffer(data, np.uint8).astype(np.int64) + 1
    return int(values @ _powers(prime, base)[CHUNK_BYTES - len(values):]) % prime


_tables: dict[tuple[int, int], np.ndarray] = {}


def _powers(prime: int, base: int) -> np.ndarray:
    """Falling powers; CHUNK_BYTES products of a byte and a power fit 63 bits."""
    if (prime, base) not in _tables:
        out, value = np.empty(CHUNK_BYTES, np.int64), 1
        for i in range(CHUNK_BYTES - 1, -1, -1):
            out[i], value = value, value * base % prime
        _tables[prime, base] = out
    return _tables[prime, base]


def combine(left: int, right: int, right_bytes: int, prime: int, base: int) -> int:
    """Fingerprint of two neighbouring pieces."""
    return (left * pow(base, right_bytes, prime) + right) % prime


def text_fingerprint(data: bytes, prime: int, base: int) -> int:
    out = 0
    for at in range(0, len(data), CHUNK_BYTES):
        piece = data[at:at + CHUNK_BYTES]
        out = combine(out, chunk_fingerprint(piece, prime, base), len(piece), prime, base)
    return out


def fingerprints(texts: DataFrame, primes: tuple[int, int] = PRIMES, huge_bytes: int = 8 << 20) -> DataFrame:
    """(doc_id, text_sha256, n_bytes, f0, f1) of rows (doc_id, text_sha256, body).

    Texts above ``huge_bytes`` are cut into pieces of that size, which are hashed apart and then combined.
    """
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = batch.column("body").to_pylist()
            kept = [n for n in batch.schema.names if n != "body"]
            found = [pa.array([text_fingerprint(b, p, base) for b in bodies], pa.int64()) for p, base in zip(primes, BASES)]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), *found], [*kept, "f0", "f1"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    head = f"doc_id {kind}, text_sha256 string, n_bytes long"
    rows = texts.select("doc_id", "text_sha256", F.octet_length("body").cast("long").alias("n_bytes"), "body")
    small = rows.where(F.col("n_bytes") <= huge_bytes).mapInArrow(hashed, f"{head}, f0 long, f1 long")
    pieces = (rows.where(F.col("n_bytes") > huge_bytes)
              .withColumn("row", F.monotonically_increasing_id())
              .withColumn("piece", F.explode(F.sequence(F.lit(0), ((F.col("n_bytes") - 1) / huge_bytes).cast("int"))))
              .withColumn("body", F.substring("body", F.col("piece") * huge_bytes + 1, F.lit(huge_bytes)))
              .withColumn("piece_bytes", F.octet_length("body"))
              .repartition("text_sha256", "piece")
              .mapInArrow(hashed, f"{head}, row long, piece int, piece_bytes int, f0 long, f1 long"))

    def folded(parts: pa.Table) -> pa.Table:
        parts = parts.sort_by("piece")
        out = [0, 0]
        for n, *fs in zip(*(parts[c].to_pylist() for c in ("piece_bytes", "f0", "f1"))):
            out = [combine(a, b, n, p, base) for a, b, p, base in zip(out, fs, primes, BASES)]
        first = parts.slice(0, 1).select(["doc_id", "text_sha256", "n_bytes"])
        return first.append_column("f0", pa.array(out[:1], pa.int64())).append_column("f1", pa.array(out[1:], pa.int64()))

    return small.unionByName(pieces.groupBy("row").applyInArrow(folded, f"{head}, f0 long, f1 long"))


def differing(texts: DataFrame, proposed: DataFrame) -> DataFrame:
    """Rows (doc_id, text_sha256) of ``proposed`` whose text isn't that of their group's keeper.

    proposed: (doc_id, text_sha256, keep_id, keep_sha, members). Large groups are salted: the keeper's chunks go to each
    salt, and each salt is one sorted stream of chunks.
    """
    salts = (F.col("members") / ROWS_PER_SALT).cast("int") + 1
    keeper = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("text_sha256") == F.col("keep_sha"))
    others = proposed.where(~keeper).withColumn(
        "salt", F.pmod(F.xxhash64("doc_id", "text_sha256"), salts).cast("int")).withColumn("place", F.lit(1))
    keepers = proposed.where(keeper).withColumn(
        "salt", F.explode(F.sequence(F.lit(0), salts - 1))).withColumn("place", F.lit(0))
    chosen = others.unionByName(keepers).select(
        F.col("doc_id").alias("p_id"), F.col("text_sha256").alias("p_sha"), "keep_id", "keep_sha", "salt", "place")
    last = (F.greatest(F.octet_length("body"), F.lit(1)) - 1) / CHUNK_BYTES
    order = ["keep_id", "keep_sha", "salt", "chunk"]
    chunks = (texts.join(chosen, F.col("doc_id").eqNullSafe(F.col("p_id")) & (F.col("text_sha256") == F.col("p_sha")))
              .withColumn("chunk", F.explode(F.sequence(F.lit(0), last.cast("int"))))
              .select(*order, "place", "doc_id", "text_sha256",
                      F.substring("body", F.col("chunk") * CHUNK_BYTES + 1, F.lit(CHUNK_BYTES)).alias("piece")))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, piece = None, None
        for batch in batches:
            wrong, columns = [], (c.to_pylist() for c in batch.columns)
            for i, (*key, place, _, _, body) in enumerate(zip(*columns)):
                if place == 0:
                    at, piece = key, body
                elif at != key or piece != body:
                    wrong.append(i)
            yield batch.take(pa.array(wrong, pa.int64())).select(["doc_id", "text_sha256"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    return (chunks.repartition(*order).sortWithinPartitions(*order, "place")
            .mapInArrow(compare, f"doc_id {kind}, text_sha256 string").distinct())


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_largest: bool = True,
                 primes: tuple[int, int] = PRIMES, huge_bytes: int = 8 << 20) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256, n_bytes), a row for each row of ``docs``."""
    texts = docs.select(F.col(id_col).alias("doc_id"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("body"))
    texts = texts.withColumn("text_sha256", F.sha2("body", 256))
    keys = ["f0", "f1", "n_bytes"]
    # Repeated rows are one entry from here on, with their number.
    left = stored(fingerprints(texts, primes, huge_bytes)
                  .groupBy("doc_id", "text_sha256", *keys).agg(F.count("*").alias("copies")), "fingerprints")
    pick = F.max if keep_largest else F.min
    settled = []
    while True:
        # Which entries may form a group, and the one that would stay.
        # Groups of one need no join, and a group of a third of all rows is a skewed join that is split as it runs.
        groups = stored(left.groupBy(*keys).agg(pick(F.struct("doc_id", "text_sha256")).alias("keep"), F.count("*").alias("members"))
                        .where("members > 1"), "groups").select(
            *(F.col(k).alias(f"g_{k}") for k in keys), F.col("keep.doc_id").alias("k_id"), F.col("keep.text_sha256").alias("k_sha"), "members")
        same = (F.col("f0") == F.col("g_f0")) & (F.col("f1") == F.col("g_f1")) & (F.col("n_bytes") == F.col("g_n_bytes"))
        grouped = F.col("members").isNotNull()
        proposed = stored(left.join(groups, same, "left").select(
            *left.columns, F.when(grouped, F.col("k_id")).otherwise(F.col("doc_id")).alias("keep_id"),
            F.when(grouped, F.col("k_sha")).otherwise(F.col("text_sha256")).alias("keep_sha"),
            F.coalesce("members", F.lit(1)).alias("members")), "proposed")
        wrong = stored(differing(texts, proposed.where("members > 1")), "differing").select(
            F.col("doc_id").alias("w_id"), F.col("text_sha256").alias("w_sha"))
        is_wrong = F.col("doc_id").eqNullSafe(F.col("w_id")) & (F.col("text_sha256") == F.col("w_sha"))
        none = wrong.isEmpty()
        settled.append(proposed if none else proposed.join(wrong, is_wrong, "left_anti"))
        if none:
            break
        left = stored(left.join(wrong, is_wrong, "left_semi"), "fingerprints")
    found = settled[0]
    for more in settled[1:]:
        found = found.unionByName(more)
    sizes = stored(found.where("members > 1").groupBy("keep_id", "keep_sha").agg(F.sum("copies").alias("size")), "sizes").select(
        F.col("keep_id").alias("s_id"), F.col("keep_sha").alias("s_sha"), "size")
    keeper = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("text_sha256") == F.col("keep_sha"))
    return (found.join(sizes, F.col("keep_id").eqNullSafe(F.col("s_id")) & (F.col("keep_sha") == F.col("s_sha")), "left")
            .withColumn("group_size", F.coalesce("size", "copies"))
            .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
            .select("doc_id", "keep_id", "group_size", (keeper & (F.col("copy") == 1)).alias("kept"), "text_sha256", "n_bytes"))


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options: object) -> DataFrame:
    """The documents of which one of each group of equal texts stays, with all their columns."""
    keep = exact_groups(docs, id_col, text_col, **options).where("kept").select(
        F.col("doc_id").alias("keep_id"), F.col("text_sha256").alias("keep_sha"))
    sha = F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary"), 256)
    rows = docs.select(F.col(id_col).alias("id"), sha.alias("sha"), F.struct("*").alias("whole"))
    rows = rows.join(keep, F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("sha") == F.col("keep_sha")), "left_semi")
    # Of repeated rows one stays as well.
    first = Window.partitionBy("id", "sha").orderBy("id")
    return rows.withColumn("nth", F.row_number().over(first)).where("nth = 1").select("whole.*")


SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256,
       strlen(coalesce(text, ''))::BIGINT AS n_bytes
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""


@register("op8_exact_dedup", SQL)
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))
