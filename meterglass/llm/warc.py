"""WARC archives as a Python data source.

Reading plans its partitions from the files' index: each is a run of records of bounded size. Filters on record type and on
indexed headers are pushed down: runs without a wanted type aren't planned. Inside a run each record's header
block is decoded first; where a pushed filter rejects it or no payload is asked for, the rest of the record is skipped unread.

A record is two gzip members, one for its headers and one for its block, as the format allows records to be split over members; the index beside
each archive holds the offsets. Writing rolls archives at a size limit; names hold the attempt, and only what a commit lists in the manifest is
read, so lost and repeated attempts leave no records.

Defined cases: a null payload counts as empty; equal payloads are one response and revisits of it, unless shorter than the limit; a null or
empty url is written as the id's own name; line breaks in a url are written percent-encoded; rows that repeat an id (null
included) are records of their own, whose names go on with the digest, the url's hash and a counter of equal rows; of equal payloads exactly one
is the response, that of the largest id (null before all others), then of the largest name; an empty table gives an empty manifest and no rows.
"""

from __future__ import annotations

import json
import posixpath
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, In, InputPartition,
                                    WriterCommitMessage)
from pyspark.sql.types import StructType

from meterglass.llm.common import register, stored, table
from meterglass.session import scratch_path

ARCHIVE_BYTES = 64 << 20
PARTITION_BYTES = 8 << 20
DATE = "2024-01-01T00:00:00Z"
WRITE_SCHEMA = "record_id string, record_type string, target_uri string, refers_to string, payload_digest string, " \
               "payload_length long, payload binary"
READ_SCHEMA = WRITE_SCHEMA + ", warc_date string"
#: Columns whose headers the reader can test before a payload is decoded.
HEADERS = {"record_id": "WARC-Record-ID", "record_type": "WARC-Type", "target_uri": "WARC-Target-URI",
           "refers_to": "WARC-Refers-To", "payload_digest": "WARC-Payload-Digest", "warc_date": "WARC-Date"}


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{posixpath.abspath(path)}")


def http_block(payload: bytes) -> bytes:
    return b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload) + payload


def member(data: bytes) -> bytes:
    packer = zlib.compressobj(3, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def record(row: Row) -> tuple[bytes, bytes]:
    """Header and block of a record, each a gzip member."""
    head = ["WARC/1.1", f"WARC-Type: {row.record_type}", f"WARC-Record-ID: {row.record_id}", f"WARC-Date: {DATE}",
            f"WARC-Target-URI: {row.target_uri}", f"WARC-Payload-Digest: sha1:{row.payload_digest}",
            f"X-Payload-Length: {row.payload_length}"]
    if row.record_type == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {row.refers_to}"]
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    else:
        block = http_block(bytes(row.payload or b""))
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return member(("\r\n".join(head) + "\r\n\r\n").encode()), member(block + b"\r\n\r\n")


@dataclass
class Written(WriterCommitMessage):
    files: list[dict]


class WarcWriter(DataSourceWriter):
    def __init__(self, path: str, archive_bytes: int):
        self.path, self.archive_bytes = path, archive_bytes

    def write(self, iterator: Iterator[Row]) -> Written:
        fs, root = file_system(self.path)
        fs.create_dir(root, recursive=True)
        attempt = f"{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}"
        files, out, runs = [], None, []

        def close() -> None:
            out.close()
            files.append({"name": name, "runs": runs})

        for row in iterator:
            if out is None or at >= self.archive_bytes:
                if out is not None:
                    close()
                name, at, runs = f"{attempt}-{len(files):05d}.warc.gz", 0, []
                out = fs.open_output_stream(f"{root}/{name}", compression=None)
            head, block = record(row)
            if not runs or at - runs[-1]["at"] >= PARTITION_BYTES:
                runs.append({"at": at, "types": [], "lengths": []})
            run = runs[-1]
            if row.record_type not in run["types"]:
                run["types"].append(row.record_type)
            run["lengths"] += [len(head), len(block)]
            out.write(head)
            out.write(block)
            at += len(head) + len(block)
        if out is not None:
            close()
        # Offsets go beside the archives, not to the driver.
        for f in files:
            with fs.open_output_stream(f"{root}/{f['name']}.index", compression=None) as index:
                index.write(json.dumps(f["runs"]).encode())
        return Written([{"name": f["name"], "runs": [[r["at"], sum(r["lengths"]), i, r["types"]] for i, r in enumerate(f["runs"])]}
                        for f in files])

    def commit(self, messages: list[Written | None]) -> None:
        fs, root = file_system(self.path)
        fs.create_dir(root, recursive=True)
        with fs.open_output_stream(f"{root}/manifest.json", compression=None) as out:
            for m in messages:
                for f in m.files if m else []:
                    out.write((json.dumps(f) + "\n").encode())

    def abort(self, messages: list[Written | None]) -> None:
        """Nothing to undo: archives that no manifest lists aren't read."""


@dataclass
class Run(InputPartition):
    name: str
    at: int
    n_bytes: int
    number: int


class WarcReader(DataSourceReader):
    def __init__(self, path: str, columns: list[str], payloads: bool):
        self.path, self.columns, self.payloads = path, columns, payloads
        self.tests: list[tuple[str, frozenset]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Equality and membership on header columns are tested here; the rest goes back to Spark."""
        for f in filters:
            if isinstance(f, EqualTo) and len(f.attribute) == 1 and f.attribute[0] in HEADERS and isinstance(f.value, str):
                self.tests.append((f.attribute[0], frozenset([f.value])))
            elif isinstance(f, In) and len(f.attribute) == 1 and f.attribute[0] in HEADERS and all(isinstance(v, str) for v in f.value):
                self.tests.append((f.attribute[0], frozenset(f.value)))
            else:
                yield f

    def partitions(self) -> list[Run]:
        fs, root = file_system(self.path)
        types = [wanted for column, wanted in self.tests if column == "record_type"]
        with fs.open_input_stream(f"{root}/manifest.json", compression=None) as manifest:
            files = [json.loads(line) for line in manifest.read().splitlines()]
        out = [Run(f["name"], at, n, number) for f in files for at, n, number, has in f["runs"]
               if all(wanted & set(has) for wanted in types)]
        return out or [Run("", 0, 0, 0)]

    def read(self, partition: Run) -> Iterator[tuple]:
        if not partition.name:
            return
        fs, root = file_system(self.path)
        with fs.open_input_stream(f"{root}/{partition.name}.index", compression=None) as index:
            lengths = json.loads(index.read())[partition.number]["lengths"]
        with fs.open_input_file(f"{root}/{partition.name}") as archive:
            at = partition.at
            for head_bytes, block_bytes in zip(lengths[::2], lengths[1::2]):
                head = zlib.decompress(archive.read_at(head_bytes, at), 31).decode()
                fields = dict(line.split(": ", 1) for line in head.split("\r\n")[1:] if line)
                row = {c: fields.get(h) for c, h in HEADERS.items()}
                row["payload_digest"] = (row["payload_digest"] or "").removeprefix("sha1:")
                row["payload_length"], row["payload"] = int(fields["X-Payload-Length"]), None
                if all(row[c] in wanted for c, wanted in self.tests):
                    if self.payloads and row["record_type"] == "response":
                        block = zlib.decompress(archive.read_at(block_bytes, at + head_bytes), 31)
                        block = block[:int(fields["Content-Length"])]
                        row["payload"] = block[block.index(b"\r\n\r\n") + 4:]
                    yield tuple(row[c] for c in self.columns)
                at += head_bytes + block_bytes


class WarcDataSource(DataSource):
    """Options: path; payloads (true: decode the payloads of responses); archive_bytes (where writing begins a new archive)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return READ_SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(self.options["path"], schema.names, self.options.get("payloads", "true").lower() == "true")

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"], int(self.options.get("archive_bytes", ARCHIVE_BYTES)))


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: four characters for each 20 bits."""
    digest = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def to_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
               least_bytes: int = 0, keep_largest: bool = True) -> DataFrame:
    """Records in WRITE_SCHEMA: of equal payloads one is the response, the others revisit it.

    Only payloads that occur twice or more are looked up; a payload that a third of all pages share is a skewed join
    with one short row, which adaptive execution splits.
    """
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = named(rows.withColumns({"payload_digest": base32_sha1(F.col("payload")), "payload_length": F.octet_length("payload").cast("long")}))
    known, pick = (F.col("page_id").isNotNull(), F.max) if keep_largest else (F.col("page_id").isNull(), F.min)
    shared = stored(rows.groupBy("payload_digest", "payload_length")
                    .agg(pick(F.struct(known.alias("known"), "page_id", "name")).alias("first"), F.count("*").alias("n"))
                    .where((F.col("n") > 1) & (F.col("payload_length") >= least_bytes)), "payloads")
    shared = shared.select(F.col("payload_digest").alias("d"), F.col("payload_length").alias("l"), F.col("first.name").alias("first_name"))
    rows = rows.join(shared, (F.col("payload_digest") == F.col("d")) & (F.col("payload_length") == F.col("l")), "left")
    revisit = F.col("first_name").isNotNull() & (F.col("name") != F.col("first_name"))

    def urn(c: str) -> Column:
        return F.concat(F.lit("<"), F.col(c), F.lit(">"))

    url = F.regexp_replace(F.regexp_replace(F.trim("url"), "\r", "%0D"), "\n", "%0A")
    return rows.select(
        urn("name").alias("record_id"), F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.coalesce(F.when(url != "", url), F.col("name")).alias("target_uri"), F.when(revisit, urn("first_name")).alias("refers_to"),
        "payload_digest", "payload_length", F.when(~revisit, F.col("payload")).alias("payload"))


def named(rows: DataFrame) -> DataFrame:
    """The rows with a name each.

    An id that one row has is its name. Rows of other ids are grouped by all they hold, counted before the shuffle, and written out
    again with a counter, so neither a frequent id nor a frequent row makes a heavy task. The ids looked up are a written table; a
    small one, as usual, is held by the tasks and moves no payload.
    """
    name = F.concat(F.lit("urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")))
    repeated = stored(rows.groupBy("page_id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("page_id").alias("again")), "repeated_ids")
    same = F.col("page_id").eqNullSafe(F.col("again"))
    equal = (rows.join(repeated, same, "left_semi").groupBy("page_id", "url", "payload_digest", "payload_length")
             .agg(F.any_value("payload").alias("payload"), F.count("*").alias("n")))
    place = F.concat_ws("-", "payload_digest", F.hex(F.xxhash64("url")), "place")
    equal = equal.withColumn("place", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1))).withColumn("name", F.concat(name, F.lit("#"), place))
    return rows.join(repeated, same, "left_anti").withColumn("name", name).unionByName(equal.drop("place", "n"))


def use_warc(spark: SparkSession) -> None:
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def write_warc(records: DataFrame, path: str) -> None:
    use_warc(records.sparkSession)
    records.write.format("warc").mode("append").option("path", path).save()


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    use_warc(spark)
    return spark.read.format("warc").option("path", path).option("payloads", str(payloads).lower()).load()


def page_id(column: str) -> Column:
    return F.regexp_extract(column, "^<urn:page:([^#>]*)", 1).try_cast("long")


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
hashed AS (SELECT page_id, strlen(body)::BIGINT AS payload_bytes, sha1(body) AS h, max(page_id) OVER (PARTITION BY body) AS first,
  row_number() OVER (PARTITION BY body ORDER BY page_id DESC NULLS LAST) AS place FROM p)
SELECT page_id, payload_bytes,
  translate(list_aggregate(list_transform(range(8), lambda i: lpad(to_base(('0x' || substr(h, 1 + 5 * i::INT, 5))::BIGINT, 32), 4, '0')),
                           'string_agg', ''), '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
  CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN place > 1 THEN first END AS refers_to
FROM hashed
"""


@register("op6_warc", SQL)
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses are judged by the payloads read back, revisits by their headers alone."""
    path = scratch_path(spark, "warc")
    write_warc(to_records(table(spark, sf_dir, "pages")), path)
    responses = read_warc(spark, path).where("record_type = 'response'").select(
        page_id("record_id").alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32_sha1(F.col("payload")).alias("payload_digest"), "record_type", page_id("refers_to").alias("refers_to"))
    revisits = read_warc(spark, path, payloads=False).where("record_type = 'revisit'").select(
        page_id("record_id").alias("page_id"), F.col("payload_length").alias("payload_bytes"),
        "payload_digest", "record_type", page_id("refers_to").alias("refers_to"))
    return responses.unionByName(revisits)
