import base64
import gzip
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from meterglass.llm import warc
from meterglass.llm.common import ship
from meterglass.session import scratch_path

PAGES = [(1, "http://a.example/", "<p>one</p>"), (2, "http://b.example/x y", "<p>one</p>"), (3, None, None), (4, "", ""),
         (5, "http://c.example/\r\nWARC-Type: evil", "é" * 50_000), (6, "http://d.example", "a\r\n\r\nb"), (None, None, "<p>one</p>"), (7, "http://e.example", "z")]


def plain(pages, least=0):
    groups = {}
    for i, _, html in pages:
        groups.setdefault(html or "", []).append(i)
    for i, _, html in pages:
        body, ids = (html or "").encode(), groups[html or ""]
        first = max((x for x in ids if x is not None), default=None)
        revisit = len(body) >= least and i != first and len(ids) > 1
        yield (i, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if revisit else "response", first if revisit else None)


def written(spark, pages, **options):
    ship(spark)
    path = scratch_path(spark, "warc-test")
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("payload", F.lit(1)).withColumn("n", F.lit(2))
    warc.write_warc(warc.to_records(frame.repartition(3), **options), path)
    return path


@pytest.mark.parametrize("pages,least", [(PAGES, 0), (PAGES, 5), ([], 0)])
def test_round_trip(spark, pages, least):
    path = written(spark, pages, least_bytes=least)
    got = warc.read_warc(spark, path).collect()
    found = sorted(((int(r.record_id[10:-1]) if r.record_id[10:-1] else None, r.payload_length, r.payload_digest, r.record_type,
                     int(r.refers_to[10:-1]) if r.refers_to else None) for r in got), key=str)
    assert found == sorted(plain(pages, least), key=str)
    bodies = {i: (html or "").encode() for i, _, html in pages}
    for r in got:
        i = int(r.record_id[10:-1]) if r.record_id[10:-1] else None
        assert (bytes(r.payload) == bodies[i]) if r.record_type == "response" else r.payload is None


@pytest.mark.parametrize("largest", [True, False])
def test_repeated_ids_have_records_of_their_own(spark, largest):
    pages = [(7, "u", "z"), (7, "u", "z"), (7, "v", "z"), (7, "u", "y"), (3, "u", "z"), (9, "u", "y"), (9, None, ""), (9, None, None),
             (None, "u", "q"), (None, "u", "q"), (None, None, "q"), (None, "u", "z"), (5, "w", "only")]
    path = written(spark, pages, keep_largest=largest)
    got = warc.read_warc(spark, path).withColumns({"id": warc.page_id("record_id"), "to": warc.page_id("refers_to")}).collect()
    names = {r.record_id: r for r in got}
    assert len(names) == len(got) == len(pages)
    digest = {html or "": base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode() for _, _, html in pages}
    assert sorted((r.id or 0, r.payload_digest) for r in got) == sorted((i or 0, digest[html or ""]) for i, _, html in pages)
    for body in digest:
        rows = [r for r in got if r.payload_digest == digest[body]]
        response, = [r for r in rows if r.record_type == "response"]
        assert bytes(response.payload).decode() == body
        ids = [i for i, _, html in pages if (html or "") == body and i is not None]
        assert response.id == ((max if largest else min)(ids) if ids else None)
        assert all(r.refers_to == response.record_id and r.to == response.id for r in rows if r is not response)
    assert "<urn:page:5>" in names and "<urn:page:3>" in names


def test_filters_are_pushed_and_payloads_skipped(spark):
    path = written(spark, PAGES)
    some = warc.read_warc(spark, path, payloads=False).where("record_type = 'response' AND target_uri = 'http://e.example'")
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "Filter (" not in plan.replace("PushedFilters", "") or "isnotnull" in plan
    assert [(r.record_id, r.payload) for r in some.collect()] == [("<urn:page:7>", None)]
    assert warc.read_warc(spark, path).where("record_type = 'request'").count() == 0


def test_reader_plans_runs_and_prunes_by_type(tmp_path):
    root = str(tmp_path)
    (tmp_path / "manifest.json").write_text(json.dumps({"name": "x.warc.gz", "runs": [[0, 10, 0, ["response"]], [10, 5, 1, ["revisit"]]]}) + "\n")
    reader = warc.WarcReader(root, ["record_id"], True)
    assert len(reader.partitions()) == 2
    rest = list(reader.pushFilters([warc.EqualTo(("record_type",), "revisit"), warc.EqualTo(("payload_length",), 3)]))
    assert [f.attribute for f in rest] == [("payload_length",)]
    assert [(p.at, p.number) for p in reader.partitions()] == [(10, 1)]


def test_archives_are_gzip_members(spark):
    path = written(spark, PAGES)
    fs, root = warc.file_system(path)
    names = [json.loads(x)["name"] for x in open(f"{root}/manifest.json")]
    text = b"".join(gzip.open(f"{root}/{n}").read() for n in names)
    assert text.count(b"WARC/1.1\r\n") == len(PAGES) and b"\r\nWARC-Type: evil" not in text
