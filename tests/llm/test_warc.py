"""The WARC data source: round trips, skipping, planning, foreign files."""

import gzip
import hashlib
import json
import os

import pyarrow.fs as pafs
import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, In, IsNotNull, Not, StringStartsWith

from pricecraft.llm import warc

PAGES = "page_id long, url string, html string, payload string"


def brute(rows):
    first = {}
    for i, _, html, *_ in rows:
        b = (html or "").encode()
        if len(b) >= 100 and i is not None:
            first[b] = min(first.get(b, i), i)
    out = []
    for i, _, html, *_ in rows:
        b = (html or "").encode()
        f = first.get(b, i)
        out.append((i, len(b), hashlib.sha256(b).hexdigest(), "response" if f == i else "revisit", None if f == i else f))
    return sorted(out, key=str)


def result(spark, path):
    return sorted((tuple(r) for r in warc.read_pages(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


def test_archives_of_odd_pages(spark, tmp_path):
    same, short = "é<p>copy</p>" * 20, "x" * 99
    rows = [(5, "http://a/ b\r\nEvil: 1", same, "p"), (3, None, same, None), (9, "u", same, "p"), (9, "u", same, "p"), (None, "n", same, "p"),
            (1, "u", short, "p"), (2, "u", short, "p"), (4, "u", None, "p"), (6, "u", "", "p"), (7, "u", "\r\n\r\n" * 40, "p"), (8, "ü", "WARC/1.1\r\n" * 30, "p"),
            (-10, "u", "y" * 100, "p"), (-11, "u", "y" * 100, "p"), (20, "u", "long " * 1_000_000, "p"), (30, "u", "z" * 200, "p"), (30, "u", "z" * 200, "p"),
            (None, "u", "only null " * 20, "p"), (None, "u", "only null " * 20, "p")]
    df = spark.createDataFrame(rows, PAGES).repartition(5)
    for k, options in enumerate(({}, {"compression": "none"}, {"split_bytes": 500, "file_bytes": 3000, "level": 6})):
        path = warc.archive_pages(df, f"file://{tmp_path}/{k}", **options)
        assert result(spark, path) == brute(rows)
    back = {r.record_id: bytes(r.payload) for r in warc.read_warc(spark, path).where("record_type = 'response' AND record_id LIKE 'urn:page:%'").collect()}
    assert back["urn:page:20"] == b"long " * 1_000_000 and back["urn:page:8"] == b"WARC/1.1\r\n" * 30 and back["urn:page:4"] == b""
    assert warc.read_warc(spark, path).where("record_type = 'revisit'").where("payload IS NOT NULL").count() == 0


def test_empty_table(spark, tmp_path):
    path = warc.archive_pages(spark.createDataFrame([], PAGES), f"{tmp_path}/e")
    assert result(spark, path) == []


def test_all_joins_by_shuffle_give_the_same(spark, tmp_path):
    rows = [(i, "u", f"{i % 3} " * 100) for i in range(60)]
    df = spark.createDataFrame([(*r, None) for r in rows], PAGES)
    spark.conf.set("pricecraft.broadcast.maxRows", "1")
    try:
        assert result(spark, warc.archive_pages(df, f"{tmp_path}/s")) == brute(rows)
    finally:
        spark.conf.unset("pricecraft.broadcast.maxRows")


def test_conditions_reach_the_reader_and_spare_payloads(spark, tmp_path):
    df = spark.createDataFrame([(i, f"http://h{i % 4}/", f"page {i} " * 3000, None) for i in range(40)], PAGES)
    path = warc.archive_pages(df, f"{tmp_path}/p")
    read = warc.read_warc(spark, path).where("target_uri = 'http://h1/'")
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "BatchScan warc" in plan and "Filter " not in plan              # all of the condition went to the reader
    assert read.count() == 10
    assert read.where("record_id IN ('urn:page:1', 'urn:page:2') AND payload IS NOT NULL").count() == 1
    # the same in the reader alone: which payloads were decoded
    schema = spark.createDataFrame([], warc.SCHEMA).schema
    r = warc.WarcReader({"path": path}, schema)
    left = list(r.pushFilters([EqualTo(("target_uri",), "http://h1/"), IsNotNull(("payload",)), Not(In(("record_id",), ("urn:page:1",)))]))
    assert [type(f) for f in left] == [IsNotNull] and len(r.tests) == 2
    fs, _ = warc.file_system(path)
    decoded, seen, wanted = 0, 0, 0
    for p in r.partitions():
        for name, lo, hi in p.pieces:
            with fs.open_input_file(name) as f:
                records = warc.Records(f, lo, hi)
                for head, block in records:
                    seen += 1
                    row = warc.head_columns(head)
                    if all(t(row) for t in r.tests):
                        wanted += len(warc.payload_of(head, block()))
                decoded += records.decoded
    assert seen >= 41 and 0 < wanted <= decoded <= wanted + 9 * 200
    assert not warc._test(StringStartsWith(("target_uri",), "x"))({"target_uri": None})


def test_partitions_are_cut_at_records_and_packed(spark, tmp_path):
    df = spark.createDataFrame([(i, "u", os.urandom(2000).hex(), None) for i in range(200)], PAGES).coalesce(1)
    path = warc.archive_pages(df, f"{tmp_path}/c", split_bytes=50_000)
    schema = spark.createDataFrame([], warc.SCHEMA).schema
    many = warc.WarcReader({"path": path, "split_bytes": "50000"}, schema).partitions()
    assert len(many) > 4 and all(len(p.pieces) == 1 for p in many)
    ids = [x for p in many for b in warc.WarcReader({"path": path}, schema).read(p) for x in b.column(0).to_pylist() if x.startswith("urn:page")]
    assert sorted(ids) == sorted(f"urn:page:{i}" for i in range(200))
    assert len(warc.WarcReader({"path": path, "split_bytes": str(1 << 30)}, schema).partitions()) == 1


def test_files_outside_the_manifest_are_not_read_and_append_keeps_the_old(spark, tmp_path):
    path = f"{tmp_path}/m"
    first, second = (spark.createDataFrame([(i, "u", "h", None)], PAGES) for i in (1, 2))
    warc.archive_pages(first, path)
    with open(f"{path}/part-lost.warc.gz", "wb") as f:
        f.write(b"half a rec")
    warc.archive_pages(second, path)
    assert [r[0] for r in result(spark, path)] == [1, 2]
    warc.WarcWriter({"path": path}, False).abort([None])
    warc.page_records(first).write.format("warc").mode("overwrite").save(path)
    assert [r[0] for r in result(spark, path)] == [1] and len(json.load(open(f"{path}/{warc.MANIFEST}"))) >= 1


def test_archives_of_other_writers(spark, tmp_path):
    """Members without lengths, several in a row, plain files, continued header lines, other kinds of record."""
    rec = lambda kind, uri, body, more="": (f"WARC/1.0\r\nWARC-Type: {kind}\r\nwarc-target-uri: {uri}\r\n{more}Content-Length: {len(body)}\r\n\r\n").encode() + body + b"\r\n\r\n"
    http = b"HTTP/1.1 200 OK\r\nX: y\r\n\r\nbody \xff\x00"
    recs = [rec("warcinfo", "", b"a: b"), rec("response", "http://x/", http, "Content-Type: application/http;\r\n msgtype=response\r\n"),
            rec("resource", "http://y/", b"r" * 9000), rec("metadata", "m", b""), rec("response", "http://z/", os.urandom(20_000), "X-Long: " + "q" * 9000 + "\r\n")]
    for name, data in (("a.warc.gz", b"".join(map(gzip.compress, recs))), ("b.warc", b"".join(recs))):
        os.makedirs(f"{tmp_path}/{name}-d")
        with open(f"{tmp_path}/{name}-d/{name}", "wb") as f:
            f.write(data)
        rows = {r.target_uri: r for r in warc.read_warc(spark, f"{tmp_path}/{name}-d").collect()}
        assert len(rows) == 5 and bytes(rows["http://x/"].payload) == b"body \xff\x00" and bytes(rows["http://y/"].payload) == b"r" * 9000
        assert len(rows["http://z/"].payload) == 20_000 and rows["m"].record_type == "metadata"
        assert warc.read_warc(spark, f"{tmp_path}/{name}-d/{name}", ["target_uri"]).where(F.col("target_uri") >= "http://y/").count() == 3


def test_gzip_members_are_standard(tmp_path):
    data = b"".join(warc.gzip_member(x, 1) for x in (b"one", b"two" * 1000))
    assert gzip.decompress(data) == b"one" + b"two" * 1000


def test_broken_archives_and_unknown_columns_raise(spark, tmp_path):
    member = warc.gzip_member(warc.record_bytes({"record_type": "response", "payload": os.urandom(50_000)}), 1)
    with open(f"{tmp_path}/x.warc.gz", "wb") as f:
        f.write(member[:20_000])
    with pytest.raises(Exception, match="cut short"):
        warc.read_warc(spark, f"{tmp_path}/x.warc.gz").collect()
    with pytest.raises(Exception, match="not columns"):
        warc.write_warc(spark.createDataFrame([(1,)], "page_id long"), f"{tmp_path}/y")
    assert isinstance(warc.file_system("file:/tmp")[0], pafs.LocalFileSystem)
