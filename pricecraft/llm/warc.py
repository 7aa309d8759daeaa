"""WARC archives as a PySpark data source (operator 13).

``spark.read.format("warc")`` and ``df.write.format("warc")`` after
``register(spark)``.  Records are gzip members of their own (or plain), and a
member's header holds its compressed length (the ``sl`` field of the WARC
standard's annex), so a record can be left without reading it to its end.

Reading: the driver plans file partitions, cut at record starts that the writer
noted and packed to about ``split_bytes``.  Conditions on header columns
(everything but ``payload``) are pushed down.  A record's headers are parsed
first, from the first few KB of its member; the payload is decoded only if the
conditions hold and ``payload`` is in the schema.

Writing: each task writes files of its own name; the commit lists the finished
ones in ``_manifest.json``, and readers follow it, so files of lost or repeated
tasks are never read.  Files are opened with pyarrow's file systems (local,
HDFS, S3, GCS), on executors and, for listing and commit, on the driver.

Edge cases: null fields give no header and null payloads are empty; control
characters and blanks in header values are percent-encoded; an empty table
gives an archive without records; payloads of any length up to 2 GB are kept
whole; columns of other names are an error on writing.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, GreaterThan, GreaterThanOrEqual, In,
                                    InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual, Not, StringContains, StringEndsWith, StringStartsWith,
                                    WriterCommitMessage)

from ..operators.joins import checked_broadcast
from .common import scratch_path

SCHEMA = "record_id string, record_type string, target_uri string, warc_date string, refers_to string, payload_digest string, payload_bytes bigint, payload binary"
#: Header of each column (fixed names of the format).
HEADERS = {"record_id": "WARC-Record-ID", "record_type": "WARC-Type", "target_uri": "WARC-Target-URI", "warc_date": "WARC-Date",
           "refers_to": "WARC-Refers-To", "payload_digest": "WARC-Payload-Digest", "payload_bytes": "WARC-Payload-Length"}
IN_BRACKETS = ("record_id", "refers_to")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "_manifest.json"
DEFAULT_DATE = "2000-01-01T00:00:00Z"
SPLIT_BYTES = 32 << 20
OPEN_BYTES = 1 << 20            # what opening a file counts as, when partitions are packed
FILE_BYTES = 1 << 30
HEAD_BYTES = 4096
BATCH_BYTES = 4 << 20
BATCH_ROWS = 4096
_END = b"\r\n\r\n"


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("s3a://"):
        path = "s3://" + path[6:]
    if path.startswith("file:/") and not path.startswith("file:///"):
        path = "file:///" + path[6:].lstrip("/")
    return pafs.FileSystem.from_uri(path)


# ---------------------------------------------------------------- records

def _value(x: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in str(x))


def record_bytes(row: dict) -> bytes:
    """One record.  Responses and revisits hold an HTTP message; a revisit's has
    headers only."""
    payload = row.get("payload") or b""
    kind = row.get("record_type") or "resource"
    block, mime = payload, "application/octet-stream"
    if kind in ("response", "revisit"):
        size = row.get("payload_bytes")
        http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload) if size is None else size}\r\n\r\n".encode()
        block, mime = http + (payload if kind == "response" else b""), "application/http; msgtype=response"
    elif kind == "warcinfo":
        mime = "application/warc-fields"
    head = ["WARC/1.1"]
    for c, name in HEADERS.items():
        v = row.get(c)
        if v is not None:
            v = f"sha256:{_value(v)}" if c == "payload_digest" else _value(v)
            head.append(f"{name}: <{v}>" if c in IN_BRACKETS else f"{name}: {v}")
    if kind == "revisit":
        head.append(f"WARC-Profile: {REVISIT_PROFILE}")
    head += [f"Content-Type: {mime}", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + _END + block + _END


def gzip_member(data: bytes, level: int) -> bytes:
    """A gzip member whose ``sl`` field has its length and the record's."""
    z = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = z.compress(data) + z.flush()
    size = 24 + len(body) + 8
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H2sHII", 12, b"sl", 8, size, len(data)) \
        + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def parse_head(text: bytes) -> dict[str, str]:
    """Header names in lower case; continued lines are joined."""
    out: dict[str, str] = {}
    last = None
    for line in text.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and last:
            out[last] += " " + line.strip()
            continue
        name, _, v = line.partition(":")
        last = name.strip().lower()
        out[last] = v.strip()
    return out


def head_columns(head: dict[str, str]) -> dict:
    row = {c: head.get(h.lower()) for c, h in HEADERS.items()}
    for c in IN_BRACKETS:
        if row[c]:
            row[c] = row[c].removeprefix("<").removesuffix(">")
    if row["payload_digest"]:
        row["payload_digest"] = row["payload_digest"].split(":", 1)[-1]
    row["payload_bytes"] = int(row["payload_bytes"]) if row["payload_bytes"] else None
    return row


def payload_of(head: dict[str, str], block: bytes) -> bytes | None:
    if head.get("warc-type") == "revisit":
        return None
    if head.get("content-type", "").startswith("application/http"):
        at = block.find(_END)
        return block[at + 4:] if at >= 0 else b""
    return block


class Records:
    """Records of a file between two record starts: headers first, payload
    only on demand."""

    def __init__(self, file: pa.NativeFile, start: int, end: int):
        self.file, self.at, self.end = file, start, end
        self.decoded = 0                # payload bytes that were decoded

    def __iter__(self):
        while self.at < self.end:
            self.file.seek(self.at)
            first = self.file.read(HEAD_BYTES)
            if not first.strip():
                return
            yield from self._member(first) if first[:2] == b"\x1f\x8b" else self._plain(first)

    def _member(self, first: bytes):
        size = None
        if first[3] & 4 and first[12:14] == b"sl":
            size = struct.unpack("<I", first[16:20])[0]
        z = zlib.decompressobj(31)
        text, rest, read = z.decompress(first, HEAD_BYTES), z.unconsumed_tail, len(first)
        while _END not in text and not z.eof:
            if not rest:
                rest = self.file.read(HEAD_BYTES)
                read += len(rest)
                if not rest:
                    raise ValueError(f"record at {self.at} ends inside its headers")
            text += z.decompress(rest, HEAD_BYTES)
            rest = z.unconsumed_tail
        cut = text.index(_END)
        head = parse_head(text[:cut])
        start = self.at
        done = {}

        def whole() -> bytes:
            # the rest of the member
            parts, tail, pos = [text[cut + 4:]], rest, start + read
            self.file.seek(pos)
            while not z.eof:
                if not tail:
                    tail = self.file.read(1 << 16 if size is None else max(1, start + size - pos))
                    pos += len(tail)
                    if not tail:
                        raise ValueError(f"record at {start} is cut short")
                parts.append(z.decompress(tail))
                tail = z.unconsumed_tail
            done["end"] = pos - len(z.unused_data)
            return b"".join(parts)

        def block() -> bytes:
            b = whole()[:int(head.get("content-length", 0))]
            self.decoded += len(b)
            return b

        yield head, block
        if size is not None:
            self.at = start + size
        else:
            if "end" not in done:
                whole()
            self.at = done["end"]

    def _plain(self, first: bytes):
        text = first
        while _END not in text:
            more = self.file.read(HEAD_BYTES)
            if not more:
                raise ValueError(f"record at {self.at} ends inside its headers")
            text += more
        cut = text.index(_END)
        head = parse_head(text[:cut])
        body, n = self.at + cut + 4, int(head.get("content-length", 0))

        def block() -> bytes:
            self.file.seek(body)
            b = self.file.read(n)
            if len(b) < n:
                raise ValueError(f"record at {body} is cut short")
            self.decoded += n
            return b

        yield head, block
        self.at = body + n + 4


# ---------------------------------------------------------------- conditions

def _test(f):
    """The condition as a function of header columns, or None if it can't be
    decided from them.  SQL's three values: None is unknown."""
    if isinstance(f, Not):
        inner = _test(f.child)
        return inner and (lambda row: None if (x := inner(row)) is None else not x)
    if not hasattr(f, "attribute") or len(f.attribute) != 1 or f.attribute[0] not in HEADERS:
        return None
    c = f.attribute[0]
    if isinstance(f, IsNull):
        return lambda row: row[c] is None
    if isinstance(f, IsNotNull):
        return lambda row: row[c] is not None
    v = f.value
    if isinstance(f, EqualNullSafe):
        return lambda row: row[c] == v
    ops = {EqualTo: lambda x: x == v, GreaterThan: lambda x: x > v, GreaterThanOrEqual: lambda x: x >= v, LessThan: lambda x: x < v,
           LessThanOrEqual: lambda x: x <= v, StringStartsWith: lambda x: x.startswith(v), StringEndsWith: lambda x: x.endswith(v),
           StringContains: lambda x: v in x}
    if isinstance(f, In):
        if any(x is None for x in v):
            return None
        return lambda row: None if row[c] is None else row[c] in v
    # strings compare by UTF-8 bytes in Spark, as code points do here
    return (lambda row, op=ops[type(f)]: None if row[c] is None else op(row[c])) if type(f) in ops and v is not None else None


# ---------------------------------------------------------------- data source

class Ranges(InputPartition):
    """(file, start, end) pieces of one task."""

    def __init__(self, pieces: list[tuple[str, int, int]]):
        self.pieces = pieces


class WarcReader(DataSourceReader):
    def __init__(self, options: dict, schema):
        self.path, self.schema = options["path"], schema
        self.split = int(options.get("split_bytes", SPLIT_BYTES))
        self.tests: list = []

    def pushFilters(self, filters):
        for f in filters:
            test = _test(f)
            if test:
                self.tests.append(test)
            else:
                yield f

    def files(self) -> list[tuple[str, int, list[int]]]:
        """(path, size, record starts to cut at)."""
        fs, root = file_system(self.path)
        if fs.get_file_info(root).is_file:
            return [(root, fs.get_file_info(root).size, [])]
        if fs.get_file_info(f"{root}/{MANIFEST}").is_file:
            with fs.open_input_stream(f"{root}/{MANIFEST}") as f:
                return [(f"{root}/{n}", size, cuts) for n, size, cuts in json.loads(f.read())]
        found = fs.get_file_info(pafs.FileSelector(root, recursive=True))
        return sorted((x.path, x.size, []) for x in found if x.is_file and x.path.endswith((".warc", ".warc.gz")))

    def partitions(self):
        out, pieces, held = [], [], 0
        for path, size, cuts in self.files():
            bounds = [0, *cuts, size]
            for lo, hi in zip(bounds, bounds[1:]):
                if pieces and held + hi - lo + OPEN_BYTES > self.split:
                    out.append(Ranges(pieces))
                    pieces, held = [], 0
                if hi > lo:
                    pieces.append((path, lo, hi))
                    held += hi - lo + OPEN_BYTES
        return [*out, Ranges(pieces)]

    def read(self, partition):
        fs, _ = file_system(self.path)
        names = [f.name for f in self.schema.fields]
        kinds = pa.schema([(n, {"payload": pa.binary(), "payload_bytes": pa.int64()}.get(n, pa.string())) for n in names])
        rows, held = [], 0

        def batch():
            return pa.RecordBatch.from_pylist(rows, schema=kinds)

        for path, lo, hi in partition.pieces:
            with fs.open_input_file(path) as f:
                for head, block in Records(f, lo, hi):
                    row = head_columns(head)
                    if not all(t(row) for t in self.tests):
                        continue
                    if "payload" in names:
                        row["payload"] = payload_of(head, block())
                        held += len(row["payload"] or b"")
                    rows.append(row)
                    if held >= BATCH_BYTES or len(rows) >= BATCH_ROWS:
                        yield batch()
                        rows, held = [], 0
        if rows:
            yield batch()


class Written(WriterCommitMessage):
    def __init__(self, files: list[tuple[str, int, list[int]]]):
        self.files = files


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.level = int(options.get("level", 1))
        self.packed = options.get("compression", "gzip") == "gzip"
        self.split, self.most = int(options.get("split_bytes", SPLIT_BYTES)), int(options.get("file_bytes", FILE_BYTES))

    def write(self, iterator):
        fs, root = file_system(self.path)
        fs.create_dir(root, recursive=True)
        files, out = [], None
        name, size, cuts = "", 0, []
        try:
            for batch in iterator:
                for row in batch.to_pylist():
                    if out is not None and size >= self.most:
                        out.close()
                        files.append((name, size, cuts))
                        out = None
                    if out is None:
                        name, size, cuts = f"part-{uuid.uuid4().hex}.warc" + ".gz" * self.packed, 0, []
                        out = fs.open_output_stream(f"{root}/{name}", compression=None)
                        info = {"record_type": "warcinfo", "record_id": f"urn:uuid:{uuid.uuid4()}", "warc_date": DEFAULT_DATE, "payload": b"format: WARC File Format 1.1\r\n"}
                        size += self._put(out, info)
                    if size >= (cuts[-1] if cuts else 0) + self.split:
                        cuts.append(size)
                    size += self._put(out, row)
        finally:
            if out is not None:
                out.close()
        if out is not None:
            files.append((name, size, cuts))
        return Written(files)

    def _put(self, out, row: dict) -> int:
        data = record_bytes(row)
        data = gzip_member(data, self.level) if self.packed else data
        out.write(data)
        return len(data)

    def commit(self, messages):
        fs, root = file_system(self.path)
        fs.create_dir(root, recursive=True)
        old, where = [], f"{root}/{MANIFEST}"
        if fs.get_file_info(where).is_file:
            with fs.open_input_stream(where) as f:
                old = json.loads(f.read())
        new = [x for m in messages if m is not None for x in m.files]
        with fs.open_output_stream(where, compression=None) as f:
            f.write(json.dumps([*([] if self.overwrite else old), *new]).encode())
        for n, *_ in old if self.overwrite else []:
            fs.delete_file(f"{root}/{n}")

    def abort(self, messages):
        fs, root = file_system(self.path)
        for m in messages:
            for n, *_ in m.files if m is not None else []:
                fs.delete_file(f"{root}/{n}")


class WarcSource(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        known = {x.split()[0] for x in SCHEMA.split(", ")}
        if odd := [f.name for f in schema.fields if f.name not in known]:
            raise ValueError(f"not columns of a WARC record: {odd}")
        return WarcReader(self.options, schema)

    def writer(self, schema, overwrite):
        known = {x.split()[0] for x in SCHEMA.split(", ")}
        if odd := [f.name for f in schema.fields if f.name not in known]:
            raise ValueError(f"not columns of a WARC record: {odd}")
        return WarcWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    """Make the format known to the session, with conditions pushed down."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read_warc(spark: SparkSession, path: str, columns: list[str] | None = None, **options) -> DataFrame:
    """Records of an archive; without ``payload`` among ``columns`` no payload is decoded."""
    register(spark)
    fields = SCHEMA.split(", ")
    wanted = ", ".join(f for f in fields if columns is None or f.split()[0] in columns)
    return spark.read.format("warc").schema(wanted).options(**options).load(path)


def write_warc(records: DataFrame, path: str, **options) -> None:
    """Write records (columns of ``SCHEMA``, any of them) to an archive folder."""
    register(records.sparkSession)
    records.write.format("warc").mode("append").options(**options).save(path)


# ---------------------------------------------------------------- archives of pages

def page_records(pages: DataFrame, min_bytes: int = 100) -> DataFrame:
    """Records of (page_id, url, html), ``refers_to`` included.

    Of equal payloads of ``min_bytes`` or more the smallest page_id is the
    response and the others revisit it (rows that repeat that page_id and
    payload are responses too; a null page_id revisits any other).  Digests are
    grouped with partial aggregates; groups of one need no entry, and the rest
    is broadcast if small, else joined (adaptive execution splits hot ones).
    """
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("target_uri"),
                     F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload"))
    p = p.select("*", F.sha2("payload", 256).alias("payload_digest"), F.octet_length("payload").cast("long").alias("payload_bytes"))
    groups = p.where(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest").agg(
        F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    known = p.join(checked_broadcast(groups), "payload_digest", "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    name = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("none")))
    return known.select(name("page_id").alias("record_id"), F.when(again, "revisit").otherwise("response").alias("record_type"), "target_uri",
                        F.lit(DEFAULT_DATE).alias("warc_date"), F.when(again, name("first")).alias("refers_to"), "payload_digest", "payload_bytes",
                        F.when(~again, F.col("payload")).alias("payload"))


def archive_pages(pages: DataFrame, path: str | None = None, min_bytes: int = 100, **options) -> str:
    """Write an archive of (page_id, url, html); returns its folder."""
    path = path or scratch_path(pages.sparkSession, "warc")
    write_warc(page_records(pages, min_bytes), path, **options)
    return path


def read_pages(spark: SparkSession, path: str, **options) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of an
    archive: of responses from the payload as read, of revisits from headers
    alone (their read skips every payload)."""
    page = lambda c: F.expr(f"try_cast(substring({c}, {len('urn:page:') + 1}) AS bigint)")
    cols = ["record_id", "record_type", "refers_to"]
    full = read_warc(spark, path, [*cols, "payload"], **options).where("record_type = 'response'") \
        .withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha2("payload", 256)}).drop("payload")
    again = read_warc(spark, path, [*cols, "payload_digest", "payload_bytes"], **options).where("record_type = 'revisit'")
    return full.unionByName(again).select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to"))
