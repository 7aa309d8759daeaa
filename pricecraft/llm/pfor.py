"""Token-id files in patched frame-of-reference blocks (operator 8).

Ids are written in ascending doc_id order.  A segment holds whole documents
(about ``SEGMENT_IDS`` ids) in blocks of ``BLOCK`` values: the block minimum
is subtracted, the differences are packed at the width that a percentile of
them needs, and wider ones are exceptions with position and value.  A segment
begins with the index of its blocks' starts.

Layout (little-endian): magic ``PFR1``, u16 block size, u16 reserved, u64 number of
ids, u32 number of blocks, u32 block starts (one more than blocks), then per
block u32 minimum, u8 width, u16 number of exceptions, packed bits, u8
positions, u32 values.

Segments are rows of a Parquet table, so they live in any store Spark can
write, and a task that is lost or repeated leaves no half-written file.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import partitions, save
from .tokens import encode_batches, read_tokenizer

BLOCK = 256
SEGMENT_IDS = 1 << 18
PERCENTILE = 0.9
_HEAD = "<4sHHQI"
_HEAD_SIZE = struct.calcsize(_HEAD)
_BLOCK_HEAD = "<IBH"
_BLOCK_HEAD_SIZE = struct.calcsize(_BLOCK_HEAD)


def _bit_lengths(x: np.ndarray) -> np.ndarray:
    return np.frexp(x.astype(np.float64))[1].astype(np.uint8)


def pack_segment(values: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    """The segment of an array of unsigned 32-bit values."""
    v = np.asarray(values, "<u4")
    n = len(v)
    nb = -(-n // BLOCK)
    x = np.empty(nb * BLOCK, np.uint32)
    x[:n] = v
    if n:
        x[n:] = v[-1]
    x = x.reshape(nb, BLOCK)
    low = x.min(1) if nb else np.zeros(0, np.uint32)
    x = x - low[:, None]
    bits = _bit_lengths(x)
    k = min(int(percentile * BLOCK), BLOCK - 1)
    width = np.partition(bits, k, axis=1)[:, k] if nb else np.zeros(0, np.uint8)
    patch = bits > width[:, None]
    n_patch = patch.sum(1)
    packed: list[bytes] = [b""] * nb
    for w in np.unique(width).tolist():
        rows = np.flatnonzero(width == w)
        if not w:
            continue
        part = np.where(patch[rows], 0, x[rows]).astype("<u4")
        bits_of = np.unpackbits(part.view(np.uint8), axis=1, bitorder="little").reshape(len(rows), BLOCK, 32)
        raw = np.packbits(bits_of[:, :, :w].reshape(len(rows), BLOCK * w), axis=1, bitorder="little")
        for i, r in zip(rows.tolist(), raw):
            packed[i] = r.tobytes()
    out, starts, at = [], np.zeros(nb + 1, np.uint32), 0
    where = [np.zeros(0, np.intp)] * nb
    hit = np.flatnonzero(n_patch)
    for i in hit.tolist():
        where[i] = np.flatnonzero(patch[i])
    for i, (a, w, k) in enumerate(zip(low.tolist(), width.tolist(), n_patch.tolist())):
        b = struct.pack(_BLOCK_HEAD, a, w, k) + packed[i]
        if k:
            b += where[i].astype(np.uint8).tobytes() + x[i, where[i]].astype("<u4").tobytes()
        out.append(b)
        at += len(b)
        starts[i + 1] = at
    return struct.pack(_HEAD, b"PFR1", BLOCK, 0, n, nb) + starts.astype("<u4").tobytes() + b"".join(out)


def unpack_segment(raw: bytes) -> np.ndarray:
    """All values of a segment."""
    magic, block, _, n, nb = struct.unpack_from(_HEAD, raw)
    if magic != b"PFR1" or block != BLOCK:
        raise ValueError("not a segment of this format")
    starts = np.frombuffer(raw, "<u4", nb + 1, _HEAD_SIZE).astype(np.int64) + _HEAD_SIZE + 4 * (nb + 1)
    buf = np.frombuffer(raw, np.uint8)
    heads = [struct.unpack_from(_BLOCK_HEAD, raw, s) for s in starts[:-1].tolist()]
    low = np.array([h[0] for h in heads], np.uint32)
    width = np.array([h[1] for h in heads], np.int64)
    x = np.zeros((nb, BLOCK), np.uint32)
    for w in np.unique(width).tolist():
        if not w:
            continue
        rows = np.flatnonzero(width == w)
        size = BLOCK * w // 8
        at = starts[rows][:, None] + _BLOCK_HEAD_SIZE + np.arange(size)
        bits_of = np.zeros((len(rows), BLOCK, 32), np.uint8)
        bits_of[:, :, :w] = np.unpackbits(buf[at], axis=1, bitorder="little").reshape(len(rows), BLOCK, w)
        x[rows] = np.packbits(bits_of.reshape(len(rows), BLOCK * 32), axis=1, bitorder="little").view("<u4")
    for i, (_, w, k) in enumerate(heads):
        if k:
            at = int(starts[i]) + _BLOCK_HEAD_SIZE + BLOCK * w // 8
            x[i, buf[at:at + k]] = np.frombuffer(raw, "<u4", k, at + k)
    return (x + low[:, None]).reshape(-1)[:n]


def read_block(raw: bytes, i: int) -> np.ndarray:
    """The values of block ``i`` alone, by way of the index."""
    _, _, _, n, nb = struct.unpack_from(_HEAD, raw)
    if not 0 <= i < nb:
        raise IndexError(i)
    a, b = struct.unpack_from("<II", raw, _HEAD_SIZE + 4 * i)
    body = raw[_HEAD_SIZE + 4 * (nb + 1):][a:b]
    m = min(BLOCK, n - i * BLOCK)
    one = struct.pack(_HEAD, b"PFR1", BLOCK, 0, m, 1) + struct.pack("<II", 0, len(body)) + body
    return unpack_segment(one)


def write_token_files(docs: DataFrame, tokenizer_file: str, end_id: int = 0, text: str = "text") -> DataFrame:
    """Encode and write all documents; returns the written table: part int,
    segment int, n_ids long, doc_ids array<long>, n_tokens array<long>, data binary.

    Parts are ranges of doc_id in ascending order; null ids come first.  Null
    and empty texts hold the end id alone; repeated rows stay repeated; other
    columns are left behind.
    """
    file = read_tokenizer(docs, tokenizer_file)

    def write(batches):
        from pyspark import TaskContext
        part, segment = TaskContext.get().partitionId(), 0
        held, ids, size = [], [], 0

        def flush():
            lengths = [len(x) // 4 for x in ids]
            data = pack_segment(np.frombuffer(b"".join(ids), "<u4"))
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([segment], pa.int32()), pa.array([size], pa.int64()),
                 pa.array([held], pa.list_(pa.int64())), pa.array([lengths], pa.list_(pa.int64())), pa.array([data], pa.binary())],
                names=["part", "segment", "n_ids", "doc_ids", "n_tokens", "data"])

        for b, encoded in encode_batches(batches, file.value, end_id, max_bytes=1 << 20):
            held += b.column(0).to_pylist()
            ids += encoded
            size += sum(map(len, encoded)) // 4
            if size >= SEGMENT_IDS:
                yield flush()
                held, ids, size, segment = [], [], 0, segment + 1
        if held:
            yield flush()

    sorted_docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text")) \
        .repartitionByRange(partitions(docs.sparkSession), "doc_id").sortWithinPartitions("doc_id")
    return save(sorted_docs.mapInArrow(write, "part int, segment int, n_ids long, doc_ids array<long>, "
                                              "n_tokens array<long>, data binary"), "token-files")


def read_token_files(files: DataFrame, derive: dict[str, Column] | None = None) -> DataFrame:
    """One row per document: doc_id, start long (ids of all documents before
    it), n_tokens long, ids binary (little-endian unsigned 32-bit).

    With ``derive``, its columns of ``ids`` stand in place of ``ids``; they
    are computed before the starts are joined, so the ids are not shuffled.
    """
    sizes = files.select("part", "segment", "n_ids")
    inside = W.partitionBy("part").orderBy("segment").rowsBetween(W.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))            # one row per file part
    before = parts.select("part", F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)),
                                             F.lit(0)).alias("before"))
    start = sizes.withColumn("inside", F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).join(before, "part") \
        .select("part", "segment", (F.col("before") + F.col("inside")).alias("first"))

    def read(batches):
        for b in batches:
            for part, segment, docs, n, data in zip(*(b.column(i) for i in range(5))):
                ids = unpack_segment(data.as_py()).astype("<u4").tobytes()
                n = np.array(n.as_py(), np.int64)
                ends = np.cumsum(n)
                out = [ids[4 * (e - k):4 * e] for e, k in zip(ends.tolist(), n.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.as_py()] * len(n), pa.int32()), pa.array([segment.as_py()] * len(n), pa.int32()),
                     pa.array(docs.as_py(), pa.int64()), pa.array(ends - n), pa.array(n), pa.array(out, pa.binary())],
                    names=["part", "segment", "doc_id", "inside", "n_tokens", "ids"])

    rows = files.select("part", "segment", "doc_ids", "n_tokens", "data") \
        .mapInArrow(read, "part int, segment int, doc_id long, inside long, n_tokens long, ids binary")
    own = ["ids"] if derive is None else [c.alias(name) for name, c in derive.items()]
    rows = rows.select("part", "segment", "doc_id", "inside", "n_tokens", *own)
    names = ["ids"] if derive is None else list(derive)
    return rows.join(start, ["part", "segment"]).select("doc_id", (F.col("first") + F.col("inside")).alias("start"), "n_tokens", *names)
