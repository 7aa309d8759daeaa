"""Helpers shared by the operators: scratch tables, Arrow text buffers, hashed
words and shingles, connected components."""

from __future__ import annotations

import sys
import types
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_path

#: Word separators of every operator: space and 0x09-0x0D.
SEPARATORS = b" \t\n\x0b\x0c\r"


# ---------------------------------------------------------------- scratch

def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder (``spark.checkpoint.dir``)."""
    return shared_path(spark, "llm", name)


def save(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts the
    lineage in a way that survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def drop(*dfs: DataFrame | None) -> None:
    """Delete tables made by ``save`` that nothing reads any more."""
    for df in dfs:
        path = getattr(df, "_scratch_path", None)
        if path:
            spark = df.sparkSession
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


#: Rows of a table of a few longs a row that may be broadcast to a table of texts (64 MB as pairs of longs).
BROADCAST_ROWS = 1 << 22


def few(df: DataFrame) -> bool:
    """Whether ``df``, a saved table, may be broadcast; runs a count.  Beyond
    the bound its joins are shuffle joins, with the same result."""
    return df.count() <= BROADCAST_ROWS


def partitions(spark: SparkSession) -> int:
    """Shuffle partitions of the session."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc_mod(doc_id: Column, mod: int) -> Column:
    """crc32(doc_id as text) mod ``mod``: the repeatable hold-out of the contracts."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(mod)


def worker_store(name: str) -> dict:
    """A dict that lives as long as the Python worker (caches, loaded models)."""
    m = sys.modules.setdefault("pricecraft_worker_store", types.ModuleType("pricecraft_worker_store"))
    return m.__dict__.setdefault(name, {})


# ---------------------------------------------------------------- text buffers

def text_buffer(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary Arrow array; null counts as empty."""
    if arr.null_count:
        arr = arr.fill_null("" if pa.types.is_string(arr.type) or pa.types.is_large_string(arr.type) else b"")
    arr = arr.cast(pa.large_binary())
    _, off, data = arr.buffers()
    off = np.frombuffer(off, dtype=np.int64)[arr.offset:arr.offset + len(arr) + 1] if len(arr) else np.zeros(1, np.int64)
    if data is None or not len(arr):
        return np.zeros(0, np.uint8), np.zeros(len(arr) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[off[0]:off[-1]], off - off[0]


def text_chunks(batch: pa.RecordBatch, max_bytes: int, max_rows: int = 16_384, column: str = "text"):
    """Slices of a batch of at most ``max_bytes`` of text (one row at least)."""
    if not batch.num_rows:
        return
    _, off = text_buffer(batch.column(batch.schema.get_field_index(column)))
    i, n = 0, batch.num_rows
    while i < n:
        j = int(np.searchsorted(off, off[i] + max_bytes, side="right")) - 1
        j = min(max(j, i + 1), i + max_rows, n)
        yield batch.slice(i, j - i)
        i = j


_WORD_BYTE = np.ones(256, bool)
_WORD_BYTE[list(SEPARATORS)] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MULT = np.uint64(0x9E3779B97F4A7C15 | 1)
_MULT_INV = np.uint64(pow(int(_MULT), -1, 1 << 64))
_BYTE_CODE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHINGLE_CODE = np.random.default_rng(77).integers(1, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix64(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finalizer."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def word_bounds(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first word of each text, with the end) of all words."""
    w = _WORD_BYTE[data]
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    cut = np.zeros(n + 1, bool)
    cut[off] = True                       # a text's first byte (and the end)
    start = w.copy()
    start[1:] &= ~w[:-1] | cut[1:n]
    end = w.copy()
    end[:-1] &= ~w[1:] | cut[1:n]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, off)


def word_hashes(data: np.ndarray, off: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of every word, first word of each text): a polynomial hash
    from one running sum over the bytes, then a bijective finalizer."""
    starts, ends, ptr = word_bounds(data, off)
    if not len(starts):
        return np.zeros(0, np.uint64), ptr
    code = _BYTE_CODE[_LOWER] if lower else _BYTE_CODE
    n = len(data)
    powers = np.empty(n, np.uint64)
    powers[0] = 1
    powers[1:] = _MULT
    np.multiply.accumulate(powers, out=powers)
    run = np.zeros(n + 1, np.uint64)
    np.cumsum(code[data] * powers, out=run[1:])
    powers[0] = 1
    powers[1:] = _MULT_INV
    np.multiply.accumulate(powers, out=powers)
    h = (run[ends] - run[starts]) * powers[starts]
    return mix64(h + (ends - starts).astype(np.uint64)), ptr


def shingle_sets(arr: pa.Array, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): each text's sorted distinct 64-bit hashes of its
    k-word shingles; a text of fewer words has its whole sequence as one."""
    data, off = text_buffer(arr)
    w, ptr = word_hashes(data, off)
    n = len(off) - 1
    grams = np.zeros(max(len(w) - k + 1, 0), np.uint64)
    for j in range(k):
        grams += w[j:j + len(grams)] * _SHINGLE_CODE[j]
    grams = mix64(grams)
    out, ends = [], np.zeros(n + 1, np.int64)
    for i in range(n):
        a, b = int(ptr[i]), int(ptr[i + 1])
        if b - a >= k:
            s = np.sort(grams[a:b - k + 1])
            s = s[np.concatenate(([True], s[1:] != s[:-1]))] if len(s) > 1 else s
        elif b > a:
            s = mix64(np.array([(w[a:b] * _SHINGLE_CODE[:b - a]).sum(dtype=np.uint64) + np.uint64(b - a)], np.uint64))
        else:
            s = w[:0]
        out.append(s)
        ends[i + 1] = ends[i] + len(s)
    return (np.concatenate(out) if out else w[:0]), ends


def crc32(b: bytes) -> int:
    return zlib.crc32(b) & 0xFFFFFFFF


# ---------------------------------------------------------------- components

def connected_components(edges: DataFrame) -> DataFrame:
    """(id, root) of every node of ``edges`` (a, b longs): root is the smallest
    id reachable.  Alternating large-star and small-star rounds; every round
    is joins and partial aggregates, so a node with very many edges is split."""
    e = save(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc")
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = save(large, "cc")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v") \
            .unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        new = save(small, "cc")
        drop(e, large)
        e = new
        # done when every node has one edge, and it leads to a root
        two = e.groupBy("u").agg(F.min("v").alias("a"), F.max("v").alias("b")).where("a < b").select("u")
        inner = e.select(F.col("v").alias("u")).distinct().join(e.select("u").distinct(), "u", "left_semi")
        if not two.unionByName(inner).take(1):
            return e.select(F.col("u").alias("id"), F.col("v").alias("root")) \
                .unionByName(e.select(F.col("v").alias("id"), F.col("v").alias("root"))).distinct()
