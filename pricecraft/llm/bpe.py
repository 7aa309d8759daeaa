"""Byte-level BPE encoding and decoding (operator 2).

Each document is cut into words by the tokenizer's pattern; a distinct word is
folded once per worker: its bytes are merged pair by pair in rank order until
no adjacent pair has a rank.  Documents are the concatenation of their words'
ids; decoding concatenates the binary pieces of the ids.

The rank map is a file of fixed size (about 50,000 entries), sent to the
tasks as one broadcast value.  The memo of folded words is bounded.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_chunks, worker_store

SLICE_BYTES = 4 << 20      # text handled at a time
MEMO_WORDS = 250_000        # words a worker remembers (a cache: results do not depend on it)
LONG_WORD = 128             # bytes from which merges are kept in a heap


def fold_merges(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word: the adjacent pair of lowest rank is merged (leftmost
    first among equals) until none is left."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    if len(word) >= LONG_WORD:
        return _fold_heap(word, ranks)
    parts = [word[i:i + 1] for i in range(len(word))]
    pair = [ranks.get(parts[i] + parts[i + 1], _NONE) for i in range(len(parts) - 1)]
    while pair:
        low = min(pair)
        if low == _NONE:
            break
        i = pair.index(low)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
        del pair[i]
        if i < len(pair):
            pair[i] = ranks.get(parts[i] + parts[i + 1], _NONE)
        if i:
            pair[i - 1] = ranks.get(parts[i - 1] + parts[i], _NONE)
    return [ranks[p] for p in parts]


_NONE = 1 << 60


def _fold_heap(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same fold for long words in n log n: a heap of pairs over a linked list."""
    n = len(word)
    end = list(range(1, n + 1))         # part that starts at i ends at end[i]
    prev = list(range(-1, n - 1))
    alive = [True] * n

    def rank(i: int) -> int:
        j = end[i]
        return ranks.get(word[i:end[j]], _NONE) if j < n else _NONE

    heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := rank(i)) != _NONE]
    heapq.heapify(heap)
    while heap:
        _, i, mid, stop = heapq.heappop(heap)
        if not alive[i] or end[i] != mid or mid >= n or end[mid] != stop:
            continue                     # one of the two parts has changed
        alive[mid] = False
        end[i] = stop
        if stop < n:
            prev[stop] = i
        for a in (prev[i], i):
            if a >= 0 and (r := rank(a)) != _NONE:
                heapq.heappush(heap, (r, a, end[a], end[end[a]]))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i:end[i]]])
        i = end[i]
    return out


def load_ranks(text: bytes) -> dict[bytes, int]:
    """Ranks of a tiktoken-format file."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, text.splitlines()) if a}


#: Longer keys are not remembered: the memos are bounded in bytes by their entries.
LONG_KEY = 64


class WordIds(dict):
    """word (str) -> its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks

    def __missing__(self, word: str) -> bytes:
        v = np.array(fold_merges(word.encode(), self.ranks), "<u4").tobytes()
        if len(word) <= LONG_KEY:
            self[word] = v
        return v


class ChunkIds(dict):
    """Chunk key -> ids of the chunk, a space and what follows it up to the
    next word (``chunk_keys``).

    The pattern always starts a new word at a space followed by a non-space
    and looks at nothing before it, so a text may be cut there."""

    def __init__(self, words: WordIds, pattern):
        self.words, self.find = words, pattern.findall

    def __missing__(self, key: str) -> bytes:
        v = b"".join(map(self.words.__getitem__, self.find(key[1:] if key[0] == " " else " " + key)))
        if len(key) <= LONG_KEY:
            self[key] = v
        return v


def cut_at_spaces(text: str) -> list[str]:
    """Cut before every space that a non-space follows (finest safe cut)."""
    parts = text.split(" ")
    out = [parts[0]]
    for p in parts[1:]:
        if p and not p[0].isspace():
            out.append(" " + p)
        else:
            out[-1] += " " + p
    return out


_SPACES = re.compile(r" (?:\s|$)")


def chunk_keys(text: str) -> list[str]:
    """The chunks of a text as memo keys: a space before the first one, and
    the others without the space that they begin with."""
    if _SPACES.search(text) is None:
        keys = text.split(" ")
        keys[0] = " " + keys[0]
        return keys
    cut = cut_at_spaces(text)
    return [" " + cut[0], *[c[1:] for c in cut[1:]]]


def encode_bpe(docs: DataFrame, rank_file: str, pattern: str, text: str = "text",
               carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Rows of ``docs`` as (*carry, n_tokens long, ids binary); ids are
    little-endian unsigned 32-bit integers.

    Null and empty texts give no ids.  Repeated rows stay repeated; other
    columns (also ones named ``ids`` or ``n_tokens``) are left behind; an
    empty table gives an empty table.  ``rank_file`` is read on the driver.
    """
    spark = docs.sparkSession
    with open(rank_file, "rb") as f:
        ranks_file = spark.sparkContext.broadcast(f.read())
    digest = hashlib.sha256(ranks_file.value).hexdigest()[:16] + str(hash(pattern))
    sel = docs.select(*carry, F.col(text).alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sel.schema.fields[:-1])

    def run(batches):
        import regex
        store = worker_store("bpe-" + digest)
        if not store:
            words = WordIds(load_ranks(ranks_file.value))
            store.update(words=words, chunks=ChunkIds(words, regex.compile(pattern)))
        words, chunks = store["words"], store["chunks"]
        get = chunks.__getitem__
        for b in (part for batch in batches for part in text_chunks(batch, SLICE_BYTES, column="_text")):
            ids = []
            for t in b.column(b.num_columns - 1):
                t = t.as_py()
                ids.append(b"".join(map(get, chunk_keys(t))) if t else b"")
                if len(chunks) > MEMO_WORDS:
                    chunks.clear()
                if len(words) > MEMO_WORDS:
                    words.clear()
            n = pa.array([len(x) // 4 for x in ids], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], n, pa.array(ids, pa.binary())],
                                             names=[*b.schema.names[:-1], "n_tokens", "ids"])

    return sel.mapInArrow(run, (schema + ", " if schema else "") + "n_tokens long, ids binary")


def decode_bpe(encoded: DataFrame, rank_file: str, ids: str = "ids",
               carry: tuple[str, ...] = ("doc_id", "n_tokens")) -> DataFrame:
    """Rows of ``encoded`` as (*carry, ids binary, decoded binary): the
    concatenated binary pieces of the ids.  Null ids give empty bytes; an id
    without a piece raises KeyError.
    """
    spark = encoded.sparkSession
    with open(rank_file, "rb") as f:
        ranks_file = spark.sparkContext.broadcast(f.read())
    digest = hashlib.sha256(ranks_file.value).hexdigest()[:16]
    sel = encoded.select(*carry, F.col(ids).alias("ids"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sel.schema.fields)

    def run(batches):
        store = worker_store("pieces-" + digest)
        if not store:
            store.update({i: p for p, i in load_ranks(ranks_file.value).items()})
        for b in batches:
            out = [b"".join(map(store.__getitem__, np.frombuffer(x.as_py() or b"", "<u4").tolist()))
                   for x in b.column(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.binary())],
                                             names=[*b.schema.names, "decoded"])

    return sel.mapInArrow(run, schema + ", decoded binary")


def round_trip_digests(docs: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the ids and of the decoded bytes."""
    d = decode_bpe(encode_bpe(docs, rank_file, pattern), rank_file)
    return d.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                    F.sha2("decoded", 256).alias("decoded_sha256"))


__all__ = ["encode_bpe", "decode_bpe", "round_trip_digests", "fold_merges", "load_ranks", "cut_at_spaces"]
