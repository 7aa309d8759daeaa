"""Periodic runs of words (operator 12).

A run is a stretch of words with smallest period q that no neighbour extends.
Every run holds a Lyndon root: for one of two opposite orders of the words, the
longest Lyndon word that starts at some place of the run is one period long
(Bannai et al., the "runs" theorem).  So there are two candidates a place, from
the next smaller suffix in both orders.  A candidate is extended to the right
by the longest common extension (LCE) of two suffixes and to the left by that
of two prefixes.  Both come from suffix trees, of the stretch and of its
reversal, built by Ukkonen's algorithm: between two leaves the Euler tour's
shallowest node is their lowest common ancestor, and its depth, found in
constant time by a sparse table, is the LCE.

Texts are first cut, exactly, to the stretches where a run can lie: with
exponent e and least length m, each k words that start inside a run occur again
at the distance of the period, at most 1/e of the stretch (k from e and m; 5
for 4 and 6).  Places whose k words have no equal that near go, twice.

Edge cases: a null or empty text has no words and no runs.  Whole texts are
read whatever their length; memory grows with one task's slice of texts, or the
longest text, and about 1 KB a word of its longest stretch.  Extra columns are
kept out of the way of the new ones by ``names``; repeated rows give repeated
results; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from .common import mix64, text_buffer, text_chunks, word_bounds, word_hashes

SLICE_BYTES = 2 << 20
_GRAM = np.random.default_rng(1212).integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


# ---------------------------------------------------------------- suffix trees

class SuffixTree:
    """Ukkonen's suffix tree of ``s``, whose last symbol must occur only there."""

    def __init__(self, s: list[int]):
        self.s = s
        n = len(s)
        start, end, link, below = [0], [0], [0], [{}]
        node = edge = length = left = 0
        for i, c in enumerate(s):
            last = 0
            left += 1
            while left:
                if not length:
                    edge = i
                first = s[edge]
                kids = below[node]
                child = kids.get(first)
                if child is None:
                    kids[first] = len(start)
                    start.append(i); end.append(n); link.append(0); below.append(None)
                    if last:
                        link[last] = node
                        last = 0
                else:
                    at = start[child]
                    span = (end[child] if end[child] <= i else i + 1) - at
                    if length >= span:
                        edge += span
                        length -= span
                        node = child
                        continue
                    if s[at + length] == c:
                        length += 1
                        if last:
                            link[last] = node
                        break
                    split = len(start)
                    start.append(at); end.append(at + length); link.append(0)
                    start.append(i); end.append(n); link.append(0)
                    start[child] = at + length
                    below.append({c: split + 1, s[at + length]: child})
                    below.append(None)
                    kids[first] = split
                    if last:
                        link[last] = split
                    last = split
                left -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - left + 1
        self.start, self.end, self.below = start, end, below

    def tour(self, falling: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(suffixes in the order of the leaves, depth of the shallowest node of
        the Euler tour between each leaf and the one before).  Children rise by
        symbol, or fall with the end symbol (0) still first."""
        s, start, end, below, n = self.s, self.start, self.end, self.below, len(self.s)
        leaves, lows = [], []
        stack, low = [(0, 0)], 0
        while stack:
            v, depth = stack.pop()
            if depth < low:
                low = depth
            kids = below[v]
            depth += end[v] - start[v]
            if kids is None:
                leaves.append(n - depth)
                lows.append(low)
                low = n
                continue
            keys = sorted(kids, reverse=not falling)
            if falling and keys[0] == 0:
                keys = [*keys[1:], 0]
            for k in keys:
                stack.append((kids[k], depth))
        return np.array(leaves, np.int64), np.array(lows, np.int64)


class CommonExtensions:
    """Longest common prefix of any two suffixes in constant time."""

    def __init__(self, leaves: np.ndarray, lows: np.ndarray):
        self.rank = np.empty(len(leaves), np.int64)
        self.rank[leaves] = np.arange(len(leaves))
        self.table = [lows.astype(np.int32)]
        while 2 << len(self.table) <= 2 * len(lows):
            a, h = self.table[-1], 1 << (len(self.table) - 1)
            self.table.append(np.minimum(a[:-h], a[h:]) if len(a) > h else a[:0])

    def lce(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """For suffixes i <> j."""
        a, b = self.rank[i], self.rank[j]
        a, b = np.minimum(a, b) + 1, np.maximum(a, b) + 1
        level = np.frexp((b - a).astype(np.float64))[1] - 1
        out = np.zeros(len(a), np.int64)
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            t = self.table[k]
            out[at] = np.minimum(t[a[at]], t[b[at] - (1 << int(k))])
        return out


def next_smaller(rank: list[int]) -> np.ndarray:
    """For each place, the next one of smaller rank (the last has the smallest)."""
    n = len(rank)
    out, stack = [0] * n, []
    for i in range(n - 1, -1, -1):
        r = rank[i]
        while stack and rank[stack[-1]] > r:
            stack.pop()
        out[i] = stack[-1] if stack else n
        stack.append(i)
    return np.array(out, np.int64)


def runs_of(symbols: list[int], exponent: int = 2, length: int = 2) -> np.ndarray:
    """(start, length, period) rows, sorted, of all runs of at least this
    exponent (2 or more) and length; symbols are integers from 1."""
    n = len(symbols)
    if n < max(length, exponent):
        return np.zeros((0, 3), np.int64)
    tree = SuffixTree([*symbols, 0])
    rising, lows = tree.tour()
    falling, _ = tree.tour(falling=True)
    del tree
    right = CommonExtensions(rising, lows)
    left = CommonExtensions(*SuffixTree([*symbols[::-1], 0]).tour())
    i = np.arange(n)
    found = []
    for order in (rising, falling):
        rank = np.empty(n + 1, np.int64)
        rank[order] = np.arange(n + 1)
        j = next_smaller(rank.tolist())[:n]
        after = right.lce(i, j)
        inside = i > 0
        before = np.zeros(n, np.int64)
        before[inside] = left.lce(n - i[inside], n - j[inside])
        p = j - i
        size = before + p + after
        good = (size >= exponent * p) & (size >= length)
        found.append(np.column_stack([i - before, size, p])[good])
    out = np.unique(np.concatenate(found), axis=0)
    return out[np.lexsort((out[:, 2], out[:, 0]))]


# ---------------------------------------------------------------- stretches

def gram_words(exponent: int, length: int) -> int:
    """The longest k such that each k words that start inside a run have an
    equal at the distance of the period inside it."""
    return 1 + min(max(length, exponent * q) - 2 * q for q in range(1, length + 1))


def stretches(hashes: np.ndarray, ptr: np.ndarray, exponent: int, length: int) -> list[tuple[int, int, int]]:
    """(text, first word, end) of the stretches that can hold a run."""
    k = min(gram_words(exponent, length), len(_GRAM))
    n = len(hashes) - k + 1
    if n <= 0:
        return []
    text = np.repeat(np.arange(len(ptr) - 1), np.diff(ptr))[:n]
    gram = np.zeros(n, np.uint64)
    for t in range(k):
        gram += hashes[t:t + n] * _GRAM[t]
    gram = mix64(gram + mix64(text.astype(np.uint64) + np.uint64(1)))
    at = np.flatnonzero(np.arange(n) + k <= ptr[1:][text])              # the k words end in the same text
    gram = gram[at]
    if not len(at):
        return []
    order = np.argsort(gram, kind="stable")
    same = gram[order][1:] == gram[order][:-1]
    step = np.where(same, at[order][1:] - at[order][:-1], np.iinfo(np.int64).max)
    near = np.full(len(at), np.iinfo(np.int64).max)
    near[order[1:]] = step
    near[order[:-1]] = np.minimum(near[order[:-1]], step)
    keep = near < np.iinfo(np.int64).max
    for _ in range(3):
        at, near = at[keep], near[keep]
        if not len(at):
            return []
        begins = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1] + 1) | (text[at[1:]] != text[at[:-1]]))))
        sizes = np.diff([*begins, len(at)])
        words = np.repeat(sizes + k - 1, sizes)
        keep = (near * exponent <= words) & (words >= length)
    return [(int(text[at[b]]), int(at[b]), int(at[b]) + size + k - 1) for b, size in zip(begins.tolist(), sizes.tolist()) if keep[b:b + size].any()]


def slice_runs(arr: pa.Array, exponent: int, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict[int, np.ndarray]]:
    """(bytes, word starts, first word of each text, {text: runs}) of a slice."""
    data, off = text_buffer(arr)
    hashes, ptr = word_hashes(data, off, lower=False)
    starts, ends, _ = word_bounds(data, off)
    found: dict[int, list[np.ndarray]] = {}
    raw = data.tobytes() if len(hashes) else b""
    for t, lo, hi in stretches(hashes, ptr, exponent, length):
        ids: dict[bytes, int] = {}
        symbols = [ids.setdefault(raw[a:b], len(ids) + 1) for a, b in zip(starts[lo:hi].tolist(), ends[lo:hi].tolist())]
        runs = runs_of(symbols, exponent, length)
        if len(runs):
            runs[:, 0] += lo - ptr[t]
            found.setdefault(t, []).append(runs)
    out = {}
    for t, parts in found.items():
        runs = np.concatenate(parts)
        out[t] = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    return data, off, ptr, out


def collapse(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words that no run holds after its first period."""
    gone = np.zeros(len(words) + 1, np.int64)
    np.add.at(gone, runs[:, 0] + runs[:, 2], 1)
    np.add.at(gone, runs[:, 0] + runs[:, 1], -1)
    return [w for w, g in zip(words, np.cumsum(gone)) if not g]


# ---------------------------------------------------------------- operator

def periodic_runs(docs: DataFrame, carry: Sequence[str] = ("doc_id",), exponent: int = 4, length: int = 6,
                  names: tuple[str, str, str] = ("n_words", "runs", "collapsed")) -> DataFrame:
    """Runs of every text: the columns of ``carry`` and, under ``names``, the
    number of words, all runs of at least this exponent and length
    (array of start, length, period, by start and period) and the text without
    the words that a run holds after its first period, joined by one space."""
    carry = list(carry)
    if set(carry) & set(names):
        raise ValueError("names must differ from the carried columns")
    rows = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *(F.col(c).alias(f"_c{i}") for i, c in enumerate(carry)))
    kept = StructType(rows.schema.fields[1:])
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches):
        for batch in batches:
            for part in text_chunks(batch, SLICE_BYTES):
                data, off, ptr, found = slice_runs(part.column(0), exponent, length)
                raw = data.tobytes()
                texts, runs = [], []
                for t, (a, b) in enumerate(zip(off[:-1].tolist(), off[1:].tolist())):
                    words = raw[a:b].split()
                    r = found.get(t)
                    if r is not None:
                        words = collapse(words, r)
                    texts.append(b" ".join(words))
                    runs.append([] if r is None else [{"start": x, "length": y, "period": z} for x, y, z in r.tolist()])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:], pa.array(np.diff(ptr)), pa.array(runs, run_type), pa.array(texts, pa.binary()).cast(pa.string())],
                    names=[*part.schema.names[1:], "_n", "_runs", "_text"])

    one_run = StructType([StructField(x, LongType()) for x in ("start", "length", "period")])
    out = StructType([*kept.fields, StructField("_n", LongType()), StructField("_runs", ArrayType(one_run)), StructField("_text", StringType())])
    return rows.mapInArrow(run, out).select(*(F.col(f"_c{i}").alias(c) for i, c in enumerate(carry)),
                                            *(F.col(a).alias(b) for a, b in zip(("_n", "_runs", "_text"), names)))


def greatest_run(runs: Column) -> Column:
    """The run of greatest exact length / period, the first of equals (of an
    array by start and period); null if there is none."""
    return F.aggregate(runs, F.try_element_at(runs, F.lit(1)),
                       lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best))
