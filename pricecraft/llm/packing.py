"""Best-fit packing by exact complements (operator 6).

Documents are cut into pieces of at most ``capacity`` tokens.  Only the
histogram of piece lengths (``capacity`` counts at most, whatever the size of
the corpus) reaches the driver, where the packing is planned for lengths with
counts: for every length, from the longest, single, pair and triple sums that
fill the gap exactly are consumed as long as their counts last; what remains
is packed best-fit.  The plan is a list of patterns with multiplicities, and
every pattern takes runs of consecutive ranks of its lengths.  The pieces find
their run by their rank among the pieces of equal length.  A hot length is not
a hot key: ranks are counted per task and added up.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import save
from .tokens import encode_batches, read_tokenizer

CAPACITY = 2048


def cut_documents(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, end_id: int = 0,
                  text: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece int, start long, length long, ids binary.

    Null and empty texts give one piece with the end id alone.  Documents of
    more than ``capacity`` ids are cut into pieces of ``capacity``, the first
    of which may be shorter.  Other columns are left behind; repeated rows
    give repeated pieces; an empty table gives none.
    """
    file = read_tokenizer(docs, tokenizer_file)

    def run(batches):
        for part, ids in encode_batches(batches, file.value, end_id, by_ranks=True):
            doc, piece, start, length, out = [], [], [], [], []
            for d, x in zip(part.column(0).to_pylist(), ids):
                n = len(x) // 4
                a, k = 0, 0
                b = (n - 1) % capacity + 1
                while a < n:
                    doc.append(d), piece.append(k), start.append(a), length.append(b - a)
                    out.append(x[4 * a:4 * b])
                    a, b, k = b, b + capacity, k + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(out, pa.binary())],
                names=["doc_id", "piece", "start", "length", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text")) \
        .mapInArrow(run, "doc_id long, piece int, start long, length long, ids binary")


# ---------------------------------------------------------------- the plan

def plan_patterns(counts: dict[int, int], capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """[(members [(length, copies)], multiplicity)] that use up ``counts``.

    Every step uses up one length at least, so the plan has at most a few
    times ``capacity`` patterns."""
    have = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} does not fit into {capacity}")
        have[length] += n
    plan: list[tuple[list[tuple[int, int]], int]] = []

    def take(members: list[int]) -> None:
        copies: dict[int, int] = {}
        for m in members:
            copies[m] = copies.get(m, 0) + 1
        times = min(int(have[m]) // k for m, k in copies.items())
        for m, k in copies.items():
            have[m] -= times * k
        plan.append((list(copies.items()), times))

    def enough(*members: int) -> bool:
        return all(have[m] >= members.count(m) for m in set(members))

    def pair(total: int, *others: int) -> tuple[int, int] | None:
        """The pair with this sum whose larger member is largest."""
        a = np.arange(min(total - 1, capacity), (total - 1) // 2, -1)
        for x in a[(have[a] > 0) & (have[total - a] > 0)].tolist():
            if enough(*others, x, total - x):
                return x, total - x
        return None

    sums, used = _pair_sums(have), 0
    for top in range(capacity, 0, -1):
        while have[top]:
            gap = capacity - top
            if used >= 32:                       # the index may be too full, never too empty
                sums, used = _pair_sums(have), 0
            found = None
            if gap == 0:
                found = (top,)
            elif enough(top, gap):
                found = (top, gap)
            elif sums[gap] and (p := pair(gap, top)):
                found = (top, *p)
            else:
                for x in range(min(gap - 2, top), 0, -1):
                    if 3 * x < gap:
                        break
                    if have[x] and sums[gap - x] and enough(top, x) and (p := pair(gap - x, top, x)):
                        found = (top, x, *p)
                        break
            if found is None:
                break
            take(list(found))
            used += 1
    for top in range(capacity, 0, -1):           # best fit of what remains
        while have[top]:
            left = have.copy()
            left[top] -= 1
            members, gap = [top], capacity - top
            while gap:
                fits = np.flatnonzero(left[1:gap + 1])
                if not len(fits):
                    break
                x = int(fits[-1]) + 1
                k = min(gap // x, int(left[x]))
                members += [x] * k
                left[x] -= k
                gap -= k * x
            take(members)
    return plan


def _pair_sums(have: np.ndarray) -> np.ndarray:
    """Which sums up to the capacity two available lengths have."""
    a = (have > 0).astype(np.float64)
    n = 2 * len(a)
    f = np.fft.rfft(a, n)
    return np.fft.irfft(f * f, n)[:len(a)] > 0.5


def plan_runs(plan: list[tuple[list[tuple[int, int]], int]], capacity: int) -> np.ndarray:
    """Rows (length, first rank, first sequence, multiplicity, offset) sorted
    by length and rank: the runs of ranks the patterns take."""
    taken = np.zeros(capacity + 1, np.int64)
    rows, sequence = [], 0
    for members, times in plan:
        offset = 0
        for length, copies in members:
            rows.append((length, int(taken[length]), sequence, times, offset))
            taken[length] += times * copies
            offset += length * copies
        sequence += times
    rows.sort()
    return np.array(rows, np.int64).reshape(-1, 5)


# ---------------------------------------------------------------- the pieces

def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (any columns, with ``length`` from 1 to ``capacity``) with
    sequence_id long and offset long: their place in sequences of at most
    ``capacity`` tokens, without gaps from 0.

    Ties are told apart by their place in the table; input columns named
    sequence_id or offset are replaced.  Raises ValueError for a length that
    does not fit; an empty table stays empty.
    """
    spark = pieces.sparkSession
    pieces = pieces.drop("sequence_id", "offset", "_block", "_rank", "_base")
    names = pieces.columns
    at = names.index("length")

    def number(batches):
        from pyspark import TaskContext
        block, seen = TaskContext.get().partitionId(), {}
        for b in batches:
            length = b.column(at).to_numpy(zero_copy_only=False).astype(np.int64)
            order = np.argsort(length, kind="stable")
            values, first, n = np.unique(length[order], return_index=True, return_counts=True)
            rank = np.empty(len(length), np.int64)
            rank[order] = np.arange(len(length)) - np.repeat(first, n)
            rank += np.array([seen.get(v, 0) for v in values.tolist()], np.int64)[np.searchsorted(values, length)]
            for v, k in zip(values.tolist(), n.tolist()):
                seen[v] = seen.get(v, 0) + k
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(len(length), block, np.int32)), pa.array(rank)],
                                             names=[*b.schema.names, "_block", "_rank"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    numbered = save(pieces.mapInArrow(number, schema + ", _block int, _rank long"), "pieces")
    per_block = numbered.groupBy("length", "_block").agg(F.count(F.lit(1)).alias("n"))
    counts = {r[0]: r[1] for r in per_block.groupBy("length").agg(F.sum("n")).collect()}      # ``capacity`` rows at most
    runs = spark.sparkContext.broadcast(plan_runs(plan_patterns(counts, capacity), capacity))
    before = W.partitionBy("length").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    base = per_block.select("length", "_block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"))
    ranked = numbered.join(base, ["length", "_block"]).select(*names, (F.col("_rank") + F.col("_base")).alias("_rank"))

    def place(batches):
        r = runs.value
        key = (r[:, 0] << 40) + r[:, 1]
        for b in batches:
            length = b.column(at).to_numpy(zero_copy_only=False).astype(np.int64)
            rank = b.column(b.num_columns - 1).to_numpy(zero_copy_only=False)
            i = np.searchsorted(key, (length << 40) + rank, side="right") - 1
            copy, which = np.divmod(rank - r[i, 1], r[i, 3])
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(r[i, 2] + which), pa.array(r[i, 4] + copy * length)],
                                             names=[*b.schema.names[:-1], "sequence_id", "offset"])

    return ranked.mapInArrow(place, schema + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, with_ids: bool = True) -> DataFrame:
    """Cut and pack: (doc_id, piece, start, length, ids or ids_crc32, sequence_id, offset)."""
    pieces = cut_documents(docs, tokenizer_file, capacity)
    if not with_ids:
        pieces = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return pack_pieces(pieces, capacity)
