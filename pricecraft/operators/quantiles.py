"""Exact quantiles with linear interpolation (pandas semantics) by repeated
narrowing, one algorithm for every size.

A scan counts, for all columns at once, the values in sub-ranges (at first of
all doubles, by their leading bits) with the smallest and largest value of each;
partial aggregates, a bounded number of sub-ranges.  The counts are exact, so
the sub-range that holds a wanted rank is known, and the rank inside it.  Where
that is the first or last value, or the only one, the search ends.  Else the
sub-range becomes the bracket of the next scan, which cuts it again; a bracket
of at most ``limit`` rows is cut into its distinct values, which ends the
search.  So a task that orders sub-ranges sees at most
max(``sub_ranges``, ``limit``) rows a bracket, whatever the table's size.
Ordinary tables take two scans; 64 bits give out after a few in any case.

Without keys the columns are counted side by side in Arrow batches (no row is
exploded), and the few brackets are held by the driver.  With keys everything
stays in DataFrames: any number of groups, hot ones included, since rows are
joined with the brackets of their group and counted by partial aggregates.

The functions run their scans when called (fits are small tables).  A bracket
that holds another number of rows than the scan before counted means that the
input changed between scans, and is an error.  NULL and NaN values are ignored,
NULL keys are dropped (pandas ``groupby``).  ``method="approx"`` gives
``percentile_approx`` of ``accuracy``, lazily.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_path
from .joins import checked_broadcast

ACCURACY = 10_000
#: Sub-ranges of a bracket (a power of two), and the rows up to which a bracket is cut into its distinct values.
SUB_RANGES = 1 << 18
EXACT_ROWS = 1 << 16
_CHUNK_ROWS = 1 << 17
_CHANGED = "the input gave other rows on a later scan"

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _save(df: DataFrame) -> DataFrame:
    """Written to the shared folder and read back."""
    path = shared_path(df.sparkSession, "quantiles", "t")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# ---------------------------------------------------------------- columns side by side

def order_key(v: np.ndarray) -> np.ndarray:
    """Integers in the order of the doubles."""
    b = v.view(np.int64)
    return b ^ ((b >> 63) & np.int64(0x7FFFFFFFFFFFFFFF))


def _shift(lo: float, hi: float, rows: int, sub_ranges: int, limit: int) -> int:
    """Low bits of the order key that a sub-range of this bracket spans."""
    if rows <= limit:
        return 0
    a, b = (int(order_key(np.array([x]))[0]) for x in (lo, hi))
    return max(0, (b - a).bit_length() - (sub_ranges.bit_length() - 1))


def count_sub_ranges(df: DataFrame, cols: Sequence[str], brackets: list[list[tuple[float, float, int]]], moments: bool = False) -> DataFrame:
    """One scan: (col, b, s, c, mn, mx) for each sub-range s of bracket b of
    column number col that holds values: their count, least and greatest.

    ``brackets[col]`` has (least, greatest, bits of a sub-range).  With
    ``moments`` each task adds one row a column with b = -1: the count, mean
    and sum of squared deviations of all its values (in c, mn, mx)."""
    x = df.select(*(F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)))
    edges = [[(float(lo), float(hi), int(order_key(np.array([lo]))[0]) & (1 << 64) - 1, sh) for lo, hi, sh in br] for br in brackets]

    def groups(s: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))

    def cut(v: np.ndarray, lo: float, hi: float, klo: int, sh: int) -> tuple | None:
        v = v[np.searchsorted(v, lo):np.searchsorted(v, hi, side="right")]
        if not len(v):
            return None
        s = ((order_key(v).view(np.uint64) - np.uint64(klo)) >> np.uint64(sh)).view(np.int64)
        at = groups(s)
        end = np.append(at[1:], len(v)) - 1
        return s[at], end - at + 1, v[at], v[end]

    def merge(parts: list[tuple]) -> tuple:
        s = np.concatenate([p[0] for p in parts])
        order = np.argsort(s, kind="stable")
        at = groups(s[order])
        c, mn, mx = (np.concatenate([p[k] for p in parts])[order] for k in (1, 2, 3))
        return s[order][at], np.add.reduceat(c, at), np.minimum.reduceat(mn, at), np.maximum.reduceat(mx, at)

    def run(batches):
        held: dict[tuple[int, int], list[tuple]] = {}
        total = np.zeros((len(edges), 3))                   # count, mean, squared deviations
        buffer, rows = [], 0

        def count():
            for i, br in enumerate(edges):
                if not br:
                    continue
                v = np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in buffer]).astype(np.float64)
                v = np.sort(v[~np.isnan(v)] + 0.0)          # -0.0 and 0.0 are one value
                if moments and len(v):
                    n, m, q = total[i]
                    mean = v.mean()
                    off = mean - m
                    total[i] = n + len(v), m + off * len(v) / (n + len(v)), q + ((v - mean) ** 2).sum() + off * off * n * len(v) / (n + len(v))
                for k, bracket in enumerate(br):
                    got = cut(v, *bracket)
                    if got:
                        parts = held.setdefault((i, k), [])
                        parts.append(got)
                        if len(parts) >= 8:
                            held[i, k] = [merge(parts)]

        for b in batches:
            buffer.append(b)
            rows += b.num_rows
            if rows >= _CHUNK_ROWS:
                count()
                buffer, rows = [], 0
        if rows:
            count()
        out = [(np.full(len(got[0]), i), np.full(len(got[0]), k), *got) for (i, k), parts in held.items() for got in [merge(parts)]]
        if moments:
            i = np.flatnonzero(total[:, 0])
            out.append((i, np.full(len(i), -1), np.full(len(i), TaskContext.get().partitionId()), total[i, 0], total[i, 1], total[i, 2]))
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
        for arrays in out:
            yield pa.RecordBatch.from_arrays([pa.array(a.astype(t.to_pandas_dtype())) for a, t in zip(arrays, kinds)], names=["col", "b", "s", "c", "mn", "mx"])

    counted = x.mapInArrow(run, "col int, b int, s long, c long, mn double, mx double")
    return counted.groupBy("col", "b", "s").agg(F.sum("c").alias("c"), F.min("mn").alias("mn"), F.max("mx").alias("mx"))


def _ranked(counts: DataFrame, group: Sequence[str]) -> DataFrame:
    """Add first rank ``r0``, end ``r1`` and rows of the group ``n``; a window
    over one bracket's sub-ranges, whose number is bounded."""
    w = Window.partitionBy(*group).orderBy("s")
    return counts.withColumn("r1", F.sum("c").over(w.rowsBetween(Window.unboundedPreceding, 0))) \
        .withColumn("r0", F.col("r1") - F.col("c")).withColumn("n", F.sum("c").over(Window.partitionBy(*group)))


class ColumnQuantiles:
    """Quantiles (and, if asked, moments) of several columns of a table."""

    def __init__(self, df: DataFrame, cols: Sequence[str], probs: Sequence[float], moments: bool = False,
                 sub_ranges: int = SUB_RANGES, limit: int = EXACT_ROWS):
        self.cols, self.probs = list(cols), [float(p) for p in probs]
        self.scans = 0
        #: (column number, probability number) -> quantile
        self.values: dict[tuple[int, int], float] = {}
        self.counts = None
        if self.cols and (self.probs or moments):
            self._search(df, moments, sub_ranges, limit)

    def _search(self, df: DataFrame, moments: bool, sub_ranges: int, limit: int) -> None:
        whole = (-math.inf, math.inf, _shift(-math.inf, math.inf, 1 << 62, sub_ranges, limit))
        counts = count_sub_ranges(df, self.cols, [[whole]] * len(self.cols), moments)
        self.scans = 1
        if moments:
            counts = self.counts = _save(counts)
        ranked = _ranked(counts.where("b = 0"), ["col"])
        wanted = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), f(F.lit(p) * (F.col("n") - 1)).cast("long").alias("r"))
                                     for i, p in enumerate(self.probs) for f in (F.floor, F.ceil)))) if self.probs else None
        if wanted is None:
            return
        hits = ranked.select("*", wanted.alias("w")).where("w.r >= r0 AND w.r < r1").select(
            "col", "w.i", "w.r", (F.col("w.r") - F.col("r0")).alias("at"), "c", "mn", "mx", "n").distinct().collect()     # 2 a column and probability
        n = {h["col"]: h["n"] for h in hits}
        found: dict[tuple[int, int], float] = {}            # (column, rank) -> value
        open_: dict[tuple[int, int], tuple] = {}            # (column, rank) -> (rank inside, rows, least, greatest)
        for h in hits:
            open_[h["col"], h["r"]] = (h["at"], h["c"], h["mn"], h["mx"])
        while True:
            for key, (at, c, mn, mx) in list(open_.items()):
                if at == 0 or at == c - 1 or mn == mx:
                    found[key] = mn if at == 0 else mx
                    del open_[key]
            if not open_:
                break
            spans = [sorted({(mn, mx, c) for (j, _), (_, c, mn, mx) in open_.items() if j == i}) for i in range(len(self.cols))]
            counts = count_sub_ranges(df, self.cols, [[(mn, mx, _shift(mn, mx, c, sub_ranges, limit)) for mn, mx, c in s] for s in spans])
            self.scans += 1
            asked = [(i, spans[i].index((mn, mx, c)), r, at) for (i, r), (at, c, mn, mx) in open_.items()]
            asked = df.sparkSession.createDataFrame(asked, "col int, b int, rank long, at long")
            got = _ranked(counts, ["col", "b"]).join(F.broadcast(asked), ["col", "b"]).where("at >= r0 AND at < r1").select(
                "col", "rank", "n", (F.col("at") - F.col("r0")).alias("at"), "c", "mn", "mx").collect()
            new = {(g["col"], g["rank"]): g for g in got}
            if new.keys() != open_.keys() or any(g["n"] != open_[k][1] for k, g in new.items()):
                raise RuntimeError(_CHANGED)
            open_ = {k: (g["at"], g["c"], g["mn"], g["mx"]) for k, g in new.items()}
        for j, m in n.items():
            for i, p in enumerate(self.probs):
                pos = p * (m - 1)
                lo, hi = found[j, math.floor(pos)], found[j, math.ceil(pos)]
                self.values[j, i] = lo + (pos - math.floor(pos)) * (hi - lo) if lo != hi else lo

    def moments(self) -> DataFrame:
        """col, count, mean, std, min, max of the columns that have values, from
        the first scan."""
        tasks = self.counts.where("b = -1")
        mean = tasks.groupBy("col").agg((F.sum(F.col("c") * F.col("mn")) / F.sum("c")).alias("mean"))
        off = F.col("mn") - F.col("mean")
        std = tasks.join(F.broadcast(mean), "col").groupBy("col").agg(
            F.sum("c").alias("count"), F.max("mean").alias("mean"), F.sqrt(F.try_divide(F.sum(F.col("mx") + F.col("c") * off * off), F.sum("c") - 1)).alias("std"))
        return std.join(self.counts.where("b = 0").groupBy("col").agg(F.min("mn").alias("min"), F.max("mx").alias("max")), "col")


# ---------------------------------------------------------------- groups

def _first_place(v) -> F.Column:
    """Sub-range of a double among all of them: its sign and 1/64 octave;
    infinities have their own."""
    octave = F.when(F.abs(v) == float("inf"), 200_000.0).otherwise(F.floor(F.log2(F.abs(v)) * 64) + 100_000)
    return F.when(v == 0, 0.0).otherwise(F.signum(v) * octave).cast("double")


def _group_quantiles(df: DataFrame, value_col: str, probs: list[float], keys: list[str], sub_ranges: int, limit: int) -> DataFrame:
    names = [f"_k{i}" for i in range(len(keys))]
    base = df.select(*(F.col(k).alias(n) for k, n in zip(keys, names)), (F.col(value_col).cast("double") + 0.0).alias("v")) \
        .where(F.col("v").isNotNull() & ~F.isnan("v"))
    for k in names:
        base = base.where(F.col(k).isNotNull())
    counts = base.groupBy(*names, _first_place(F.col("v")).alias("s")).agg(F.count(F.lit(1)).alias("c"), F.min("v").alias("mn"), F.max("v").alias("mx"))
    pos = [F.lit(p) * (F.col("n") - 1) for p in probs]
    wanted = F.explode(F.array(*(F.struct(F.lit(p).alias("p"), F.lit(side).alias("side"), f(x).cast("long").alias("r"))
                                 for p, x in zip(probs, pos) for side, f in enumerate((F.floor, F.ceil)))))
    known = _save(_ranked(counts, names).select("*", wanted.alias("w")).where("w.r >= r0 AND w.r < r1").select(
        *names, "w.p", "w.side", "n", (F.col("w.r") - F.col("r0")).alias("at"), "c", "mn", "mx"))
    ended = (F.col("at") == 0) | (F.col("at") == F.col("c") - 1) | (F.col("mn") == F.col("mx"))
    value = F.when(F.col("at") == 0, F.col("mn")).otherwise(F.col("mx"))
    done = [known.where(ended).select(*names, "p", "side", "n", value.alias("x"))]
    left = known.where(~ended)
    while left.take(1):
        spans = left.select(*names, F.col("mn").alias("lo"), F.col("mx").alias("hi"), F.col("c").alias("rows")).distinct()
        place = F.when((F.col("rows") <= limit), F.col("v")).otherwise(F.floor((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * sub_ranges).cast("double"))
        near = base.join(checked_broadcast(spans), names).where("v >= lo AND v <= hi")
        counts = near.groupBy(*names, "lo", place.alias("s")).agg(F.count(F.lit(1)).alias("c"), F.min("v").alias("mn"), F.max("v").alias("mx"))
        asked = left.select(*names, F.col("mn").alias("lo"), "p", "side", F.col("n").alias("all"), "at", F.col("c").alias("rows"))
        known = _save(_ranked(counts, [*names, "lo"]).join(asked, [*names, "lo"]).where("at >= r0 AND at < r1").select(
            *names, "p", "side", F.col("all").alias("n"), (F.col("at") - F.col("r0")).alias("at"), "c", "mn", "mx",
            F.when(F.col("n") != F.col("rows"), F.raise_error(F.lit(_CHANGED))).cast("int").alias("checked")))
        done.append(known.where(ended).select(*names, "p", "side", "n", value.alias("x")))
        left = known.where(~ended)
    both = done[0]
    for d in done[1:]:
        both = both.unionByName(d)
    at = F.col("p") * (F.col("n") - 1)
    return both.groupBy(*names, "p", "n").agg(F.max(F.when(F.col("side") == 0, F.col("x"))).alias("lo"), F.max(F.when(F.col("side") == 1, F.col("x"))).alias("hi")) \
        .select(*(F.col(n).alias(k) for n, k in zip(names, keys)), "p",
                F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise(F.col("lo") + (at - F.floor(at)) * (F.col("hi") - F.col("lo"))).alias("q"))


# ---------------------------------------------------------------- interface

def exact_quantiles(df: DataFrame, value_col: str, probs: Sequence[float], keys: Sequence[str] = (),
                    method: str = "exact", accuracy: int = ACCURACY, sub_ranges: int = SUB_RANGES, limit: int = EXACT_ROWS) -> DataFrame:
    """Quantiles of ``value_col`` per group.

    Returns ``keys..., p double, q double`` with one row per key and
    probability (keys with no non-NULL value are absent).
    """
    keys, probs = list(keys), [float(p) for p in probs]
    if method == "approx":
        base = df.select(*keys, (F.col(value_col).cast("double") + 0.0).alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
        for k in keys:
            base = base.where(F.col(k).isNotNull())
        points = F.array(*(F.lit(p) for p in probs))
        agg = base.groupBy(*keys).agg(F.percentile_approx("_v", points, accuracy).alias("_qs"))
        return agg.select(*keys, F.posexplode("_qs").alias("_i", "q")).select(*keys, F.element_at(points, F.col("_i") + 1).alias("p"), "q")
    if keys:
        return _group_quantiles(df, value_col, probs, keys, sub_ranges, limit)
    got = ColumnQuantiles(df, [value_col], probs, sub_ranges=sub_ranges, limit=limit).values
    return df.sparkSession.createDataFrame([(probs[i], q) for (_, i), q in sorted(got.items())], "p double, q double")


def quantile_columns(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                     keys: Sequence[str] = (), method: str = "exact", **kw) -> DataFrame:
    """Quantiles of several columns: ``keys..., column, p, q``."""
    cols, probs = list(cols), [float(p) for p in probs]
    if not keys and method == "exact":
        kw.pop("accuracy", None)
        got = ColumnQuantiles(df, cols, probs, **kw).values
        rows = [(cols[j], probs[i], q) for (j, i), q in sorted(got.items())]
        return df.sparkSession.createDataFrame(rows, "column string, p double, q double")
    stack = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("_x")) for c in cols]))
    long = df.select(*keys, stack.alias("_s")).select(*keys, "_s.column", "_s._x")
    return exact_quantiles(long, "_x", probs, list(keys) + ["column"], method=method, **kw)


def quantile_row(df: DataFrame, cols: Sequence[str], probs: Sequence[float], **kw) -> DataFrame:
    """One-row DataFrame with a column ``<col>_p<pct>`` per column and probability.

    Handy as a scalar-subquery source (``.scalar()``) for fences and fills.
    """
    q = quantile_columns(df, cols, probs, **kw)
    sel = [F.max(F.when((F.col("column") == c) & (F.col("p") == float(p)), F.col("q")))
           .alias(f"{c}_p{_pct(p)}") for c in cols for p in probs]
    return q.agg(*sel)


def _pct(p: float) -> str:
    s = f"{p * 100:g}"
    return s.replace(".", "_")
