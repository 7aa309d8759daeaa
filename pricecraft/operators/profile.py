"""Table profiling: missing values, distributions, moments, correlations.

Wide statistics are computed in one aggregation pass over the table
(partial aggregation on every executor) and then stacked to long form; only
quantiles take the skew-safe exact operator.  Global scalars (min, max,
totals) reach row expressions as scalar subqueries, never through a
partition-less window.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.binning import width_bucket_closed
from ..functions.scalars import SENTINEL
from .joins import ScalarRow
from .quantiles import ColumnQuantiles, exact_quantiles


def _stack(one_row: DataFrame, parts: list[Column]) -> DataFrame:
    return one_row.select(F.explode(F.array(*parts)).alias("_s")).select("_s.*")


def missing_report(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Per column: NULL count and percent of rows (long form)."""
    cols = list(cols or df.columns)
    one = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count_if(F.col(c).isNull()).alias(f"_m{i}") for i, c in enumerate(cols)])
    return _stack(one, [F.struct(F.lit(c).alias("column"), F.col(f"_m{i}").alias("missing"),
                                 (F.col(f"_m{i}") * 100.0 / F.col("_n")).alias("missing_pct"))
                        for i, c in enumerate(cols)])


def filter_nonzero_missing(report: DataFrame) -> DataFrame:
    return report.where(F.col("missing") > 0)


def sentinel_report(df: DataFrame, cols: Sequence[str], sentinel: str = SENTINEL) -> DataFrame:
    """Per string column: rows equal to the sentinel and their percent."""
    one = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count_if(F.col(c) == sentinel).alias(f"_s{i}") for i, c in enumerate(cols)])
    return _stack(one, [F.struct(F.lit(c).alias("column"), F.col(f"_s{i}").alias("n_sentinel"),
                                 (F.col(f"_s{i}") * 100.0 / F.col("_n")).alias("sentinel_pct"))
                        for i, c in enumerate(cols)])


def missing_matrix(df: DataFrame, key: str, cols: Sequence[str], n: int = 100) -> DataFrame:
    """0/1 missing flags of the first ``n`` rows by ``key``, long form."""
    head = df.orderBy(key).limit(n)
    return head.select(key, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).isNull().cast("int").alias("is_missing"))
        for c in cols])).alias("_s")).select(key, "_s.*")


def describe(df: DataFrame, cols: Sequence[str], digits: int | None = 3, **qkw) -> DataFrame:
    """count, mean, std, min, 25/50/75 %, max per column (exact quartiles).

    Moments and the first sub-range counts of the quartiles come from one
    scan; it runs when the function is called.
    """
    cols = list(cols)
    quartiles = {0.25: "q25", 0.5: "q50", 0.75: "q75"}
    search = ColumnQuantiles(df, cols, list(quartiles), moments=True, **qkw)
    rows = [(i, c, *(search.values.get((i, k)) for k in range(3))) for i, c in enumerate(cols)]
    q = df.sparkSession.createDataFrame(rows, "col int, column string, q25 double, q50 double, q75 double")
    r = lambda c: (F.round(F.col(c), digits) if digits is not None else F.col(c)).alias(c)
    return q.join(F.broadcast(search.moments()), "col", "left").select(
        "column", F.coalesce("count", F.lit(0)).alias("count"), r("mean"), r("std"), r("min"), r("q25"), r("q50"), r("q75"), r("max"))


def corrected_skew(x: Column) -> tuple[Column, Column]:
    """(bias-corrected skewness G1, bias-corrected excess kurtosis G2) like pandas."""
    n = F.count(x).cast("double")
    g1 = F.skewness(x)
    g2 = F.kurtosis(x)
    skew = F.when(n > 2, g1 * F.sqrt(n * (n - 1)) / (n - 2))
    kurt = F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6))
    return skew, kurt


def _median_scalar(df: DataFrame, col: str, **qkw) -> Column:
    return exact_quantiles(df, col, [0.5], **qkw).select("q").scalar()


def target_summary(df: DataFrame, col: str, **qkw) -> DataFrame:
    """min, max, mean, median, std, skewness, kurtosis of one column."""
    x = F.col(col).cast("double")
    skew, kurt = corrected_skew(x)
    return df.agg(F.min(x).alias("min"), F.max(x).alias("max"), F.avg(x).alias("mean"),
                  F.stddev_samp(x).alias("std"), skew.alias("skew"), kurt.alias("kurtosis")).select(
        "min", "max", "mean", _median_scalar(df, col, **qkw).alias("median"), "std", "skew", "kurtosis")


def prediction_summary(df: DataFrame, col: str = "prediction", **qkw) -> DataFrame:
    x = F.col(col).cast("double")
    return df.agg(F.min(x).alias("min"), F.max(x).alias("max"), F.avg(x).alias("mean")).select(
        "min", "max", "mean", _median_scalar(df, col, **qkw).alias("median"))


def target_transform_summary(df: DataFrame, col: str, **qkw) -> DataFrame:
    """Mean and median of the target, raw and after log1p."""
    t = df.select(F.col(col).cast("double").alias("raw"), F.log1p(F.col(col)).alias("logged"))
    return t.agg(F.avg("raw").alias("raw_mean"), F.avg("logged").alias("log_mean")).select(
        "raw_mean", _median_scalar(t, "raw", **qkw).alias("raw_median"),
        "log_mean", _median_scalar(t, "logged", **qkw).alias("log_median"))


def n_distinct(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct non-NULL values per column."""
    # values as text in one long column: a partial distinct, then one count
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("x")) for c in cols])).alias("_s")) \
        .select("_s.*").where("x IS NOT NULL").distinct().groupBy("column").agg(F.count(F.lit(1)).alias("n"))
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "column string")
    return names.join(long, "column", "left").select("column", F.coalesce("n", F.lit(0)).alias("n_distinct"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """value -> count, NULL excluded, most frequent first (ties by value)."""
    return (df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value"))
              .agg(F.count(F.lit(1)).alias("count"))
              .orderBy(F.desc("count"), F.asc("value")))


def value_counts_topk(df: DataFrame, col: str, k: int) -> DataFrame:
    return value_counts(df, col).limit(k)


def value_share(df: DataFrame, col: str) -> DataFrame:
    """Percent share per value among non-NULL rows."""
    nn = df.where(F.col(col).isNotNull())
    total = nn.agg(F.count(F.lit(1))).scalar()
    return value_counts(df, col).select("value", "count", (F.col("count") * 100.0 / total).alias("share_pct"))


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """Equal-width histogram; the maximum goes to the last bin; empty bins kept."""
    x = F.col(col).cast("double")
    vals = df.select(x.alias("x")).where(F.col("x").isNotNull())
    mm = ScalarRow(vals.agg(F.min("x").alias("mn"), F.max("x").alias("mx")))
    mn, mx = mm["mn"], mm["mx"]
    width = (mx - mn) / bins
    counts = (vals.select(width_bucket_closed(F.col("x"), mn, width, bins).alias("bin"))
                  .groupBy("bin").agg(F.count(F.lit(1)).alias("count")))
    spark = df.sparkSession
    grid = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (grid.join(F.broadcast(counts), "bin", "left")
                .select("bin", (mn + F.col("bin") * width).alias("lo"),
                        (mn + (F.col("bin") + 1) * width).alias("hi"),
                        F.coalesce(F.col("count"), F.lit(0)).alias("count")))


def histogram_many(df: DataFrame, cols: Sequence[str], bins: int) -> DataFrame:
    """Histogram of several columns at once (long form: column, bin, lo, hi,
    count), empty bins and edges included; a column without values has none."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in cols]
    )).alias("_s")).select("_s.*").where(F.col("x").isNotNull())
    # one row per column: bounded by the number of columns, safe to broadcast
    rng = long.groupBy("column").agg(F.min("x").alias("mn"), F.max("x").alias("mx"))
    b = (long.join(F.broadcast(rng), "column")
             .select("column", width_bucket_closed(F.col("x"), F.col("mn"),
                                                   (F.col("mx") - F.col("mn")) / bins, bins).alias("bin")))
    counts = b.groupBy("column", "bin").agg(F.count(F.lit(1)).alias("count"))
    width = (F.col("mx") - F.col("mn")) / bins
    grid = rng.select("column", "mn", width.alias("_w"), F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return grid.join(counts, ["column", "bin"], "left").select(
        "column", "bin", (F.col("mn") + F.col("bin") * F.col("_w")).alias("lo"),
        (F.col("mn") + (F.col("bin") + 1) * F.col("_w")).alias("hi"), F.coalesce("count", F.lit(0)).alias("count"))


# Fine bins of a bandwidth, and bandwidths beyond which the kernel counts as 0 (exp(-32) of its height).
DENSITY_BINS, DENSITY_REACH = 64, 8


def density_grid(df: DataFrame, col: str, grid: int = 1000, bins: int = DENSITY_BINS) -> DataFrame:
    """Gaussian kernel density on an even grid (Scott bandwidth h).

    Linear binning: the places of an even mesh of h / ``bins`` share each value
    between its two neighbours, one aggregation; the kernel is summed from the
    mesh places within ``DENSITY_REACH`` h of a grid point.  A linear share
    misses a kernel's height by at most 1 / (8 bins²) of its peak (its greatest
    second derivative is its peak / h²), so the density is within
    1 / (8 bins² h sqrt(2 pi)), 3e-5 of one kernel's peak, of the exact sum.
    The grid spans min - range/2 .. max + range/2.
    """
    x = F.col(col).cast("double")
    vals = df.select(x.alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x"))
    st = ScalarRow(vals.agg(F.count("x").alias("n"), F.min("x").alias("mn"), F.max("x").alias("mx"),
                            F.stddev_samp("x").alias("sd")))
    n, mn, mx, sd = (st[c] for c in ("n", "mn", "mx", "sd"))
    h = sd * F.pow(n.cast("double"), F.lit(-0.2))
    w = h / bins
    at = (F.col("x") - mn) / w
    share = vals.select(F.floor(at).alias("b"), (at - F.floor(at)).alias("f"))
    both = F.explode(F.array(F.struct(F.col("b").alias("b"), (1 - F.col("f")).alias("c")), F.struct((F.col("b") + 1).alias("b"), F.col("f").alias("c"))))
    mesh = share.select(both.alias("m")).select("m.*").groupBy("b").agg(F.sum("c").alias("c"))
    start = mn - (mx - mn) * 0.5
    step = (mx - mn) * 2.0 / (grid - 1)
    place = mn + F.col("b") * w
    first = F.greatest(F.lit(0), F.ceil((place - DENSITY_REACH * h - start) / step)).cast("int")
    last = F.least(F.lit(grid - 1), F.floor((place + DENSITY_REACH * h - start) / step)).cast("int")
    pts = mesh.withColumn("place", place).withColumn("first", first).withColumn("last", last).where("first <= last") \
        .select("place", "c", F.explode(F.sequence("first", "last")).alias("i"))
    term = F.col("c") * F.exp(-0.5 * F.pow((start + F.col("i") * step - F.col("place")) / h, 2))
    sums = pts.groupBy("i").agg(F.sum(term).alias("_s"))
    every = df.sparkSession.range(grid).select(F.col("id").cast("int").alias("i"))
    return every.join(F.broadcast(sums), "i", "left").select(
        "i", (start + F.col("i") * step).alias("x"), (F.coalesce("_s", F.lit(0.0)) / (n * h * math.sqrt(2 * math.pi))).alias("density"))


def boxplot_stats(df: DataFrame, col: str, whisker: float = 1.5, **qkw) -> DataFrame:
    """Quartiles, 1.5 IQR fences, whisker ends and outlier count."""
    q = exact_quantiles(df, col, [0.25, 0.5, 0.75], **qkw)
    qs = ScalarRow(q.agg(*[F.max(F.when(F.col("p") == p, F.col("q"))).alias(n)
                           for p, n in [(0.25, "q1"), (0.5, "q2"), (0.75, "q3")]]))
    q1, q2, q3 = qs["q1"], qs["q2"], qs["q3"]
    lo = q1 - (q3 - q1) * whisker
    hi = q3 + (q3 - q1) * whisker
    x = F.col(col).cast("double")
    return df.agg(
        F.min(F.when(x >= lo, x)).alias("whisker_lo"), F.max(F.when(x <= hi, x)).alias("whisker_hi"),
        F.count_if((x < lo) | (x > hi)).alias("n_outliers")).select(
        q1.alias("q1"), q2.alias("median"), q3.alias("q3"), (q3 - q1).alias("iqr"),
        lo.alias("fence_lo"), hi.alias("fence_hi"), "whisker_lo", "whisker_hi", "n_outliers")


def pair_corr(x: Column, y: Column) -> Column:
    """Pearson r on pairwise non-NULL rows; NULL (not an error) for a constant column."""
    both = x.isNotNull() & y.isNotNull()
    xx, yy = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(xx, yy), F.stddev_pop(xx) * F.stddev_pop(yy))


def correlation_with_target(df: DataFrame, cols: Sequence[str], target: str,
                            top: int | None = None) -> DataFrame:
    """r of each column with the target, strongest positive first (pairwise
    complete rows; NULL for a constant column or without a complete pair).

    One scan: a task adds up counts, means and co-moments of its rows for all
    columns side by side; the tasks' sums are merged in Spark, in order.
    """
    cols = list(cols)
    k = len(cols)
    x = df.select(*(F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate([*cols, target])))
    names = ["n", "mx", "my", "xx", "yy", "xy"]

    def add(a, b):
        """Both (6, k): the sums of two disjoint sets of rows."""
        n = a[0] + b[0]
        with np.errstate(invalid="ignore", divide="ignore"):
            share = np.where(n > 0, b[0] / n, 0.0)
        dx, dy, f = b[1] - a[1], b[2] - a[2], a[0] * share
        return np.stack([n, np.where(a[0] > 0, a[1] + dx * share, b[1]), np.where(a[0] > 0, a[2] + dy * share, b[2]),
                         a[3] + b[3] + dx * dx * f, a[4] + b[4] + dy * dy * f, a[5] + b[5] + dx * dy * f])

    def run(batches):
        total = np.zeros((6, k))
        for b in batches:
            if not b.num_rows:
                continue
            v = np.column_stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(k + 1)]).astype(np.float64)
            v, y = v[:, :k], v[:, k:]
            there = ~np.isnan(v) & ~np.isnan(y)
            n = there.sum(0)
            first = np.argmax(there, axis=0)
            # moved by the first value, so that a constant column has no spread at all
            x0, y0 = v[first, np.arange(k)], y[first, 0]
            dv, dy = np.where(there, v - x0, 0.0), np.where(there, y - y0, 0.0)
            m = np.maximum(n, 1)
            ax, ay = dv.sum(0) / m, dy.sum(0) / m
            ex, ey = np.where(there, dv - ax, 0.0), np.where(there, dy - ay, 0.0)
            part = np.stack([n.astype(np.float64), np.where(n, x0 + ax, 0.0), np.where(n, y0 + ay, 0.0), (ex * ex).sum(0), (ey * ey).sum(0), (ex * ey).sum(0)])
            total = add(total, part)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k, dtype=np.int32)), pa.array(np.full(k, TaskContext.get().partitionId(), np.int32)),
                                          *(pa.array(total[i].copy()) for i in range(6))], names=["col", "task", *names])

    sums = x.mapInArrow(run, "col int, task int, " + ", ".join(f"{c} double" for c in names)).where("n > 0")

    def merge(a: Column, b: Column) -> Column:
        n = a["n"] + b["n"]
        share = F.try_divide(b["n"], n)
        dx, dy, f = b["mx"] - a["mx"], b["my"] - a["my"], a["n"] * share
        return F.struct(n.alias("n"), (a["mx"] + dx * share).alias("mx"), (a["my"] + dy * share).alias("my"), (a["xx"] + b["xx"] + dx * dx * f).alias("xx"),
                        (a["yy"] + b["yy"] + dy * dy * f).alias("yy"), (a["xy"] + b["xy"] + dx * dy * f).alias("xy"))

    tasks = sums.groupBy("col").agg(F.array_sort(F.collect_list(F.struct("task", *names))).alias("s"))             # one small row a task
    whole = tasks.select("col", F.aggregate(F.slice("s", F.lit(2), F.size("s")), F.struct(*(F.col("s")[0][c].alias(c) for c in names)), merge).alias("t"))
    r = whole.select("col", F.try_divide("t.xy", F.sqrt("t.xx") * F.sqrt("t.yy")).alias("corr"))
    every = df.sparkSession.createDataFrame(list(enumerate(cols)), "col int, column string")
    out = every.join(F.broadcast(r), "col", "left").select("column", "corr").orderBy(F.desc_nulls_last("corr"), F.asc("column"))
    return out.limit(top) if top else out


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """All pairs (long form col_a, col_b, corr), pairwise complete, one pass.

    Every task gives the sums of its rows as small matrices: with the values
    moved by the first row's (for precision), counts, sums, squares and products
    over the rows where both columns are present.  They are added up in Spark.
    """
    cols = list(cols)
    k = len(cols)
    x = df.select(*(F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)))
    got = x.agg(*(F.avg(f"c{i}").alias(f"c{i}") for i in range(k))).first()
    mid = np.array([got[i] if got[i] is not None else 0.0 for i in range(k)])

    def run(batches):
        total = np.zeros((4, k, k))
        for b in batches:
            v = np.column_stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(k)]).astype(np.float64)
            there = ~np.isnan(v)
            m = there.astype(np.float64)
            v = np.where(there, v - mid, 0.0)
            total += np.stack([m.T @ m, v.T @ m, (v * v).T @ m, v.T @ v])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(4 * k * k)), pa.array(total.ravel())], names=["at", "x"])

    sums = x.mapInArrow(run, "at long, x double").groupBy("at").agg(F.sum("x").alias("x")).collect()      # 4 k^2 numbers
    total = np.zeros(4 * k * k)
    for r in sums:
        total[r["at"]] = r["x"]
    n, s, q, p = total.reshape(4, k, k)
    rows = []
    for i in range(k):
        for j in range(k):
            c = n[i, j]
            var = [(q[i, j] / c - (s[i, j] / c) ** 2), (q[j, i] / c - (s[j, i] / c) ** 2)] if c else [0.0, 0.0]
            level = [q[i, j] / c, q[j, i] / c] if c else [0.0, 0.0]
            flat = any(v <= 1e-12 * e for v, e in zip(var, level))
            rows.append((cols[i], cols[j], None if flat else float((p[i, j] / c - s[i, j] / c * s[j, i] / c) / math.sqrt(var[0] * var[1]))))
    return df.sparkSession.createDataFrame(rows, "col_a string, col_b string, corr double")


def low_correlation_report(df: DataFrame, cols: Sequence[str], target: str,
                           threshold: float = 0.01) -> DataFrame:
    """Columns whose |r| with the target is below the threshold (report only)."""
    return correlation_with_target(df, cols, target).where(F.abs(F.col("corr")) < threshold)
