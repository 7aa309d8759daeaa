"""Quantile tiers, outlier fences, winsorising and IQR row filtering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.binning import TIER_LABELS, cut_by_columns
from ..functions.scalars import clip, flag
from .joins import ScalarRow
from .quantiles import exact_quantiles, quantile_row


def qcut_tier(stats: DataFrame, col: str, out: str, labels: Sequence[str] = TIER_LABELS,
              digits: int = 6, **qkw) -> DataFrame:
    """Quantile bins of ``col`` over the rows of ``stats`` (e.g. one row per brand).

    Edges are the exact 1/k .. (k-1)/k quantiles of the value rounded to
    ``digits`` (rounding first keeps a value that equals an edge in the lower
    bin on every engine).  Right-closed like ``pd.qcut``; coinciding edges
    give the lower label.
    """
    k = len(labels)
    probs = [i / k for i in range(1, k)]
    r = stats.withColumn("_qt_x", F.round(F.col(col), digits))
    q = exact_quantiles(r, "_qt_x", probs, **qkw)
    s = ScalarRow(q.agg(*[F.max(F.when(F.col("p") == i / k, F.col("q"))).alias(f"e{i}") for i in range(1, k)]))
    edges = [s[f"e{i}"] for i in range(1, k)]
    return r.withColumn(out, cut_by_columns(F.col("_qt_x"), edges, labels)).drop("_qt_x")


def fences(df: DataFrame, cols: Sequence[str], lo_p: float = 0.05, hi_p: float = 0.95,
           k: float = 1.5, **qkw) -> DataFrame:
    """One row: ``<c>_lo`` = p5 - 1.5 R and ``<c>_hi`` = p95 + 1.5 R, R = p95 - p5."""
    q = quantile_row(df, cols, [lo_p, hi_p], **qkw)
    lo_s, hi_s = _sfx(lo_p), _sfx(hi_p)
    sel = []
    for c in cols:
        a, b = F.col(f"{c}_p{lo_s}"), F.col(f"{c}_p{hi_s}")
        sel += [(a - k * (b - a)).alias(f"{c}_lo"), (b + k * (b - a)).alias(f"{c}_hi")]
    return q.select(*sel)


def _sfx(p: float) -> str:
    return f"{p * 100:g}".replace(".", "_")


def outlier_flag_and_clip(df: DataFrame, cols: Sequence[str], lo_p: float = 0.05,
                          hi_p: float = 0.95, k: float = 1.5, fetch: bool = False, **qkw) -> DataFrame:
    """``<c>_outlier`` flag, then clip ``c`` to the same fences (fences fitted on ``df``)."""
    f = ScalarRow(fences(df, cols, lo_p, hi_p, k, **qkw), fetch)
    out = df
    for c in cols:
        lo, hi = f[f"{c}_lo"], f[f"{c}_hi"]
        x = F.col(c)
        out = out.withColumn(f"{c}_outlier", flag((x < lo) | (x > hi)))
        out = out.withColumn(c, clip(x, lo, hi))
    return out


def iqr_filter(df: DataFrame, cols: Sequence[str], k: float = 1.5, **qkw) -> DataFrame:
    """Drop rows outside Q1 - k IQR .. Q3 + k IQR on any listed column.

    NULL values are kept (they are neither inside nor outside).
    """
    q = ScalarRow(quantile_row(df, cols, [0.25, 0.75], **qkw))
    cond = F.lit(True)
    for c in cols:
        q1, q3 = q[f"{c}_p25"], q[f"{c}_p75"]
        lo, hi = q1 - k * (q3 - q1), q3 + k * (q3 - q1)
        x = F.col(c)
        cond = cond & (x.isNull() | ((x >= lo) & (x <= hi)))
    return df.where(cond)
