"""Right-closed binning (``pd.cut`` semantics) as ``CASE WHEN`` chains.

``Bucketizer`` is left-closed, so it is not used.  Out-of-range and NULL
inputs give NULL.  Every bin definition below is a fixed value taken from the
reference; labels are kept verbatim because downstream ordinal codes key on
them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import col_of

# Bin edges and labels (right-closed, first bin closed on the
# left unless noted).
AGE_EDGES = [0, 3, 5, 10, 100]
AGE_LABELS = ["0-3年", "3-5年", "5-10年", "10+年"]
REG_YEAR_EDGES = [1990, 2005, 2010, 2015, 2020]
REG_YEAR_LABELS = ["2005前", "2005-2010", "2010-2015", "2015-2020"]
KM_EDGES = [0, 5, 10, 15, 20, 1000]
KM_LABELS = ["0-5万", "5-10万", "10-15万", "15-20万", "20+万"]
POWER_EDGES = [0, 100, 150, 200, 5000]
POWER_LABELS = ["低功率", "中功率", "高功率", "超高功率"]
KM_INT_EDGES = [0, 5, 10, 15]          # codes 0, 1, 2
AGE_YEARS_EDGES = [-0.01, 1, 3, 5, 10, 100]   # no include_lowest
AGE_YEARS_LABELS = ["0-1年", "1-3年", "3-5年", "5-10年", "10年以上"]
TIER_LABELS = ["budget", "economy", "premium", "luxury"]


def cut(c, edges, labels=None, include_lowest: bool = True) -> Column:
    """Right-closed bins ``(e[i], e[i+1]]``; returns labels or 0-based int codes."""
    x = col_of(c)
    n = len(edges) - 1
    labels = list(range(n)) if labels is None else list(labels)
    if len(labels) != n:
        raise ValueError("need one label per bin")
    out = None
    for i in range(n):
        lo = edges[i]
        lo_ok = (x >= F.lit(lo)) if (i == 0 and include_lowest) else (x > F.lit(lo))
        cond = lo_ok & (x <= F.lit(edges[i + 1]))
        out = F.when(cond, F.lit(labels[i])) if out is None else out.when(cond, F.lit(labels[i]))
    return out


def cut_by_columns(c, edge_cols: list[Column], labels) -> Column:
    """Right-closed bins whose inner edges are columns (fitted quantiles).

    ``edge_cols`` holds the n-1 inner edges; the first bin takes everything up
    to the first edge and the last everything above the last edge.  A value
    equal to an edge goes to the lower bin; coinciding edges leave the upper
    bin empty.
    """
    x = col_of(c)
    out = None
    for i, e in enumerate(edge_cols):
        out = F.when(x <= e, F.lit(labels[i])) if out is None else out.when(x <= e, F.lit(labels[i]))
    return out.when(x.isNotNull(), F.lit(labels[len(edge_cols)]))


def cut_age(c) -> Column:
    return cut(c, AGE_EDGES, AGE_LABELS)


def cut_reg_year(c) -> Column:
    return cut(c, REG_YEAR_EDGES, REG_YEAR_LABELS)


def cut_km(c) -> Column:
    return cut(c, KM_EDGES, KM_LABELS)


def cut_power(c) -> Column:
    return cut(c, POWER_EDGES, POWER_LABELS)


def cut_km_int(c) -> Column:
    return cut(c, KM_INT_EDGES, None)


def cut_age_years(c) -> Column:
    return cut(c, AGE_YEARS_EDGES, AGE_YEARS_LABELS, include_lowest=False)


def width_bucket_closed(x, lo: Column, width: Column, n: int) -> Column:
    """Equal-width bin 0..n-1; the maximum falls in the last bin."""
    b = F.floor(F.try_divide(col_of(x) - lo, width))
    return F.least(F.coalesce(b, F.lit(0)), F.lit(n - 1)).cast("int")
