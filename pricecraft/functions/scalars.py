"""Row-level cleaning, arithmetic and flag expressions (Column -> Column)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The missing-value marker used in string columns.
SENTINEL = "-"
# Label for a missing category (frequency encoding) and for
# filling non-numeric columns.
UNKNOWN_LABEL = "未知"
MISSING_LABEL = "missing"


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sentinel_to_numeric(c, sentinel: str = SENTINEL) -> Column:
    """'-' -> NULL, then a lenient cast to double (bad text -> NULL)."""
    return F.nullif(col_of(c).cast("string"), F.lit(sentinel)).try_cast("double")


def sentinel_to_default(c, default: float = -1.0, sentinel: str = SENTINEL) -> Column:
    return F.coalesce(sentinel_to_numeric(c, sentinel), F.lit(float(default)))


def nan_to_null(c) -> Column:
    x = col_of(c)
    return F.when(~F.isnan(x), x)


def log1p(c) -> Column:
    """log(1 + x); x <= -1 gives NULL."""
    return F.log1p(col_of(c))


def square(c) -> Column:
    x = col_of(c)
    return x * x


def safe_div(a, b) -> Column:
    """a / b with NULL for a zero divisor (ANSI-safe)."""
    return F.try_divide(col_of(a).cast("double"), col_of(b).cast("double"))


def ratio_plus(a, b, plus: float = 1.0) -> Column:
    """a / (b + plus), the reference's guarded ratio."""
    return safe_div(a, col_of(b) + F.lit(plus))


def product(a, b) -> Column:
    return col_of(a) * col_of(b)


def km_per_year(km, age) -> Column:
    return ratio_plus(km, age, 1.0)


def km_per_year_frac(km, age_years) -> Column:
    return ratio_plus(km, age_years, 0.1)


def flag_missing(c) -> Column:
    return col_of(c).isNull().cast("int")


def flag(cond: Column) -> Column:
    """Boolean condition -> 0/1 int; NULL comparisons count as 0."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def clip_nonneg_int(c) -> Column:
    """max(p, 0) truncated toward zero to a long; NULL stays NULL."""
    x = col_of(c)
    return F.when(x.isNotNull(), F.greatest(x, F.lit(0.0)).cast("long"))


def clip(c, lo: Column | float, hi: Column | float) -> Column:
    """c moved into [lo, hi]; NULL stays NULL."""
    lo = lo if isinstance(lo, Column) else F.lit(lo)
    hi = hi if isinstance(hi, Column) else F.lit(hi)
    x = col_of(c)
    return F.when(x.isNotNull(), F.greatest(lo, F.least(hi, x)))


def md5_order(c) -> Column:
    """Repeatable pseudo-random order: first 32 bits of md5(value) as a long."""
    return F.conv(F.substring(F.md5(col_of(c).cast("string")), 1, 8), 16, 10).cast("long")


def hash_pct(c) -> Column:
    """Repeatable 0..99 bucket of a value."""
    return (md5_order(c) % 100).cast("int")


def concat_key(*cols, sep: str = "_", null_text: str = "nan") -> Column:
    """str(a) + '_' + str(b); a NULL prints as 'nan' like pandas."""
    return F.concat_ws(sep, *[F.coalesce(col_of(c).cast("string"), F.lit(null_text)) for c in cols])
