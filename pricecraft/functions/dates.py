"""Date features from ``YYYYMMDD`` integers and real dates (Column -> Column).

All functions are built-in expressions, so they stay inside whole-stage
codegen and work unchanged on streaming DataFrames.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import col_of

# Season names by calendar quarter, as in the reference.
QUARTER_SEASONS = {1: "winter", 2: "spring", 3: "summer", 4: "autumn"}
# Fallback for dates that do not parse.
DEFAULT_DATE = "2016-01-01"


def int_date_pad(c) -> Column:
    """Integer date -> string zero-padded to 8 characters; never truncates."""
    s = col_of(c).cast("string")
    return F.lpad(s, F.greatest(F.lit(8), F.length(s)), "0")


def int_date_year(c) -> Column:
    """Characters 1-4 of the padded date, as int."""
    return F.substring(int_date_pad(c), 1, 4).try_cast("int")


def int_date_month(c) -> Column:
    """Characters 5-6 of the padded date, as int (month 00 stays 0)."""
    return F.substring(int_date_pad(c), 5, 2).try_cast("int")


def car_age(year, as_of_year: int) -> Column:
    """Age in whole years against a fixed reference year (repeatable)."""
    return (F.lit(int(as_of_year)) - col_of(year)).cast("int")


def calendar_quarter(month) -> Column:
    """(month - 1) // 3 + 1 with floor division, so month 0 gives quarter 0."""
    return (F.floor((col_of(month) - 1) / 3.0) + 1).cast("int")


def calendar_quarter_clipped(month) -> Column:
    """Quarter moved into 1..4; a NULL month stays NULL."""
    q = calendar_quarter(month)
    return F.when(q.isNotNull(), F.greatest(F.lit(1), F.least(F.lit(4), q)))


def quarter_season(quarter) -> Column:
    """Quarter 1..4 -> season name; anything else -> NULL."""
    q = col_of(quarter)
    out = None
    for k, name in QUARTER_SEASONS.items():
        out = F.when(q == k, name) if out is None else out.when(q == k, name)
    return out


def meteorological_season(month) -> Column:
    """(m % 12 + 3) // 3: Dec-Feb 1, Mar-May 2, Jun-Aug 3, Sep-Nov 4."""
    m = col_of(month)
    return F.floor((F.pmod(m, F.lit(12)) + 3) / 3.0).cast("int")


def int_date_diff(later, earlier) -> Column:
    """Plain integer difference of two YYYYMMDD values (not days)."""
    return (col_of(later) - col_of(earlier)).cast("int")


def parse_date_lenient(c, default: str = DEFAULT_DATE) -> Column:
    """YYYYMMDD integer -> date; anything invalid -> ``default``."""
    s = col_of(c).cast("string")
    parsed = F.when(F.length(s) == 8, F.try_to_date(s, "yyyyMMdd"))
    return F.coalesce(parsed, F.lit(default).cast("date"))


def age_days(later, earlier) -> Column:
    """Day difference, negatives clipped to 0; NULL if a date is NULL."""
    d = F.datediff(col_of(later), col_of(earlier))
    return F.when(d.isNotNull(), F.greatest(d, F.lit(0)))


def age_years(days) -> Column:
    return col_of(days) / 365.0


def date_parts(c, prefix: str) -> list[Column]:
    d = col_of(c)
    return [F.year(d).alias(f"{prefix}_year"), F.month(d).alias(f"{prefix}_month"),
            F.dayofmonth(d).alias(f"{prefix}_day")]
