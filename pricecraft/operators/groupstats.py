"""Per-key target statistics, fitted on one table and joined onto another.

Fitting is a ``groupBy().agg()`` (partial aggregation, so a hot key costs
one partial buffer per task, not a big merge); NULL keys are dropped like
pandas ``groupby``.  Applying is a left join through ``left_join_params``
(broadcast only after the row count is checked).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import left_join_params
from .quantiles import exact_quantiles


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _non_null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    for k in keys:
        df = df.where(F.col(k).isNotNull())
    return df


def group_stats(train: DataFrame, keys, target: str, prefix: str,
                stats: Sequence[str] = ("mean", "std", "count")) -> DataFrame:
    """mean / sample std / count of the target per key.

    Output columns are ``<prefix>_avg_price``-style names chosen by ``names``
    below so the reference's feature names are reproduced.
    """
    keys = _keys(keys)
    y = F.col(target).cast("double")
    exprs = {"mean": F.avg(y), "std": F.stddev_samp(y), "count": F.count(y),
             "median": None}
    names = stat_names(prefix)
    aggs = [exprs[s].alias(names[s]) for s in stats if s != "median"]
    out = _non_null_keys(train, keys).groupBy(*keys).agg(*aggs)
    if "median" in stats:
        med = exact_quantiles(train, target, [0.5], keys).select(*keys, F.col("q").alias(names["median"]))
        out = out.join(med, keys, "left")
    return out


def stat_names(prefix: str) -> dict[str, str]:
    return {"mean": f"{prefix}_avg_price", "std": f"{prefix}_price_std",
            "count": f"{prefix}_count", "median": f"{prefix}_price_median"}


def group_stats_median(train: DataFrame, keys, target: str, prefix: str) -> DataFrame:
    """mean, median, std, count (the function-structured variant's names)."""
    keys = _keys(keys)
    y = F.col(target).cast("double")
    base = _non_null_keys(train, keys).groupBy(*keys).agg(
        F.avg(y).alias(f"{prefix}_price_mean"), F.stddev_samp(y).alias(f"{prefix}_price_std"),
        F.count(y).alias(f"{prefix}_price_count"))
    med = exact_quantiles(train, target, [0.5], keys).select(*keys, F.col("q").alias(f"{prefix}_price_median"))
    return base.join(med, keys, "left")


def global_mean(train: DataFrame, target: str) -> Column:
    """Mean of the target as a scalar-subquery column."""
    return train.agg(F.avg(F.col(target).cast("double"))).scalar()


def group_stats_region(train: DataFrame, key: str, target: str, prefix: str = "region") -> DataFrame:
    """mean, std, count per key and the mean relative to the global mean."""
    st = group_stats(train, key, target, prefix)
    gm = global_mean(train, target)
    return st.withColumn(f"{prefix}_multiplier", F.col(f"{prefix}_avg_price") / gm)


def group_mean(train: DataFrame, keys, target: str, name: str) -> DataFrame:
    keys = _keys(keys)
    return _non_null_keys(train, keys).groupBy(*keys).agg(F.avg(F.col(target).cast("double")).alias(name))


def join_stats(df: DataFrame, stats: DataFrame, keys, max_rows: int | None = None) -> DataFrame:
    return left_join_params(df, stats, _keys(keys), max_rows)


def ratio_to_mean(df: DataFrame, col: str, out: str) -> DataFrame:
    """col / (row-weighted mean of col over the whole table)."""
    m = df.agg(F.avg(F.col(col))).scalar()
    return df.withColumn(out, F.col(col) / m)


def freq_table(df: DataFrame, col: str, name: str | None = None) -> DataFrame:
    """value -> share of rows (NULL is a value here; callers fill it first)."""
    total = df.agg(F.count(F.lit(1))).scalar()
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias("_c"))
              .select(col, (F.col("_c") / total).alias(name or f"{col}_freq")))
