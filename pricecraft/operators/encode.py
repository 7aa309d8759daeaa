"""Encoders, imputers and scalers with a fit/apply split.

Each ``fit_*`` returns a small parameter DataFrame (or a one-row table of
scalars) computed by Spark; each ``apply_*`` joins or substitutes it.  Fit on
the training side only; apply to any table, including a stream.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType

from ..functions.binning import AGE_LABELS, KM_LABELS, POWER_LABELS, REG_YEAR_LABELS, TIER_LABELS
from ..functions.dates import QUARTER_SEASONS
from ..functions.scalars import MISSING_LABEL, UNKNOWN_LABEL, md5_order
from .groupstats import global_mean
from .joins import ScalarRow, checked_broadcast, left_join_params
from .prefix import dense_codes, hash_segment, prefix_sums, range_ranks
from .quantiles import quantile_columns

# ---------------------------------------------------------------- target mean


def fit_target_encoding(train: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """Mean target per (feature, value) for several features in ONE pass.

    Long form ``feature, value (string), enc``; NULL values are not fitted.
    """
    y = F.col(target).cast("double")
    long = train.select(y.alias("_y"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in cols
    ])).alias("_s")).select("_s.*", "_y").where(F.col("value").isNotNull())
    return long.groupBy("feature", "value").agg(F.avg("_y").alias("enc"))


def apply_target_encoding(df: DataFrame, params: DataFrame, cols: Sequence[str],
                          fallback: Column, suffix: str = "_encoded") -> DataFrame:
    """``<col>_encoded`` = fitted mean, or ``fallback`` (global mean) if NULL/unseen."""
    p = checked_broadcast(params)
    for c in cols:
        pc = p.where(F.col("feature") == c).select(F.col("value").alias(f"_te_{c}"),
                                                   F.col("enc").alias(f"_enc_{c}"))
        df = (df.join(pc, F.col(c).cast("string") == F.col(f"_te_{c}"), "left")
                .withColumn(f"{c}{suffix}", F.coalesce(F.col(f"_enc_{c}"), fallback))
                .drop(f"_te_{c}", f"_enc_{c}"))
    return df


def target_encode(train: DataFrame, df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    return apply_target_encoding(df, fit_target_encoding(train, cols, target), cols,
                                 global_mean(train, target))


# ------------------------------------------------------------ frequency


def fit_freq_encoding(df: DataFrame, cols: Sequence[str], unknown: str = UNKNOWN_LABEL) -> DataFrame:
    """Share of rows per (feature, value) for several columns in ONE aggregation.

    Long form ``feature, value, freq``; NULL is counted as ``unknown``.
    """
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"),
                 F.coalesce(F.col(c).cast("string"), F.lit(unknown)).alias("value")) for c in cols
    ])).alias("_s")).select("_s.*")
    counts = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("_c"))
    total = counts.where(F.col("feature") == cols[0]).agg(F.sum("_c")).scalar()
    return counts.select("feature", "value", (F.col("_c") / total).alias("freq"))


def freq_encode(df: DataFrame, cols: Sequence[str], unknown: str = UNKNOWN_LABEL) -> DataFrame:
    """NULL -> '未知', the column becomes a string, ``<col>_freq`` = share of rows."""
    cols = list(cols)
    p = checked_broadcast(fit_freq_encoding(df, cols, unknown))
    out = df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(unknown)) for c in cols})
    for c in cols:
        pc = p.where(F.col("feature") == c).select(F.col("value").alias(f"_fv_{c}"),
                                                   F.col("freq").alias(f"{c}_freq"))
        out = out.join(pc, F.col(c) == F.col(f"_fv_{c}"), "left").drop(f"_fv_{c}")
    return out


# ------------------------------------------------------------ fixed maps


def map_values(c, mapping: Mapping, default=None) -> Column:
    """Constant dictionary lookup; unknown -> ``default`` (NULL)."""
    col = F.col(c) if isinstance(c, str) else c
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    v = m[col]
    return v if default is None else F.coalesce(v, F.lit(default))


def ordinal_map(labels: Sequence) -> dict:
    return {lab: i for i, lab in enumerate(labels)}


TIER_CODES = ordinal_map(TIER_LABELS)
AGE_CODES = ordinal_map(AGE_LABELS)
KM_CODES = ordinal_map(KM_LABELS)
POWER_CODES = ordinal_map(POWER_LABELS)
SEASON_CODES = ordinal_map(QUARTER_SEASONS.values())
REG_YEAR_CODES = ordinal_map(REG_YEAR_LABELS)


def ordinal_encode_segments(df: DataFrame, default=None) -> DataFrame:
    """Label columns of the advanced pipeline -> 0-based ints (``*_encoded``)."""
    spec = [("brand_tier", TIER_CODES), ("car_age_segment", AGE_CODES), ("km_segment", KM_CODES),
            ("power_segment", POWER_CODES), ("reg_season", SEASON_CODES)]
    if default is not None:
        spec.append(("reg_year_period", REG_YEAR_CODES))
    return df.withColumns({f"{c}_encoded": map_values(c, m, default) for c, m in spec if c in df.columns})


# ------------------------------------------------------------ category codes


def fit_category_codes(train: DataFrame, col: str) -> DataFrame:
    """Sorted distinct non-NULL values -> 0..n-1 (skew-safe ranking)."""
    return dense_codes(train, col, code_col=f"{col}_code")


def apply_category_codes(df: DataFrame, codes: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Join codes; NULL and unseen values -> -1."""
    code = f"{col}_code"
    out = out or code
    j = left_join_params(df, codes, col).withColumn(out, F.coalesce(F.col(code), F.lit(-1)))
    return j if out == code else j.drop(code)


def category_codes(df: DataFrame, col: str) -> DataFrame:
    """Codes fitted on the same table (each table on its own, like the reference)."""
    return apply_category_codes(df, fit_category_codes(df, col), col)


def category_codes_shared(train: DataFrame, df: DataFrame, col: str) -> DataFrame:
    """Codes fitted on ``train`` applied to ``df``; values unseen in train -> -1."""
    return apply_category_codes(df, fit_category_codes(train, col), col)


def fit_category_codes_many(train: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Sorted codes for several columns in ONE pass: long form ``feature, value, code``."""
    long = train.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in cols
    ])).alias("_s")).select("_s.*")
    return dense_codes(long, "value", ["feature"], code_col="code")


def apply_category_codes_many(df: DataFrame, codes: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``<col>_code`` for each column; NULL and unseen -> -1."""
    p = checked_broadcast(codes)
    for c in cols:
        pc = p.where(F.col("feature") == c).select(F.col("value").alias(f"_cv_{c}"), F.col("code").alias(f"_cc_{c}"))
        df = (df.join(pc, F.col(c).cast("string") == F.col(f"_cv_{c}"), "left")
                .withColumn(f"{c}_code", F.coalesce(F.col(f"_cc_{c}"), F.lit(-1)))
                .drop(f"_cv_{c}", f"_cc_{c}"))
    return df


def fit_first_seen_codes(train: DataFrame, col: str, order_col: str) -> DataFrame:
    """Codes in order of first appearance (by ``order_col``)."""
    first = (train.where(F.col(col).isNotNull()).groupBy(col)
                  .agg(F.min(order_col).alias("_first")))
    return range_ranks(first, [], ["_first", col], f"{col}_code").select(col, f"{col}_code")


def cast_category_str(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in cols})


# ------------------------------------------------------------ ordered target statistics


def ordered_target_stats(df: DataFrame, col: str, target: str, key: str,
                         prior: Column | None = None, prior_weight: float = 1.0,
                         out: str | None = None, missing: str = MISSING_LABEL) -> DataFrame:
    """Leak-free category mean: each row sees only earlier rows of its category.

    Order is a fixed hash of ``key`` (ties broken by the key itself), so the
    result is repeatable.  ``enc = (sum_before + a * prior) / (count_before + a)``
    with ``prior`` = global target mean by default.  The running sums use the
    skew-safe ``prefix_sums`` (a hot category is split across tasks).
    """
    out = out or f"{col}_ots"
    prior = prior if prior is not None else global_mean(df, target)
    # a decimal target is summed exactly, in any order
    kind = df.schema[target].dataType if isinstance(df.schema[target].dataType, DecimalType) else DoubleType()
    y = F.col(target).cast(kind)
    base = df.withColumns({
        "_ots_c": F.coalesce(F.col(col).cast("string"), F.lit(missing)),
        "_ots_h": md5_order(F.col(key)),
        "_ots_n": F.when(F.col(target).isNotNull(), F.lit(1)).otherwise(F.lit(0)).cast("long"),
        "_ots_y": F.coalesce(y, F.lit(0).cast(kind)),
    })
    ps = prefix_sums(base, ["_ots_c"], ["_ots_h", key], ["_ots_n", "_ots_y"], hash_segment(F.col("_ots_h")))
    a = F.lit(float(prior_weight))
    enc = (F.col("_ots_y_before").cast("double") + a * prior) / (F.col("_ots_n_before") + a)
    return ps.withColumn(out, enc).drop("_ots_c", "_ots_h", "_ots_n", "_ots_y",
                                        "_ots_n_before", "_ots_y_before")


def ordered_target_stats_many(df: DataFrame, cols: Sequence[str | Sequence[str]], target: str, key: str,
                              salts: Sequence[str] = ("0", "1", "2"), prior: Column | None = None,
                              prior_weight: float = 1.0, missing: str = MISSING_LABEL) -> DataFrame:
    """(key, ``<col>_ots`` ...): ordered target statistics of several categories,
    averaged over several orders of the rows, one order per salt.

    An entry of ``cols`` is a column or a list of columns; a list is one combined
    category, named ``<a>_<b>_ots``.  Missing values are a category of their own,
    also inside combinations.  Rows without a target are encoded but not
    counted.  ``key`` must be unique and not NULL; an empty table gives an empty
    one.  Order p of a row is the md5 of its salt and key.

    The rows go through one exchange an order, by segments of that order, and
    take their sums so far along; no row is copied per category, and nothing is
    brought together afterwards.  What a category holds in earlier segments
    comes as a row of its own that is first in its segment.
    """
    groups = [[c] if isinstance(c, str) else list(c) for c in cols]
    names = ["_".join(g) + "_ots" for g in groups]
    prior = prior if prior is not None else global_mean(df, target)
    kind = df.schema[target].dataType if isinstance(df.schema[target].dataType, DecimalType) else DoubleType()
    # a length before each value keeps ('a', 'bc') and ('ab', 'c') apart
    values = [[F.coalesce(F.col(c).cast("string"), F.lit(missing)) for c in g] for g in groups]
    keyed = [F.concat(*(F.concat(F.length(v).cast("string"), F.lit(":"), v) for v in vs)) for vs in values]
    cats, sums = [f"_v{i}" for i in range(len(groups))], [f"_a{i}" for i in range(len(groups))]
    rows = df.select(F.col(key).alias("_key"), *(v.alias(c) for c, v in zip(cats, keyed)),
                     F.when(F.col(target).isNotNull(), 1).otherwise(0).cast("long").alias("_n"),
                     F.coalesce(F.col(target).cast(kind), F.lit(0).cast(kind)).alias("_y"))
    a, done = F.lit(float(prior_weight)), rows.select("*", *(F.lit(0.0).alias(c) for c in sums))
    for salt in salts:
        order = md5_order(F.concat(F.lit(f"{salt}:"), F.col("_key").cast("string")))
        each = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.col(c).alias("v")) for i, c in enumerate(cats)))).alias("_c")
        totals = rows.select(each, hash_segment(order).alias("_seg"), "_n", "_y").groupBy("_c.i", "_c.v", "_seg").agg(F.sum("_n").alias("_n"), F.sum("_y").alias("_y"))
        earlier = Window.partitionBy("i", "v").orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
        offsets = totals.select("i", "v", "_seg", *(F.coalesce(F.sum(m).over(earlier), F.lit(0)).alias(f"_off{m}") for m in ("_n", "_y")))
        kinds = {m: offsets.schema[m].dataType for m in ("_off_n", "_off_y")}
        first = offsets.select(F.lit(None).cast(rows.schema["_key"].dataType).alias("_key"), *(F.when(F.col("i") == i, F.col("v")).alias(c) for i, c in enumerate(cats)),
                               F.lit(0).cast("long").alias("_n"), F.lit(0).cast(kind).alias("_y"), *(F.lit(0.0).alias(c) for c in sums),
                               F.lit(-1).cast("long").alias("_h"), "_seg", *kinds)
        placed = done.select("_key", *cats, "_n", "_y", *sums, order.cast("long").alias("_h"), hash_segment(order).alias("_seg"),
                             *(F.lit(None).cast(t).alias(m) for m, t in kinds.items()))
        placed = placed.unionByName(first).where(F.col("_seg").isNotNull()).repartition("_seg")
        encs = {}
        for c, total in zip(cats, sums):
            before = Window.partitionBy("_seg", c).orderBy("_h", "_key").rowsBetween(Window.unboundedPreceding, -1)
            n, y = (F.coalesce(F.sum(m).over(before), F.lit(0)) + F.max(f"_off{m}").over(before) for m in ("_n", "_y"))
            encs[total] = F.col(total) + (y.cast("double") + a * prior) / (n + a)
        done = placed.withColumns(encs).where("_h >= 0").select("_key", *cats, "_n", "_y", *sums, "_seg")
    # rows of one key lie in one segment
    out = done.groupBy("_seg", "_key").agg(*(F.avg(c).alias(c) for c in sums))
    return out.select(F.col("_key").alias(key), *((F.col(c) / len(salts)).alias(n) for c, n in zip(sums, names)))


# ------------------------------------------------------------ imputation


def fit_medians(train: DataFrame, cols: Sequence[str], **qkw) -> DataFrame:
    """One row: the exact median of each column (columns keep their names)."""
    q = quantile_columns(train, cols, [0.5], **qkw)
    return q.agg(*[F.max(F.when(F.col("column") == c, F.col("q"))).alias(c) for c in cols])


def apply_fill_row(df: DataFrame, fills: DataFrame, cols: Sequence[str], fetch: bool = False) -> DataFrame:
    """NULL -> value from a one-row fill table (scalar subqueries, no join).

    The filled columns are doubles: the median of integers need not be one."""
    s = ScalarRow(fills, fetch)
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), s[c].cast("double")) for c in cols})


def impute_median(train: DataFrame, df: DataFrame, cols: Sequence[str] | None = None, **qkw) -> DataFrame:
    """NULL -> training median, numeric columns of ``train`` (default: all)."""
    from .schema import select_by_type
    cols = list(cols or select_by_type(train, "numeric"))
    return apply_fill_row(df, fit_medians(train, cols, **qkw), cols)


def impute_median_combined(a: DataFrame, b: DataFrame, cols: Sequence[str], **qkw):
    """Medians over ``a ∪ b`` applied to both (the function-structured variant)."""
    both = a.select(*cols).unionByName(b.select(*cols))
    fills = fit_medians(both, cols, **qkw)
    return apply_fill_row(a, fills, cols), apply_fill_row(b, fills, cols)


def impute_missing_label(df: DataFrame, cols: Sequence[str] | None = None,
                         label: str = MISSING_LABEL) -> DataFrame:
    from .schema import select_by_type
    cols = list(cols or select_by_type(df, "string"))
    return df.na.fill(label, subset=cols)


def impute_zero(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    from .schema import select_by_type
    cols = list(cols or select_by_type(df, "numeric"))
    return df.na.fill(0, subset=cols)


def impute_from_column(df: DataFrame, col: str, source: str) -> DataFrame:
    return df.withColumn(col, F.coalesce(F.col(col), F.col(source)))


# ------------------------------------------------------------ scaling


def fit_standard_scale(train: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: mean and population std per column (std 0 -> 1)."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"{c}__mean"),
                 F.coalesce(F.nullif(F.stddev_pop(x), F.lit(0.0)), F.lit(1.0)).alias(f"{c}__std")]
    return train.agg(*aggs)


def apply_standard_scale(df: DataFrame, params: DataFrame, cols: Sequence[str]) -> DataFrame:
    s = ScalarRow(params)
    return df.withColumns({c: (F.col(c).cast("double") - s[f"{c}__mean"]) / s[f"{c}__std"] for c in cols})


def standard_scale(train: DataFrame, df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return apply_standard_scale(df, fit_standard_scale(train, cols), cols)


