"""Splitting, regression metrics, training histories, importance and blending."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import clip_nonneg_int, hash_pct

# MAE is estimated as 0.55 x RMSE in the reference's curves.
MAE_FROM_RMSE = 0.55


# ------------------------------------------------------------ split


def split_bucket(key) -> F.Column:
    """0..99 from the first 32 bits of md5(key): same on every engine and run."""
    return hash_pct(F.col(key) if isinstance(key, str) else key)


def holdout_split(df: DataFrame, key: str, valid_pct: int = 20, col: str = "split") -> DataFrame:
    """Tag each row 'train' or 'valid' by a hash of its key (repeatable, partition-independent)."""
    return df.withColumn(col, F.when(split_bucket(key) < valid_pct, "valid").otherwise("train"))


# Rows of one hash value up to which a cut is found by sorting them.
CUT_ROWS = 10_000
_CUT_BITS = 15


def hash_cut(df: DataFrame, key: str, n: int) -> tuple[int, str] | None:
    """(number, text) such that exactly ``n`` rows have a (60-bit number of
    md5(key), md5(key) and key) up to it; None if no row is wanted.

    The hash's high bits are counted, the one value that holds the cut is
    counted by its next bits, until so few rows are left that they can be
    sorted; no task holds ``n`` rows.  Runs when called.  Rows of equal key
    stand or fall together only by chance: keys should be unique.
    """
    if n <= 0:
        return None
    text = F.md5(F.col(key).cast("string"))
    d = df.select(F.conv(F.substring(text, 1, 15), 16, 10).cast("long").alias("h"), F.concat(text, F.col(key).cast("string")).alias("t")).where("t IS NOT NULL")
    low, bits, left = 0, 60, n
    while bits > 0:
        bits = max(0, bits - _CUT_BITS)
        place = F.shiftright(F.col("h"), bits)
        counts = d.groupBy(place.alias("b")).agg(F.count(F.lit(1)).alias("n")).orderBy("b").collect()        # 2^15 rows at most
        for r in counts:
            if left <= r["n"]:
                break
            left -= r["n"]
        else:
            return (1 << 60), ""                    # fewer rows than wanted: all of them
        low = r["b"] << bits
        d = d.where((F.col("h") >= low) & (F.col("h") < low + (1 << bits)))
        if r["n"] <= CUT_ROWS:
            break
    last = d.orderBy("t").limit(left).agg(F.max(F.struct("t", "h")).alias("x")).first()["x"]       # CUT_ROWS rows at most
    return last["h"], last["t"]


def _up_to(key: str, cut: tuple[int, str] | None) -> F.Column:
    if cut is None:
        return F.lit(False)
    if cut[1] == "":
        return F.col(key).isNotNull()
    text = F.md5(F.col(key).cast("string"))
    return F.coalesce(F.concat(text, F.col(key).cast("string")) <= cut[1], F.lit(False))


def random_sample_n(df: DataFrame, key: str, n: int) -> DataFrame:
    """Exactly ``n`` rows without replacement (all, if fewer): the first in the
    order of md5(key).  Finding the cut runs when called; NULL keys are never drawn."""
    return df.where(_up_to(key, hash_cut(df, key, n)))


def holdout_split_exact(df: DataFrame, key: str, valid_share: float = 0.2, col: str = "split") -> DataFrame:
    """Tag exactly round(share x rows) rows 'valid', by hash of the key, the
    others 'train' (repeatable, partition-independent)."""
    n = df.where(F.col(key).isNotNull()).count()
    return df.withColumn(col, F.when(_up_to(key, hash_cut(df, key, round(valid_share * n))), "valid").otherwise("train"))


def split_frames(df: DataFrame, key: str, valid_pct: int = 20) -> tuple[DataFrame, DataFrame]:
    b = split_bucket(key)
    return df.where(b >= valid_pct), df.where(b < valid_pct)


# ------------------------------------------------------------ metrics


def regression_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction",
                       group: Sequence[str] = ()) -> DataFrame:
    """MAE, MSE, RMSE, R² (optionally per group) in one aggregation.

    Only complete pairs count: rows without a label or a prediction are left
    out of every figure, ``n`` included."""
    df = df.where(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    y = F.col(label).cast("double")
    e = F.col(prediction).cast("double") - y
    n = F.count(F.lit(1))
    sse = F.sum(e * e)
    aggs = [n.alias("n"), F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse"),
            F.sqrt(F.avg(e * e)).alias("rmse"),
            (1 - F.try_divide(sse, F.var_pop(y) * n)).alias("r2")]
    return df.groupBy(*group).agg(*aggs) if group else df.agg(*aggs)


def model_comparison(preds: DataFrame, label: str = "y", prediction: str = "p",
                     model: str = "model") -> DataFrame:
    """Metrics per model plus the MAE gap to the best model (in percent)."""
    m = regression_metrics(preds, label, prediction, [model])
    best = m.agg(F.min("mae")).scalar()
    return m.withColumn("mae_vs_best_pct", (F.col("mae") - best) * 100.0 / best)


def ensemble_r2_weights(metrics: DataFrame, model: str = "model", r2: str = "r2") -> DataFrame:
    """weight = R² / sum of R² (over the few models; a scalar subquery, no window)."""
    total = metrics.agg(F.sum(r2)).scalar()
    return metrics.select(model, r2, (F.col(r2) / total).alias("weight"))


def ensemble_blend(preds: DataFrame, weights: DataFrame, key: str = "key", model: str = "model",
                   prediction: str = "p") -> DataFrame:
    """Weighted sum of per-model predictions per key (weights table: one row per model)."""
    j = preds.join(F.broadcast(weights.select(model, "weight")), model)
    return j.groupBy(key).agg(F.sum(F.col(prediction) * F.col("weight")).alias("blend"))


def clip_predictions(df: DataFrame, prediction: str = "prediction", out: str = "price") -> DataFrame:
    return df.withColumn(out, clip_nonneg_int(prediction))


def prediction_vs_actual(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.select(F.col(label).alias("actual"), F.col(prediction).alias("predicted"))


# ------------------------------------------------------------ histories


def early_stop_point(history: DataFrame, patience: int, metric: str = "rmse",
                     iteration: str = "iteration", group: Sequence[str] = ("set",)) -> DataFrame:
    """Per history: best iteration (first minimum) and the iteration where
    training stops (first one ``patience`` rounds after the last improvement;
    the last iteration if that never happens).

    A history has one row per boosting round, so each window is bounded by
    the round count.
    """
    g = list(group)
    w = Window.partitionBy(*g).orderBy(iteration)
    run_best = F.min(metric).over(w.rowsBetween(Window.unboundedPreceding, -1))
    h = history.withColumn("_improved", F.coalesce(F.col(metric) < run_best, F.lit(True)))
    h = h.withColumn("_last_best", F.max(F.when(F.col("_improved"), F.col(iteration))).over(
        w.rowsBetween(Window.unboundedPreceding, 0)))
    h = h.withColumn("_stop", (F.col(iteration) - F.col("_last_best")) >= patience)
    return h.groupBy(*g).agg(
        F.min_by(iteration, F.struct(F.col(metric), F.col(iteration))).alias("best_iteration"),
        F.min(metric).alias("best_value"),
        F.coalesce(F.min(F.when(F.col("_stop"), F.col(iteration))), F.max(iteration)).alias("stop_iteration"))


def learning_curve(train_hist: DataFrame, valid_hist: DataFrame, metric: str = "rmse",
                   iteration: str = "iteration") -> DataFrame:
    """Train and validation metric side by side, best validation round marked."""
    t = train_hist.select(iteration, F.col(metric).alias(f"train_{metric}"))
    v = valid_hist.select(iteration, F.col(metric).alias(f"valid_{metric}"))
    j = t.join(v, iteration, "full")
    best = v.agg(F.min_by(iteration, F.struct(F.col(f"valid_{metric}"), F.col(iteration)))).scalar()
    return j.withColumn("is_best", (F.col(iteration) == best).cast("int"))


def mae_from_rmse_estimate(history: DataFrame, metric: str = "rmse") -> DataFrame:
    return history.withColumn("mae_estimate", F.col(metric) * MAE_FROM_RMSE)


# ------------------------------------------------------------ importance


def importance_topk(imp: DataFrame, k: int, feature: str = "feature",
                    importance: str = "importance") -> DataFrame:
    return imp.orderBy(F.desc(importance), F.asc(feature)).limit(k)


def cumulative_importance_select(imp: DataFrame, share: float = 0.85, feature: str = "feature",
                                 importance: str = "importance") -> DataFrame:
    """Keep the ``count(cum_share <= share) + 1`` most important features.

    The importance table has one row per feature (tens to thousands), so a
    single ordered window over it is bounded.
    """
    w = Window.orderBy(F.desc(importance), F.asc(feature))
    ranked = imp.select(feature, importance,
                        F.row_number().over(w).alias("rank"),
                        F.sum(importance).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("_cum"))
    total = imp.agg(F.sum(importance)).scalar()
    ranked = ranked.withColumn("cum_share", F.col("_cum") / total).drop("_cum")
    keep = ranked.agg(F.count_if(F.col("cum_share") <= share)).scalar() + 1
    return ranked.where(F.col("rank") <= keep)
