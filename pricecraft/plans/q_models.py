"""Registered queries: regressors, scoring, importance, histories.

Single trees are Spark ML's; boosting is ``operators/boosting.py``, with the
categories as such.  Other libraries' boosting cannot be reproduced, so the
queries on all features are checked by rows.  Their exact counterparts
(``*_groups``) fit the same operators on one category, where a deep enough tree
tells its values apart, so that SQL can compute what training must arrive at.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import boosting as BT
from ..operators import encode as E
from ..operators import evaluate as EVO
from ..operators import models as M
from ..session import shared_path
from ..sources.listings import ROW_GROUP_BYTES
from . import evalsets as EV
from . import features as FE
from .registry import AS_OF_YEAR, L, TEST, TRAIN, VALID_PCT, register

NUMBERS = ["power", "kilometer", "not_repaired", "region_code", "car_age"] + FE.V_COLS
FEATS = NUMBERS + [f"{c}_code" for c in FE.CATEGORICAL]

# The fits without patience run the default rounds of ``fit_boosted``, the source's 200.
# Rounds, step, depth and patience of the source's fits with patience, and its quick fit for selection.
EARLY = dict(rounds=500, step=0.01, depth=7, patience=20)
EARLY_MAE = dict(rounds=3000, step=0.03, depth=6, l2=3.0, subsample=1.0, feature_share=1.0, patience=100)
QUICK = dict(rounds=100, depth=5, step=0.05, subsample=1.0, feature_share=1.0)
# Rounds after the selection.
REFIT_ROUNDS = 20


def _once(spark, sf, name, make):
    return EV.once(spark, sf, name, make)


def _frames(spark, sf):
    """Flagship features for all listings, tagged with the repeatable split.

    Codes and medians are fitted on the training part of the split.  The frame
    feeds many passes, so it is written once per application, in columns."""
    def write():
        fit, _ = EV.split_train(spark, sf)
        d = FE.flagship_features(fit, L(spark, sf), AS_OF_YEAR, keep=["source", *FE.CATEGORICAL])
        path = shared_path(spark, "tables", "model-frame")
        EVO.holdout_split(d, "sale_key", VALID_PCT).write.option("compression", "zstd").option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
        return path
    d = spark.read.parquet(_once(spark, sf, "frame", write))
    labelled = d.where(F.col("source") == "train")
    return labelled.where(F.col("split") == "train"), labelled.where(F.col("split") == "valid"), \
        d.where(F.col("source") == "test")


def _gbt(spark, sf):
    """Boosted trees on the training part, shared by the queries that read it."""
    return _once(spark, sf, "gbt", lambda: BT.fit_boosted(_frames(spark, sf)[0], "price", NUMBERS, FE.CATEGORICAL, FE.KEY))


def _metrics(model, valid):
    if isinstance(model, BT.Boosted):
        s = BT.score_boosted(model, valid, keep=["sale_key", "price"])
    else:
        s = M.score(model, valid, keep=["sale_key", "price"])
    return EVO.regression_metrics(s, "price", "prediction")


@register("fit_tree")
def q_fit_tree(spark, sf):
    """Regression tree (depth 15, 5 rows per leaf): metrics of both splits."""
    tr, va, _ = _frames(spark, sf)
    model = M.fit_tree(tr, FEATS, "price")
    return _metrics(model, tr).withColumn("split", F.lit("train")).unionByName(_metrics(model, va).withColumn("split", F.lit("valid")))


@register("fit_gbt")
def q_fit_gbt(spark, sf):
    """Boosted trees, squared error: metrics of both splits."""
    tr, va, _ = _frames(spark, sf)
    model = _gbt(spark, sf)
    return _metrics(model, tr).withColumn("split", F.lit("train")).unionByName(_metrics(model, va).withColumn("split", F.lit("valid")))


def _stopped(model, va):
    return _metrics(model, va).withColumn("n_trees", F.lit(len(model.trees))).withColumn("rounds_run", F.lit(model.rounds_run))


@register("fit_gbt_early_stop")
def q_fit_gbt_early_stop(spark, sf):
    """Boosted trees with patience: stopped in training, cut at their best round."""
    tr, va, _ = _frames(spark, sf)
    return _stopped(BT.fit_boosted(tr, "price", NUMBERS, FE.CATEGORICAL, FE.KEY, va, **EARLY), va)


@register("fit_gbt_mae")
def q_fit_gbt_mae(spark, sf):
    """Boosted trees with absolute-error loss and median leaves, with patience."""
    tr, va, _ = _frames(spark, sf)
    return _stopped(BT.fit_boosted(tr, "price", NUMBERS, FE.CATEGORICAL, FE.KEY, va, loss="absolute", **EARLY_MAE), va)


@register("fit_select_refit")
def q_fit_select_refit(spark, sf):
    """Quick fit, the features of 85 % of its importance, fit on these."""
    tr, va, _ = _frames(spark, sf)
    quick, kept, model = BT.select_and_refit(tr, "price", NUMBERS, FE.CATEGORICAL, 0.85, QUICK, key=FE.KEY, rounds=REFIT_ROUNDS)
    both = _metrics(quick, va).withColumn("model", F.lit("quick")).withColumn("n_features", F.lit(len(quick.binning.features)))
    return both.unionByName(_metrics(model, va).withColumn("model", F.lit("selected")).withColumn("n_features", F.lit(len(kept))))


@register("score")
def q_score(spark, sf):
    """Submission rows for the test side: key and non-negative integer price,
    from a model of the log price."""
    tr, va, te = _frames(spark, sf)
    both = tr.unionByName(va).withColumn("log_price", F.log1p("price"))
    model = _once(spark, sf, "log-gbt", lambda: BT.fit_boosted(both, "log_price", NUMBERS, FE.CATEGORICAL, FE.KEY))
    s = BT.score_boosted(model, te, keep=["sale_key"]).withColumn("prediction", F.expm1("prediction"))
    return EVO.clip_predictions(s, "prediction", "price").select("sale_key", "price")


@register("feature_importance")
def q_feature_importance(spark, sf):
    return _gbt(spark, sf).feature_importance(spark)


@register("eval_history")
def q_eval_history(spark, sf):
    """MAE, RMSE and R² after every boosting round on both splits, in one pass."""
    tr, va, _ = _frames(spark, sf)
    return BT.staged_metrics(_gbt(spark, sf), tr.unionByName(va), "price", "split")


@register("save_model")
def q_save_model(spark, sf):
    """Save the fitted pipeline to the shared checkpoint folder, load it back, score."""
    tr, va, _ = _frames(spark, sf)
    path = shared_path(spark, "models", "tree")
    M.save_model(M.fit_tree(tr, FEATS, "price"), path)
    return _metrics(M.load_model(path), va)


# ---------------------------------------------------------------- one feature of few values


def _brand_frames(spark, sf):
    """(train, valid) with the brand code alone, fitted on train."""
    fit, valid = EV.split_train(spark, sf)
    codes = E.fit_category_codes(fit, "brand")
    return tuple(E.apply_category_codes(d.select("sale_key", "brand", "price"), codes, "brand") for d in (fit, valid))


@register("fit_tree_groups", "SELECT sale_key, p_brand AS prediction FROM scored", ctes=EV.SCORED_SQL, rounds={"prediction": 5})
def q_fit_tree_groups(spark, sf):
    """A tree on the brand code predicts the brand mean."""
    tr, va = _brand_frames(spark, sf)
    return M.score(M.fit_tree(tr, ["brand_code"], "price"), va, keep=["sale_key"]).select("sale_key", "prediction")


@register("save_model_groups", "SELECT sale_key, p_brand AS prediction FROM scored", ctes=EV.SCORED_SQL, rounds={"prediction": 5})
def q_save_model_groups(spark, sf):
    tr, va = _brand_frames(spark, sf)
    path = shared_path(spark, "models", "tree")
    M.save_model(M.fit_tree(tr, ["brand_code"], "price"), path)
    return M.score(M.load_model(path), va, keep=["sale_key"]).select("sale_key", "prediction")


@register("score_groups", """
SELECT t.sale_key, CAST(trunc(greatest(b.m, 0.0)) AS BIGINT) AS price
FROM test t JOIN (SELECT brand, avg(price) AS m FROM train GROUP BY brand) b ON t.brand = b.brand""")
def q_score_groups(spark, sf):
    """One whole boosting step on the brand, all labelled rows, scored on test;
    the model is saved, loaded and then applied."""
    model = BT.fit_boosted(TRAIN(spark, sf), "price", [], ["brand"], "sale_key", rounds=1, step=1.0, **EV.ALL_ROWS)
    path = shared_path(spark, "models", "boosted")
    BT.save_boosted(spark, model, path)
    s = BT.score_boosted(BT.load_boosted(spark, path), TEST(spark, sf), keep=["sale_key"])
    return EVO.clip_predictions(s, "prediction", "price").select("sale_key", "price")


@register("eval_history_groups", "SELECT set, iteration, mae, rmse, r2 FROM hist", ctes=EV.HISTORY_SQL, rounds={"mae": 5, "rmse": 5, "r2": 8})
def q_eval_history_groups(spark, sf):
    """The staged errors of boosting on the brand, by a pass over the rows."""
    fit, valid = EV.split_train(spark, sf)
    both = fit.withColumn("split", F.lit("train")).unionByName(valid.withColumn("split", F.lit("valid")))
    return BT.staged_metrics(EV.brand_model(spark, sf), both, "price", "split")


@register("fit_gbt_mae_groups", """
SELECT v.sale_key, b.md AS prediction FROM val v JOIN bgroup b ON v.brand IS NOT DISTINCT FROM b.brand""",
          ctes=EV.SPLIT_SQL + "," + EV.BY_BRAND_SQL, rounds={"prediction": 5})
def q_fit_gbt_mae_groups(spark, sf):
    """The leaves of the absolute loss are medians: one step gives the brand median."""
    return BT.score_boosted(EV.median_model(spark, sf), EV.split_train(spark, sf)[1], keep=["sale_key"])


@register("fit_gbt_early_stop_groups", f"""
SELECT CAST(best AS INTEGER) AS n_trees, CAST(least(best + {EV.PATIENCE}, {EV.ROUNDS}) AS INTEGER) AS rounds_run
FROM (SELECT min(iteration) AS best FROM (
  SELECT iteration, rmse, min(rmse) OVER (ORDER BY iteration ROWS BETWEEN 1 FOLLOWING AND {EV.PATIENCE} FOLLOWING) AS later,
         min(rmse) OVER (ORDER BY iteration ROWS UNBOUNDED PRECEDING) AS low
  FROM hist WHERE set = 'valid') WHERE rmse = low AND coalesce(later >= rmse, true))""", ctes=EV.HISTORY_SQL)
def q_fit_gbt_early_stop_groups(spark, sf):
    """Boosting on the brand stops ``PATIENCE`` rounds after its best one."""
    fit, valid = EV.split_train(spark, sf)
    model = BT.fit_boosted(fit, "price", [], ["brand"], "sale_key", valid, rounds=EV.ROUNDS, step=EV.STEP, patience=EV.PATIENCE, **EV.ALL_ROWS)
    return spark.createDataFrame([(len(model.trees), model.rounds_run)], "n_trees int, rounds_run int")


@register("model_facts", f"""
SELECT (SELECT count(*) FROM val) AS n_valid, (SELECT count(*) FROM test) AS n_test, {len(FEATS)} AS n_features,
       1.0 AS importance_sum, true AS all_finite""", ctes=EV.SPLIT_SQL, rounds={"importance_sum": 6})
def q_model_facts(spark, sf):
    """What must hold of the boosted model on all features."""
    _, va, te = _frames(spark, sf)
    model = _gbt(spark, sf)
    imp = model.feature_importance(spark).agg(F.count(F.lit(1)).cast("int").alias("n_features"), F.sum("importance").alias("importance_sum"))
    p = F.col("prediction")
    ok = F.coalesce(F.every(p.isNotNull() & ~F.isnan(p) & (F.abs(p) < 1e18)), F.lit(True))
    v = BT.score_boosted(model, va, keep=["sale_key"]).agg(F.count(F.lit(1)).alias("n_valid"), ok.alias("v"))
    t = BT.score_boosted(model, te, keep=["sale_key"]).agg(F.count(F.lit(1)).alias("n_test"), ok.alias("t"))
    one = F.lit(1)
    j = v.withColumn("_k", one).join(t.withColumn("_k", one), "_k").join(imp.withColumn("_k", one), "_k")
    return j.select("n_valid", "n_test", "n_features", "importance_sum", (F.col("v") & F.col("t")).alias("all_finite"))
