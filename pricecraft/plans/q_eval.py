"""Registered queries: sampling, split, histories, importance and ensembles
(SURVEY 2.6, 2.11 without a model)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluate as EVO
from . import evalsets as EV
from . import features as FE
from .q_scalars import TF_CTES
from .registry import AS_OF_YEAR, TRAIN, VALID_PCT, register

PATIENCE = EV.PATIENCE


IMP_CTE = EV.IMPORTANCE_SQL


@register("importance_topk", """
SELECT feature, importance FROM imp ORDER BY importance DESC, feature ASC LIMIT 10""", ctes=IMP_CTE,
          rounds={"importance": 9})
def q_importance_topk(spark, sf):
    return EVO.importance_topk(EV.importance(spark, sf), 10)


@register("cumulative_importance_select", """
SELECT feature, importance, rank, cum_share FROM (
  SELECT feature, importance, CAST(row_number() OVER w AS INTEGER) AS rank,
         sum(importance) OVER (w ROWS UNBOUNDED PRECEDING) / (SELECT sum(importance) FROM imp) AS cum_share
  FROM imp WINDOW w AS (ORDER BY importance DESC, feature ASC))
WHERE rank <= (SELECT count(*) FROM (
  SELECT sum(importance) OVER (ORDER BY importance DESC, feature ASC ROWS UNBOUNDED PRECEDING)
         / (SELECT sum(importance) FROM imp) AS cs FROM imp) WHERE cs <= 0.85) + 1""", ctes=IMP_CTE,
          rounds={"importance": 9, "cum_share": 9})
def q_cumulative_importance_select(spark, sf):
    return EVO.cumulative_importance_select(EV.importance(spark, sf), 0.85).withColumn(
        "rank", F.col("rank").cast("int"))


@register("random_sample_n", "SELECT sale_key, price FROM train ORDER BY md5(sale_key) LIMIT 5000")
def q_random_sample_n(spark, sf):
    """5,000 rows without replacement in a repeatable pseudo-random order."""
    return EVO.random_sample_n(TRAIN(spark, sf).select("sale_key", "price"), "sale_key", 5000)


@register("scatter_sample", """
SELECT sale_key, 'kilometer' AS feature, kilometer AS x, price FROM s
UNION ALL SELECT sale_key, 'power', CAST(power AS DOUBLE), price FROM s
UNION ALL SELECT sale_key, 'car_age', CAST(car_age AS DOUBLE), price FROM s""",
          ctes=TF_CTES + ", s AS (SELECT * FROM tf WHERE source = 'train' ORDER BY md5(sale_key) LIMIT 5000)")
def q_scatter_sample(spark, sf):
    s = EVO.random_sample_n(FE.time_features(TRAIN(spark, sf), AS_OF_YEAR), "sale_key", 5000)
    return s.select("sale_key", "price", F.explode(F.array(
        F.struct(F.lit("kilometer").alias("feature"), F.col("kilometer").cast("double").alias("x")),
        F.struct(F.lit("power").alias("feature"), F.col("power").cast("double").alias("x")),
        F.struct(F.lit("car_age").alias("feature"), F.col("car_age").cast("double").alias("x")),
    )).alias("_s")).select("sale_key", "_s.feature", "_s.x", "price")


@register("holdout_split", f"""
SELECT sale_key, CASE WHEN ('0x' || substr(md5(sale_key), 1, 8))::BIGINT % 100 < {VALID_PCT}
                      THEN 'valid' ELSE 'train' END AS split FROM train""")
def q_holdout_split(spark, sf):
    return EVO.holdout_split(TRAIN(spark, sf), "sale_key", VALID_PCT).select("sale_key", "split")


@register("holdout_split_exact", """
SELECT sale_key, CASE WHEN row_number() OVER (ORDER BY md5(sale_key)) <= (SELECT round(0.2 * count(*)) FROM train) THEN 'valid' ELSE 'train' END AS split
FROM train""")
def q_holdout_split_exact(spark, sf):
    """A hold-out of exactly 20 % of the rows."""
    return EVO.holdout_split_exact(TRAIN(spark, sf).select("sale_key"), "sale_key", 0.2)


@register("early_stop_point", f"""
SELECT set, best_iteration, best_value, coalesce(stop_iteration, last_iteration) AS stop_iteration FROM (
  SELECT set, min(iteration) FILTER (WHERE rmse = best) AS best_iteration, min(best) AS best_value,
         min(iteration) FILTER (WHERE iteration - last_best >= {PATIENCE}) AS stop_iteration,
         max(iteration) AS last_iteration
  FROM (
    SELECT *, max(CASE WHEN improved THEN iteration END) OVER (PARTITION BY set ORDER BY iteration
                                                               ROWS UNBOUNDED PRECEDING) AS last_best,
           min(rmse) OVER (PARTITION BY set) AS best
    FROM (SELECT *, coalesce(rmse < min(rmse) OVER (PARTITION BY set ORDER BY iteration
                                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS improved
          FROM hist))
  GROUP BY set)""", ctes=EV.HISTORY_SQL, rounds={"best_value": 6})
def q_early_stop_point(spark, sf):
    return EVO.early_stop_point(EV.history(spark, sf), PATIENCE, "rmse", "iteration", ["set"])


@register("learning_curve", """
SELECT t.iteration, t.rmse AS train_rmse, v.rmse AS valid_rmse,
       CAST(t.iteration = (SELECT arg_min(iteration, rmse) FROM hist WHERE set = 'valid') AS INTEGER) AS is_best
FROM (SELECT * FROM hist WHERE set = 'train') t FULL JOIN (SELECT * FROM hist WHERE set = 'valid') v
ON t.iteration = v.iteration""", ctes=EV.HISTORY_SQL, rounds={"train_rmse": 6, "valid_rmse": 6})
def q_learning_curve(spark, sf):
    h = EV.history(spark, sf)
    return EVO.learning_curve(h.where(F.col("set") == "train"), h.where(F.col("set") == "valid"))


@register("mae_from_rmse_estimate", "SELECT set, iteration, rmse, rmse * 0.55 AS mae_estimate FROM hist",
          ctes=EV.HISTORY_SQL, rounds={"rmse": 6, "mae_estimate": 6})
def q_mae_from_rmse_estimate(spark, sf):
    return EVO.mae_from_rmse_estimate(EV.history(spark, sf).select("set", "iteration", "rmse"))


W_SQL = """
mt AS (SELECT model, 1 - sum((p - y) * (p - y)) / (var_pop(y) * count(*)) AS r2 FROM preds GROUP BY model),
wt AS (SELECT model, r2, r2 / (SELECT sum(r2) FROM mt) AS weight FROM mt)
"""


@register("ensemble_r2_weights", "SELECT * FROM wt", ctes=EV.PREDS_SQL + "," + W_SQL,
          rounds={"r2": 9, "weight": 6})
def q_ensemble_r2_weights(spark, sf):
    m = EVO.regression_metrics(EV.predictions(spark, sf), "y", "p", ["model"])
    return EVO.ensemble_r2_weights(m)


@register("ensemble_blend", """
SELECT key, sum(p * weight) AS blend FROM preds JOIN wt USING (model) GROUP BY key""",
          ctes=EV.PREDS_SQL + "," + W_SQL, rounds={"blend": 4})
def q_ensemble_blend(spark, sf):
    preds = EV.predictions(spark, sf)
    w = EVO.ensemble_r2_weights(EVO.regression_metrics(preds, "y", "p", ["model"]))
    return EVO.ensemble_blend(preds, w, "key", "model", "p")


@register("prediction_vs_actual", "SELECT y AS actual, p_brand AS predicted FROM scored", ctes=EV.SCORED_SQL,
          rounds={"predicted": 6})
def q_prediction_vs_actual(spark, sf):
    return EVO.prediction_vs_actual(EV.scored(spark, sf), "y", "p_brand")


@register("clip_predictions", """
SELECT sale_key, CAST(trunc(greatest(p_brand - 20000.0, 0.0)) AS BIGINT) AS price FROM scored""",
          ctes=EV.SCORED_SQL)
def q_clip_predictions(spark, sf):
    s = EV.scored(spark, sf).withColumn("p", F.col("p_brand") - 20000.0)
    return EVO.clip_predictions(s, "p", "price").select("sale_key", "price")
