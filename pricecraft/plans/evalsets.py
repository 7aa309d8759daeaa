"""Inputs of the evaluation operators.

* ``scored``: baseline means (global, brand, brand x region) of the training
  split on the rows of a split.
* Fitted models whose outcome SQL can compute as well: boosted trees on one
  category, deep enough to tell all its values apart.  With step s, all rows and
  the start at the global mean, the prediction after k rounds is
  mean(value) - (1 - s)^k (mean(value) - mean); with the absolute loss and one
  whole step it is the median of the value; on the logarithm, the mean log.
* ``history``: MAE, RMSE and R² of every round of the first of them, measured
  while it is trained.
* ``predictions``: these models scored on the validation split in one pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import boosting as BT
from ..operators import groupstats as G
from ..operators.evaluate import split_bucket
from ..operators.joins import left_join_params
from .registry import TRAIN, VALID_PCT


def split_train(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    t = TRAIN(spark, sf)
    b = split_bucket("sale_key")
    return t.where(b >= VALID_PCT), t.where(b < VALID_PCT)


def _fitted_means(fit: DataFrame):
    g = G.global_mean(fit, "price")
    bm = G.group_mean(fit, "brand", "price", "b_mean")
    br = G.group_mean(fit, ["brand", "region_code"], "price", "br_mean")
    return g, bm, br


def scored(spark: SparkSession, sf: str, part: str = "valid") -> DataFrame:
    """Rows of one split with the three baseline predictions as columns."""
    fit, valid = split_train(spark, sf)
    g, bm, br = _fitted_means(fit)
    rows = valid if part == "valid" else fit
    j = left_join_params(left_join_params(rows, bm, "brand"), br, ["brand", "region_code"])
    return j.select("sale_key", "brand", "region_code", F.col("price").alias("y"),
                    g.alias("p_global"), F.coalesce("b_mean", g).alias("p_brand"),
                    F.coalesce("br_mean", "b_mean", g).alias("p_brand_region"))


_CACHE: dict = {}


def once(spark: SparkSession, sf: str, name: str, make):
    """A value computed once per application and input folder."""
    key = (spark.sparkContext.applicationId, sf.rstrip("/"), name)
    if key not in _CACHE:
        _CACHE[key] = make()
    return _CACHE[key]


#: Training of the models on one category.
ROUNDS, STEP, DEPTH = 12, 0.3, 40
PATIENCE = 3
ALL_ROWS = dict(subsample=1.0, feature_share=1.0, depth=DEPTH)


def brand_model(spark: SparkSession, sf: str) -> BT.Boosted:
    """Squared loss on the brand, measured on both splits in every round."""
    def fit():
        train, valid = split_train(spark, sf)
        return BT.fit_boosted(train, "price", [], ["brand"], "sale_key", valid, rounds=ROUNDS, step=STEP, **ALL_ROWS)
    return once(spark, sf, "brand-model", fit)


def median_model(spark: SparkSession, sf: str) -> BT.Boosted:
    """Absolute loss on the brand, one whole step."""
    return once(spark, sf, "median-model", lambda: BT.fit_boosted(
        split_train(spark, sf)[0], "price", [], ["brand"], "sale_key", rounds=1, step=1.0, loss="absolute", **ALL_ROWS))


def log_model(spark: SparkSession, sf: str) -> BT.Boosted:
    """Squared loss of the log price on the region, one whole step."""
    return once(spark, sf, "log-model", lambda: BT.fit_boosted(
        split_train(spark, sf)[0].withColumn("log_price", F.log1p("price")), "log_price", [], ["region_code"], "sale_key", rounds=1, step=1.0, **ALL_ROWS))


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """(key, model, y, p) of three fitted models on the validation split."""
    models = {"brand_boosted": (brand_model(spark, sf), "identity"), "brand_median": (median_model(spark, sf), "identity"),
              "region_log": (log_model(spark, sf), "log1p")}
    s = BT.score_many(models, split_train(spark, sf)[1], keep=["sale_key", "price"])
    pair = F.explode(F.arrays_zip(F.array(*map(F.lit, models)).alias("model"), F.col("predictions").alias("p"))).alias("_s")
    return s.select(F.col("sale_key").alias("key"), F.col("price").alias("y"), pair).select("key", "_s.model", "y", "_s.p")


def history(spark: SparkSession, sf: str) -> DataFrame:
    """(set, iteration, mae, rmse, r2) of the training of ``brand_model``."""
    return brand_model(spark, sf).history_frame(spark)


def importance(spark: SparkSession, sf: str) -> DataFrame:
    """(feature, importance): the total gain of a fitted tree on each feature
    alone, as a share of their sum (a tree that tells all values apart gains
    the squares between them)."""
    def fit():
        train, _ = split_train(spark, sf)
        gains = BT.gains_alone(train, "price", [], IMPORTANCE_FEATURES, "sale_key", DEPTH)
        return [(c, gains[c]) for c in IMPORTANCE_FEATURES]
    gains = once(spark, sf, "gains", fit)
    total = sum(g for _, g in gains)
    return spark.createDataFrame([(c, g / total if total else 0.0) for c, g in gains], "feature string, importance double")


#: Few values each, so that SQL's groups are the leaves.
IMPORTANCE_FEATURES = ["brand", "body_type", "fuel_type", "gearbox", "region_code", "not_repaired", "offer_type"]


# SQL twins (DuckDB); names match the Spark columns.
SPLIT_SQL = """
sp AS (SELECT *, CASE WHEN ('0x' || substr(md5(sale_key), 1, 8))::BIGINT % 100 < 20 THEN 'valid' ELSE 'train' END AS split
       FROM train),
fit AS (SELECT * FROM sp WHERE split = 'train'),
val AS (SELECT * FROM sp WHERE split = 'valid'),
gm AS (SELECT avg(price) AS g FROM fit),
bmean AS (SELECT brand, avg(price) AS b_mean FROM fit WHERE brand IS NOT NULL GROUP BY brand),
brmean AS (SELECT brand, region_code, avg(price) AS br_mean FROM fit
           WHERE brand IS NOT NULL AND region_code IS NOT NULL GROUP BY brand, region_code)
"""

SCORED_SQL = SPLIT_SQL + """,
scored AS (
  SELECT v.sale_key, v.brand, v.region_code, v.price AS y, gm.g AS p_global,
         coalesce(b.b_mean, gm.g) AS p_brand, coalesce(r.br_mean, b.b_mean, gm.g) AS p_brand_region
  FROM val v CROSS JOIN gm LEFT JOIN bmean b ON v.brand = b.brand
  LEFT JOIN brmean r ON v.brand = r.brand AND v.region_code = r.region_code)
"""

BY_BRAND_SQL = """
bgroup AS (SELECT brand, avg(price) AS m, median(price) AS md FROM fit GROUP BY brand),
rgroup AS (SELECT region_code, avg(ln(1 + price)) AS lm FROM fit GROUP BY region_code)
"""

PREDS_SQL = SCORED_SQL + "," + BY_BRAND_SQL + f""",
fitted AS (
  SELECT v.sale_key AS key, v.price AS y, b.m - power(1 - {STEP}, {ROUNDS}) * (b.m - gm.g) AS p1, b.md AS p2, exp(r.lm) - 1 AS p3
  FROM val v CROSS JOIN gm JOIN bgroup b ON v.brand IS NOT DISTINCT FROM b.brand JOIN rgroup r ON v.region_code IS NOT DISTINCT FROM r.region_code),
preds AS (
  SELECT key, 'brand_boosted' AS model, y, p1 AS p FROM fitted
  UNION ALL SELECT key, 'brand_median', y, p2 FROM fitted
  UNION ALL SELECT key, 'region_log', y, p3 FROM fitted)
"""

HISTORY_SQL = SPLIT_SQL + "," + BY_BRAND_SQL + f""",
hrows AS (
  SELECT CASE split WHEN 'train' THEN 'train' ELSE 'valid' END AS set, s.price AS y, b.m, gm.g
  FROM sp s CROSS JOIN gm JOIN bgroup b ON s.brand IS NOT DISTINCT FROM b.brand),
hist AS (
  SELECT set, CAST(k AS INTEGER) AS iteration, avg(abs(e)) AS mae, sqrt(avg(e * e)) AS rmse, 1 - avg(e * e) / var_pop(y) AS r2
  FROM (SELECT set, k, y, y - (m - power(1 - {STEP}, k) * (m - g)) AS e FROM hrows CROSS JOIN range(1, {ROUNDS + 1}) r(k)) GROUP BY set, k)
"""

IMPORTANCE_SQL = SPLIT_SQL + ",\ngains AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, sum(n * (m - g) * (m - g)) AS gain FROM (SELECT count(*) AS n, avg(price) AS m FROM fit GROUP BY {c}) CROSS JOIN gm"
    for c in IMPORTANCE_FEATURES) + "),\nimp AS (SELECT feature, gain / (SELECT sum(gain) FROM gains) AS importance FROM gains)"
