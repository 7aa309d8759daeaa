"""Registered queries: projection/schema, union, joins, profiling and group statistics
(SURVEY 2.2-2.5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import encode as E
from ..operators import groupstats as G
from ..operators import profile as P
from ..operators import schema as SC
from ..operators.evaluate import model_comparison, regression_metrics
from ..operators.joins import left_join_params
from . import evalsets as EV
from . import features as FE
from .registry import L, R, TEST, TRAIN, register

LISTING_COLS = (["sale_key", "reg_date", "creat_date", "brand", "model", "body_type", "fuel_type", "gearbox",
                 "power", "kilometer", "not_repaired", "region_code", "offer_type", "price"]
                + [f"v_{i}" for i in range(15)] + ["source"])
NUMERIC = (["reg_date", "creat_date", "power", "kilometer", "region_code", "offer_type", "price"]
           + [f"v_{i}" for i in range(15)])
STRINGS = ["brand", "model", "body_type", "fuel_type", "gearbox", "not_repaired"]


def _union_all(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


# ---------------------------------------------------------------- 2.2 projection / schema


@register("head_n", """
SELECT sale_key, brand, price, reg_date FROM listings ORDER BY sale_key LIMIT 10""")
def q_head_n(spark, sf):
    return SC.head_n(L(spark, sf), 10, "sale_key").select("sale_key", "brand", "price", "reg_date")


@register("table_shape", """
SELECT 'train' AS "table", count(*) AS n_rows, 29 AS n_columns FROM train
UNION ALL SELECT 'test', count(*), 28 FROM test""")
def q_table_shape(spark, sf):
    return SC.table_shape(TRAIN(spark, sf).drop("source"), "train").unionByName(
        SC.table_shape(TEST(spark, sf).drop("source"), "test"))


@register("select_by_type", "SELECT " + ", ".join(NUMERIC) + " FROM listings")
def q_select_by_type(spark, sf):
    d = L(spark, sf)
    return d.select(*SC.select_by_type(d, "numeric"))


@register("select_features", """
SELECT * EXCLUDE (sale_key, reg_date, creat_date, price, source) FROM listings""")
def q_select_features(spark, sf):
    return SC.select_features(L(spark, sf), ["sale_key", "reg_date", "creat_date", "price", "source"])


@register("drop_columns", "SELECT * EXCLUDE (offer_type, source) FROM listings")
def q_drop_columns(spark, sf):
    return SC.drop_columns(L(spark, sf), ["offer_type", "source", "seller", "name"])


@register("drop_constant_columns", "SELECT * EXCLUDE (offer_type) FROM train")
def q_drop_constant_columns(spark, sf):
    return SC.drop_constant_columns(TRAIN(spark, sf).drop("source"))


@register("rename_columns", """
SELECT brand, avg(price) AS brand_avg_price, stddev_samp(price) AS brand_price_std, count(price) AS brand_count
FROM train WHERE brand IS NOT NULL GROUP BY brand""", rounds={"brand_avg_price": 6, "brand_price_std": 6})
def q_rename_columns(spark, sf):
    agg = TRAIN(spark, sf).groupBy("brand").agg(F.avg("price"), F.stddev_samp("price"), F.count("price"))
    return agg.toDF("brand", "brand_avg_price", "brand_price_std", "brand_count")


@register("cast_double", "SELECT sale_key, " + ", ".join(
    f"TRY_CAST({c} AS DOUBLE) AS {c}" for c in ["power", "kilometer", "not_repaired", "region_code", "reg_date"])
    + " FROM listings")
def q_cast_double(spark, sf):
    d = L(spark, sf).select("sale_key", "power", "kilometer", "not_repaired", "region_code", "reg_date")
    return SC.cast_double(d, ["power", "kilometer", "not_repaired", "region_code", "reg_date"])


@register("carry_key", "SELECT sale_key FROM test")
def q_carry_key(spark, sf):
    return TEST(spark, sf).select("sale_key")


@register("tag_source", "SELECT *, 'test' AS source FROM test")
def q_tag_source(spark, sf):
    return SC.tag_source(TEST(spark, sf).drop("source"), "test")


UNION_SQL = """
u AS (SELECT *, 'train' AS source FROM train UNION ALL BY NAME SELECT *, 'test' AS source FROM test)
"""


@register("filter_source", "SELECT * FROM u WHERE source = 'test'", ctes=UNION_SQL)
def q_filter_source(spark, sf):
    u = SC.union_by_name(SC.tag_source(TRAIN(spark, sf).drop("source"), "train"),
                         SC.tag_source(TEST(spark, sf).drop("source"), "test"))
    return SC.filter_source(u, "test")


@register("union_by_name", "SELECT * FROM u", ctes=UNION_SQL)
def q_union_by_name(spark, sf):
    return SC.union_by_name(SC.tag_source(TRAIN(spark, sf).drop("source"), "train"),
                            SC.tag_source(TEST(spark, sf).drop("source"), "test"))


# ---------------------------------------------------------------- 2.4 joins

BRAND_STATS_SQL = """
bs AS (SELECT brand, avg(price) AS brand_avg_price, stddev_samp(price) AS brand_price_std, count(price) AS brand_count
       FROM train WHERE brand IS NOT NULL GROUP BY brand),
edges AS (SELECT quantile_cont(round(brand_avg_price, 6), 0.25) AS e1, quantile_cont(round(brand_avg_price, 6), 0.5) AS e2,
                 quantile_cont(round(brand_avg_price, 6), 0.75) AS e3 FROM bs),
bst AS (SELECT bs.*, CASE WHEN round(brand_avg_price, 6) <= e1 THEN 'budget'
                          WHEN round(brand_avg_price, 6) <= e2 THEN 'economy'
                          WHEN round(brand_avg_price, 6) <= e3 THEN 'premium' ELSE 'luxury' END AS brand_tier
        FROM bs, edges)
"""


@register("join_brand_stats", """
SELECT l.sale_key, b.brand_avg_price, b.brand_price_std, b.brand_count, b.brand_tier
FROM listings l LEFT JOIN bst b ON l.brand = b.brand""", ctes=BRAND_STATS_SQL,
          rounds={"brand_avg_price": 6, "brand_price_std": 6})
def q_join_brand_stats(spark, sf):
    st = FE.fit_brand_stats(TRAIN(spark, sf))
    return G.join_stats(L(spark, sf), st, "brand").select(
        "sale_key", "brand_avg_price", "brand_price_std", "brand_count", "brand_tier")


REGION_SQL = """
gmean AS (SELECT avg(price) AS g FROM train),
rs AS (SELECT region_code, avg(price) AS region_avg_price, stddev_samp(price) AS region_price_std,
              count(price) AS region_count, avg(price) / (SELECT g FROM gmean) AS region_multiplier
       FROM train WHERE region_code IS NOT NULL GROUP BY region_code)
"""


@register("join_region_stats", """
SELECT l.sale_key, r.region_avg_price, r.region_price_std, r.region_count, r.region_multiplier
FROM listings l LEFT JOIN rs r ON l.region_code = r.region_code""", ctes=REGION_SQL,
          rounds={"region_avg_price": 6, "region_price_std": 6, "region_multiplier": 9})
def q_join_region_stats(spark, sf):
    st = G.group_stats_region(TRAIN(spark, sf), "region_code", "price")
    return G.join_stats(L(spark, sf), st, "region_code").select(
        "sale_key", "region_avg_price", "region_price_std", "region_count", "region_multiplier")


BR_SQL = """
bmn AS (SELECT brand, avg(price) AS brand_avg_price FROM train WHERE brand IS NOT NULL GROUP BY brand),
brm AS (SELECT brand, region_code, avg(price) AS brand_region_avg_price FROM train
        WHERE brand IS NOT NULL AND region_code IS NOT NULL GROUP BY brand, region_code)
"""


@register("join_brand_region", """
SELECT l.sale_key, coalesce(r.brand_region_avg_price, b.brand_avg_price) AS brand_region_avg_price
FROM listings l LEFT JOIN bmn b ON l.brand = b.brand
LEFT JOIN brm r ON l.brand = r.brand AND l.region_code = r.region_code""", ctes=BR_SQL,
          rounds={"brand_region_avg_price": 6})
def q_join_brand_region(spark, sf):
    tr = TRAIN(spark, sf)
    d = left_join_params(L(spark, sf), G.group_mean(tr, "brand", "price", "brand_avg_price"), "brand")
    d = left_join_params(d, G.group_mean(tr, ["brand", "region_code"], "price", "brand_region_avg_price"),
                         ["brand", "region_code"])
    return E.impute_from_column(d, "brand_region_avg_price", "brand_avg_price").select(
        "sale_key", "brand_region_avg_price")


# Gearbox status -> label (constant dictionary; unknown -> NULL).
GEARBOX_LABELS = {"F": "手动", "O": "自动"}


@register("map_lookup", "SELECT sale_key, CASE gearbox " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in GEARBOX_LABELS.items()) + " END AS gearbox_label FROM listings")
def q_map_lookup(spark, sf):
    return L(spark, sf).select("sale_key", E.map_values("gearbox", GEARBOX_LABELS).alias("gearbox_label"))


# ---------------------------------------------------------------- 2.5 profiling

ALL_COLS = [c for c in LISTING_COLS]


@register("missing_report", _union_all([
    f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing, (count(*) - count({c})) * 100.0 / count(*) AS missing_pct "
    f"FROM listings" for c in ALL_COLS]), rounds={"missing_pct": 9})
def q_missing_report(spark, sf):
    return P.missing_report(L(spark, sf), ALL_COLS)


@register("filter_nonzero_missing", "SELECT * FROM (" + _union_all([
    f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing, (count(*) - count({c})) * 100.0 / count(*) AS missing_pct "
    f"FROM listings" for c in ALL_COLS]) + ") WHERE missing > 0", rounds={"missing_pct": 9})
def q_filter_nonzero_missing(spark, sf):
    return P.filter_nonzero_missing(P.missing_report(L(spark, sf), ALL_COLS))


CLEAN_TRAIN_COLS = [c for c in LISTING_COLS if c != "source"]


@register("missing_counts", _union_all([
    f"SELECT '{c}' AS \"column\", count(*) - count({c if c != 'not_repaired' else 'TRY_CAST(nullif(not_repaired, ' + chr(39) + '-' + chr(39) + ') AS DOUBLE)'}) AS missing FROM train"
    for c in CLEAN_TRAIN_COLS]))
def q_missing_counts(spark, sf):
    d = FE.clean(TRAIN(spark, sf).drop("source"))
    return P.missing_report(d, CLEAN_TRAIN_COLS).select("column", "missing")


@register("sentinel_report", _union_all([
    f"SELECT '{c}' AS \"column\", CAST(count_if({c} = '-') AS BIGINT) AS n_sentinel, count_if({c} = '-') * 100.0 / count(*) AS sentinel_pct "
    f"FROM listings" for c in STRINGS]), rounds={"sentinel_pct": 9})
def q_sentinel_report(spark, sf):
    return P.sentinel_report(L(spark, sf), STRINGS)


MM_COLS = [c for c in LISTING_COLS if c != "sale_key"]


@register("missing_matrix", _union_all([
    f"SELECT sale_key, '{c}' AS \"column\", CAST({c} IS NULL AS INTEGER) AS is_missing FROM head" for c in MM_COLS]),
          ctes="head AS (SELECT * FROM listings ORDER BY sale_key LIMIT 100)")
def q_missing_matrix(spark, sf):
    return P.missing_matrix(L(spark, sf), "sale_key", MM_COLS, 100)


@register("describe", _union_all([
    f"SELECT '{c}' AS \"column\", count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std, "
    f"min({c}) AS min, quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.5) AS q50, "
    f"quantile_cont({c}, 0.75) AS q75, max({c}) AS max FROM (SELECT CAST({c} AS DOUBLE) AS {c} FROM train)"
    for c in NUMERIC]), rounds=R(["mean", "std", "min", "q25", "q50", "q75", "max"], 3))
def q_describe(spark, sf):
    return P.describe(TRAIN(spark, sf), NUMERIC, digits=None)


@register("target_summary", """
SELECT min(price) AS min, max(price) AS max, avg(price) AS mean, quantile_cont(price, 0.5) AS median,
       stddev_samp(price) AS std, skewness(price) AS skew, kurtosis(price) AS kurtosis FROM train""",
          rounds={"mean": 6, "median": 6, "std": 6, "skew": 6, "kurtosis": 6})
def q_target_summary(spark, sf):
    return P.target_summary(TRAIN(spark, sf), "price")


@register("prediction_summary", """
SELECT min(p_brand) AS min, max(p_brand) AS max, avg(p_brand) AS mean, quantile_cont(p_brand, 0.5) AS median
FROM scored""", ctes=EV.SCORED_SQL, rounds=R(["min", "max", "mean", "median"], 6))
def q_prediction_summary(spark, sf):
    return P.prediction_summary(EV.scored(spark, sf), "p_brand")


@register("target_transform_summary", """
SELECT avg(price) AS raw_mean, quantile_cont(price, 0.5) AS raw_median,
       avg(ln(1 + price)) AS log_mean, quantile_cont(ln(1 + price), 0.5) AS log_median FROM train""",
          rounds=R(["raw_mean", "raw_median", "log_mean", "log_median"], 6))
def q_target_transform_summary(spark, sf):
    return P.target_transform_summary(TRAIN(spark, sf), "price")


ND_COLS = STRINGS + ["region_code", "power"]


@register("n_distinct", _union_all([
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct FROM train" for c in ND_COLS]))
def q_n_distinct(spark, sf):
    return P.n_distinct(TRAIN(spark, sf), ND_COLS)


@register("value_counts", """
SELECT brand AS value, count(*) AS count FROM train WHERE brand IS NOT NULL GROUP BY brand""")
def q_value_counts(spark, sf):
    return P.value_counts(TRAIN(spark, sf), "brand")


@register("value_counts_topk", """
SELECT brand AS value, count(*) AS count FROM train WHERE brand IS NOT NULL GROUP BY brand
ORDER BY count DESC, value ASC LIMIT 15""")
def q_value_counts_topk(spark, sf):
    return P.value_counts_topk(TRAIN(spark, sf), "brand", 15)


@register("value_share", """
SELECT body_type AS value, count(*) AS count,
       count(*) * 100.0 / (SELECT count(*) FROM train WHERE body_type IS NOT NULL) AS share_pct
FROM train WHERE body_type IS NOT NULL GROUP BY body_type""", rounds={"share_pct": 9})
def q_value_share(spark, sf):
    return P.value_share(TRAIN(spark, sf), "body_type")


HIST_SQL = """
mm AS (SELECT min(price) AS mn, max(price) AS mx FROM train),
hb AS (SELECT CAST(least(coalesce(floor((price - mn) / ((mx - mn) / 100)), 0), 99) AS INTEGER) AS bin
       FROM train, mm WHERE price IS NOT NULL),
hc AS (SELECT bin, count(*) AS count FROM hb GROUP BY bin)
"""


@register("histogram", """
SELECT CAST(r.range AS INTEGER) AS bin, mn + r.range * ((mx - mn) / 100) AS lo, mn + (r.range + 1) * ((mx - mn) / 100) AS hi,
       coalesce(hc.count, 0) AS count
FROM range(100) r CROSS JOIN mm LEFT JOIN hc ON hc.bin = r.range""", ctes=HIST_SQL, rounds={"lo": 6, "hi": 6})
def q_histogram(spark, sf):
    return P.histogram(TRAIN(spark, sf), "price", 100)


HM_COLS = NUMERIC[:12]


@register("histogram_many", """
SELECT hr."column", CAST(r.range AS INTEGER) AS bin, mn + r.range * ((mx - mn) / 50) AS lo, mn + (r.range + 1) * ((mx - mn) / 50) AS hi,
       coalesce(hc.count, 0) AS count
FROM hr CROSS JOIN range(50) r LEFT JOIN hc ON hc."column" = hr."column" AND hc.bin = r.range""", ctes="hl AS (" + _union_all([
    f"SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS x FROM train WHERE {c} IS NOT NULL" for c in HM_COLS]) + """),
hr AS (SELECT "column", min(x) AS mn, max(x) AS mx FROM hl GROUP BY "column"),
hc AS (SELECT "column", CAST(CASE WHEN mx = mn THEN 0 ELSE least(floor((x - mn) / ((mx - mn) / 50)), 49) END AS INTEGER) AS bin, count(*) AS count
       FROM hl JOIN hr USING ("column") GROUP BY ALL)""", rounds={"lo": 6, "hi": 6})
def q_histogram_many(spark, sf):
    return P.histogram_many(TRAIN(spark, sf), HM_COLS, 50)


@register("density_grid", """
SELECT i, start + i * step AS x,
       coalesce(sum(c * exp(-0.5 * power((start + i * step - (mn + b * w)) / h, 2))) FILTER (abs(start + i * step - (mn + b * w)) <= 8 * h), 0)
       / (n * h * sqrt(2 * pi())) AS density
FROM ks CROSS JOIN (SELECT CAST(range AS INTEGER) AS i FROM range(1000)) g CROSS JOIN kb
GROUP BY i, start, step, n, h""", ctes="""
k0 AS (SELECT count(price) AS n, min(price) AS mn, max(price) AS mx, stddev_samp(price) * power(count(price), -0.2) AS h FROM train),
ks AS (SELECT n, mn, mx, h, h / 64 AS w, mn - (mx - mn) * 0.5 AS start, (mx - mn) * 2.0 / 999 AS step FROM k0),
kv AS (SELECT (price - mn) / w AS pos FROM train, ks WHERE price IS NOT NULL),
kb AS (SELECT b, sum(c) AS c FROM (SELECT floor(pos) AS b, 1 - (pos - floor(pos)) AS c FROM kv UNION ALL SELECT floor(pos) + 1, pos - floor(pos) FROM kv) GROUP BY b)""",
          rounds={"x": 6, "density": 14})
def q_density_grid(spark, sf):
    return P.density_grid(TRAIN(spark, sf), "price")


@register("boxplot_stats", """
SELECT q1, q2 AS median, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS fence_lo, q3 + 1.5 * (q3 - q1) AS fence_hi,
  (SELECT min(price) FROM train WHERE price >= q1 - 1.5 * (q3 - q1)) AS whisker_lo,
  (SELECT max(price) FROM train WHERE price <= q3 + 1.5 * (q3 - q1)) AS whisker_hi,
  (SELECT count(*) FROM train WHERE price < q1 - 1.5 * (q3 - q1) OR price > q3 + 1.5 * (q3 - q1)) AS n_outliers
FROM (SELECT quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.5) AS q2, quantile_cont(price, 0.75) AS q3 FROM train)""",
          rounds=R(["q1", "median", "q3", "iqr", "fence_lo", "fence_hi", "whisker_lo", "whisker_hi"], 6))
def q_boxplot_stats(spark, sf):
    return P.boxplot_stats(TRAIN(spark, sf), "price")


def _corr_sql(a: str, b: str, src: str = "train") -> str:
    return (f"(SELECT covar_pop(x, y) / nullif(stddev_pop(x) * stddev_pop(y), 0) FROM "
            f"(SELECT CAST({a} AS DOUBLE) AS x, CAST({b} AS DOUBLE) AS y FROM {src} "
            f"WHERE {a} IS NOT NULL AND {b} IS NOT NULL))")


CORR_ALL = _union_all([f"SELECT '{c}' AS \"column\", {_corr_sql(c, 'price')} AS corr" for c in NUMERIC])


@register("correlation_with_target", f"""
SELECT * FROM ({CORR_ALL}) ORDER BY corr DESC NULLS LAST, "column" ASC LIMIT 10""", rounds={"corr": 9})
def q_correlation_with_target(spark, sf):
    return P.correlation_with_target(TRAIN(spark, sf), NUMERIC, "price", top=10)


CM_COLS = NUMERIC


@register("correlation_matrix", _union_all([
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, {_corr_sql(a, b)} AS corr" for a in CM_COLS for b in CM_COLS]),
          rounds={"corr": 9})
def q_correlation_matrix(spark, sf):
    return P.correlation_matrix(TRAIN(spark, sf), CM_COLS)


@register("low_correlation_report", f"SELECT * FROM ({CORR_ALL}) WHERE abs(corr) < 0.01", rounds={"corr": 9})
def q_low_correlation_report(spark, sf):
    return P.low_correlation_report(TRAIN(spark, sf), NUMERIC, "price", 0.01)


# ---------------------------------------------------------------- 2.5 group statistics


@register("group_stats_brand", """
SELECT brand, avg(price) AS brand_avg_price, stddev_samp(price) AS brand_price_std, count(price) AS brand_count
FROM train WHERE brand IS NOT NULL GROUP BY brand""", rounds={"brand_avg_price": 6, "brand_price_std": 6})
def q_group_stats_brand(spark, sf):
    return G.group_stats(TRAIN(spark, sf), "brand", "price", "brand")


@register("group_stats_median", """
SELECT brand, avg(price) AS brand_price_mean, quantile_cont(price, 0.5) AS brand_price_median,
       stddev_samp(price) AS brand_price_std, count(price) AS brand_price_count
FROM train WHERE brand IS NOT NULL GROUP BY brand""",
          rounds={"brand_price_mean": 6, "brand_price_median": 6, "brand_price_std": 6})
def q_group_stats_median(spark, sf):
    return G.group_stats_median(TRAIN(spark, sf), "brand", "price", "brand")


@register("group_stats_region", "SELECT * FROM rs", ctes=REGION_SQL,
          rounds={"region_avg_price": 6, "region_price_std": 6, "region_multiplier": 9})
def q_group_stats_region(spark, sf):
    return G.group_stats_region(TRAIN(spark, sf), "region_code", "price")


@register("group_mean_brand_region", "SELECT * FROM brm", ctes=BR_SQL, rounds={"brand_region_avg_price": 6})
def q_group_mean_brand_region(spark, sf):
    return G.group_mean(TRAIN(spark, sf), ["brand", "region_code"], "price", "brand_region_avg_price")


@register("ratio_to_mean", """
SELECT sale_key, brand_price_mean / avg(brand_price_mean) OVER () AS brand_price_ratio
FROM (SELECT l.sale_key, b.brand_price_mean FROM listings l
      LEFT JOIN (SELECT brand, avg(price) AS brand_price_mean FROM train WHERE brand IS NOT NULL GROUP BY brand) b
      ON l.brand = b.brand)""", rounds={"brand_price_ratio": 9})
def q_ratio_to_mean(spark, sf):
    bm = G.group_mean(TRAIN(spark, sf), "brand", "price", "brand_price_mean")
    d = left_join_params(L(spark, sf), bm, "brand")
    return G.ratio_to_mean(d, "brand_price_mean", "brand_price_ratio").select("sale_key", "brand_price_ratio")


@register("freq_encode_stats", """
SELECT coalesce(model, '未知') AS model, count(*) / (SELECT count(*) FROM listings) AS model_freq
FROM listings GROUP BY 1""", rounds={"model_freq": 12})
def q_freq_encode_stats(spark, sf):
    d = L(spark, sf).withColumn("model", F.coalesce("model", F.lit("未知")))
    return G.freq_table(d, "model")


METRIC_R = {"mae": 6, "mse": 2, "rmse": 6, "r2": 9}


@register("regression_metrics", """
SELECT model, count(*) AS n, avg(abs(p - y)) AS mae, avg((p - y) * (p - y)) AS mse,
       sqrt(avg((p - y) * (p - y))) AS rmse, 1 - sum((p - y) * (p - y)) / (var_pop(y) * count(*)) AS r2
FROM preds GROUP BY model""", ctes=EV.PREDS_SQL, rounds=METRIC_R)
def q_regression_metrics(spark, sf):
    return regression_metrics(EV.predictions(spark, sf), "y", "p", ["model"])


@register("model_comparison", """
SELECT *, (mae - min(mae) OVER ()) * 100.0 / min(mae) OVER () AS mae_vs_best_pct FROM (
SELECT model, count(*) AS n, avg(abs(p - y)) AS mae, avg((p - y) * (p - y)) AS mse,
       sqrt(avg((p - y) * (p - y))) AS rmse, 1 - sum((p - y) * (p - y)) / (var_pop(y) * count(*)) AS r2
FROM preds GROUP BY model)""", ctes=EV.PREDS_SQL, rounds={**METRIC_R, "mae_vs_best_pct": 6})
def q_model_comparison(spark, sf):
    return model_comparison(EV.predictions(spark, sf), "y", "p", "model")
