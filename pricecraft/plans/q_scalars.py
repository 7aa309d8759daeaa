"""Registered queries: date, string, math, flag and binning features."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import binning as B
from ..functions import dates as D
from ..functions import scalars as S
from ..operators import groupstats as G
from ..operators.joins import left_join_params
from ..operators.outliers import outlier_flag_and_clip, qcut_tier
from . import features as FE
from .registry import AS_OF_YEAR, L, R, TRAIN, register

Y = AS_OF_YEAR

# ---------------------------------------------------------------- shared SQL blocks

TF_CTES = f"""
tf0 AS (
  SELECT *,
    lpad(CAST(reg_date AS VARCHAR), CAST(greatest(8, length(CAST(reg_date AS VARCHAR))) AS INTEGER), '0') AS reg_date_str,
    lpad(CAST(creat_date AS VARCHAR), CAST(greatest(8, length(CAST(creat_date AS VARCHAR))) AS INTEGER), '0') AS creat_date_str
  FROM listings),
tf1 AS (
  SELECT *,
    TRY_CAST(substr(reg_date_str, 1, 4) AS INTEGER) AS reg_year,
    TRY_CAST(substr(reg_date_str, 5, 2) AS INTEGER) AS reg_month,
    TRY_CAST(substr(creat_date_str, 1, 4) AS INTEGER) AS create_year,
    TRY_CAST(substr(creat_date_str, 5, 2) AS INTEGER) AS create_month,
    CAST(creat_date - reg_date AS INTEGER) AS time_diff
  FROM tf0),
tf AS (
  SELECT *,
    CAST({Y} - reg_year AS INTEGER) AS car_age,
    CAST(floor((reg_month - 1) / 3.0) + 1 AS INTEGER) AS reg_quarter
  FROM tf1)
"""

PD_CTES = """
pd0 AS (
  SELECT *,
    coalesce(CASE WHEN length(CAST(reg_date AS VARCHAR)) = 8
                  THEN CAST(try_strptime(CAST(reg_date AS VARCHAR), '%Y%m%d') AS DATE) END, DATE '2016-01-01') AS reg_dt,
    coalesce(CASE WHEN length(CAST(creat_date AS VARCHAR)) = 8
                  THEN CAST(try_strptime(CAST(creat_date AS VARCHAR), '%Y%m%d') AS DATE) END, DATE '2016-01-01') AS creat_dt
  FROM listings),
pd1 AS (
  SELECT *, CAST(greatest(datediff('day', reg_dt, creat_dt), 0) AS INTEGER) AS vehicle_age_days FROM pd0),
pdx AS (
  SELECT *, vehicle_age_days / 365.0 AS vehicle_age_years FROM pd1)
"""

BRAND_MEAN_CTE = """
bm AS (SELECT brand, avg(price) AS brand_avg_price FROM train WHERE brand IS NOT NULL GROUP BY brand)
"""


def _tf(spark, sf):
    return FE.time_features(L(spark, sf), Y)


def _pd(spark, sf):
    df = L(spark, sf).withColumns({"reg_dt": D.parse_date_lenient("reg_date"),
                                   "creat_dt": D.parse_date_lenient("creat_date")})
    df = df.withColumn("vehicle_age_days", D.age_days("creat_dt", "reg_dt"))
    return df.withColumn("vehicle_age_years", D.age_years("vehicle_age_days"))


def _case(col: str, edges, labels, include_lowest=True) -> str:
    parts = []
    for i in range(len(edges) - 1):
        lo = f"{col} >= {edges[i]}" if (i == 0 and include_lowest) else f"{col} > {edges[i]}"
        lab = f"'{labels[i]}'" if isinstance(labels[i], str) else str(labels[i])
        parts.append(f"WHEN {lo} AND {col} <= {edges[i + 1]} THEN {lab}")
    return "CASE " + " ".join(parts) + " END"


# ---------------------------------------------------------------- 2.7 dates and strings


@register("int_date_pad", """
SELECT sale_key,
  lpad(CAST(reg_date AS VARCHAR), CAST(greatest(8, length(CAST(reg_date AS VARCHAR))) AS INTEGER), '0') AS reg_date_str,
  lpad(CAST(creat_date AS VARCHAR), CAST(greatest(8, length(CAST(creat_date AS VARCHAR))) AS INTEGER), '0') AS creat_date_str
FROM listings""")
def q_int_date_pad(spark, sf):
    return L(spark, sf).select("sale_key", D.int_date_pad("reg_date").alias("reg_date_str"),
                               D.int_date_pad("creat_date").alias("creat_date_str"))


@register("int_date_parts", """
SELECT sale_key, reg_year, reg_month, create_year, create_month FROM tf""", ctes=TF_CTES)
def q_int_date_parts(spark, sf):
    return _tf(spark, sf).select("sale_key", "reg_year", "reg_month", "create_year", "create_month")


@register("car_age", "SELECT sale_key, car_age FROM tf", ctes=TF_CTES)
def q_car_age(spark, sf):
    return _tf(spark, sf).select("sale_key", "car_age")


@register("car_age_from_now", f"""
SELECT sale_key, CAST({Y} - year(reg_dt) AS INTEGER) AS car_age_from_now FROM pdx""", ctes=PD_CTES)
def q_car_age_from_now(spark, sf):
    return _pd(spark, sf).select("sale_key", D.car_age(F.year("reg_dt"), Y).alias("car_age_from_now"))


@register("calendar_quarter", "SELECT sale_key, reg_month, reg_quarter FROM tf", ctes=TF_CTES)
def q_calendar_quarter(spark, sf):
    return _tf(spark, sf).select("sale_key", "reg_month", "reg_quarter")


@register("calendar_quarter_clipped", """
SELECT sale_key, CASE WHEN reg_quarter IS NOT NULL THEN greatest(1, least(4, reg_quarter)) END AS reg_quarter_clipped FROM tf""", ctes=TF_CTES)
def q_calendar_quarter_clipped(spark, sf):
    return _tf(spark, sf).select("sale_key", D.calendar_quarter_clipped("reg_month").alias("reg_quarter_clipped"))


@register("quarter_season", """
SELECT sale_key, reg_quarter,
  CASE reg_quarter WHEN 1 THEN 'winter' WHEN 2 THEN 'spring' WHEN 3 THEN 'summer' WHEN 4 THEN 'autumn' END AS reg_season
FROM tf""", ctes=TF_CTES)
def q_quarter_season(spark, sf):
    return _tf(spark, sf).select("sale_key", "reg_quarter", "reg_season")


@register("meteorological_season", """
SELECT sale_key,
  CAST(floor(((month(reg_dt) % 12) + 3) / 3.0) AS INTEGER) AS reg_season,
  CAST(floor(((month(creat_dt) % 12) + 3) / 3.0) AS INTEGER) AS creat_season
FROM pdx""", ctes=PD_CTES)
def q_meteorological_season(spark, sf):
    d = _pd(spark, sf)
    return d.select("sale_key", D.meteorological_season(F.month("reg_dt")).alias("reg_season"),
                    D.meteorological_season(F.month("creat_dt")).alias("creat_season"))


@register("int_date_diff", "SELECT sale_key, time_diff FROM tf", ctes=TF_CTES)
def q_int_date_diff(spark, sf):
    return _tf(spark, sf).select("sale_key", "time_diff")


@register("parse_date_lenient", """
SELECT sale_key, strftime(reg_dt, '%Y-%m-%d') AS reg_dt, strftime(creat_dt, '%Y-%m-%d') AS creat_dt FROM pdx""",
          ctes=PD_CTES)
def q_parse_date_lenient(spark, sf):
    d = _pd(spark, sf)
    return d.select("sale_key", F.date_format("reg_dt", "yyyy-MM-dd").alias("reg_dt"),
                    F.date_format("creat_dt", "yyyy-MM-dd").alias("creat_dt"))


@register("age_days", "SELECT sale_key, vehicle_age_days FROM pdx", ctes=PD_CTES)
def q_age_days(spark, sf):
    return _pd(spark, sf).select("sale_key", "vehicle_age_days")


@register("age_years", "SELECT sale_key, vehicle_age_years FROM pdx", ctes=PD_CTES,
          rounds=R(["vehicle_age_years"], 9))
def q_age_years(spark, sf):
    return _pd(spark, sf).select("sale_key", "vehicle_age_years")


@register("date_parts", """
SELECT sale_key, CAST(year(reg_dt) AS INTEGER) AS reg_year, CAST(month(reg_dt) AS INTEGER) AS reg_month,
  CAST(day(reg_dt) AS INTEGER) AS reg_day, CAST(year(creat_dt) AS INTEGER) AS creat_year,
  CAST(month(creat_dt) AS INTEGER) AS creat_month, CAST(day(creat_dt) AS INTEGER) AS creat_day
FROM pdx""", ctes=PD_CTES)
def q_date_parts(spark, sf):
    d = _pd(spark, sf)
    return d.select("sale_key", *D.date_parts("reg_dt", "reg"), *D.date_parts("creat_dt", "creat"))


@register("concat_key", """
SELECT sale_key, concat_ws('_', coalesce(brand, 'nan'), coalesce(model, 'nan')) AS brand_model FROM listings""")
def q_concat_key(spark, sf):
    return L(spark, sf).select("sale_key", S.concat_key("brand", "model").alias("brand_model"))


@register("sentinel_to_numeric", """
SELECT sale_key, TRY_CAST(nullif(not_repaired, '-') AS DOUBLE) AS not_repaired FROM listings""")
def q_sentinel_to_numeric(spark, sf):
    return L(spark, sf).select("sale_key", S.sentinel_to_numeric("not_repaired").alias("not_repaired"))


@register("sentinel_to_default", """
SELECT sale_key, coalesce(TRY_CAST(nullif(not_repaired, '-') AS DOUBLE), -1.0) AS not_repaired FROM listings""")
def q_sentinel_to_default(spark, sf):
    return L(spark, sf).select("sale_key", S.sentinel_to_default("not_repaired").alias("not_repaired"))


# ---------------------------------------------------------------- 2.8 math, flags


@register("log1p_features", """
SELECT l.sale_key, ln(1 + l.power) AS log_power, ln(1 + l.kilometer) AS log_km,
       ln(1 + bm.brand_avg_price) AS log_brand_avg_price
FROM listings l LEFT JOIN bm ON l.brand = bm.brand""", ctes=BRAND_MEAN_CTE,
          rounds=R(["log_power", "log_km", "log_brand_avg_price"], 9))
def q_log1p_features(spark, sf):
    bm = G.group_stats(TRAIN(spark, sf), "brand", "price", "brand", ("mean",))
    d = left_join_params(L(spark, sf), bm, "brand")
    return d.select("sale_key", S.log1p("power").alias("log_power"), S.log1p("kilometer").alias("log_km"),
                    S.log1p("brand_avg_price").alias("log_brand_avg_price"))


@register("square_feature", """
SELECT sale_key, CAST(power AS BIGINT) * CAST(power AS BIGINT) AS power_sq FROM listings""")
def q_square_feature(spark, sf):
    return L(spark, sf).select("sale_key", S.square(F.col("power").cast("long")).alias("power_sq"))


@register("target_log_transform", """
SELECT sale_key, ln(1 + price) AS price_log, exp(ln(1 + price)) - 1 AS price_back FROM train""",
          rounds={"price_log": 9, "price_back": 4})
def q_target_log_transform(spark, sf):
    t = TRAIN(spark, sf).select("sale_key", F.log1p("price").alias("price_log"))
    return t.withColumn("price_back", F.expm1("price_log"))


@register("km_per_year", """
SELECT sale_key, kilometer / (car_age + 1) AS km_per_year FROM tf""", ctes=TF_CTES, rounds=R(["km_per_year"], 9))
def q_km_per_year(spark, sf):
    return _tf(spark, sf).select("sale_key", S.km_per_year("kilometer", "car_age").alias("km_per_year"))


@register("km_per_year_frac", """
SELECT sale_key, kilometer / (vehicle_age_years + 0.1) AS km_per_year FROM pdx""", ctes=PD_CTES,
          rounds=R(["km_per_year"], 9))
def q_km_per_year_frac(spark, sf):
    return _pd(spark, sf).select("sale_key", S.km_per_year_frac("kilometer", "vehicle_age_years").alias("km_per_year"))


@register("ratio_features", """
SELECT l.sale_key, l.power / (l.kilometer + 1) AS power_km_ratio,
       l.power / (bm.brand_avg_price + 1) AS power_to_brand_price
FROM listings l LEFT JOIN bm ON l.brand = bm.brand""", ctes=BRAND_MEAN_CTE,
          rounds=R(["power_km_ratio", "power_to_brand_price"], 9))
def q_ratio_features(spark, sf):
    bm = G.group_stats(TRAIN(spark, sf), "brand", "price", "brand", ("mean",))
    d = left_join_params(L(spark, sf), bm, "brand")
    return d.select("sale_key", S.ratio_plus("power", "kilometer").alias("power_km_ratio"),
                    S.ratio_plus("power", "brand_avg_price").alias("power_to_brand_price"))


@register("product_features", """
SELECT sale_key, power * car_age AS power_age, kilometer * car_age AS km_age FROM tf""", ctes=TF_CTES)
def q_product_features(spark, sf):
    d = _tf(spark, sf)
    return d.select("sale_key", S.product("power", "car_age").alias("power_age"),
                    S.product("kilometer", "car_age").alias("km_age"))


@register("flag_missing", """
SELECT sale_key, CAST(TRY_CAST(nullif(not_repaired, '-') AS DOUBLE) IS NULL AS INTEGER) AS not_repaired_is_missing
FROM listings""")
def q_flag_missing(spark, sf):
    return L(spark, sf).select("sale_key", S.flag_missing(S.sentinel_to_numeric("not_repaired"))
                               .alias("not_repaired_is_missing"))


_MISS = ["power", "kilometer"] + [f"v_{i}" for i in range(15)] + ["model", "body_type", "gearbox"]


@register("flag_missing_many", "SELECT sale_key, " + ", ".join(
    f"CAST({c} IS NULL AS INTEGER) AS {c}_missing" for c in _MISS) + " FROM listings")
def q_flag_missing_many(spark, sf):
    return L(spark, sf).select("sale_key", *[S.flag_missing(c).alias(f"{c}_missing") for c in _MISS])


@register("flag_threshold", """
SELECT sale_key,
  CAST(coalesce(kilometer / (car_age + 1) > 2.5, false) AS INTEGER) AS km_per_year_high,
  CAST(coalesce(power = 0, false) AS INTEGER) AS power_is_zero,
  CAST(coalesce(time_diff > 365, false) AS INTEGER) AS long_listing_delay
FROM tf""", ctes=TF_CTES)
def q_flag_threshold(spark, sf):
    d = _tf(spark, sf).withColumn("km_per_year", S.km_per_year("kilometer", "car_age"))
    return d.select("sale_key", S.flag(F.col("km_per_year") > 2.5).alias("km_per_year_high"),
                    S.flag(F.col("power") == 0).alias("power_is_zero"),
                    S.flag(F.col("time_diff") > 365).alias("long_listing_delay"))


@register("flag_conjunction", """
SELECT sale_key,
  CAST(coalesce(car_age <= 2 AND kilometer > 10, false) AS INTEGER) AS new_car_high_km,
  CAST(coalesce(power > 200 AND car_age <= 3, false) AS INTEGER) AS high_power_young,
  CAST(coalesce(kilometer <= 5 AND car_age <= 2, false) AS INTEGER) AS low_km_young,
  CAST(coalesce(kilometer <= 5 AND car_age <= 4, false) AS INTEGER) AS low_km_newish
FROM tf""", ctes=TF_CTES)
def q_flag_conjunction(spark, sf):
    d = _tf(spark, sf)
    age, km, pw = F.col("car_age"), F.col("kilometer"), F.col("power")
    return d.select("sale_key", S.flag((age <= 2) & (km > 10)).alias("new_car_high_km"),
                    S.flag((pw > 200) & (age <= 3)).alias("high_power_young"),
                    S.flag((km <= 5) & (age <= 2)).alias("low_km_young"),
                    S.flag((km <= 5) & (age <= 4)).alias("low_km_newish"))


@register("flag_new", """
SELECT sale_key, CAST(coalesce(vehicle_age_years < 1, false) AS INTEGER) AS is_new_car FROM pdx""",
          ctes=PD_CTES)
def q_flag_new(spark, sf):
    return _pd(spark, sf).select("sale_key", S.flag(F.col("vehicle_age_years") < 1).alias("is_new_car"))


@register("clip_nonneg_int", """
SELECT l.sale_key, CAST(trunc(greatest(l.price - 1.5 * bm.brand_avg_price, 0.0)) AS BIGINT) AS price_clipped
FROM listings l LEFT JOIN bm ON l.brand = bm.brand""", ctes=BRAND_MEAN_CTE)
def q_clip_nonneg_int(spark, sf):
    bm = G.group_stats(TRAIN(spark, sf), "brand", "price", "brand", ("mean",))
    d = left_join_params(L(spark, sf), bm, "brand")
    return d.select("sale_key", S.clip_nonneg_int(F.col("price") - 1.5 * F.col("brand_avg_price"))
                    .alias("price_clipped"))


# ---------------------------------------------------------------- 2.9 binning


@register("cut_age", f"SELECT sale_key, car_age, {_case('car_age', B.AGE_EDGES, B.AGE_LABELS)} AS car_age_segment FROM tf",
          ctes=TF_CTES)
def q_cut_age(spark, sf):
    return _tf(spark, sf).select("sale_key", "car_age", "car_age_segment")


@register("cut_reg_year",
          f"SELECT sale_key, {_case('reg_year', B.REG_YEAR_EDGES, B.REG_YEAR_LABELS)} AS reg_year_period FROM tf",
          ctes=TF_CTES)
def q_cut_reg_year(spark, sf):
    return _tf(spark, sf).select("sale_key", "reg_year_period")


@register("cut_km", f"SELECT sale_key, {_case('kilometer', B.KM_EDGES, B.KM_LABELS)} AS km_segment FROM listings")
def q_cut_km(spark, sf):
    return L(spark, sf).select("sale_key", B.cut_km("kilometer").alias("km_segment"))


@register("cut_power",
          f"SELECT sale_key, {_case('power', B.POWER_EDGES, B.POWER_LABELS)} AS power_segment FROM listings")
def q_cut_power(spark, sf):
    return L(spark, sf).select("sale_key", B.cut_power("power").alias("power_segment"))


@register("cut_km_int",
          f"SELECT sale_key, CAST({_case('kilometer', B.KM_INT_EDGES, [0, 1, 2])} AS DOUBLE) AS km_bin FROM listings")
def q_cut_km_int(spark, sf):
    # nullable code: exposed as double so NULL has one representation on every engine
    return L(spark, sf).select("sale_key", B.cut_km_int("kilometer").cast("double").alias("km_bin"))


@register("cut_age_years", f"""
SELECT sale_key, {_case('vehicle_age_years', B.AGE_YEARS_EDGES, B.AGE_YEARS_LABELS, False)} AS age_segment
FROM pdx""", ctes=PD_CTES)
def q_cut_age_years(spark, sf):
    return _pd(spark, sf).select("sale_key", B.cut_age_years("vehicle_age_years").alias("age_segment"))


QT_CTES = """
bs AS (SELECT brand, round(avg(price), 6) AS brand_avg_price FROM train WHERE brand IS NOT NULL GROUP BY brand),
edges AS (SELECT quantile_cont(brand_avg_price, 0.25) AS e1, quantile_cont(brand_avg_price, 0.5) AS e2,
                 quantile_cont(brand_avg_price, 0.75) AS e3 FROM bs)
"""


@register("qcut_tier", """
SELECT brand, brand_avg_price,
  CASE WHEN brand_avg_price <= e1 THEN 'budget' WHEN brand_avg_price <= e2 THEN 'economy'
       WHEN brand_avg_price <= e3 THEN 'premium' ELSE 'luxury' END AS brand_tier
FROM bs, edges""", ctes=QT_CTES, rounds=R(["brand_avg_price"], 6))
def q_qcut_tier(spark, sf):
    st = G.group_stats(TRAIN(spark, sf), "brand", "price", "brand", ("mean",))
    return qcut_tier(st, "brand_avg_price", "brand_tier").select(
        "brand", F.round("brand_avg_price", 6).alias("brand_avg_price"), "brand_tier")


FENCE_CTES = """
qq AS (SELECT quantile_cont(power, 0.05) AS p_a, quantile_cont(power, 0.95) AS p_b,
              quantile_cont(kilometer, 0.05) AS k_a, quantile_cont(kilometer, 0.95) AS k_b,
              quantile_cont(v_0, 0.05) AS v_a, quantile_cont(v_0, 0.95) AS v_b FROM listings),
fz AS (SELECT p_a - 1.5 * (p_b - p_a) AS p_lo, p_b + 1.5 * (p_b - p_a) AS p_hi,
              k_a - 1.5 * (k_b - k_a) AS k_lo, k_b + 1.5 * (k_b - k_a) AS k_hi,
              v_a - 1.5 * (v_b - v_a) AS v_lo, v_b + 1.5 * (v_b - v_a) AS v_hi FROM qq)
"""


@register("outlier_flag", """
SELECT sale_key,
  CAST(coalesce(power < p_lo OR power > p_hi, false) AS INTEGER) AS power_outlier,
  CAST(coalesce(kilometer < k_lo OR kilometer > k_hi, false) AS INTEGER) AS kilometer_outlier,
  CAST(coalesce(v_0 < v_lo OR v_0 > v_hi, false) AS INTEGER) AS v_0_outlier
FROM listings, fz""", ctes=FENCE_CTES)
def q_outlier_flag(spark, sf):
    d = outlier_flag_and_clip(L(spark, sf), ["power", "kilometer", "v_0"])
    return d.select("sale_key", "power_outlier", "kilometer_outlier", "v_0_outlier")


@register("winsorize", """
SELECT sale_key, CASE WHEN power IS NOT NULL THEN greatest(p_lo, least(p_hi, power)) END AS power,
  CASE WHEN kilometer IS NOT NULL THEN greatest(k_lo, least(k_hi, kilometer)) END AS kilometer,
  CASE WHEN v_0 IS NOT NULL THEN greatest(v_lo, least(v_hi, v_0)) END AS v_0
FROM listings, fz""", ctes=FENCE_CTES, rounds=R(["power", "kilometer", "v_0"], 9))
def q_winsorize(spark, sf):
    d = outlier_flag_and_clip(L(spark, sf), ["power", "kilometer", "v_0"])
    return d.select("sale_key", F.col("power").cast("double").alias("power"),
                    F.col("kilometer").cast("double").alias("kilometer"), F.col("v_0").cast("double").alias("v_0"))
