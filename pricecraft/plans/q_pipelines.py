"""Registered queries: documented-only features and composite
pipelines (SURVEY 2.14)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import binning as B
from ..functions import scalars as S
from ..operators import profile as P
from ..operators.outliers import iqr_filter
from . import features as FE
from .q_profile import LISTING_COLS, NUMERIC, _corr_sql, _union_all
from .q_scalars import PD_CTES, TF_CTES, _case
from .registry import AS_OF_YEAR, L, TRAIN, register

Y = AS_OF_YEAR

# ---------------------------------------------------------------- 2.13 documented only


@register("brand_model_stats", """
SELECT brand, model, avg(price) AS brand_model_avg_price, count(price) AS brand_model_count
FROM train WHERE brand IS NOT NULL AND model IS NOT NULL GROUP BY brand, model""",
          rounds={"brand_model_avg_price": 6})
def q_brand_model_stats(spark, sf):
    return FE.brand_model_stats(TRAIN(spark, sf))


@register("region_brand_stats", """
SELECT region_code, brand, avg(price) AS region_brand_avg_price
FROM train WHERE region_code IS NOT NULL AND brand IS NOT NULL GROUP BY region_code, brand""",
          rounds={"region_brand_avg_price": 6})
def q_region_brand_stats(spark, sf):
    return FE.region_brand_stats(TRAIN(spark, sf))


@register("power_per_age", "SELECT sale_key, power / (car_age + 1) AS power_per_age FROM tf", ctes=TF_CTES,
          rounds={"power_per_age": 9})
def q_power_per_age(spark, sf):
    return FE.power_per_age(FE.time_features(L(spark, sf), Y)).select("sale_key", "power_per_age")


@register("km_per_year_segment", f"""
SELECT sale_key, {_case('kilometer / (car_age + 1)', FE.KM_PER_YEAR_EDGES, [0, 1, 2, 3])} AS km_per_year_segment
FROM tf""", ctes=TF_CTES)
def q_km_per_year_segment(spark, sf):
    d = FE.time_features(L(spark, sf), Y).withColumn("km_per_year", S.km_per_year("kilometer", "car_age"))
    return FE.km_per_year_segment(d).select("sale_key", "km_per_year_segment")


@register("price_per_km", "SELECT sale_key, price / (kilometer + 1) AS price_per_km FROM listings",
          rounds={"price_per_km": 6})
def q_price_per_km(spark, sf):
    return FE.price_per_km(L(spark, sf)).select("sale_key", "price_per_km")


AGE_SEG = _case("car_age", B.AGE_EDGES, B.AGE_LABELS)
ANOM_MIN_ROWS = 800


@register("age_region_anomaly", f"""
SELECT sale_key, CAST(coalesce(NOT has_null AND n < {ANOM_MIN_ROWS}, false) AS INTEGER) AS age_region_anomaly
FROM (SELECT sale_key, count(*) OVER (PARTITION BY seg, region_code) AS n,
             seg IS NULL OR region_code IS NULL AS has_null
      FROM (SELECT sale_key, region_code, {AGE_SEG} AS seg FROM tf))
""", ctes=TF_CTES)
def q_age_region_anomaly(spark, sf):
    d = FE.time_features(L(spark, sf), Y)
    return FE.age_region_anomaly(d, ANOM_MIN_ROWS).select("sale_key", "age_region_anomaly")


@register("age_model_anomaly", f"""
SELECT t.sale_key, CAST(coalesce(abs(t.price - s.m) > 3 * s.sd, false) AS INTEGER) AS age_model_anomaly
FROM (SELECT sale_key, price, model, {AGE_SEG} AS seg FROM tf) t
LEFT JOIN (SELECT {AGE_SEG} AS seg, model, avg(price) AS m, stddev_samp(price) AS sd FROM tf
           WHERE source = 'train' AND model IS NOT NULL GROUP BY 1, 2 HAVING seg IS NOT NULL) s
ON t.seg = s.seg AND t.model = s.model""", ctes=TF_CTES)
def q_age_model_anomaly(spark, sf):
    tr = FE.time_features(TRAIN(spark, sf), Y)
    d = FE.time_features(L(spark, sf), Y)
    return FE.age_model_anomaly(tr, d).select("sale_key", "age_model_anomaly")


@register("iqr_filter", """
SELECT sale_key, price, power FROM train, q
WHERE (price IS NULL OR (price >= pq1 - 1.5 * (pq3 - pq1) AND price <= pq3 + 1.5 * (pq3 - pq1)))
  AND (power IS NULL OR (power >= wq1 - 1.5 * (wq3 - wq1) AND power <= wq3 + 1.5 * (wq3 - wq1)))""",
          ctes="""q AS (SELECT quantile_cont(price, 0.25) AS pq1, quantile_cont(price, 0.75) AS pq3,
                         quantile_cont(power, 0.25) AS wq1, quantile_cont(power, 0.75) AS wq3 FROM train)""")
def q_iqr_filter(spark, sf):
    return iqr_filter(TRAIN(spark, sf), ["price", "power"]).select("sale_key", "price", "power")


# ---------------------------------------------------------------- 2.14 composites

FLAG_FEATS = ["power", "kilometer", "not_repaired", "region_code", "offer_type", "car_age"] + FE.V_COLS


def _flagship_sql() -> tuple[str, str]:
    base = (f"SELECT *, TRY_CAST(nullif(not_repaired, '-') AS DOUBLE) AS nr, "
            f"{Y} - TRY_CAST(substr(CAST(reg_date AS VARCHAR), 1, 4) AS INTEGER) AS age FROM ")
    ctes = [f"fa AS ({base} listings)", f"ft AS ({base} train)"]
    src = {"not_repaired": "nr", "car_age": "age"}
    meds = ", ".join(f"quantile_cont({src.get(c, c)}, 0.5) AS m_{c}" for c in FLAG_FEATS)
    ctes.append(f"fm AS (SELECT {meds} FROM ft)")
    for c in FE.CATEGORICAL:
        ctes.append(f"cc_{c} AS (SELECT {c} AS v, CAST(dense_rank() OVER (ORDER BY {c}) - 1 AS INTEGER) AS code "
                    f"FROM (SELECT DISTINCT {c} FROM ft WHERE {c} IS NOT NULL))")
    sel = []
    for c in FLAG_FEATS:
        sel.append(f"coalesce(CAST(fa.{src.get(c, c)} AS DOUBLE), m_{c}, 0.0) AS {c}")
    sel += [f"coalesce(cc_{c}.code, -1) AS {c}_code" for c in FE.CATEGORICAL]
    joins = " ".join(f"LEFT JOIN cc_{c} ON fa.{c} = cc_{c}.v" for c in FE.CATEGORICAL)
    return f"SELECT fa.sale_key, fa.price, {', '.join(sel)} FROM fa CROSS JOIN fm {joins}", ",\n".join(ctes)


_FS_SQL, _FS_CTES = _flagship_sql()


@register("flagship_features", _FS_SQL, ctes=_FS_CTES)
def q_flagship_features(spark, sf):
    return FE.flagship_features(TRAIN(spark, sf), L(spark, sf), Y)


ADV_ORD = ["brand_tier", "car_age_segment", "km_segment", "power_segment", "reg_season"]


def _advanced_sql() -> tuple[str, str]:
    tiers = "CASE WHEN round(b.brand_avg_price, 6) <= e1 THEN 'budget' WHEN round(b.brand_avg_price, 6) <= e2 THEN " \
            "'economy' WHEN round(b.brand_avg_price, 6) <= e3 THEN 'premium' ELSE 'luxury' END"
    ctes = TF_CTES.strip() + f""",
bs AS (SELECT brand, avg(price) AS brand_avg_price, stddev_samp(price) AS brand_price_std, count(price) AS brand_count
       FROM train WHERE brand IS NOT NULL GROUP BY brand),
ed AS (SELECT quantile_cont(round(brand_avg_price, 6), 0.25) AS e1, quantile_cont(round(brand_avg_price, 6), 0.5) AS e2,
              quantile_cont(round(brand_avg_price, 6), 0.75) AS e3 FROM bs),
bst AS (SELECT b.*, {tiers} AS brand_tier FROM bs b, ed),
gm AS (SELECT avg(price) AS g FROM train),
""" + ",\n".join(
        f"te_{c} AS (SELECT CAST({c} AS VARCHAR) AS v, avg(price) AS enc FROM train WHERE {c} IS NOT NULL GROUP BY 1)"
        for c in FE.TARGET_ENCODED) + f""",
a1 AS (
  SELECT t.* EXCLUDE (not_repaired), TRY_CAST(nullif(t.not_repaired, '-') AS DOUBLE) AS not_repaired,
    CASE t.reg_quarter WHEN 1 THEN 'winter' WHEN 2 THEN 'spring' WHEN 3 THEN 'summer' WHEN 4 THEN 'autumn' END AS reg_season,
    {_case('t.car_age', B.AGE_EDGES, B.AGE_LABELS)} AS car_age_segment,
    {_case('t.reg_year', B.REG_YEAR_EDGES, B.REG_YEAR_LABELS)} AS reg_year_period,
    b.brand_avg_price, b.brand_price_std, b.brand_count, b.brand_tier,
    t.kilometer / (t.car_age + 1) AS km_per_year,
    {_case('t.kilometer', B.KM_EDGES, B.KM_LABELS)} AS km_segment,
    {_case('t.power', B.POWER_EDGES, B.POWER_LABELS)} AS power_segment,
    t.power / (t.kilometer + 1) AS power_km_ratio,
    t.power / (b.brand_avg_price + 1) AS power_to_brand_price
  FROM tf t LEFT JOIN bst b ON t.brand = b.brand),
a2 AS (
  SELECT a1.*,
    CAST(not_repaired IS NULL AS INTEGER) AS not_repaired_is_missing,
    CAST(coalesce(km_per_year > 2.5, false) AS INTEGER) AS km_per_year_high,
    CAST(coalesce(car_age <= 2 AND kilometer > 10, false) AS INTEGER) AS new_car_high_km,
    CAST(coalesce(power = 0, false) AS INTEGER) AS power_is_zero,
    CAST(coalesce(time_diff > 365, false) AS INTEGER) AS long_listing_delay,
    power * car_age AS power_age, kilometer * car_age AS km_age,
    CAST(coalesce(power > 200 AND car_age <= 3, false) AS INTEGER) AS high_power_young,
    CAST(coalesce(kilometer <= 5 AND car_age <= 2, false) AS INTEGER) AS low_km_young,
    ln(1 + power) AS log_power, ln(1 + kilometer) AS log_km, ln(1 + brand_avg_price) AS log_brand_avg_price
  FROM a1)"""
    enc = ", ".join(f"coalesce(te_{c}.enc, gm.g) AS {c}_encoded" for c in FE.TARGET_ENCODED)
    joins = " ".join(f"LEFT JOIN te_{c} ON CAST(a2.{c} AS VARCHAR) = te_{c}.v" for c in FE.TARGET_ENCODED)
    from ..functions import binning as BB
    labels = {"brand_tier": BB.TIER_LABELS, "car_age_segment": BB.AGE_LABELS, "km_segment": BB.KM_LABELS,
              "power_segment": BB.POWER_LABELS, "reg_season": ["winter", "spring", "summer", "autumn"]}
    ords = ", ".join(
        "CAST(CASE a2." + c + " " + " ".join(f"WHEN '{lab}' THEN {i}" for i, lab in enumerate(labels[c]))
        + f" END AS DOUBLE) AS {c}_encoded" for c in ADV_ORD)
    sql = f"SELECT a2.* EXCLUDE (source, creat_date_str), {enc}, {ords} FROM a2 CROSS JOIN gm {joins}"
    return sql, ctes


_ADV_SQL, _ADV_CTES = _advanced_sql()
ADV_ROUND = {c: 6 for c in ["brand_avg_price", "brand_price_std", "power_to_brand_price", "log_brand_avg_price",
                            "body_type_encoded", "fuel_type_encoded", "gearbox_encoded", "region_code_encoded"]}
ADV_ROUND.update({c: 9 for c in ["km_per_year", "power_km_ratio", "log_power", "log_km"]})


@register("advanced_features", _ADV_SQL, ctes=_ADV_CTES, rounds=ADV_ROUND)
def q_advanced_features(spark, sf):
    out = FE.advanced_features(TRAIN(spark, sf), L(spark, sf), Y).drop("source")
    return out.withColumns({f"{c}_encoded": F.col(f"{c}_encoded").cast("double") for c in ADV_ORD})


@register("region_features", """
SELECT l.sale_key, r.region_avg_price, r.region_price_std, r.region_count, r.region_multiplier, b.brand_avg_price,
       coalesce(x.brand_region_avg_price, b.brand_avg_price) AS brand_region_avg_price
FROM listings l LEFT JOIN rs r ON l.region_code = r.region_code LEFT JOIN bmn b ON l.brand = b.brand
LEFT JOIN brm x ON l.brand = x.brand AND l.region_code = x.region_code""", ctes="""
gmean AS (SELECT avg(price) AS g FROM train),
rs AS (SELECT region_code, avg(price) AS region_avg_price, stddev_samp(price) AS region_price_std,
              count(price) AS region_count, avg(price) / (SELECT g FROM gmean) AS region_multiplier
       FROM train WHERE region_code IS NOT NULL GROUP BY region_code),
bmn AS (SELECT brand, avg(price) AS brand_avg_price FROM train WHERE brand IS NOT NULL GROUP BY brand),
brm AS (SELECT brand, region_code, avg(price) AS brand_region_avg_price FROM train
        WHERE brand IS NOT NULL AND region_code IS NOT NULL GROUP BY brand, region_code)""",
          rounds={"region_avg_price": 6, "region_price_std": 6, "region_multiplier": 9, "brand_avg_price": 6,
                  "brand_region_avg_price": 6})
def q_region_features(spark, sf):
    out = FE.region_features(TRAIN(spark, sf), L(spark, sf))
    return out.select("sale_key", "region_avg_price", "region_price_std", "region_count", "region_multiplier",
                      "brand_avg_price", "brand_region_avg_price")


# Column descriptions of the listings table (ours, in the spirit
# of the reference's field table).
DESCRIPTIONS = {
    "sale_key": "listing id, unique", "reg_date": "registration date, YYYYMMDD", "creat_date": "listing date, YYYYMMDD",
    "brand": "brand code", "model": "model code", "body_type": "body type code", "fuel_type": "fuel type code",
    "gearbox": "gearbox code", "power": "engine power", "kilometer": "distance driven, 10,000 km",
    "not_repaired": "unrepaired damage, dash = unknown", "region_code": "region code", "offer_type": "offer type",
    "price": "price (train only)",
}
DD_COLS = [c for c in LISTING_COLS if c != "source"]


def _dtype(c: str) -> str:
    if c in ("reg_date", "creat_date", "power", "region_code", "offer_type"):
        return "int"
    if c in ("sale_key", "brand", "model", "body_type", "fuel_type", "gearbox", "not_repaired"):
        return "string"
    return "double"


def _desc(c: str) -> str:
    return DESCRIPTIONS.get(c, "anonymous numeric feature")


@register("data_dictionary", _union_all([
    (f"SELECT '{c}' AS field, '{_dtype(c)}' AS type, '{_desc(c)}' AS description, count({c}) AS count, "
     f"count(*) - count({c}) AS missing, "
     + (f"avg({c}) AS mean, stddev_samp({c}) AS std, min({c}) AS min, quantile_cont({c}, 0.25) AS q25, "
        f"quantile_cont({c}, 0.5) AS q50, quantile_cont({c}, 0.75) AS q75, max({c}) AS max "
        f"FROM (SELECT CAST({c} AS DOUBLE) AS {c} FROM train)" if _dtype(c) != "string" else
        "CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS std, CAST(NULL AS DOUBLE) AS min, "
        "CAST(NULL AS DOUBLE) AS q25, CAST(NULL AS DOUBLE) AS q50, CAST(NULL AS DOUBLE) AS q75, "
        f"CAST(NULL AS DOUBLE) AS max FROM train"))
    for c in DD_COLS]), rounds={k: 4 for k in ["mean", "std", "min", "q25", "q50", "q75", "max"]})
def q_data_dictionary(spark, sf):
    """Field, type, description, count, missing and describe() per column of train."""
    tr = TRAIN(spark, sf).drop("source")
    types = {f.name: f.dataType.simpleString() for f in tr.schema.fields}
    num = [c for c in DD_COLS if types[c] != "string"]
    miss = P.missing_report(tr, DD_COLS).select(F.col("column").alias("field"), "missing")
    cnt = P._stack(tr.agg(*[F.count(c).alias(f"_c{i}") for i, c in enumerate(DD_COLS)]), [
        F.struct(F.lit(c).alias("field"), F.col(f"_c{i}").alias("count")) for i, c in enumerate(DD_COLS)])
    desc = P.describe(tr, num, digits=None).withColumnRenamed("column", "field").drop("count")
    meta = spark.createDataFrame([(c, types[c], _desc(c)) for c in DD_COLS], "field string, type string, description string")
    return (meta.join(cnt, "field").join(miss, "field").join(desc, "field", "left")
                .select("field", "type", "description", "count", "missing", "mean", "std", "min", "q25", "q50",
                        "q75", "max"))


EDA_STRINGS = ["brand", "model", "body_type", "fuel_type", "gearbox", "not_repaired"]


@register("eda_report", _union_all(
    ["SELECT 'shape' AS section, 'n_rows' AS name, CAST(count(*) AS DOUBLE) AS value FROM train",
     f"SELECT 'shape', 'n_columns', CAST({len(LISTING_COLS) - 1} AS DOUBLE)",
     "SELECT 'target', 'min', min(price) FROM train", "SELECT 'target', 'max', max(price) FROM train",
     "SELECT 'target', 'mean', avg(price) FROM train",
     "SELECT 'target', 'median', quantile_cont(price, 0.5) FROM train",
     "SELECT 'target', 'std', stddev_samp(price) FROM train",
     "SELECT 'target', 'skew', skewness(price) FROM train",
     "SELECT 'target', 'kurtosis', kurtosis(price) FROM train"]
    + [f"SELECT 'n_distinct', '{c}', CAST(count(DISTINCT {c}) AS DOUBLE) FROM train" for c in EDA_STRINGS]
    + [f"SELECT 'corr', \"column\", corr FROM (SELECT * FROM (" + _union_all(
        [f"SELECT '{c}' AS \"column\", {_corr_sql(c, 'price')} AS corr" for c in NUMERIC if c != "price"])
       + ") ORDER BY corr DESC NULLS LAST, \"column\" ASC LIMIT 5)"]), rounds={"value": 4})
def q_eda_report(spark, sf):
    """Shape, target moments, distinct counts and the top-5 correlations in one long table."""
    tr = TRAIN(spark, sf)
    shape = tr.agg(F.count(F.lit(1)).cast("double").alias("v")).select(
        F.explode(F.array(F.struct(F.lit("shape").alias("section"), F.lit("n_rows").alias("name"),
                                   F.col("v").alias("value")),
                          F.struct(F.lit("shape").alias("section"), F.lit("n_columns").alias("name"),
                                   F.lit(float(len(tr.drop("source").columns))).alias("value")))).alias("s")).select("s.*")
    ts = P.target_summary(tr, "price")
    tgt = ts.select(F.explode(F.array(*[F.struct(F.lit("target").alias("section"), F.lit(c).alias("name"),
                                                 F.col(c).alias("value")) for c in ts.columns])).alias("s")).select("s.*")
    nd = P.n_distinct(tr, EDA_STRINGS).select(F.lit("n_distinct").alias("section"), F.col("column").alias("name"),
                                              F.col("n_distinct").cast("double").alias("value"))
    cr = P.correlation_with_target(tr, [c for c in NUMERIC if c != "price"], "price", top=5).select(
        F.lit("corr").alias("section"), F.col("column").alias("name"), F.col("corr").alias("value"))
    return shape.unionByName(tgt).unionByName(nd).unionByName(cr)


# ---------------------------------------------------------------- function-structured pipeline

FP_NUM = ["power", "kilometer"] + FE.V_COLS
FP_FENCED = ["power", "kilometer", "v_0"]
FP_FREQ = {"model": "model", "brand": "brand", "body_type": "body_type", "fuel_type": "fuel_type", "gearbox": "gearbox",
           "not_repaired": "CAST(TRY_CAST(nullif(not_repaired, '-') AS DOUBLE) AS VARCHAR)"}


def _function_pipeline_sql() -> tuple[str, str]:
    ctes = PD_CTES.strip() + ",\n" + ",\n".join([
        "fm AS (SELECT " + ", ".join(f"quantile_cont({c}, 0.5) AS m_{c}" for c in FP_NUM) + " FROM listings)",
        "fl AS (SELECT * REPLACE (" + ", ".join(f"coalesce(CAST({c} AS DOUBLE), m_{c}) AS {c}" for c in FP_NUM) + "), "
        + ", ".join(f"CAST({c} IS NULL AS INTEGER) AS {c}_missing" for c in FP_NUM) + ", kilometer AS km_raw FROM pdx, fm)",
        "fq AS (SELECT " + ", ".join(f"quantile_cont({c}, 0.05) AS a_{c}, quantile_cont({c}, 0.95) AS b_{c}" for c in FP_FENCED) + " FROM fl)",
        "ff AS (SELECT " + ", ".join(f"a_{c} - 1.5 * (b_{c} - a_{c}) AS lo_{c}, b_{c} + 1.5 * (b_{c} - a_{c}) AS hi_{c}" for c in FP_FENCED) + " FROM fq)",
        "bs AS (SELECT brand, avg(price) AS brand_avg_price, quantile_cont(price, 0.5) AS brand_price_median, "
        "stddev_samp(price) AS brand_price_std, count(price) AS brand_count FROM train WHERE brand IS NOT NULL GROUP BY brand)",
        "mc AS (SELECT model AS m_key, CAST(row_number() OVER (ORDER BY model) - 1 AS INTEGER) AS code "
        "FROM (SELECT DISTINCT model FROM listings WHERE model IS NOT NULL))"])
    sel = ["sale_key", "vehicle_age_days", "vehicle_age_years",
           "CAST(coalesce(vehicle_age_years < 1, false) AS INTEGER) AS is_new_car",
           "CAST(floor(((month(reg_dt) % 12) + 3) / 3.0) AS INTEGER) AS reg_season",
           "CAST(floor(((month(creat_dt) % 12) + 3) / 3.0) AS INTEGER) AS creat_season",
           "CAST(year(reg_dt) AS INTEGER) AS reg_year", "km_raw / (vehicle_age_years + 0.1) AS km_per_year",
           _case("vehicle_age_years", B.AGE_YEARS_EDGES, B.AGE_YEARS_LABELS, False) + " AS age_segment",
           f"CAST({Y} - year(reg_dt) AS INTEGER) AS car_age_from_now",
           "coalesce(l.brand, 'nan') || '_' || coalesce(l.model, 'nan') AS brand_model", "coalesce(mc.code, -1) AS model_num"]
    sel += [f"{c}_missing" for c in FP_NUM] + [c for c in FP_NUM if c not in FP_FENCED]
    for c in FP_FENCED:
        sel += [f"greatest(lo_{c}, least(hi_{c}, {c})) AS {c}", f"CAST({c} < lo_{c} OR {c} > hi_{c} AS INTEGER) AS {c}_outlier"]
    sel += ["brand_avg_price", "brand_price_median", "brand_price_std", "brand_count", "brand_avg_price / avg(brand_avg_price) OVER () AS brand_price_ratio"]
    for c, x in FP_FREQ.items():
        x = x if c == "not_repaired" else f"l.{x}"
        sel += [f"coalesce({x}, '未知') AS {c}", f"count(*) OVER (PARTITION BY coalesce({x}, '未知')) / CAST(count(*) OVER () AS DOUBLE) AS {c}_freq"]
    return ctes, "SELECT " + ",\n  ".join(sel) + "\nFROM fl l CROSS JOIN ff LEFT JOIN bs ON l.brand = bs.brand LEFT JOIN mc ON l.model = mc.m_key"


_FP_CTES, _FP_SQL = _function_pipeline_sql()
FP_ROUNDS = ["vehicle_age_years", "km_per_year", "brand_avg_price", "brand_price_median", "brand_price_std", "brand_price_ratio",
             *FP_NUM, *(f"{c}_freq" for c in FP_FREQ)]
FP_COLS = (["sale_key", "vehicle_age_days", "is_new_car", "reg_season", "creat_season", "reg_year", "age_segment", "car_age_from_now", "brand_model",
            "model_num", "brand_count"] + [f"{c}_missing" for c in FP_NUM] + [f"{c}_outlier" for c in FP_FENCED] + list(FP_FREQ) + FP_ROUNDS)


@register("function_pipeline", _FP_SQL, ctes=_FP_CTES, rounds={c: 6 for c in FP_ROUNDS})
def q_function_pipeline(spark, sf):
    return FE.function_pipeline(L(spark, sf), Y).select(*FP_COLS)
