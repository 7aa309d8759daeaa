"""Registered queries: encoders, imputers and scaling."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import encode as E
from ..operators import groupstats as G
from ..operators.joins import left_join_params
from . import features as FE
from .q_scalars import TF_CTES
from .registry import AS_OF_YEAR, L, R, TEST, TRAIN, register

TE_COLS = FE.TARGET_ENCODED


def _te_sql() -> tuple[str, str]:
    ctes = ["gm AS (SELECT avg(price) AS g FROM train)"]
    joins, sel = [], []
    for i, c in enumerate(TE_COLS):
        ctes.append(f"te{i} AS (SELECT CAST({c} AS VARCHAR) AS v, avg(price) AS enc FROM train "
                    f"WHERE {c} IS NOT NULL GROUP BY 1)")
        joins.append(f"LEFT JOIN te{i} ON CAST(l.{c} AS VARCHAR) = te{i}.v")
        sel.append(f"coalesce(te{i}.enc, gm.g) AS {c}_encoded")
    sql = ("SELECT l.sale_key, " + ", ".join(sel) + " FROM listings l CROSS JOIN gm " + " ".join(joins))
    return sql, ",\n".join(ctes)


_TE_SQL, _TE_CTES = _te_sql()


@register("target_encode", _TE_SQL, ctes=_TE_CTES, rounds=R([f"{c}_encoded" for c in TE_COLS], 6))
def q_target_encode(spark, sf):
    out = E.target_encode(TRAIN(spark, sf), L(spark, sf), TE_COLS, "price")
    return out.select("sale_key", *[f"{c}_encoded" for c in TE_COLS])


FREQ_COLS = ["model", "brand", "body_type", "fuel_type", "gearbox", "not_repaired"]


def _freq_sql() -> tuple[str, str]:
    ctes = ["fl AS (SELECT sale_key, " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '未知') AS {c}" for c in FREQ_COLS)
            + " FROM listings)"]
    joins, sel = [], []
    for i, c in enumerate(FREQ_COLS):
        ctes.append(f"fq{i} AS (SELECT {c} AS v, count(*) / (SELECT count(*) FROM fl) AS f FROM fl GROUP BY 1)")
        joins.append(f"LEFT JOIN fq{i} ON fl.{c} = fq{i}.v")
        sel.append(f"fl.{c}, fq{i}.f AS {c}_freq")
    return "SELECT fl.sale_key, " + ", ".join(sel) + " FROM fl " + " ".join(joins), ",\n".join(ctes)


_FQ_SQL, _FQ_CTES = _freq_sql()


@register("freq_encode", _FQ_SQL, ctes=_FQ_CTES, rounds=R([f"{c}_freq" for c in FREQ_COLS], 12))
def q_freq_encode(spark, sf):
    out = E.freq_encode(L(spark, sf), FREQ_COLS)
    return out.select("sale_key", *[x for c in FREQ_COLS for x in (c, f"{c}_freq")])


TIER_SQL = """
bs AS (SELECT brand, round(avg(price), 6) AS x FROM train WHERE brand IS NOT NULL GROUP BY brand),
edges AS (SELECT quantile_cont(x, 0.25) AS e1, quantile_cont(x, 0.5) AS e2, quantile_cont(x, 0.75) AS e3 FROM bs),
bt AS (SELECT brand, CASE WHEN x <= e1 THEN 'budget' WHEN x <= e2 THEN 'economy' WHEN x <= e3 THEN 'premium'
                          ELSE 'luxury' END AS brand_tier FROM bs, edges)
"""


@register("ordinal_encode_tier", """
SELECT brand, brand_tier, CASE brand_tier WHEN 'budget' THEN 0 WHEN 'economy' THEN 1 WHEN 'premium' THEN 2
                                          WHEN 'luxury' THEN 3 END AS brand_tier_encoded FROM bt""", ctes=TIER_SQL)
def q_ordinal_encode_tier(spark, sf):
    st = FE.fit_brand_stats(TRAIN(spark, sf))
    return st.select("brand", "brand_tier", E.map_values("brand_tier", E.TIER_CODES).alias("brand_tier_encoded"))


def _seg_sql(default: bool) -> str:
    from ..functions import binning as B
    from .q_scalars import _case

    def enc(expr, labels):
        body = " ".join(f"WHEN '{lab}' THEN {i}" for i, lab in enumerate(labels))
        e = f"CASE {expr} {body} END"
        # without a default the code is nullable: a double, like a pandas map with gaps
        return f"coalesce({e}, -1)" if default else f"CAST({e} AS DOUBLE)"
    cols = [
        enc("bt.brand_tier", B.TIER_LABELS) + " AS brand_tier_encoded",
        enc(_case("t.car_age", B.AGE_EDGES, B.AGE_LABELS), B.AGE_LABELS) + " AS car_age_segment_encoded",
        enc(_case("t.kilometer", B.KM_EDGES, B.KM_LABELS), B.KM_LABELS) + " AS km_segment_encoded",
        enc(_case("t.power", B.POWER_EDGES, B.POWER_LABELS), B.POWER_LABELS) + " AS power_segment_encoded",
        enc("CASE t.reg_quarter WHEN 1 THEN 'winter' WHEN 2 THEN 'spring' WHEN 3 THEN 'summer' WHEN 4 THEN 'autumn' END",
            ["winter", "spring", "summer", "autumn"]) + " AS reg_season_encoded",
    ]
    if default:
        cols.append(enc(_case("t.reg_year", B.REG_YEAR_EDGES, B.REG_YEAR_LABELS), B.REG_YEAR_LABELS)
                    + " AS reg_year_period_encoded")
    return "SELECT t.sale_key, " + ", ".join(cols) + " FROM tf t LEFT JOIN bt ON t.brand = bt.brand"


def _seg_spark(spark, sf, default):
    d = FE.time_features(L(spark, sf), AS_OF_YEAR)
    tiers = FE.fit_brand_stats(TRAIN(spark, sf)).select("brand", "brand_tier")
    from ..functions import binning as B
    d = left_join_params(d, tiers, "brand").withColumns({
        "km_segment": B.cut_km("kilometer"), "power_segment": B.cut_power("power")})
    out = E.ordinal_encode_segments(d, default=-1 if default else None)
    cols = ["brand_tier", "car_age_segment", "km_segment", "power_segment", "reg_season"]
    if default:
        cols.append("reg_year_period")
    return out.select("sale_key", *[F.col(f"{c}_encoded") if default else
                                    F.col(f"{c}_encoded").cast("double").alias(f"{c}_encoded") for c in cols])


@register("ordinal_encode_segments", _seg_sql(False), ctes=TF_CTES + "," + TIER_SQL)
def q_ordinal_encode_segments(spark, sf):
    return _seg_spark(spark, sf, False)


@register("ordinal_encode_default", _seg_sql(True), ctes=TF_CTES + "," + TIER_SQL)
def q_ordinal_encode_default(spark, sf):
    return _seg_spark(spark, sf, True)


@register("category_codes", """
SELECT l.sale_key, l.model, coalesce(c.code, -1) AS model_code
FROM listings l LEFT JOIN (SELECT model, CAST(dense_rank() OVER (ORDER BY model) - 1 AS INTEGER) AS code
                           FROM (SELECT DISTINCT model FROM listings WHERE model IS NOT NULL)) c ON l.model = c.model""")
def q_category_codes(spark, sf):
    return E.category_codes(L(spark, sf), "model").select("sale_key", "model", "model_code")


BM_KEY = "concat_ws('_', coalesce(brand, 'nan'), coalesce(model, 'nan'))"


@register("category_codes_shared", f"""
SELECT t.sale_key, t.brand_model, coalesce(c.code, -1) AS brand_model_code
FROM (SELECT sale_key, {BM_KEY} AS brand_model FROM test) t
LEFT JOIN (SELECT brand_model, CAST(dense_rank() OVER (ORDER BY brand_model) - 1 AS INTEGER) AS code
           FROM (SELECT DISTINCT {BM_KEY} AS brand_model FROM train)) c
ON t.brand_model = c.brand_model""")
def q_category_codes_shared(spark, sf):
    """Dictionary from all training rows; unseen combinations of the test rows get -1."""
    tr = TRAIN(spark, sf).withColumn("brand_model", S.concat_key("brand", "model"))
    te = TEST(spark, sf).withColumn("brand_model", S.concat_key("brand", "model"))
    return E.category_codes_shared(tr, te, "brand_model").select("sale_key", "brand_model", "brand_model_code")


@register("first_seen_codes", f"""
SELECT brand_model, CAST(row_number() OVER (ORDER BY first_key, brand_model) - 1 AS INTEGER) AS brand_model_code
FROM (SELECT {BM_KEY} AS brand_model, min(sale_key) AS first_key FROM train GROUP BY 1)""")
def q_first_seen_codes(spark, sf):
    tr = TRAIN(spark, sf).withColumn("brand_model", S.concat_key("brand", "model"))
    return E.fit_first_seen_codes(tr, "brand_model", "sale_key")


@register("cast_category_str", "SELECT sale_key, CAST(region_code AS VARCHAR) AS region_code FROM listings")
def q_cast_category_str(spark, sf):
    return E.cast_category_str(L(spark, sf).select("sale_key", "region_code"), ["region_code"])


@register("ordered_target_stats", """
SELECT sale_key, body_type,
  (CAST(coalesce(sum(p) OVER w, 0) AS DOUBLE) + (SELECT CAST(sum(CAST(price AS DECIMAL(18, 2))) AS DOUBLE) / count(price) FROM train))
  / (coalesce(count(p) OVER w, 0) + CAST(1 AS DOUBLE)) AS body_type_ots
FROM (SELECT *, CAST(price AS DECIMAL(18, 2)) AS p FROM train)
WINDOW w AS (PARTITION BY coalesce(body_type, 'missing')
             ORDER BY ('0x' || substr(md5(sale_key), 1, 8))::BIGINT, sale_key
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""", rounds={"body_type_ots": 6})
def q_ordered_target_stats(spark, sf):
    d = TRAIN(spark, sf).select("sale_key", "body_type", F.col("price").cast("decimal(18,2)").alias("price"))
    mean = d.agg(F.sum("price").cast("double") / F.count("price")).scalar()
    out = E.ordered_target_stats(d, "body_type", "price", "sale_key", prior=mean)
    return out.select("sale_key", "body_type", "body_type_ots")


OTS_SALTS = ("0", "1", "2")
OTS_COLS = {"body_type": ["body_type"], "brand_gearbox": ["brand", "gearbox"]}


def _ots_many_sql() -> str:
    part, sel = {n: ", ".join(f"coalesce(CAST({c} AS VARCHAR), 'missing')" for c in cs) for n, cs in OTS_COLS.items()}, []
    for n in OTS_COLS:
        encs = [f"(CAST(coalesce(sum(p) OVER {n}_{s}, 0) AS DOUBLE) + g) / (coalesce(count(p) OVER {n}_{s}, 0) + CAST(1 AS DOUBLE))" for s in OTS_SALTS]
        sel.append(f"({' + '.join(encs)}) / {len(encs)} AS {n}_ots")
    windows = [f"{n}_{s} AS (PARTITION BY {part[n]} ORDER BY ('0x' || substr(md5('{s}:' || CAST(sale_key AS VARCHAR)), 1, 8))::BIGINT, sale_key "
               "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)" for n in OTS_COLS for s in OTS_SALTS]
    return (f"SELECT sale_key, {', '.join(sel)} FROM (SELECT *, CAST(price AS DECIMAL(18, 2)) AS p FROM train), "
            "(SELECT CAST(sum(CAST(price AS DECIMAL(18, 2))) AS DOUBLE) / count(price) AS g FROM train) WINDOW " + ", ".join(windows))


@register("ordered_target_stats_many", _ots_many_sql(), rounds={f"{n}_ots": 6 for n in OTS_COLS})
def q_ordered_target_stats_many(spark, sf):
    cols = sorted({c for cs in OTS_COLS.values() for c in cs})
    d = TRAIN(spark, sf).select("sale_key", *cols, F.col("price").cast("decimal(18,2)").alias("price"))
    mean = d.agg(F.sum("price").cast("double") / F.count("price")).scalar()
    return E.ordered_target_stats_many(d, list(OTS_COLS.values()), "price", "sale_key", OTS_SALTS, prior=mean)


IMP_CTE = """
ctr AS (SELECT *, TRY_CAST(nullif(not_repaired, '-') AS DOUBLE) AS nr FROM train),
cte AS (SELECT *, TRY_CAST(nullif(not_repaired, '-') AS DOUBLE) AS nr FROM test),
med AS (SELECT quantile_cont(nr, 0.5) AS m_nr, quantile_cont(power, 0.5) AS m_power,
               quantile_cont(kilometer, 0.5) AS m_km FROM ctr)
"""


@register("impute_median", """
SELECT sale_key, coalesce(nr, m_nr) AS not_repaired, coalesce(CAST(power AS DOUBLE), m_power) AS power,
       coalesce(kilometer, m_km) AS kilometer FROM cte, med""", ctes=IMP_CTE)
def q_impute_median(spark, sf):
    tr, te = FE.clean(TRAIN(spark, sf)), FE.clean(TEST(spark, sf))
    out = E.impute_median(tr, te, ["not_repaired", "power", "kilometer"])
    return out.select("sale_key", "not_repaired", F.col("power").cast("double").alias("power"), "kilometer")


@register("impute_median_combined", """
SELECT sale_key, 'train' AS side, coalesce(nr, m) AS not_repaired FROM ctr, mc
UNION ALL SELECT sale_key, 'test', coalesce(nr, m) FROM cte, mc""",
          ctes=IMP_CTE + ", mc AS (SELECT quantile_cont(nr, 0.5) AS m FROM (SELECT nr FROM ctr UNION ALL SELECT nr FROM cte))")
def q_impute_median_combined(spark, sf):
    tr, te = FE.clean(TRAIN(spark, sf)), FE.clean(TEST(spark, sf))
    a, b = E.impute_median_combined(tr, te, ["not_repaired"])
    return (a.select("sale_key", F.lit("train").alias("side"), "not_repaired")
             .unionByName(b.select("sale_key", F.lit("test").alias("side"), "not_repaired")))


@register("impute_missing_label", """
SELECT sale_key, coalesce(model, 'missing') AS model, coalesce(body_type, 'missing') AS body_type,
       coalesce(gearbox, 'missing') AS gearbox FROM listings""")
def q_impute_missing_label(spark, sf):
    d = L(spark, sf).select("sale_key", "model", "body_type", "gearbox")
    return E.impute_missing_label(d, ["model", "body_type", "gearbox"])


@register("impute_zero", """
SELECT sale_key, coalesce(TRY_CAST(nullif(not_repaired, '-') AS DOUBLE), 0.0) AS not_repaired FROM listings""")
def q_impute_zero(spark, sf):
    return E.impute_zero(FE.clean(L(spark, sf)).select("sale_key", "not_repaired"))


@register("impute_from_column", """
SELECT t.sale_key, coalesce(r.brand_region_avg_price, b.brand_avg_price) AS brand_region_avg_price, b.brand_avg_price
FROM test t LEFT JOIN bmn b ON t.brand = b.brand
LEFT JOIN brm r ON t.brand = r.brand AND t.region_code = r.region_code""", ctes="""
bmn AS (SELECT brand, avg(price) AS brand_avg_price FROM train WHERE brand IS NOT NULL GROUP BY brand),
brm AS (SELECT brand, region_code, avg(price) AS brand_region_avg_price FROM train
        WHERE brand IS NOT NULL AND region_code IS NOT NULL GROUP BY brand, region_code)""",
          rounds=R(["brand_region_avg_price", "brand_avg_price"], 6))
def q_impute_from_column(spark, sf):
    """brand x region mean; unseen combinations fall back to the brand mean."""
    tr = TRAIN(spark, sf)
    d = left_join_params(TEST(spark, sf), G.group_mean(tr, "brand", "price", "brand_avg_price"), "brand")
    br = G.group_mean(tr, ["brand", "region_code"], "price", "brand_region_avg_price")
    d = left_join_params(d, br, ["brand", "region_code"])
    return E.impute_from_column(d, "brand_region_avg_price", "brand_avg_price").select(
        "sale_key", "brand_region_avg_price", "brand_avg_price")


SC_COLS = ["power", "kilometer", "v_0", "offer_type"]


@register("standard_scale", "SELECT sale_key, " + ", ".join(
    f"(CAST({c} AS DOUBLE) - (SELECT avg({c}) FROM train)) / "
    f"(SELECT coalesce(nullif(stddev_pop({c}), 0), 1.0) FROM train) AS {c}" for c in SC_COLS) + " FROM test",
          rounds=R(SC_COLS, 9))
def q_standard_scale(spark, sf):
    return E.standard_scale(TRAIN(spark, sf), TEST(spark, sf).select("sale_key", *SC_COLS), SC_COLS)
