"""All registered queries (importing the section modules fills the registry)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import q_encode, q_eval, q_io, q_models, q_pipelines, q_profile, q_scalars  # noqa: F401  (fills the registry)
from .registry import AS_OF_YEAR, ORACLES, QUERIES, TRAIN, L, register
from . import features as FE
from ..operators.joins import left_join_params

FLAGSHIP_SQL = """
bs AS (SELECT brand, round(avg(price), 6) AS brand_avg_price FROM train WHERE brand IS NOT NULL GROUP BY brand),
edges AS (SELECT quantile_cont(brand_avg_price, 0.25) AS e1, quantile_cont(brand_avg_price, 0.5) AS e2,
                 quantile_cont(brand_avg_price, 0.75) AS e3 FROM bs),
tiers AS (SELECT brand, CASE WHEN brand_avg_price <= e1 THEN 'budget' WHEN brand_avg_price <= e2 THEN 'economy'
       WHEN brand_avg_price <= e3 THEN 'premium' ELSE 'luxury' END AS brand_tier FROM bs, edges)
"""


@register("flagship_tier_summary", f"""
SELECT t.brand_tier, count(*) AS n_listings, avg(l.price) AS avg_price,
       avg({AS_OF_YEAR} - TRY_CAST(substr(CAST(l.reg_date AS VARCHAR), 1, 4) AS INTEGER)) AS avg_car_age,
       avg(TRY_CAST(nullif(l.not_repaired, '-') AS DOUBLE)) AS damaged_share
FROM listings l JOIN tiers t ON l.brand = t.brand
GROUP BY t.brand_tier""", ctes=FLAGSHIP_SQL, rounds={"avg_price": 4, "avg_car_age": 6, "damaged_share": 6})
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings -> clean sentinel -> car age -> brand stats -> quantile tiers ->
    join -> average price per tier."""
    train = TRAIN(spark, sf_dir)
    tiers = FE.fit_brand_stats(train).select("brand", "brand_tier")
    d = FE.clean(L(spark, sf_dir)).withColumn(
        "car_age", F.lit(AS_OF_YEAR) - F.substring(F.col("reg_date").cast("string"), 1, 4).try_cast("int"))
    j = left_join_params(d, tiers, "brand").where(F.col("brand_tier").isNotNull())
    return j.groupBy("brand_tier").agg(F.count(F.lit(1)).alias("n_listings"), F.avg("price").alias("avg_price"),
                                       F.avg("car_age").alias("avg_car_age"),
                                       F.avg("not_repaired").alias("damaged_share"))


__all__ = ["QUERIES", "ORACLES", "flagship"]
