"""Registered queries: sources and sinks.  Each writes data that
Spark derives from the given tables into the shared checkpoint folder and
reads it back, so the oracle checks the round trip."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluate as EVO
from ..session import shared_path
from ..sources import io as IO
from . import evalsets as EV
from . import features as FE
from .q_eval import IMP_CTE
from .q_scalars import TF_CTES
from .registry import AS_OF_YEAR, VALID_PCT, L, register


def _path(spark, name: str) -> str:
    return shared_path(spark, "io", name)


RD_COLS = ["sale_key", "reg_date", "brand", "model", "body_type", "power", "kilometer", "not_repaired", "price"]


@register("read_delimited", "SELECT " + ", ".join(RD_COLS) + " FROM listings")
def q_read_delimited(spark, sf):
    """Space-separated text with a header, read back with a declared schema."""
    d = L(spark, sf).select(*RD_COLS)
    p = _path(spark, "delimited")
    d.write.option("sep", " ").option("header", True).csv(p)
    return IO.read_delimited(spark, p, d.schema, sep=" ")


@register("read_training_log", """
SELECT iteration AS iter, rmse AS "RMSE" FROM hist WHERE set = 'valid'""", ctes=EV.HISTORY_SQL,
          rounds={"RMSE": 6})
def q_read_training_log(spark, sf):
    """Per-iteration metric log (tab separated, header iter/RMSE) written and parsed."""
    h = EV.history(spark, sf).where(F.col("set") == "valid").select(
        F.col("iteration").alias("iter"), F.col("rmse").alias("RMSE"))
    p = _path(spark, "learn_error")
    h.coalesce(1).write.option("sep", "\t").option("header", True).csv(p)
    return IO.read_training_log(spark, p, "error")


@register("write_submission", """
SELECT sale_key, CAST(trunc(greatest(p_brand, 0.0)) AS BIGINT) AS price FROM scored""", ctes=EV.SCORED_SQL)
def q_write_submission(spark, sf):
    s = EVO.clip_predictions(EV.scored(spark, sf), "p_brand", "price")
    p = _path(spark, "submission")
    IO.write_submission(s, p, key="sale_key", price="price")
    return spark.read.schema("sale_key string, price long").option("header", True).csv(p)


@register("write_importance", "SELECT feature, importance FROM imp", ctes=IMP_CTE, rounds={"importance": 9})
def q_write_importance(spark, sf):
    imp = EV.importance(spark, sf)
    p = _path(spark, "importance")
    IO.write_importance(imp, p)
    return spark.read.schema("feature string, importance double").option("header", True).csv(p)


FT_COLS = ["sale_key", "split", "reg_year", "reg_month", "create_year", "create_month", "time_diff", "car_age", "reg_quarter"]


@register("write_feature_table", f"""
SELECT sale_key, CASE WHEN source = 'test' THEN 'test'
                      WHEN ('0x' || substr(md5(sale_key), 1, 8))::BIGINT % 100 < {VALID_PCT} THEN 'valid' ELSE 'train' END AS split,
       reg_year, reg_month, create_year, create_month, time_diff, car_age, reg_quarter
FROM tf""", ctes=TF_CTES)
def q_write_feature_table(spark, sf):
    """Time features written as Parquet in train, valid and test sets, read back."""
    d = EVO.holdout_split(FE.time_features(L(spark, sf), AS_OF_YEAR), "sale_key", VALID_PCT)
    d = d.withColumn("split", F.when(F.col("source") == "test", "test").otherwise(F.col("split"))).select(*FT_COLS)
    p = _path(spark, "features")
    IO.write_feature_table(d, p, partition_by="split")
    return spark.read.parquet(p).select(*FT_COLS)


# ---------------------------------------------------------------- streaming

STREAM_COLS = ["sale_key", "car_age", "reg_season", "brand_avg_price", "km_per_year", "km_per_year_high",
               "power_is_zero", "long_listing_delay"]


@register("stream_features", """
SELECT t.sale_key, t.car_age,
  CASE t.reg_quarter WHEN 1 THEN 'winter' WHEN 2 THEN 'spring' WHEN 3 THEN 'summer' WHEN 4 THEN 'autumn' END AS reg_season,
  b.brand_avg_price, t.kilometer / (t.car_age + 1) AS km_per_year,
  CAST(coalesce(t.kilometer / (t.car_age + 1) > 2.5, false) AS INTEGER) AS km_per_year_high,
  CAST(coalesce(t.power = 0, false) AS INTEGER) AS power_is_zero,
  CAST(coalesce(t.time_diff > 365, false) AS INTEGER) AS long_listing_delay
FROM tf t LEFT JOIN (SELECT brand, avg(price) AS brand_avg_price FROM train WHERE brand IS NOT NULL GROUP BY brand) b
ON t.brand = b.brand WHERE t.source = 'test'""", ctes=TF_CTES,
          rounds={"brand_avg_price": 6, "km_per_year": 9})
def q_stream_features(spark, sf):
    """Test listings arrive as files; a Structured Streaming query applies the
    feature expressions and joins brand statistics fitted on train."""
    from ..operators import groupstats as G
    from ..streaming.features import run_available_now, stage_files, stream_features
    from .registry import TEST, TRAIN
    src = stage_files(TEST(spark, sf), "test-listings")
    schema = spark.read.parquet(src).schema
    stats = G.group_stats(TRAIN(spark, sf), "brand", "price", "brand", ("mean",))
    out = run_available_now(spark, src, schema, lambda s: stream_features(s, stats, AS_OF_YEAR), "features")
    return out.select(*STREAM_COLS)
