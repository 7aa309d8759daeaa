"""Feature pipelines: the composite blocks of the original scripts.

Each block takes the fitting table ``train`` (labelled rows) and the table to
transform ``df``; statistics are fitted on ``train`` only and joined onto
``df``.  Row-level features are one ``withColumns`` projection each, so the
whole block compiles into a few whole-stage-codegen spans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import binning as B
from ..functions import dates as D
from ..functions import scalars as S
from ..operators import encode as E
from ..operators import groupstats as G
from ..operators.joins import left_join_params
from ..operators.outliers import outlier_flag_and_clip, qcut_tier

TARGET = "price"
KEY = "sale_key"
CATEGORICAL = ["brand", "model", "body_type", "fuel_type", "gearbox"]
V_COLS = [f"v_{i}" for i in range(15)]
TARGET_ENCODED = ["body_type", "fuel_type", "gearbox", "region_code"]


def clean(df: DataFrame) -> DataFrame:
    """'-' sentinel -> NULL, damage flag as a number."""
    return df.withColumn("not_repaired", S.sentinel_to_numeric("not_repaired"))


def time_features(df: DataFrame, as_of_year: int) -> DataFrame:
    """Year/month from padded YYYYMMDD, age, quarter, season, delay, bins."""
    df = df.withColumns({
        "reg_date_str": D.int_date_pad("reg_date"),
        "reg_year": D.int_date_year("reg_date"),
        "reg_month": D.int_date_month("reg_date"),
        "create_year": D.int_date_year("creat_date"),
        "create_month": D.int_date_month("creat_date"),
        "time_diff": D.int_date_diff("creat_date", "reg_date"),
    })
    df = df.withColumns({
        "car_age": D.car_age("reg_year", as_of_year),
        "reg_quarter": D.calendar_quarter("reg_month"),
    })
    return df.withColumns({
        "reg_season": D.quarter_season("reg_quarter"),
        "car_age_segment": B.cut_age("car_age"),
        "reg_year_period": B.cut_reg_year("reg_year"),
    })


def fit_brand_stats(train: DataFrame) -> DataFrame:
    """Per brand: mean, std, count of price and the quartile tier of the mean."""
    st = G.group_stats(train, "brand", TARGET, "brand")
    return qcut_tier(st, "brand_avg_price", "brand_tier")


def condition_features(df: DataFrame) -> DataFrame:
    df = df.withColumn("km_per_year", S.km_per_year("kilometer", "car_age"))
    return df.withColumns({
        "km_segment": B.cut_km("kilometer"),
        "power_segment": B.cut_power("power"),
        "power_km_ratio": S.ratio_plus("power", "kilometer"),
        "power_to_brand_price": S.ratio_plus("power", "brand_avg_price"),
    })


def flag_features(df: DataFrame) -> DataFrame:
    age, km, power = F.col("car_age"), F.col("kilometer"), F.col("power")
    return df.withColumns({
        "not_repaired_is_missing": S.flag_missing("not_repaired"),
        "km_per_year_high": S.flag(F.col("km_per_year") > 2.5),
        "new_car_high_km": S.flag((age <= 2) & (km > 10)),
        "power_is_zero": S.flag(power == 0),
        "long_listing_delay": S.flag(F.col("time_diff") > 365),
    })


def interaction_features(df: DataFrame) -> DataFrame:
    age, km, power = F.col("car_age"), F.col("kilometer"), F.col("power")
    return df.withColumns({
        "power_age": S.product(power, age),
        "km_age": S.product(km, age),
        "high_power_young": S.flag((power > 200) & (age <= 3)),
        "low_km_young": S.flag((km <= 5) & (age <= 2)),
        "log_power": S.log1p(power),
        "log_km": S.log1p(km),
        "log_brand_avg_price": S.log1p("brand_avg_price"),
    })


def advanced_features(train: DataFrame, df: DataFrame, as_of_year: int) -> DataFrame:
    """Time, brand, condition, flag, interaction and encoding features.

    The fitted lookups (brand statistics, target means) only need raw key
    columns, so they are joined first while the rows are still narrow; all
    derived columns are computed after the joins, in one codegen stage whose
    joins carry 30 columns instead of 70.
    """
    train_c = clean(train)
    brand = fit_brand_stats(train_c).select("brand", "brand_avg_price", "brand_price_std",
                                            "brand_count", "brand_tier")
    out = left_join_params(clean(df), brand, "brand")
    out = E.target_encode(train_c, out, TARGET_ENCODED, TARGET)
    out = time_features(out, as_of_year)
    out = interaction_features(flag_features(condition_features(out)))
    return E.ordinal_encode_segments(out)


def region_features(train: DataFrame, df: DataFrame) -> DataFrame:
    """Region statistics and the brand x region mean (NULL -> brand mean)."""
    region = G.group_stats_region(train, "region_code", TARGET, "region")
    brand = G.group_stats(train, "brand", TARGET, "brand", ("mean",))
    br = G.group_mean(train, ["brand", "region_code"], TARGET, "brand_region_avg_price")
    out = left_join_params(df, region, "region_code")
    out = left_join_params(out, brand, "brand")
    out = left_join_params(out, br, ["brand", "region_code"])
    return E.impute_from_column(out, "brand_region_avg_price", "brand_avg_price")


def flagship_features(train: DataFrame, df: DataFrame, as_of_year: int, keep=()) -> DataFrame:
    """Basic model inputs: cleaned damage flag, car age, category codes,
    NULL -> training median, anything left -> 0 (``keep``: extra columns to carry)."""
    def basic(t):
        t = clean(t).withColumn("car_age", D.car_age(
            F.substring(F.col("reg_date").cast("string"), 1, 4).try_cast("int"), as_of_year))
        return t
    tr, out = basic(train), basic(df)
    out = E.apply_category_codes_many(out, E.fit_category_codes_many(tr, CATEGORICAL), CATEGORICAL)
    feats = ["power", "kilometer", "not_repaired", "region_code", "offer_type", "car_age"] + V_COLS
    out = E.impute_median(tr, out, feats)
    out = E.impute_zero(out, feats)
    return out.select(KEY, TARGET, *keep, *feats, *[f"{c}_code" for c in CATEGORICAL])


def car_features(data: DataFrame, as_of_year: int) -> DataFrame:
    """Function-structured variant: real dates, day ages, missing flags,
    median fill over all rows, brand_model key, fences."""
    num = ["power", "kilometer"] + V_COLS
    d = clean(data).withColumns({
        "reg_dt": D.parse_date_lenient("reg_date"),
        "creat_dt": D.parse_date_lenient("creat_date"),
    })
    d = d.withColumn("vehicle_age_days", D.age_days("creat_dt", "reg_dt"))
    d = d.withColumn("vehicle_age_years", D.age_years("vehicle_age_days"))
    d = d.select("*", *D.date_parts("reg_dt", "reg"), *D.date_parts("creat_dt", "creat"))
    d = d.withColumns({
        "is_new_car": S.flag(F.col("vehicle_age_years") < 1),
        "reg_season": D.meteorological_season("reg_month"),
        "creat_season": D.meteorological_season("creat_month"),
        "km_per_year": S.km_per_year_frac("kilometer", "vehicle_age_years"),
        "age_segment": B.cut_age_years("vehicle_age_years"),
    })
    d = d.withColumns({f"{c}_missing": S.flag_missing(c) for c in num})
    d = E.apply_fill_row(d, E.fit_medians(data, num), num, fetch=True)
    d = d.withColumns({
        "brand_model": S.concat_key("brand", "model"),
        "car_age_from_now": D.car_age("reg_year", as_of_year),
    })
    return outlier_flag_and_clip(d, ["power", "kilometer", "v_0"], fetch=True)


def function_pipeline(data: DataFrame, as_of_year: int) -> DataFrame:
    """The function-structured pipeline from end to end over labelled and
    unlabelled rows (``source`` tells them apart): time and car features, the
    model code, brand statistics of the labelled rows with the ratio to their
    mean over all rows, and frequency encodings."""
    d = car_features(data, as_of_year)
    d = E.apply_category_codes(d, E.fit_category_codes(data, "model"), "model", "model_num")
    train = data.where(F.col("source") == "train")
    d = left_join_params(d, G.group_stats(train, "brand", TARGET, "brand", ("mean", "median", "std", "count")), "brand")
    mean = d.agg(F.avg("brand_avg_price")).first()[0]
    d = d.withColumn("brand_price_ratio", F.col("brand_avg_price") / F.lit(mean).cast("double"))
    return E.freq_encode(d, ["model", "brand", "body_type", "fuel_type", "gearbox", "not_repaired"])


# ------------------------------------------------------------ documented-only features


def brand_model_stats(train: DataFrame) -> DataFrame:
    return G.group_stats(train.where(F.col("model").isNotNull()), ["brand", "model"], TARGET,
                         "brand_model", ("mean", "count"))


def region_brand_stats(train: DataFrame) -> DataFrame:
    return G.group_mean(train, ["region_code", "brand"], TARGET, "region_brand_avg_price")


def power_per_age(df: DataFrame) -> DataFrame:
    return df.withColumn("power_per_age", S.ratio_plus("power", "car_age"))


# Km-per-year segment edges (ours; the source names the feature only).
KM_PER_YEAR_EDGES = [0, 1, 2, 3, 1000]


def km_per_year_segment(df: DataFrame, edges=KM_PER_YEAR_EDGES) -> DataFrame:
    return df.withColumn("km_per_year_segment", B.cut("km_per_year", edges, None))


def price_per_km(df: DataFrame) -> DataFrame:
    return df.withColumn("price_per_km", S.ratio_plus(TARGET, "kilometer"))


def age_region_anomaly(df: DataFrame, min_rows: int = 5) -> DataFrame:
    """Flag (age segment, region) combinations with fewer than ``min_rows`` rows.

    Counts come from a grouped aggregate joined back (a window partitioned by
    the combination would put a hot combination in one task).
    """
    keys = ["car_age_segment", "region_code"]
    counts = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
                .where(F.col("car_age_segment").isNotNull() & F.col("region_code").isNotNull()))
    j = left_join_params(df, counts, keys)
    return j.withColumn("age_region_anomaly", S.flag(F.col("_n") < min_rows)).drop("_n")


def age_model_anomaly(train: DataFrame, df: DataFrame, k: float = 3.0) -> DataFrame:
    """Price more than ``k`` sample std from its (age segment, model) mean."""
    keys = ["car_age_segment", "model"]
    st = G.group_stats(train, keys, TARGET, "_am", ("mean", "std"))
    j = left_join_params(df, st, keys)
    dev = F.abs(F.col(TARGET) - F.col("_am_avg_price"))
    return j.withColumn("age_model_anomaly", S.flag(dev > k * F.col("_am_price_std"))).drop(
        "_am_avg_price", "_am_price_std")
