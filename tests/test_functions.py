"""Row-level functions on hand-made tables (edges, months, sentinels)."""

import datetime as dt

from pyspark.sql import functions as F

from pricecraft.functions import binning as B
from pricecraft.functions import dates as D
from pricecraft.functions import scalars as S


def test_cut_edges_right_closed(spark):
    df = spark.createDataFrame([(x,) for x in [-1.0, 0.0, 3.0, 3.0001, 5.0, 10.0, 100.0, 100.5, None]], "x double")
    got = [r[0] for r in df.select(B.cut_age("x")).collect()]
    assert got == [None, "0-3年", "0-3年", "3-5年", "3-5年", "5-10年", "10+年", None, None]


def test_cut_without_include_lowest(spark):
    df = spark.createDataFrame([(x,) for x in [-0.01, -0.005, 1.0, 1.5, 100.0]], "x double")
    got = [r[0] for r in df.select(B.cut_age_years("x")).collect()]
    assert got == [None, "0-1年", "0-1年", "1-3年", "10年以上"]


def test_cut_codes_and_km_int(spark):
    df = spark.createDataFrame([(x,) for x in [0.0, 5.0, 7.5, 15.0, 16.0]], "x double")
    assert [r[0] for r in df.select(B.cut_km_int("x")).collect()] == [0, 0, 1, 2, None]


def test_int_date_parts_and_quarter(spark):
    df = spark.createDataFrame([(20010015,), (20011231,), (2001015,), (None,)], "d int")
    rows = df.select(D.int_date_pad("d").alias("s"), D.int_date_year("d").alias("y"),
                     D.int_date_month("d").alias("m")).collect()
    assert rows[0]["s"] == "20010015" and rows[0]["m"] == 0
    assert rows[1]["m"] == 12
    assert rows[2]["s"] == "02001015" and rows[2]["y"] == 200
    assert rows[3]["s"] is None
    q = df.select(D.calendar_quarter(D.int_date_month("d")).alias("q")).collect()
    assert [r["q"] for r in q] == [0, 4, 4, None]
    seasons = spark.createDataFrame([(q,) for q in [0, 1, 2, 3, 4, 5]], "q int").select(D.quarter_season("q")).collect()
    assert [r[0] for r in seasons] == [None, "winter", "spring", "summer", "autumn", None]


def test_parse_date_lenient(spark):
    df = spark.createDataFrame([(20010230,), (20010015,), (2001015,), (20040229,)], "d int")
    got = [r[0] for r in df.select(D.parse_date_lenient("d")).collect()]
    assert got == [dt.date(2016, 1, 1), dt.date(2016, 1, 1), dt.date(2016, 1, 1), dt.date(2004, 2, 29)]


def test_meteorological_season(spark):
    df = spark.createDataFrame([(m,) for m in range(1, 13)], "m int")
    got = [r[0] for r in df.select(D.meteorological_season("m")).collect()]
    assert got == [1, 1, 2, 2, 2, 3, 3, 3, 4, 4, 4, 1]


def test_sentinels(spark):
    df = spark.createDataFrame([("-",), ("",), ("0.0",), ("text",), (None,), ("1.0",)], "s string")
    got = [r[0] for r in df.select(S.sentinel_to_numeric("s")).collect()]
    assert got == [None, None, 0.0, None, None, 1.0]
    got = [r[0] for r in df.select(S.sentinel_to_default("s")).collect()]
    assert got == [-1.0, -1.0, 0.0, -1.0, -1.0, 1.0]


def test_flags_treat_null_as_false(spark):
    df = spark.createDataFrame([(None,), (3.0,), (1.0,)], "x double")
    got = [r[0] for r in df.select(S.flag(F.col("x") > 2.5)).collect()]
    assert got == [0, 1, 0]


def test_clip_nonneg_truncates(spark):
    df = spark.createDataFrame([(-3.7,), (2.9,), (1e6 + 0.99,)], "p double")
    assert [r[0] for r in df.select(S.clip_nonneg_int("p")).collect()] == [0, 2, 1000000]


def test_concat_key_prints_nan(spark):
    df = spark.createDataFrame([("a", None), ("b", "x")], "a string, b string")
    assert [r[0] for r in df.select(S.concat_key("a", "b")).collect()] == ["a_nan", "b_x"]


def test_safe_division(spark):
    df = spark.createDataFrame([(5.0, -1.0)], "km double, age double")
    assert df.select(S.km_per_year("km", "age")).collect()[0][0] is None
