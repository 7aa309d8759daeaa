"""NULLs through the scalar functions, metrics and fills; delimited files by header."""

import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricecraft.functions import dates as D
from pricecraft.functions import scalars as S
from pricecraft.operators import encode as E
from pricecraft.operators import evaluate as EV
from pricecraft.operators import profile as P
from pricecraft.operators.outliers import outlier_flag_and_clip
from pricecraft.sources import io as IO


def one(spark, value, kind, expr):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expr.alias("y")).first().y


def test_null_stays_null(spark):
    assert one(spark, None, "double", S.clip("x", 0.0, 5.0)) is None
    assert one(spark, 7.0, "double", S.clip("x", 0.0, 5.0)) == 5.0
    assert one(spark, None, "double", S.clip_nonneg_int("x")) is None
    assert one(spark, -3.0, "double", S.clip_nonneg_int("x")) == 0
    assert one(spark, None, "int", D.calendar_quarter_clipped("x")) is None
    assert one(spark, 0, "int", D.calendar_quarter_clipped("x")) == 1
    assert one(spark, None, "date", D.age_days(F.current_date(), "x")) is None


def test_winsorize_keeps_gaps(spark):
    df = spark.createDataFrame([(float(i),) for i in range(100)] + [(None,)], "v double")
    got = outlier_flag_and_clip(df, ["v"]).where("v IS NULL").collect()
    assert len(got) == 1 and got[0].v_outlier == 0


def test_median_of_integers_is_not_truncated(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    assert sorted(r.k for r in E.impute_median(df, df, ["k"]).collect()) == [1.0, 1.5, 2.0]


def test_metrics_use_complete_pairs(spark):
    df = spark.createDataFrame([(1.0, 1.0), (3.0, 2.0), (5.0, None), (None, 4.0)], "y double, p double")
    r = EV.regression_metrics(df, "y", "p").first()
    assert (r.n, r.mae, r.mse) == (2, 0.5, 0.5) and math.isclose(r.r2, 0.5)


def test_reader_goes_by_header_and_drops_nan(spark, tmp_path):
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.DoubleType()), T.StructField("c", T.StringType())])
    (tmp_path / "f.csv").write_text("c b extra a\nx 1.5 q 7\ny NaN q 8\nz word q 9\n")
    rows = IO.read_delimited(spark, str(tmp_path / "f.csv"), schema).orderBy("a").collect()
    assert [tuple(r) for r in rows] == [(7, 1.5, "x"), (8, None, "y"), (9, None, "z")]
    with pytest.raises(ValueError):
        IO.read_delimited(spark, str(tmp_path / "f.csv"), T.StructType([T.StructField("missing", T.StringType())]))


def test_correlations_with_gaps_and_constants(spark):
    rows = [(float(i), float(i * i), 1.0, None if i % 3 else float(-i)) for i in range(30)] + [(None, 2.0, 1.0, 5.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(4)
    got = {(r.col_a, r.col_b): r.corr for r in P.correlation_matrix(df, ["a", "b", "c", "d"]).collect()}
    pdf = df.toPandas()
    want = pdf.corr()
    assert len(got) == 16 and got["a", "c"] is None and got["c", "c"] is None
    for x in "abd":
        for y in "abd":
            assert math.isclose(got[x, y], want.loc[x, y], abs_tol=1e-12)


def test_histograms_keep_empty_bins(spark):
    df = spark.createDataFrame([(0.0, 1.0), (10.0, 1.0), (None, 1.0)], "a double, b double")
    got = {(r.column, r.bin): r for r in P.histogram_many(df, ["a", "b"], 5).collect()}
    assert len(got) == 10 and [got["a", i]["count"] for i in range(5)] == [1, 0, 0, 0, 1]
    assert (got["a", 1].lo, got["a", 1].hi) == (2.0, 4.0)


def test_a_listings_file_is_read_by_many_tasks(spark, tmp_path, monkeypatch):
    """One task's file has many row groups; before, a row group took in up to 128 MB."""
    import glob

    import pyarrow.parquet as pq

    from pricecraft.sources import listings as S
    monkeypatch.setattr(S, "ROW_GROUP_BYTES", 64 << 10)
    df = spark.range(100_000).selectExpr("id", "rand(1) AS v", "'train' AS source").coalesce(1)
    S._write_by_source(df, f"{tmp_path}/l")
    files = glob.glob(f"{tmp_path}/l/source=train/*.parquet")
    assert sum(pq.read_metadata(f).num_row_groups for f in files) > 4 and spark.read.parquet(f"{tmp_path}/l").count() == 100_000
