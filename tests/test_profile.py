import math

import numpy as np
from pyspark.sql import functions as F

from prepfold.operators import profile

NULL_ROWS = [(2.0, None), (None, 3.0), (5.0, 1.0), (1.0, 9.0)]


def test_pearson_skips_null_pairs_or_counts_zero(spark):
    df = spark.createDataFrame(NULL_ROWS, "x double, y double")
    r = df.agg(profile.pearson(F.col("x"), F.col("y")).alias("r"),
               profile.pearson(F.col("x"), F.col("y"), null_as_zero=True).alias("z")).first()
    assert math.isclose(r.r, -1.0, abs_tol=1e-12)
    assert math.isclose(r.z, df.fillna(0).corr("x", "y"), rel_tol=1e-12)
    assert math.isclose(r.z, -0.459336, abs_tol=1e-6)


def test_constant_column_correlation_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (1.0, 5.0)], "x double, y double")
    assert df.agg(profile.pearson(F.col("x"), F.col("y")).alias("r")).first().r is None


def test_correlation_ranking_negative_and_ties(spark):
    rows = [(float(i), float(-i), float(i), 1.0) for i in range(10)]
    df = spark.createDataFrame(rows, "t double, neg double, pos double, const double")
    rank = profile.correlation_ranking(df, "t", ["neg", "const", "pos"]).orderBy("rank").collect()
    assert [r.column_name for r in rank] == ["pos", "neg", "const"]
    by_abs = profile.correlation_ranking(df, "t", ["neg", "pos"], by_abs=True).orderBy("rank").collect()
    assert by_abs[0].column_name == "neg"  # tie on |corr|: first listed wins
    assert profile.best_correlated(df, "t", ["neg", "pos"]) == "pos"


def test_skewness_population_formula(spark):
    xs = [1.0, 2.0, 2.0, 3.0, 10.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    a = np.array(xs)
    m2, m3 = ((a - a.mean()) ** 2).mean(), ((a - a.mean()) ** 3).mean()
    got = profile.skewness(df, ["x"]).first().skewness
    assert math.isclose(got, m3 / m2 ** 1.5, rel_tol=1e-12)


def test_hash_sample_is_layout_independent(spark):
    df = spark.range(2000)
    a = {r.id for r in profile.hash_sample(df, ["id"], 0.3, 7).collect()}
    b = {r.id for r in profile.hash_sample(df.repartition(13), ["id"], 0.3, 7).collect()}
    assert a == b and 450 < len(a) < 750


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (10.0,), (None,)], "x double")
    h = {r.bin: (r.bin_low, r.bin_high, r["count"]) for r in profile.histogram(df, "x", 2).collect()}
    assert h == {0: (0.0, 5.0, 1), 1: (5.0, 10.0, 2)}


def test_histogram_constant_column(spark):
    df = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert [(r.bin, r["count"]) for r in profile.histogram(df, "x", 4).collect()] == [(0, 2)]


def test_null_profile_and_patterns(spark):
    df = spark.createDataFrame([(1.0, None), (float("nan"), None), (None, "a")], "x double, s string")
    prof = {r.column_name: r for r in profile.null_profile(df).collect()}
    assert prof["x"].null_count == 1 and prof["s"].null_count == 2 and prof["s"].most_missing
    with_nan = {r.column_name: r.null_count for r in profile.null_profile(df, count_nan=True).collect()}
    assert with_nan["x"] == 2
    pats = {(r.x_missing, r.s_missing): r.n_rows for r in profile.null_patterns(df, ["x", "s"]).collect()}
    assert pats == {(False, True): 2, (True, False): 1}


def test_linear_trend_exact_line(spark):
    df = spark.createDataFrame([(float(x), 2.0 * x + 1.0) for x in range(5)], "x double, y double")
    r = profile.linear_trend(df, "y", "x").first()
    assert (r.n, r.slope, r.intercept, r.r2) == (5, 2.0, 1.0, 1.0)
