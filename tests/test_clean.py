import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from prepfold.operators import clean
from prepfold.plans import quantiles


def test_sigma_filter_strict_bounds_and_nulls(spark):
    vals = [10.0] * 20 + [1000.0, None]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    kept = [r.x for r in clean.sigma_filter(df, "x").collect()]
    a = np.array([v for v in vals if v is not None])
    lo, hi = a.mean() - 3 * a.std(ddof=1), a.mean() + 3 * a.std(ddof=1)
    assert sorted(kept) == sorted(v for v in vals if v is not None and lo < v < hi)


def test_sigma_filter_constant_column(spark):
    df = spark.createDataFrame([(1.0,), (1.0,), (1.0,)], "x double")
    assert clean.sigma_filter(df, "x").count() == 0
    assert clean.sigma_filter(df, "x", keep_if_constant=True).count() == 3


def test_impute_mean_keeps_fraction(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (5,), (None,)], "pdom int")
    vals = sorted(r.pdom for r in clean.impute_mean(df, ["pdom"]).collect())
    assert vals == [1.0, 2.0, 2.75, 3.0, 5.0]


def test_impute_median_odd_even_and_nan(spark):
    df = spark.createDataFrame([(1.0, 1.0), (4.0, None), (2.0, 3.0), (None, float("nan")), (9.0, 8.0)],
                               "a double, b double")
    out = clean.impute_median(df, ["a", "b"]).collect()
    assert sorted(r.a for r in out) == [1.0, 2.0, 3.0, 4.0, 9.0]  # median of 1,2,4,9 = 3
    assert sorted(r.b for r in out) == [1.0, 3.0, 3.0, 3.0, 8.0]  # median of 1,3,8 = 3


@pytest.mark.parametrize("seed", [1, 2])
def test_exact_quantile_matches_numpy_with_hot_group(spark, seed):
    rnd = random.Random(seed)
    rows = [("hot", float(rnd.randint(0, 500))) for _ in range(3000)]
    rows += [(f"g{i % 7}", rnd.random() * 100) for i in range(1500)]
    rows += [("hot", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    for q in (0.0, 0.25, 0.5, 0.9, 1.0):
        got = {r.g: r.quantile for r in
               quantiles.exact_quantile(df, "v", q, ["g"]).collect()}
        for g in set(r[0] for r in rows):
            a = np.array([v for k, v in rows if k == g and v is not None])
            assert got[g] == pytest.approx(np.quantile(a, q), rel=1e-12, abs=1e-12)


def test_exact_quantile_global(spark):
    df = spark.createDataFrame([(float(x),) for x in [5, 1, 3, 3, 8, 2]], "v double")
    assert quantiles.exact_quantile(df, "v", 0.5).first().quantile == 3.0
    assert quantiles.exact_quantile(df, "v", 0.75).first().quantile == pytest.approx(4.5)


def test_drop_sparse_columns(spark):
    df = spark.createDataFrame([(1, None, 1.0), (2, None, float("nan")), (3, 1, float("nan"))],
                               "a int, b int, c double")
    assert clean.drop_sparse_columns(df, 0.6).columns == ["a", "c"]
    assert clean.drop_sparse_columns(df, 0.6, count_nan=True).columns == ["a"]
    empty = spark.createDataFrame([], "a int, b int")
    assert clean.drop_sparse_columns(empty, 0.1).columns == ["a", "b"]


def test_drop_low_observation_columns(spark):
    rows = [(1, 1 if i < 31 else 0, 0) for i in range(40)]
    rows[0] = (1, 1, None)
    df = spark.createDataFrame(rows, "many int, thirty_one int, none int")
    df = df.withColumn("thirty", F.when(F.monotonically_increasing_id() >= 0, F.lit(0)))
    df30 = spark.createDataFrame([(1,)] * 30 + [(0,)] * 5, "x int")
    assert clean.drop_low_observation_columns(df30, ["x"], 30).columns == []
    out = clean.drop_low_observation_columns(df, ["many", "thirty_one", "none"], 30)
    assert out.columns == ["many", "thirty_one", "thirty"]
    empty = spark.createDataFrame([], "x int")
    assert clean.low_observation_report(empty, ["x"]).first().obs_count == 0


def test_zero_fill_only_subset_and_exclusion(spark):
    df = spark.createDataFrame([(None, None, "Yes w/ Qualifying"), (1, 2, None), (3, 4, "No")],
                               "a int, b int, m string")
    filled = clean.zero_fill(df, ["a"]).collect()
    assert sorted((r.a, r.b) for r in filled)[0] == (0, None)
    kept = clean.exclude_values(df, "m", ["Yes w/ Qualifying", "Yes w/No Qualifying"]).collect()
    assert sorted(r.a for r in kept) == [1, 3]


def test_null_out_above(spark):
    df = spark.createDataFrame([(1.0,), (1000.0,)], "x double")
    assert sorted(r.x for r in clean.null_out_above(df, "x", 100).collect() if r.x is not None) == [1.0]


def test_all_null_column_keeps_its_row(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, None)], "a double, b double")
    assert {r.column_name: r.median for r in clean.column_medians(df, ["a", "b"]).collect()} == {"a": 2.0, "b": None}


@pytest.mark.parametrize("groups,rows", [(1, 20000), (4000, 5), (3, 900)])
def test_exact_quantile_equals_the_built_in(spark, groups, rows):
    rnd = random.Random(groups)
    data = [(None if g == 1 else f"g{g}", None if rnd.random() < 0.1 else float(rnd.randint(0, 300)))
            for g in range(groups) for _ in range(rows)]
    data += [("nulls", None), ("one", -1.5), (None, 5.0), (None, 7.0)]
    df = spark.createDataFrame(data, "g string, v double").repartition(6)
    got = {r.g: r.quantile for r in quantiles.exact_quantile(df, "v", 0.5, ["g"]).collect()}
    assert got == {r.g: r.m for r in df.groupBy("g").agg(F.median("v").alias("m")).collect()}


def test_exact_quantile_default_ranges_many_values(spark):
    rnd = random.Random(5)
    rows = [("a" if i % 3 else "b", rnd.random() * 1e6) for i in range(30000)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r.quantile for r in quantiles.exact_quantile(df, "v", 0.37, ["g"]).collect()}
    for g in "ab":
        a = np.array([v for k, v in rows if k == g])
        assert got[g] == pytest.approx(np.quantile(a, 0.37), rel=1e-12)
