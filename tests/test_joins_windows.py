import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from prepfold.operators import joins, windows
from prepfold.plans.quantiles import lag_rows


def test_precision_join_rounds_both_sides(spark):
    df = spark.createDataFrame([(1, 44.9812345, -93.2712344), (2, 44.0, -93.0)], "id int, lat double, lon double")
    walk = spark.createDataFrame([("44.98123", "-93.27123", 80), ("x", "-93.0", 5)],
                                 "lat string, lon string, walkscore int")
    out = {r.id: r.walkscore for r in joins.precision_join(df, walk, ["lat", "lon"], digits=5).collect()}
    assert out == {1: 80, 2: None}


def test_precision_join_keys_are_rounded_like_round(spark):
    values = [-93.5, 93.5, -0.5, 1.005, 2.675, 1e15, 2e15, None]
    df = spark.createDataFrame([(i, v, i) for i, v in enumerate(values)], "id int, v double, k int")
    for digits in (0, 2, 5):
        lookup = df.select(F.col("v").cast("string").alias("v"), F.col("k").cast("string").alias("k"), F.lit(1).alias("s"))
        lookup = lookup.unionByName(spark.createDataFrame([("7", "no number", 2)], "v string, k string, s int"))
        out = joins.precision_join(df, lookup, ["v"], ["k"], digits).collect()
        wanted = {r.id: r.w for r in df.select("id", F.round("v", digits).alias("w")).collect()}
        assert {r.id: r.v for r in out} == wanted
        assert {r.id: r.s for r in out} == {i: (None if v is None else 1) for i, v in enumerate(values)}
    big = spark.createDataFrame([("1e15", 10), ("2e15", 20)], "v string, s int")
    got = joins.precision_join(df.where("v > 1e14").select("id", "v"), big, ["v"], digits=5).collect()
    assert {(r.v, r.s) for r in got} == {(1e15, 10), (2e15, 20)}


def test_left_join_never_loses_rows_and_fanout_audit(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    right = spark.createDataFrame([(1, "x", 10), (1, "y", 11), (2, "x", 12)], "k int, k2 string, s int")
    left2 = left.withColumn("k2", F.lit("x"))
    rep = {r.variant: (r.n_left, r.n_rows, r.n_dup_right_keys) for r in
           joins.fanout_audit(left2, right, {"good": ["k", "k2"], "few": ["k"]}).collect()}
    assert rep == {"good": (3, 3, 0), "few": (3, 4, 1)}
    um = {r.variant: r.n_unmatched for r in joins.unmatched_audit(
        left2, right, {"good": ["k", "k2"]}).collect()}
    assert um == {"good": 1}


def test_join_audit_counts_equal_materialised_join(spark):
    left = spark.createDataFrame([(1,), (1,), (2,), (None,), (5,)], "k int")
    right = spark.createDataFrame([(1, "a"), (1, "b"), (1, "c"), (2, "d"), (None, "e")], "k int, s string")
    r = joins.left_join_counts(left, right, ["k"]).first()
    joined = left.join(right, ["k"], "left")
    assert r.n_left == 5 and r.n_rows == joined.count() == 9
    assert r.n_unmatched == joined.where("s IS NULL").count() == 2
    assert r.n_dup_right_keys == 1
    plan = joins.left_join_counts(left, right, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftOuter" in plan and plan.count("Aggregate") >= 3


def test_sql_left_join_names_each_key_once(spark):
    left = spark.createDataFrame([(1, 2.0)], "k int, v double")
    right = spark.createDataFrame([(1, 9)], "k int, w int")
    views_before = {t.name for t in spark.catalog.listTables()}
    out = joins.sql_left_join(left, right, ["k"])
    assert {t.name for t in spark.catalog.listTables()} == views_before
    assert out.columns == ["k", "v", "w"] and out.first().w == 9


def test_prior_period_join(spark):
    df = spark.createDataFrame([("A", dt.date(2017, 3, 1)), ("B", dt.date(2016, 1, 1))], "city string, d date")
    prices = spark.createDataFrame([("A", 2016, 100.0), ("A", 2017, 200.0)], "city string, year int, median double")
    out = {r.city: r.median for r in
           joins.prior_period_join(df, prices, "city", "d", "city", "year").collect()}
    assert out == {"A": 100.0, "B": None}


@pytest.mark.parametrize("offset", [1, 2, 7])
@pytest.mark.parametrize("parts", [["p"], []])
def test_lag_equals_window_lag(spark, offset, parts):
    rnd = random.Random(offset)
    rows = [(None if g == 0 else f"g{g}", None if rnd.random() < 0.05 else rnd.randint(0, 150), rnd.choice([None, *range(9)]))
            for g in range(40) for _ in range(rnd.choice([1, 3, 60]))]
    rows += [("hot", rnd.randint(0, 5000), rnd.randint(0, 9)) for _ in range(4000)]
    df = spark.createDataFrame(rows, "p string, d int, v int").repartition(5)
    w = (Window.partitionBy(*parts) if parts else Window.partitionBy(F.lit(1))).orderBy("d", "v")
    wanted = df.withColumn("out", F.lag("v", offset).over(w))
    got = lag_rows(df, "v", "d", "out", parts, offset)
    assert got.columns == ["p", "d", "v", "out"]
    key = lambda r: tuple((x is not None, x) for x in r)
    if parts:
        assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, wanted.collect()), key=key)
    else:  # p is no part of the order, so rows that tie may swap it
        assert sorted((tuple(r)[1:] for r in got.collect()), key=key) == sorted((tuple(r)[1:] for r in wanted.collect()), key=key)


def test_gap_audit_keeps_null_partitions(spark):
    day = dt.date(2021, 1, 1)
    rows = [(p, day + dt.timedelta(days=7 * k)) for p in ("a", None) for k in range(4)] + [("b", None)]
    got = windows.report_gap_audit(spark.createDataFrame(rows, "p string, d date"), "d", ["p"]).collect()
    assert {(r.p, r.days_between_report, r.n_reports) for r in got} == {
        ("a", None, 1), ("a", 7, 3), (None, None, 1), (None, 7, 3)}


def test_lag_feature_and_weekly_gaps(spark):
    weeks = [(dt.date(2020, 1, 3) + dt.timedelta(weeks=i),) for i in range(30)]
    df = spark.createDataFrame(weeks, "DATE date")
    lagged = windows.lag_feature(df, "DATE", "DATE_1").orderBy("DATE").collect()
    assert lagged[0].DATE_1 is None and lagged[1].DATE_1 == weeks[0][0]
    gaps = {r.days_between_report: r.n_reports for r in windows.report_gap_audit(df, "DATE").collect()}
    assert gaps == {None: 1, 7: 29}


def test_lag_plan_deals_rows_by_range(spark):
    df = spark.range(1000).select(F.date_add(F.lit(dt.date(2000, 1, 1)), F.col("id").cast("int")).alias("d"))
    plan = windows.lag_feature(df, "d", "prev")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange SinglePartition" not in plan  # the windows over rows are cut by range
    assert "hashpartitioning(__range" in plan


def test_lag_with_hot_date_keeps_every_row(spark):
    base = dt.date(2021, 1, 1)
    rows = [(base,)] * 600 + [(base + dt.timedelta(days=i),) for i in range(1, 1201)]
    df = spark.createDataFrame(rows, "d date").repartition(6)
    out = windows.lag_feature(df, "d", "prev")
    assert out.count() == len(rows)
    hot = [r.prev for r in out.where(F.col("d") == base).collect()]
    assert hot.count(None) == 1 and hot.count(base) == 599
    assert out.where(F.col("d") == base + dt.timedelta(days=2)).first().prev == base + dt.timedelta(days=1)
