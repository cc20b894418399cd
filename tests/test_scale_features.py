import datetime as dt
import math

from pyspark.sql import functions as F

from prepfold.operators import features, scale


def test_min_max_scale_range_and_constant(spark):
    df = spark.createDataFrame([(1, 5.0, 7), (3, 10.0, 7), (2, None, 7)], "a int, b double, c int")
    out = scale.min_max_scale(df, ["a", "b", "c"]).collect()
    assert sorted(r.scaled_a for r in out) == [0.0, 0.5, 1.0]
    assert sorted(r.scaled_b for r in out if r.scaled_b is not None) == [0.0, 1.0]
    assert all(r.scaled_c is None for r in out)
    assert set(scale.min_max_scale(df, ["a"]).columns) == {"a", "b", "c", "scaled_a"}


def test_min_max_scale_is_one_statistics_pass(spark, tmp_path):
    import re
    path = str(tmp_path / "t.parquet")
    spark.range(100).select(F.col("id").alias("a"), (F.col("id") * 2).alias("b")).write.parquet(path)
    out = scale.min_max_scale(spark.read.parquet(path), ["a", "b"])
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    final = plan.split("\n+- == Initial Plan ==")[0]
    executed = set(re.findall(r"[:+]- Subquery subquery#(\d+)", final))
    # All four statistics come from one executed subquery; the rest reuse it.
    assert len(executed) == 1 and "ReusedSubquery" in final
    assert "Join" not in final


def test_percent_scale_both_forms(spark):
    df = spark.createDataFrame([(0,), (1,), (2,), (8,)], "d int")
    assert sorted(r.p for r in scale.percent_scale(df, "d", "p").collect()) == [0.0, 13.0, 25.0, 100.0]
    assert sorted(r.p for r in scale.percent_scale_round_first(df, "d", "p").collect()) == [0.0, 0.0, 0.0, 100.0]


def test_reflect_log_and_log(spark):
    df = spark.createDataFrame([(1990,), (2000,), (2010,)], "y int")
    out = {r.y: (r.r, r.adj) for r in scale.reflect_log(df, "y", "r", "adj").collect()}
    assert out[2010] == (1, None)
    assert math.isclose(out[1990][1], 1 / math.log(21))
    lg = scale.log_transform(spark.createDataFrame([(0.0,), (-1.0,), (math.e,)], "x double"), "x", "l")
    assert sorted((r.l is None, r.l) for r in lg.collect())[0] == (False, 1.0)


def test_ratios_zero_divisor_and_compound(spark):
    df = spark.createDataFrame([(2.0, 0, 3.0)], "a double, b int, c double")
    r = features.ratios(df, {"q": ("a", "b"), "z": ("c", "a")}).first()
    assert r.q is None and r.z == 1.5
    assert features.per_unit(df, "a", "b", 1000.0, "k").first().k is None
    assert features.per_unit(df, "a", "c", 1000.0, "k").first().k == 2.0 / (3.0 / 1000.0)


def test_dates(spark):
    df = spark.createDataFrame([("2024-01-05",), ("x",), (None,)], "s string")
    got = [r.d for r in features.to_date_column(df, "s", out_col="d").collect()]
    assert got == [dt.date(2024, 1, 5), None, None]
    days = spark.createDataFrame([(dt.date(2024, 1, d),) for d in (5, 6, 7, 8)], "d date")
    assert [r.w for r in features.day_of_week_column(days, "d", "w").orderBy("d").collect()] == [6, 7, 1, 2]


def test_text_flag_first_match_wins(spark):
    df = spark.createDataFrame([("Attached Garage, Detached Garage",), ("Detached Garage",), ("None",), (None,)],
                               "g string")
    got = [r.f for r in features.text_flag(df, "g", "%Attached Garage%", "%Detached Garage%", "f").collect()]
    assert got == [1, 0, None, None]


def test_split_explode_and_multi_hot(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "a, b"), (4, "b")], "no int, g string")
    lists = features.split_list(df, "g", ", ", "lst")
    ex = features.explode_list(lists, "lst", "tok").collect()
    assert sorted((r.no, r.tok) for r in ex) == [(2, ""), (3, "a"), (3, "b"), (4, "b")]
    ex_all = features.explode_list(lists, "lst", "tok", keep_empty=True).collect()
    assert len(ex_all) == 5
    proj = features.multi_hot(lists, "lst", ["a", "b"], prefix="has_").drop("lst")
    piv = features.multi_hot(lists, "lst", ["a", "b"], prefix="has_", id_col="no",
                             strategy="pivot_join").drop("lst")
    assert sorted(proj.collect()) == sorted(piv.select(*proj.columns).collect())
    rows = {r.no: (r.has_a, r.has_b) for r in proj.collect()}
    assert rows == {1: (0, 0), 2: (0, 0), 3: (1, 1), 4: (0, 1)}
    vocab = features.discover_values(features.explode_list(lists, "lst", "tok"), "tok")
    assert vocab == ["", "a", "b"]


def test_null_share_of_all_columns_is_one_scan(spark, tmp_path):
    from prepfold.operators import clean
    path = str(tmp_path / "n.parquet")
    spark.range(50).select("id", (F.col("id") % 3).alias("a"), F.lit(None).cast("int").alias("b")) \
        .write.parquet(path)
    rep = clean.null_share_report(spark.read.parquet(path), 0.6)
    plan = rep._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1
    assert {r.column_name: r.dropped for r in rep.collect()} == {"id": False, "a": False, "b": True}
