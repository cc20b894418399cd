"""Cases that no driver table shows: tiny fractions, new words, plans and writes."""

import os

import pytest
from pyspark.sql import functions as F

from prepfold import catalog
from prepfold import queries as _queries  # noqa: F401  (fills the registry)
from prepfold.catalog import Tables
from prepfold.operators import features, model, profile
from prepfold.plans import stats
from prepfold.session import shared_path

SF = "/root/testdata/sf0.001"


def test_hash_sample_of_a_tiny_fraction(spark):
    df = spark.range(20_000_000)
    n = profile.hash_sample(df, ["id"], 1e-6, 42).count()
    assert 5 <= n <= 45
    assert profile.hash_sample(df.limit(1000), ["id"], 1.0, 1).count() == 1000
    assert profile.hash_sample(df.limit(1000), ["id"], 0.0, 1).count() == 0


def test_words_of_the_table_become_columns(spark, tmp_path):
    rows = [(1, "blue zeppelin"), (2, "zeppelin zeppelin"), (3, None), (4, "red")]
    spark.createDataFrame(rows, "p_partkey long, p_name string").write.parquet(str(tmp_path / "part.parquet"))
    flags = {(1, "blue"), (1, "zeppelin"), (2, "zeppelin"), (4, "red")}
    wanted = {(k, f"name_{w}", int((k, w) in flags)) for k, _ in rows for w in ("blue", "red", "zeppelin")}
    for name in ("multi_hot", "multi_hot_pivot_join"):  # a NULL name keeps its row
        out = [tuple(r) for r in catalog.REGISTRY[name].fn(spark, str(tmp_path)).collect()]
        assert len(out) == len(wanted) and set(out) == wanted
    long = catalog.REGISTRY["multi_hot_long"].fn(spark, str(tmp_path)).collect()
    assert sorted((r.p_partkey, r.token, r.present) for r in long) == [
        (1, "blue", 1), (1, "zeppelin", 1), (2, "zeppelin", 1), (4, "red", 1)]
    assert features.discover_values(spark.createDataFrame(rows, "k int, v string"), "v") == [
        "blue zeppelin", "red", "zeppelin zeppelin"]


def test_metrics_move_no_prediction_rows(spark):
    df = spark.range(1000).select((F.col("id") * 1.5).alias("y"), (F.col("id") * 1.4).alias("p")).repartition(4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = model.regression_metrics({"a": df, "b": df}, "y", "p")
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1
    assert "partial_avg" in plan


def test_importances_need_a_name_each(spark):
    class Fake:
        class featureImportances:  # noqa: N801
            @staticmethod
            def toArray():
                return [0.5, 0.5]
    with pytest.raises(ValueError):
        model.feature_importance(Fake, ["only one"])


def test_missing_table_is_sparks_own_error(spark):
    from pyspark.errors import AnalysisException
    with pytest.raises(AnalysisException):
        Tables(spark, "/nowhere/at/all").orders


def test_split_date_writes_nothing_and_cut_tables_can_go(spark):
    stats.remove_cut_tables(spark)
    folder = stats._cut_folder(spark).removeprefix("file:")
    catalog.REGISTRY["split_date"].fn(spark, SF).collect()
    assert not os.path.exists(folder)
    catalog.REGISTRY["percent_scale"].fn(spark, SF).collect()
    new = [d for d in os.listdir(folder)]
    written = [spark.read.parquet(os.path.join(folder, d)).columns for d in new]
    assert ["l_orderkey", "l_linenumber", "days_on_market"] in written
    stats.remove_cut_tables(spark)
    assert not os.path.exists(folder) and shared_path(spark)
