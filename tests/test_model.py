import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from prepfold.catalog import Tables
from prepfold.operators import model
from prepfold.queries.modelling import LABEL, PREDICTION, model_data

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def data(spark):
    train, test = model_data(Tables(spark, SF))
    return train.persist(), test.persist()


def test_train_test_disjoint_in_time(data):
    train, test = data
    assert train.agg(F.max("order_date")).first()[0] < test.agg(F.min("order_date")).first()[0]


def test_same_seed_same_predictions(data):
    train, test = data
    a = model.predict(model.train_rf(train, "features", LABEL, PREDICTION, seed=42, numTrees=5), test)
    b = model.predict(model.train_rf(train, "features", LABEL, PREDICTION, seed=42, numTrees=5), test)
    j = a.select("o_orderkey", F.col(PREDICTION).alias("a")).join(
        b.select("o_orderkey", F.col(PREDICTION).alias("b")), "o_orderkey")
    assert j.where("a != b").count() == 0 and j.count() == test.count()


def test_metrics_equal_evaluator_and_save_load(data, spark):
    train, test = data
    m = model.train_gbt(train, "features", LABEL, PREDICTION, seed=42, maxIter=5)
    preds = model.predict(m, test)
    ours = model.regression_metrics({"gbt": preds}, LABEL, PREDICTION).first()
    ev = RegressionEvaluator(labelCol=LABEL, predictionCol=PREDICTION)
    assert ours.rmse == pytest.approx(ev.evaluate(preds, {ev.metricName: "rmse"}), rel=1e-9)
    assert ours.r2 == pytest.approx(ev.evaluate(preds, {ev.metricName: "r2"}), rel=1e-9, abs=1e-9)
    path = model.save_model(m, name="gbt_test")
    model.save_model(m, path=path)  # a second save overwrites
    loaded = model.load_model(model.GBTRegressionModel, path)
    again = model.predict(loaded, test).select("o_orderkey", F.col(PREDICTION).alias("p2"))
    j = preds.select("o_orderkey", PREDICTION).join(again, "o_orderkey")
    assert j.where(F.col(PREDICTION) != F.col("p2")).count() == 0


def test_feature_importance_names_and_order(data):
    train, _ = data
    m = model.train_rf(train, "features", LABEL, PREDICTION, seed=42, numTrees=5)
    names = model.feature_names(train, "features")
    assert names[:2] == ["n_lines", "total_qty"] and len(names) == 8
    imp = model.feature_importance(m, names, top=3).collect()
    assert len(imp) == 3 and imp[0].importance >= imp[1].importance >= imp[2].importance
