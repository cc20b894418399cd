"""Queries for SURVEY 2.15 (models) and A4-A5 (model files)."""

from __future__ import annotations

import uuid

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from .fixed import SEED
from ..catalog import Tables, hu, register
from ..functions.scalar import half_up
from ..operators import clean, encode, model, split
from ..plans.stats import attach, cut_lineage

CATEGORICALS = ["o_orderpriority", "c_mktsegment"]
NUMERIC = ["n_lines", "total_qty", "avg_discount", "avg_tax", "c_acctbal", "c_nationkey"]
FEATURES = NUMERIC + [c + "_IDX" for c in CATEGORICALS]
LABEL = "o_totalprice"
PREDICTION = "Prediction_Price"
TEST_DAYS = 365


def order_frame(t: Tables):
    """One row per order: line aggregates (pre-aggregated before the join),
    customer attributes, the price to predict."""
    li = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("total_qty"),
        F.avg("l_discount").alias("avg_discount"), F.avg("l_tax").alias("avg_tax"))
    o = t.orders.select("o_orderkey", "o_custkey", LABEL, F.col("o_orderdate").cast("date").alias("order_date"),
                        "o_orderpriority")
    c = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_acctbal", "c_nationkey", "c_mktsegment")
    j = o.join(li, on="o_orderkey", how="left").join(c, on="o_custkey", how="inner")
    # Orders without lines: a sentinel outside the normal range.
    return clean.impute_constant(j, -1, ["n_lines", "total_qty", "avg_discount", "avg_tax"])


_ORDERS_SPLIT_SQL = f"""
    WITH o AS (SELECT o_orderkey, o_totalprice, CAST(o_orderdate AS DATE) AS d, c_nationkey
               FROM orders JOIN customer ON o_custkey = c_custkey),
         s AS (SELECT CAST(max(d) - {TEST_DAYS} AS DATE) AS sd FROM o),
         train AS (SELECT o.* FROM o, s WHERE d < sd),
         test AS (SELECT o.* FROM o, s WHERE d >= sd)
"""



def model_data(t: Tables):
    """Sequential split (last year is test); indexers fit on train only, so
    category frequencies of the test period do not leak into training."""
    # Read for the split date, the indexer fit, training and test, by five
    # queries: each writes the line aggregation and its joins once.
    j = cut_lineage(order_frame(t))
    train, test = split.split_by_date(j, "order_date", split.split_date(j, "order_date", TEST_DAYS))
    _, indexers = encode.index_categoricals(train, CATEGORICALS, drop_originals=False)
    train = encode.assemble(indexers.transform(train), FEATURES)
    test = encode.assemble(indexers.transform(test), FEATURES)
    return train, test


# What SQL can check of a trained model: which rows it was asked about, and
# invariants. The values of the predictions are checked in pytest.
_PREDICTED_SQL = _ORDERS_SPLIT_SQL + """
    SELECT o_orderkey, o_totalprice, true AS predicted FROM test
"""


def _predictions(m, test):
    return model.predict(m, test).select("o_orderkey", LABEL, PREDICTION)


def _predicted(m, test):
    p = F.col(PREDICTION)
    return _predictions(m, test).select("o_orderkey", LABEL, (p.isNotNull() & ~F.isnan(p)).alias("predicted"))


@register("gbt_predict", sql=_PREDICTED_SQL)
def gbt_predict(spark, sf_dir):
    """L1/L3: gradient-boosted trees, seed 42: a prediction for each order of
    the test year."""
    train, test = model_data(Tables(spark, sf_dir))
    return _predicted(model.train_gbt(train, "features", LABEL, PREDICTION, seed=SEED), test)


@register("rfr_predict", sql=_PREDICTED_SQL)
def rfr_predict(spark, sf_dir):
    """L2/L3: random forest baseline."""
    train, test = model_data(Tables(spark, sf_dir))
    return _predicted(model.train_rf(train, "features", LABEL, PREDICTION, seed=SEED), test)


MODEL_NAMES = ("Gradient Boosted Trees", "Random Forest Regression")


@register("evaluate_trees", sql=_ORDERS_SPLIT_SQL + ", m AS (SELECT unnest([" + ", ".join(
    f"'{n}'" for n in MODEL_NAMES) + """]) AS model)
    SELECT m.model, count(*) AS n, true AS same_rmse, true AS same_r2 FROM m, test GROUP BY m.model
""")
def evaluate_trees(spark, sf_dir):
    """L4: RMSE and R² of both tree models in one aggregation, held against
    ``RegressionEvaluator``'s."""
    train, test = model_data(Tables(spark, sf_dir))
    gbt = model.train_gbt(train, "features", LABEL, PREDICTION)
    rf = model.train_rf(train, "features", LABEL, PREDICTION)
    # Scored once; the metrics of either kind read the written predictions.
    preds = {n: cut_lineage(_predictions(m, test)) for n, m in zip(MODEL_NAMES, (gbt, rf))}
    ev = RegressionEvaluator(labelCol=LABEL, predictionCol=PREDICTION)
    known = {k: {n: ev.evaluate(p, {ev.metricName: k}) for n, p in preds.items()} for k in ("rmse", "r2")}
    ours = model.regression_metrics(preds, LABEL, PREDICTION)

    def same(k):
        wanted = F.lit(None).cast("double")
        for n, v in known[k].items():
            wanted = F.when(F.col("model") == n, F.lit(float(v))).otherwise(wanted)
        return F.abs(F.col(k) - wanted) <= 1e-9 * F.greatest(F.abs(wanted), F.lit(1.0))

    return ours.select("model", "n", same("rmse").alias("same_rmse"), same("r2").alias("same_r2"))


@register("evaluate_models", sql=_ORDERS_SPLIT_SQL + f""",
         preds AS (
            SELECT 'global_mean' AS model, t.o_totalprice AS y, g.p
            FROM test t, (SELECT avg(o_totalprice) AS p FROM train) g
            UNION ALL
            SELECT 'nation_mean', t.o_totalprice, n.p
            FROM test t JOIN (SELECT c_nationkey, avg(o_totalprice) AS p FROM train GROUP BY 1) n
              ON t.c_nationkey = n.c_nationkey),
         m AS (SELECT model, avg(y) AS mean_y FROM preds GROUP BY model)
    SELECT p.model, count(*) AS n, {hu('sqrt(avg(power(p.p - p.y, 2)))', 6)} AS rmse,
           {hu('1 - sum(power(p.p - p.y, 2)) / sum(power(p.y - m.mean_y, 2))', 9)} AS r2
    FROM preds p JOIN m ON p.model = m.model GROUP BY p.model
""")
def evaluate_models(spark, sf_dir):
    """L4 in SQL-checkable form: RMSE and R² of two deterministic baselines
    (overall and per-nation mean of the training prices) on the test year."""
    t = Tables(spark, sf_dir)
    o = t.orders.select("o_orderkey", LABEL, F.col("o_orderdate").cast("date").alias("d"), "o_custkey")
    c = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    # Read three times (split date, training means, test rows): join once.
    oc = cut_lineage(o.join(c, on="o_custkey", how="inner"))
    train, test = split.split_by_date(oc, "d", split.split_date(oc, "d", TEST_DAYS))
    overall = train.agg(F.avg(LABEL).alias(PREDICTION))
    # Written, so that both sides of the join are exchanges, which AQE splits
    # where a nation is hot.
    per_nation = cut_lineage(train.groupBy("c_nationkey").agg(F.avg(LABEL).alias(PREDICTION)))
    preds = {"global_mean": attach(test, overall),
             "nation_mean": test.join(per_nation, on="c_nationkey", how="inner")}
    m = model.regression_metrics(preds, LABEL, PREDICTION)
    return m.select("model", "n", half_up("rmse", 6).alias("rmse"), half_up("r2", 9).alias("r2"))


@register("feature_importance", sql="SELECT unnest([" + ", ".join(f"'{f}'" for f in FEATURES) + f"""]) AS feature,
    {len(FEATURES)} AS n_ranked, CAST(1 AS DOUBLE) AS total
""")
def feature_importance(spark, sf_dir):
    """The features of the boosted model, ranked; their importances
    add up to one. (The ranking itself is not SQL; ``feature_importance``
    with ``top=10`` is the report.)"""
    train, _ = model_data(Tables(spark, sf_dir))
    m = model.train_gbt(train, "features", LABEL, PREDICTION, seed=SEED)
    ranked = model.feature_importance(m, model.feature_names(train, "features"), top=10)
    total = ranked.agg(F.count(F.lit(1)).cast("int").alias("n_ranked"), F.round(F.sum("importance"), 9).alias("total"))
    return attach(ranked.select("feature"), total)


@register("model_roundtrip", sql=_ORDERS_SPLIT_SQL + "SELECT count(*) AS n_rows, count(*) AS n_equal FROM test")
def model_roundtrip(spark, sf_dir):
    """A4/A5: save the forest to the shared folder, load it back and count
    test rows whose predictions are equal before and after."""
    train, test = model_data(Tables(spark, sf_dir))
    m = model.train_rf(train, "features", LABEL, PREDICTION, seed=SEED)
    path = model.save_model(m, name=f"rfr_{uuid.uuid4().hex[:8]}")
    loaded = model.load_model(model.RandomForestRegressionModel, path)
    # Both models score the same rows in one pass (no join of two outputs).
    before = model.predict(m, test).withColumnRenamed(PREDICTION, "before")
    both = model.predict(loaded.setPredictionCol("after"), before)
    return both.agg(F.count(F.lit(1)).alias("n_rows"),
                    F.count_if(F.col("before") == F.col("after")).alias("n_equal"))
