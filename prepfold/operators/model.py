"""Tree regression, evaluation, importances, model files.

Training is Spark ML's distributed tree learner (binned features, one
aggregation per tree level). Metrics are aggregates over the prediction
frames, all models in one pass. Model files go under the shared folder the
cluster names in ``spark.checkpoint.dir`` unless a path is given.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.regression import (GBTRegressionModel, GBTRegressor,
                                   RandomForestRegressionModel, RandomForestRegressor)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir, shared_path


def _prepare(spark: SparkSession) -> None:
    ensure_checkpoint_dir(spark)


def train_gbt(train_df: DataFrame, features_col: str, label_col: str,
              prediction_col: str = "Prediction_Price", seed: int = 42,
              **params) -> GBTRegressionModel:
    """L1: gradient-boosted trees (defaults 20 trees, depth 5, 32 bins).

    The running predictions are checkpointed to the shared folder every 10
    iterations, so a lost executor does not replay the whole boosting
    lineage.
    """
    _prepare(train_df.sparkSession)
    gbt = GBTRegressor(featuresCol=features_col, labelCol=label_col, predictionCol=prediction_col,
                       seed=seed, checkpointInterval=10, **params)
    return gbt.fit(train_df)


def train_rf(train_df: DataFrame, features_col: str, label_col: str,
             prediction_col: str = "Prediction_Price", seed: int = 42,
             **params) -> RandomForestRegressionModel:
    """L2: random forest baseline."""
    _prepare(train_df.sparkSession)
    rf = RandomForestRegressor(featuresCol=features_col, labelCol=label_col,
                               predictionCol=prediction_col, seed=seed, **params)
    return rf.fit(train_df)


def predict(model, df: DataFrame) -> DataFrame:
    """L3: add the prediction column (the model is broadcast to tasks)."""
    return model.transform(df)


def regression_metrics(predictions: Mapping[str, DataFrame], label_col: str, prediction_col: str) -> DataFrame:
    """L4: ``(model, n, rmse, r2)`` for several prediction frames.

    ``rmse = sqrt(avg((p - y)^2))`` and ``r2 = 1 - SSE / SST`` with
    ``SST = sum((y - mean(y))^2)`` - the definitions of RegressionEvaluator.
    Every metric of every model comes out of one aggregation: ``SST`` is the
    population variance of the label times ``n``, so no second pass and no
    join with the mean is needed.
    """
    parts = [df.select(F.lit(name).alias("model"), F.col(label_col).cast("double").alias("__y"),
                       F.col(prediction_col).cast("double").alias("__p"))
             for name, df in predictions.items()]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    error = F.pow(F.col("__p") - F.col("__y"), 2)
    agg = u.groupBy("model").agg(F.count(F.lit(1)).alias("n"), F.avg(error).alias("__mse"),
                                 F.var_pop("__y").alias("__var"))
    return agg.select("model", "n", F.sqrt("__mse").alias("rmse"),
                      (F.lit(1.0) - F.try_divide(F.col("__mse"), F.col("__var"))).alias("r2"))


def feature_names(df: DataFrame, features_col: str) -> list[str]:
    """Names of the slots of an assembled vector, from its ``ml_attr``
    metadata (written by VectorAssembler)."""
    meta = df.schema[features_col].metadata.get("ml_attr", {})
    names = {}
    for group in meta.get("attrs", {}).values():
        for a in group:
            names[a["idx"]] = a["name"]
    # A slot without a name keeps its place.
    return [names.get(i, f"slot_{i}") for i in range(max(names, default=-1) + 1)]


def feature_importance(model, names: Sequence[str], top: int | None = 10) -> DataFrame:
    """``(feature, importance, rank)``, highest first, ``top`` rows.

    The importance vector has one entry per feature (bounded by the schema),
    so it is built on the driver; ordering and the limit run in Spark.
    """
    spark = SparkSession.getActiveSession()
    imp = model.featureImportances.toArray()
    if len(names) != len(imp):
        raise ValueError(f"{len(names)} names for {len(imp)} features")
    rows = [(str(n), float(v)) for n, v in zip(names, imp)]
    schema = T.StructType([T.StructField("feature", T.StringType(), False),
                           T.StructField("importance", T.DoubleType(), False)])
    df = spark.createDataFrame(rows, schema)
    ranked = df.orderBy(F.col("importance").desc(), F.col("feature"))
    return ranked.limit(top) if top else ranked


def save_model(model, path: str | None = None, name: str = "model") -> str:
    """A4: write the model (overwriting), by default under the shared
    checkpoint folder. Returns the path."""
    spark = SparkSession.getActiveSession()
    path = path or shared_path(spark, "models", name)
    model.write().overwrite().save(path)
    return path


def load_model(cls, path: str):
    """A5: ``RandomForestRegressionModel.load(path)`` and friends."""
    return cls.load(path)


__all__ = ["train_gbt", "train_rf", "predict", "regression_metrics",
           "feature_names", "feature_importance", "save_model", "load_model",
           "GBTRegressionModel", "RandomForestRegressionModel"]
