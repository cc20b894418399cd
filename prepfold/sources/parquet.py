"""Parquet source, column listing and SQL views."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A1: columnar scan. Projection and filters written later on the
    returned frame reach the reader as ``ReadSchema`` / ``PushedFilters``."""
    return spark.read.parquet(path)


def load_table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """Read ``<base_dir>/<name>.parquet``."""
    return read_parquet(spark, os.path.join(base_dir, f"{name}.parquet"))


def list_columns(df: DataFrame) -> DataFrame:
    """A2: ``df.columns`` as a frame ``(position, column_name, data_type)``.

    Built from the schema only; no job runs.
    """
    spark = df.sparkSession
    rows = [(i, name, dtype) for i, (name, dtype) in enumerate(df.dtypes)]
    schema = T.StructType([
        T.StructField("position", T.IntegerType(), False),
        T.StructField("column_name", T.StringType(), False),
        T.StructField("data_type", T.StringType(), False),
    ])
    return spark.createDataFrame(rows, schema)


def register_view(df: DataFrame, name: str | None = None) -> str:
    """A3: register ``df`` as a temp view and return the view name.

    Without a name a unique one is made, so concurrent queries in one
    session do not overwrite each other's views.
    """
    view = name or f"v_{uuid.uuid4().hex[:12]}"
    df.createOrReplaceTempView(view)
    return view
