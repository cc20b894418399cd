"""Statistics that stay in the plan.

The reference collects each scalar to the driver (one job per scalar, two per
column for min-max scaling) and sends it back as a literal. Here every
statistic a transform needs is one expression of a single aggregate, and the
one-row result is used as a scalar subquery (``DataFrame.scalar()``) holding
all statistics in one struct: Spark runs it once (the other references are
``ReusedSubquery``), hands the value to every task like a literal, and can
push a filter on it into the Parquet scan. No join is involved, and a frame
that is not exactly one row fails instead of multiplying rows.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_path

STAT_PREFIX = "__st_"


def stat_name(*parts: str) -> str:
    return STAT_PREFIX + "_".join(parts)


def without_nan(df: DataFrame, c: str) -> Column:
    """Column ``c`` with NaN as NULL, so that it counts as missing."""
    x = F.col(c)
    if dict(df.dtypes).get(c) in ("float", "double"):
        return F.when(~F.isnan(x), x)
    return x


def one_row(df: DataFrame, named: Mapping[str, Column]) -> DataFrame:
    """All named aggregates of ``df`` in one pass -> a one-row frame."""
    return df.agg(*[expr.alias(name) for name, expr in named.items()])


def scalar_struct(stats: DataFrame) -> Column:
    """A one-row frame as one scalar-subquery struct column."""
    return stats.select(F.struct(*[F.col(f"`{c}`") for c in stats.columns]).alias("__stats")).scalar()


def attach(df: DataFrame, stats: DataFrame) -> DataFrame:
    """Append the columns of a one-row frame to every row of ``df``."""
    s = scalar_struct(stats)
    return df.withColumns({c: s.getField(c) for c in stats.columns})


def with_stats(df: DataFrame, named: Mapping[str, Column]) -> DataFrame:
    """``attach(df, one_row(df, named))``."""
    return attach(df, one_row(df, named))


def drop_stats(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(STAT_PREFIX)])


def to_long(row: DataFrame, value_cols: list[str], name_col: str = "column_name",
            value_col: str = "value", ids: list[str] | None = None) -> DataFrame:
    """Unpivot a (usually one-row) frame of per-column results to long form."""
    return row.unpivot(ids or [], value_cols, name_col, value_col)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a Parquet table under the shared checkpoint
    folder (``spark.checkpoint.dir``) and continue from the written table.

    Used where several branches of a plan read the same expensive
    intermediate (a shuffle of the whole input): the input is scanned once,
    every branch reads the same rows, and a task lost with its executor
    re-reads files instead of replaying the lineage. One job (the write);
    the read-back is columnar, so each branch reads only its columns. Select
    the columns that are needed first. ``remove_cut_tables`` deletes the
    application's tables when its results have been taken.
    """
    path = os.path.join(_cut_folder(df.sparkSession), uuid.uuid4().hex)
    # The schema is known: no file is opened to ask for it.
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _cut_folder(spark: SparkSession) -> str:
    return shared_path(spark, "cut", spark.conf.get("spark.app.id", "app"))


def remove_cut_tables(spark: SparkSession) -> None:
    """Delete every table this application wrote with ``cut_lineage``. Frames
    that still read them fail afterwards, so take or write results first."""
    folder = _cut_folder(spark)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(conf).delete(path, True)
