"""Feature transformers, on Spark ML.

Binarizer, Bucketizer, StringIndexer, OneHotEncoder and VectorAssembler run
JVM-side. The estimators' ``fit`` is one distributed aggregation (label
counts); only the label list - bounded by the number of categories - reaches
the driver, as Spark ML is built to do.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import (Binarizer, Bucketizer, OneHotEncoder, StringIndexer,
                                VectorAssembler)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import iso_day_of_week


def binarize(df: DataFrame, c: str, threshold: float, out_col: str) -> DataFrame:
    """1.0 where ``c > threshold`` else 0.0. The input is cast to double
    (Binarizer rejects integer columns)."""
    tmp = f"__bin_{c}"
    staged = df.withColumn(tmp, F.col(c).cast("double"))
    out = Binarizer(threshold=threshold, inputCol=tmp, outputCol=out_col).transform(staged)
    return out.drop(tmp)


def weekend_flag(df: DataFrame, date_col: str, day_col: str, out_col: str,
                 threshold: float = 5.0) -> DataFrame:
    """J1 as meant by the reference: Monday=1 .. Sunday=7 (as double), then
    ``> threshold`` (5.0) marks Saturday and Sunday."""
    return binarize(df.withColumn(day_col, iso_day_of_week(date_col)), day_col, threshold, out_col)


def bucketize(df: DataFrame, c: str, splits: Sequence[float], out_col: str,
              handle_invalid: str = "error") -> DataFrame:
    """Left-closed bins ``[s_i, s_i+1)``; the last bin includes its upper
    split. Give ``out_col`` a name that differs from ``c`` also in case."""
    if out_col.lower() == c.lower():
        raise ValueError("out_col must differ from the input column (names are case-insensitive)")
    tmp = f"__bkt_{c}"
    staged = df.withColumn(tmp, F.col(c).cast("double"))
    b = Bucketizer(splits=list(splits), inputCol=tmp, outputCol=out_col, handleInvalid=handle_invalid)
    return b.transform(staged).drop(tmp)


def string_index(df: DataFrame, c: str, out_col: str, handle_invalid: str = "error"):
    """Labels to indices, most frequent first, ties alphabetical.
    Returns ``(frame, model)``. The model holds the label list on the driver
    and in every task: for categories, not for id-like columns."""
    model = StringIndexer(inputCol=c, outputCol=out_col, handleInvalid=handle_invalid).fit(df)
    return model.transform(df), model


def one_hot(df: DataFrame, index_col: str, out_col: str, drop_last: bool = True):
    """Index to a sparse vector; the last category is all zeros when
    ``drop_last``. OneHotEncoder is an estimator in Spark 4: fit, then
    transform. Returns ``(frame, model)``."""
    model = OneHotEncoder(inputCols=[index_col], outputCols=[out_col], dropLast=drop_last).fit(df)
    return model.transform(df), model


def index_categoricals(df: DataFrame, cols: Sequence[str], suffix: str = "_IDX",
                      handle_invalid: str = "keep", drop_originals: bool = True,
                      as_stages: bool = False):
    """Index several categorical columns; NULL and unseen labels get the
    index ``number of labels`` with ``keep``.

    By default one multi-column ``StringIndexer`` counts all columns in a
    single pass; ``as_stages`` builds the reference's Pipeline of one indexer
    per column instead. Returns ``(frame, pipeline_model)``.
    """
    cols = list(cols)
    outs = [c + suffix for c in cols]
    if as_stages:
        stages = [StringIndexer(inputCol=c, outputCol=o, handleInvalid=handle_invalid)
                  for c, o in zip(cols, outs)]
    else:
        stages = [StringIndexer(inputCols=cols, outputCols=outs, handleInvalid=handle_invalid)]
    model = Pipeline(stages=stages).fit(df)
    out = model.transform(df)
    if drop_originals:
        out = out.drop(*cols)
    return out, model


def assemble(df: DataFrame, cols: Sequence[str], out_col: str = "features",
             handle_invalid: str = "error") -> DataFrame:
    """Feature columns into one vector. NULL raises by default; impute
    first (D6) or pass ``handle_invalid='skip'``/``'keep'``."""
    return VectorAssembler(inputCols=list(cols), outputCol=out_col,
                           handleInvalid=handle_invalid).transform(df)


def as_array(c: str):
    """Vector column to ``array<double>`` (for SQL comparison and storage)."""
    return vector_to_array(F.col(c))
