"""Leakage-safe, time-aware splitting.

The split date is a one-row aggregate used as a scalar subquery, so choosing it
and applying it is a single query, not a driver round trip.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.stats import drop_stats, one_row, scalar_struct

TRAIN, TEST, NEITHER = "train", "test", "neither"


def split_date(df: DataFrame, split_col: str, test_days: int = 45) -> DataFrame:
    """Q1: one row ``(split_date)`` = last date minus ``test_days`` days."""
    return one_row(df, {"max_date": F.max(split_col)}).select(
        F.date_sub(F.col("max_date").cast("date"), test_days).alias("split_date"))


def pct_split_date(df: DataFrame, date_col: str, pct: float) -> DataFrame:
    """Q4: one row ``(split_date)`` = first date plus ``pct`` of the span
    (whole days, rounded down)."""
    s = one_row(df, {"lo": F.min(F.col(date_col).cast("date")), "hi": F.max(F.col(date_col).cast("date"))})
    days = F.floor(F.datediff("hi", "lo") * F.lit(float(pct))).cast("int")
    return s.select(F.date_add("lo", days).alias("split_date"))


def _with_split(df: DataFrame, split) -> tuple[DataFrame, Column]:
    """The split date as a Column: a scalar subquery over a one-row frame
    with ``split_date``, or a literal date."""
    if isinstance(split, DataFrame):
        return df, scalar_struct(split.select("split_date")).getField("split_date")
    if isinstance(split, (dt.date, str)):
        return df, F.to_date(F.lit(str(split)))
    return df, split


def label_split(df: DataFrame, start_col: str, end_col: str, split, out_col: str = "split") -> DataFrame:
    """Q2: ``train`` if ``end < split``; ``test`` if ``end >= split`` and
    ``start <= split``; otherwise ``neither`` (started after the split: not
    known on the split date, so in no set). ``split`` is a one-row frame
    with ``split_date``, a date, or a Column."""
    staged, s = _with_split(df, split)
    end, start = F.col(end_col), F.col(start_col)
    label = (F.when(end < s, F.lit(TRAIN))
             .when((end >= s) & (start <= s), F.lit(TEST))
             .otherwise(F.lit(NEITHER)))
    return drop_stats(staged.withColumn(out_col, label))


def train_test(df: DataFrame, start_col: str, end_col: str, split) -> tuple[DataFrame, DataFrame]:
    """Q2 as two frames, the reference's ``train_df`` and ``test_df``.

    Written as plain predicates on the columns (not a filter on the label),
    so with a literal split date and stored date columns they reach the
    Parquet reader as pushed filters.
    """
    staged, s = _with_split(df, split)
    end, start = F.col(end_col), F.col(start_col)
    train = drop_stats(staged.where(end < s))
    test = drop_stats(staged.where((end >= s) & (start <= s)))
    return train, test


def as_of_days(test_df: DataFrame, start_col: str, days_col: str, split,
               original_suffix: str = "_Original") -> DataFrame:
    """Q3: keep the observed duration as ``<days>_Original`` and recompute it
    as known on the split date: ``datediff(split, start)``."""
    staged, s = _with_split(test_df, split)
    out = staged.withColumn(days_col + original_suffix, F.col(days_col)) \
        .withColumn(days_col, F.datediff(s, F.col(start_col)))
    return drop_stats(out)


def split_by_date(df: DataFrame, date_col: str, split) -> tuple[DataFrame, DataFrame]:
    """Sequential split of point-in-time rows: train before the split date,
    test on or after it."""
    staged, s = _with_split(df, split)
    d = F.col(date_col)
    return (drop_stats(staged.where(d < s)), drop_stats(staged.where(d >= s)))
