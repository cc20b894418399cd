"""Arithmetic, date and text features.

All are projections: no shuffle, no extra pass. Several new columns are
added with one ``withColumns`` so the plan keeps a single ``Project``.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import (day_of_week, like_flag, parse_date, safe_div)


# -- arithmetic (K) -----------------------------------------------------------

def unit_convert(df: DataFrame, c: str, factor: float, out_col: str) -> DataFrame:
    """K1: ``c * factor`` (e.g. acres to square feet with 43560)."""
    return df.withColumn(out_col, F.col(c) * F.lit(factor))


def difference(df: DataFrame, a: str, b: str, out_col: str) -> DataFrame:
    """K2: ``a - b``."""
    return df.withColumn(out_col, F.col(a) - F.col(b))


def ratios(df: DataFrame, specs: Mapping[str, tuple[str, str]]) -> DataFrame:
    """K3: ``{out: (numerator, denominator)}``; a zero divisor gives NULL."""
    return df.withColumns({out: safe_div(num, den) for out, (num, den) in specs.items()})


def sum_feature(df: DataFrame, a: str, b: str, out_col: str) -> DataFrame:
    """K4: ``a + b`` (NULL if either is NULL)."""
    return df.withColumn(out_col, F.col(a) + F.col(b))


def per_unit(df: DataFrame, num: str, den: str, unit: float, out_col: str) -> DataFrame:
    """K5: ``num / (den / unit)``, e.g. baths per 1000 square feet."""
    return df.withColumn(out_col, safe_div(num, F.col(den) / F.lit(unit)))


# -- dates (P) ----------------------------------------------------------------

def to_date_column(df: DataFrame, c: str, fmt: str | None = None, out_col: str | None = None) -> DataFrame:
    """Text (or timestamp) to date; bad text gives NULL."""
    return df.withColumn(out_col or c, parse_date(c, fmt))


def day_of_week_column(df: DataFrame, c: str, out_col: str) -> DataFrame:
    """Sunday=1 .. Saturday=7."""
    return df.withColumn(out_col, day_of_week(c))


# -- text and arrays (I) ------------------------------------------------------

def text_flag(df: DataFrame, c: str, one_pattern: str, zero_pattern: str, out_col: str) -> DataFrame:
    """1 / 0 / NULL from two LIKE patterns, first match wins."""
    return df.withColumn(out_col, like_flag(c, one_pattern, zero_pattern))


def split_list(df: DataFrame, c: str, sep: str, out_col: str, literal: bool = True) -> DataFrame:
    """Split text into an array. ``sep`` is taken literally unless
    ``literal=False`` (then it is a Java regex, as ``F.split`` expects)."""
    pattern = re.escape(sep) if literal else sep
    return df.withColumn(out_col, F.split(F.col(c), pattern))


def explode_list(df: DataFrame, list_col: str, out_col: str, keep_empty: bool = False) -> DataFrame:
    """One row per element. Rows with a NULL or empty list disappear
    unless ``keep_empty`` (then one row with a NULL element)."""
    fn = F.explode_outer if keep_empty else F.explode
    return df.withColumn(out_col, fn(F.col(list_col)))


def token_vocabulary(df: DataFrame, token_col: str) -> DataFrame:
    """I4: distinct tokens with their row counts (partial aggregation runs
    before the shuffle, so a frequent token costs one row per task)."""
    return (df.where(F.col(token_col).isNotNull())
            .groupBy(token_col).agg(F.count(F.lit(1)).alias("n_rows")))


def discover_values(df: DataFrame, c: str) -> list:
    """Distinct non-NULL values of ``c``, sorted: the columns of a wide
    encoding. They are as many as the result has columns, so this is for
    vocabularies; ``multi_hot_long`` takes any number of values."""
    return sorted(r[0] for r in df.where(F.col(c).isNotNull()).select(c).distinct().collect())


def multi_hot_long(df: DataFrame, id_col: str, list_col: str, token_col: str = "token",
                   flag_col: str = "present") -> DataFrame:
    """I5 in sparse form: one row per (id, distinct token) with a 1, whatever
    the size of the vocabulary; what is absent is 0."""
    tokens = df.select(id_col, F.explode(F.array_distinct(F.col(list_col))).alias(token_col))
    return tokens.where(F.col(token_col).isNotNull()).withColumn(flag_col, F.lit(1))


def pivot_tokens(exploded: DataFrame, id_col: str, token_col: str,
                 values: Sequence[str]) -> DataFrame:
    """``groupBy(id).pivot(token, values)`` marking present tokens with 1.

    The value list is explicit, so no discovery job runs and the schema is
    fixed; NULL tokens never become a column named ``null``.
    """
    ex = exploded.where(F.col(token_col).isNotNull())
    return ex.groupBy(id_col).pivot(token_col, list(values)).agg(F.max(F.lit(1)))


def multi_hot(df: DataFrame, list_col: str, values: Sequence[str], prefix: str = "",
              id_col: str | None = None, strategy: str = "projection") -> DataFrame:
    """One 0/1 column per vocabulary value.

    ``projection`` (default): ``array_contains`` per value on each row, no
    shuffle at all. ``pivot_join``: the reference's plan - explode, pivot by
    ``id_col``, left join back on ``id_col`` (F6) and zero-fill only the
    pivoted columns (D9). Both give the same result when ``id_col`` is unique.
    """
    values = list(values)
    names = {v: f"{prefix}{v}" for v in values}
    if strategy == "projection":
        arr = F.col(list_col)
        return df.withColumns({names[v]: F.coalesce(F.array_contains(arr, F.lit(v)).cast("int"), F.lit(0))
                               for v in values})
    if strategy != "pivot_join":
        raise ValueError(strategy)
    if id_col is None:
        raise ValueError("pivot_join needs id_col")
    ex = df.select(id_col, F.explode(F.col(list_col)).alias("__tok"))
    piv = pivot_tokens(ex, id_col, "__tok", values)
    piv = piv.select(id_col, *[F.col(f"`{v}`").alias(names[v]) for v in values])
    joined = df.join(piv, on=id_col, how="left")
    return joined.fillna(0, subset=list(names.values()))
