"""Scaling and skew corrections.

Min and max of every column come from one aggregate whose single row is a
scalar subquery, so scaling N columns costs one extra pass instead of 2N jobs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import inverse_log, log_or_null, safe_div
from ..plans.stats import drop_stats, stat_name, with_stats, without_nan


def _min_max(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    named = {}
    for c in cols:
        named[stat_name(c, "min")] = F.min(without_nan(df, c))
        named[stat_name(c, "max")] = F.max(without_nan(df, c))
    return with_stats(df, named)


def _unit(df: DataFrame, c: str):
    lo, hi = F.col(stat_name(c, "min")), F.col(stat_name(c, "max"))
    return safe_div((without_nan(df, c) - lo).cast("double"), (hi - lo).cast("double"))


def min_max_scale(df: DataFrame, cols: Sequence[str], prefix: str = "scaled_") -> DataFrame:
    """``scaled_<c> = (c - min) / (max - min)`` for every column.

    A constant column has no range and gives NULL (the reference would
    divide by zero). NaN counts as missing: it moves no bound and gives NULL.
    """
    cols = list(cols)
    out = _min_max(df, cols).withColumns({prefix + c: _unit(df, c) for c in cols})
    return drop_stats(out)


def percent_scale(df: DataFrame, c: str, out_col: str) -> DataFrame:
    """``round(100 * (c - min) / (max - min))`` - a 0..100 scale."""
    out = _min_max(df, [c]).withColumn(out_col, F.round(_unit(df, c) * F.lit(100.0), 0))
    return drop_stats(out)


def percent_scale_round_first(df: DataFrame, c: str, out_col: str) -> DataFrame:
    """E1 as literally written in the reference: round the 0..1 value first,
    then multiply by 100, so the output is only 0 or 100."""
    out = _min_max(df, [c]).withColumn(out_col, F.round(_unit(df, c), 0) * F.lit(100.0))
    return drop_stats(out)


def reflect_log(df: DataFrame, c: str, reflected_col: str, out_col: str) -> DataFrame:
    """Negative-skew correction. ``reflected = (max + 1) - c`` and
    ``out = 1 / ln(reflected)``; the maximum row (``ln 1 = 0``) gives NULL."""
    mx = stat_name(c, "max")
    out = with_stats(df, {mx: F.max(without_nan(df, c))})
    out = out.withColumn(reflected_col, (F.col(mx) + F.lit(1)) - without_nan(df, c))
    out = out.withColumn(out_col, inverse_log(reflected_col))
    return drop_stats(out)


def log_transform(df: DataFrame, c: str, out_col: str) -> DataFrame:
    """Positive-skew correction with the natural log (NULL for <= 0)."""
    return df.withColumn(out_col, log_or_null(c))
