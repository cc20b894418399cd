"""Row and column cleaning: projections, filters, imputation.

Every statistic is computed in the plan (see ``plans.stats``). Operators that
decide which columns to drop have a report form (a DataFrame with one row per
column) and a dropping form; the dropping form brings only that report, one
row per column, to the driver, because the output schema depends on it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import excluding, null_if_above
from ..plans import quantiles
from ..plans.stats import attach, drop_stats, one_row, stat_name, to_long, with_stats, without_nan

_FLOATS = (T.FloatType, T.DoubleType)


def _is_float(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, _FLOATS)


def _missing(df: DataFrame, c: str, count_nan: bool = True) -> Column:
    x = F.col(c)
    if count_nan and _is_float(df, c):
        return x.isNull() | F.isnan(x)
    return x.isNull()


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """D1."""
    return df.drop(*cols)


def exclude_values(df: DataFrame, c: str, values: Sequence, keep_null: bool = True) -> DataFrame:
    """Drop rows whose value is in ``values``; NULL rows stay by default.
    The predicate reaches the Parquet reader as ``Or(Not(In), IsNull)``."""
    return df.where(excluding(c, list(values), keep_null))


def sigma_bounds(df: DataFrame, c: str, k: float = 3.0) -> DataFrame:
    """One row ``(mean, stddev, low_bound, high_bound)`` of column ``c``."""
    x = without_nan(df, c)
    s = one_row(df, {"mean": F.mean(x), "stddev": F.stddev(x)})
    return s.select("mean", "stddev",
                    (F.col("mean") - F.lit(k) * F.col("stddev")).alias("low_bound"),
                    (F.col("mean") + F.lit(k) * F.col("stddev")).alias("high_bound"))


def sigma_filter(df: DataFrame, c: str, k: float = 3.0, keep_if_constant: bool = False) -> DataFrame:
    """D3: keep rows strictly inside ``mean +- k * stddev`` (sample stddev).

    NULL values fail both comparisons and are dropped, as in the reference;
    NaN counts as missing, in the bounds and in the rows.
    With a constant column (stddev 0) the strict bounds drop every row;
    ``keep_if_constant`` keeps them instead.
    """
    lo, hi, sd = stat_name(c, "lo"), stat_name(c, "hi"), stat_name(c, "sd")
    b = sigma_bounds(df, c, k).select(F.col("low_bound").alias(lo), F.col("high_bound").alias(hi),
                                      F.col("stddev").alias(sd))
    x = F.col(c)
    inside = (x < F.col(hi)) & (x > F.col(lo))
    if keep_if_constant:
        inside = inside | ((F.col(sd) == 0) & without_nan(df, c).isNotNull())
    return drop_stats(attach(df, b).where(inside))


def impute_mean(df: DataFrame, cols: Sequence[str], count_nan: bool = True) -> DataFrame:
    """Replace missing values by the column mean; all means in one pass.

    The column becomes double, so a mean of 2.75 is not truncated to 2 as
    filling an integer column would do.
    """
    cols = list(cols)
    named = {}
    for c in cols:
        val = F.when(~_missing(df, c, count_nan), F.col(c).cast("double"))
        named[stat_name(c, "mean")] = F.avg(val)
    out = with_stats(df, named)
    out = out.withColumns({
        c: F.when(_missing(df, c, count_nan), F.col(stat_name(c, "mean")))
            .otherwise(F.col(c).cast("double"))
        for c in cols})
    return drop_stats(out)


def impute_median(df: DataFrame, cols: Sequence[str], count_nan: bool = True) -> DataFrame:
    """Replace missing values by the exact column median.

    The medians of all columns come from one distributed quantile job over
    the unpivoted values (see ``plans.quantiles``): no value set of a column
    is ever held by one task.
    """
    cols = list(cols)
    medians = column_medians(df, cols, count_nan)
    wide = medians.groupBy().pivot("column_name", cols).agg(F.first("median"))
    wide = wide.select(*[F.col(c).alias(stat_name(c, "median")) for c in cols])
    out = attach(df, wide).withColumns({
        c: F.when(_missing(df, c, count_nan), F.col(stat_name(c, "median")))
            .otherwise(F.col(c).cast("double"))
        for c in cols})
    return drop_stats(out)


def column_medians(df: DataFrame, cols: Sequence[str], count_nan: bool = True) -> DataFrame:
    """``(column_name, median)`` for each column, exact."""
    cols = list(cols)
    long = df.select(*[
        F.when(~_missing(df, c, count_nan), F.col(c).cast("double")).alias(c) for c in cols
    ]).unpivot([], cols, "column_name", "value")
    return quantiles.exact_quantile(long, "value", 0.5, ["column_name"], out_col="median")


def impute_constant(df: DataFrame, value, cols: Sequence[str]) -> DataFrame:
    """Fill missing values of ``cols`` with a sentinel such as -1."""
    return df.fillna(value, subset=list(cols))


def null_share_report(df: DataFrame, threshold: float, cols: Sequence[str] | None = None,
                      count_nan: bool = False) -> DataFrame:
    """D7 report: ``(column_name, null_count, total, null_share, dropped)``.

    One aggregate over all columns. ``dropped`` is ``null_share > threshold``;
    an empty frame drops nothing.
    """
    cols = list(cols or df.columns)
    named = {"__total": F.count(F.lit(1))}
    for i, c in enumerate(cols):
        named[f"__n{i}"] = F.count_if(_missing(df, c, count_nan))
    row = one_row(df, named)
    long = row.select("__total", F.explode(F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("column_name"),
                 F.col(f"__n{i}").alias("null_count"))
        for i, c in enumerate(cols)])).alias("s")).select("s.*", F.col("__total").alias("total"))
    share = F.try_divide(F.col("null_count").cast("double"), F.col("total").cast("double"))
    return long.select("position", "column_name", "null_count", "total",
                       share.alias("null_share"),
                       F.coalesce(share > F.lit(threshold), F.lit(False)).alias("dropped"))


def drop_sparse_columns(df: DataFrame, threshold: float, count_nan: bool = False) -> DataFrame:
    """Drop every column whose null share is above ``threshold``."""
    report = null_share_report(df, threshold, count_nan=count_nan)
    to_drop = [r["column_name"] for r in report.where("dropped").select("column_name").collect()]
    return df.drop(*to_drop)


def low_observation_report(df: DataFrame, cols: Sequence[str], threshold: int = 30) -> DataFrame:
    """D8 report: ``(column_name, obs_count, dropped)`` with ``dropped`` when
    the number of ones is ``<= threshold``. All columns in one aggregate; a
    column with no rows counts 0 observations."""
    cols = list(cols)
    row = one_row(df, {f"__o{i}": F.coalesce(F.sum(F.col(c).cast("long")), F.lit(0))
                       for i, c in enumerate(cols)})
    long = row.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("column_name"),
                 F.col(f"__o{i}").alias("obs_count"))
        for i, c in enumerate(cols)])).alias("s")).select("s.*")
    return long.withColumn("dropped", F.col("obs_count") <= F.lit(threshold))


def drop_low_observation_columns(df: DataFrame, cols: Sequence[str], threshold: int = 30) -> DataFrame:
    """Drop binary columns with at most ``threshold`` ones."""
    report = low_observation_report(df, cols, threshold)
    to_drop = [r["column_name"] for r in report.where("dropped").select("column_name").collect()]
    return df.drop(*to_drop)


def zero_fill(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Fill NULL with 0 in the given columns only (never every column)."""
    return df.fillna(0, subset=list(cols))


def null_out_above(df: DataFrame, c: str, bound, out_col: str | None = None) -> DataFrame:
    """Overwrite outliers above ``bound`` with NULL."""
    return df.withColumn(out_col or c, null_if_above(c, bound))


__all__ = ["drop_columns", "exclude_values", "sigma_bounds", "sigma_filter", "impute_mean",
           "impute_median", "column_medians", "impute_constant", "null_share_report",
           "drop_sparse_columns", "low_observation_report", "drop_low_observation_columns",
           "zero_fill", "null_out_above", "to_long"]
