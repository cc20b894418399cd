"""Profiling: correlations, skewness, samples, distributions,
linear trends, missing values and category counts, each as one aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.stats import attach, drop_stats, one_row, stat_name, without_nan
from .clean import _missing, null_share_report


def pearson(x: Column, y: Column, null_as_zero: bool = False) -> Column:
    """Pearson correlation as an aggregate expression.

    Rows where either side is NULL are skipped (as ``F.corr``); with
    ``null_as_zero`` NULL counts as 0 (what ``DataFrame.corr`` does). A
    constant side gives NULL, where ``F.corr`` raises DIVIDE_BY_ZERO under
    ANSI.
    """
    x, y = x.cast("double"), y.cast("double")
    if null_as_zero:
        x, y = F.coalesce(x, F.lit(0.0)), F.coalesce(y, F.lit(0.0))
    both = x.isNotNull() & y.isNotNull()
    xs, ys = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_samp(xs, ys), F.stddev_samp(xs) * F.stddev_samp(ys))


def correlation_ranking(df: DataFrame, target: str, cols: Sequence[str],
                        null_as_zero: bool = False, by_abs: bool = False) -> DataFrame:
    """Correlation of every column with ``target`` in one pass, ranked.

    ``(position, column_name, corr, rank, is_best)``; rank 1 is the highest
    correlation (absolute value with ``by_abs``). Ties go to the column
    listed first; NULL correlations rank last.
    """
    cols = list(cols)
    row = one_row(df, {f"__r{i}": pearson(F.col(target), F.col(c), null_as_zero)
                       for i, c in enumerate(cols)})
    long = row.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("column_name"),
                 F.col(f"__r{i}").alias("corr")) for i, c in enumerate(cols)])).alias("s")
    ).select("s.*")
    key = F.abs("corr") if by_abs else F.col("corr")
    # One row per column: a bounded frame, so a global window is fine here.
    w = Window.orderBy(key.desc_nulls_last(), F.col("position"))
    return long.withColumn("rank", F.row_number().over(w)) \
        .withColumn("is_best", F.col("rank") == 1)


def best_correlated(df: DataFrame, target: str, cols: Sequence[str], **kw) -> str:
    """C1 in the reference's form: the name of the best column."""
    return correlation_ranking(df, target, cols, **kw).where("is_best").first()["column_name"]


def correlation_report(df: DataFrame, pairs: Sequence[tuple[str, str]],
                       null_as_zero: bool = False) -> DataFrame:
    """One row, one column ``corr_<a>_<b>`` per pair, one pass."""
    return one_row(df, {f"corr_{a}_{b}": pearson(F.col(a), F.col(b), null_as_zero)
                        for a, b in pairs})


def skewness(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Population skewness ``m3 / m2^1.5`` of each column, long form."""
    cols = list(cols)
    row = one_row(df, {f"__k{i}": F.skewness(F.col(c).cast("double")) for i, c in enumerate(cols)})
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"__k{i}").alias("skewness"))
        for i, c in enumerate(cols)])).alias("s")).select("s.*")


def bernoulli_sample(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    """C4: ``sample(False, fraction, seed)``. Repeatable only for the same
    partition layout."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def hash_sample(df: DataFrame, key_cols: Sequence[str], fraction: float, seed: int) -> DataFrame:
    """C4, layout-independent: keep a row when a hash of the seed and its key
    (52 bits of MD5, which other engines have too) falls under ``fraction``.
    The same keys are kept on any cluster, after any repartition, and the
    predicate runs inside the scan stage."""
    key = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key_cols])
    h = F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("double")
    return df.where(h < F.lit(float(fraction) * float(1 << 52)))


def distinct_values(df: DataFrame, c: str) -> DataFrame:
    """C5/G4."""
    return df.select(c).distinct()


def histogram(df: DataFrame, c: str, bins: int = 20) -> DataFrame:
    """Equal-width histogram ``(bin, bin_low, bin_high, count)``.

    Min and max come from a one-row aggregate; bin ``i`` covers
    ``[low, high)`` and the last one includes the maximum. Empty bins are
    absent. NULL and NaN are not counted.
    """
    df = df.select(without_nan(df, c).alias(c))
    lo, hi = stat_name(c, "min"), stat_name(c, "max")
    s = one_row(df, {lo: F.min(F.col(c).cast("double")), hi: F.max(F.col(c).cast("double"))})
    width = (F.col(hi) - F.col(lo)) / F.lit(float(bins))
    x = F.col(c).cast("double")
    raw = F.floor(F.try_divide((x - F.col(lo)) * F.lit(float(bins)), F.col(hi) - F.col(lo)))
    b = F.least(F.coalesce(raw, F.lit(0)), F.lit(bins - 1)).cast("int")
    counted = (attach(df.select(c).where(F.col(c).isNotNull()), s)
               .groupBy(b.alias("bin"), F.col(lo), F.col(hi)).agg(F.count(F.lit(1)).alias("count")))
    return counted.select("bin",
                          (F.col(lo) + F.col("bin") * width).alias("bin_low"),
                          (F.col(lo) + (F.col("bin") + F.lit(1)) * width).alias("bin_high"),
                          "count")


def linear_trend(df: DataFrame, y: str, x: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """Least-squares line of ``y`` on ``x`` with R² (what lmplot and a
    jointplot with r2 draw), per group if given."""
    yy, xx = F.col(y).cast("double"), F.col(x).cast("double")
    aggs = [F.regr_count(yy, xx).alias("n"), F.regr_slope(yy, xx).alias("slope"),
            F.regr_intercept(yy, xx).alias("intercept"), F.regr_r2(yy, xx).alias("r2")]
    g = list(group_cols)
    return df.groupBy(*g).agg(*aggs) if g else df.agg(*aggs)


def null_profile(df: DataFrame, cols: Sequence[str] | None = None,
                 count_nan: bool = False) -> DataFrame:
    """``(position, column_name, null_count, total, null_share,
    most_missing)``; one aggregate for all columns. ``most_missing`` marks the
    column with the most missing values (first listed on a tie)."""
    rep = null_share_report(df, 1.0, cols, count_nan).drop("dropped")
    w = Window.orderBy(F.col("null_count").desc(), F.col("position"))
    return rep.withColumn("most_missing", F.row_number().over(w) == 1)


def null_patterns(df: DataFrame, cols: Sequence[str], count_nan: bool = False) -> DataFrame:
    """Which columns are missing together: one row per pattern of
    missing flags with its row count (the heatmap's content, aggregated)."""
    cols = list(cols)
    flags = [_missing(df, c, count_nan).alias(f"{c}_missing") for c in cols]
    return df.groupBy(*flags).agg(F.count(F.lit(1)).alias("n_rows"))


def category_counts(df: DataFrame, c: str) -> DataFrame:
    """Rows per category (a countplot's bars)."""
    return df.groupBy(c).agg(F.count(F.lit(1)).alias("n_rows"))


__all__ = ["pearson", "correlation_ranking", "best_correlated", "correlation_report", "skewness",
           "bernoulli_sample", "hash_sample", "distinct_values", "histogram", "linear_trend",
           "null_profile", "null_patterns", "category_counts", "drop_stats"]
