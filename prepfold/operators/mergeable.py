"""Statistics that are stored and merged.

A state is a small table: a row for each column (and each pair of columns)
with the count, mean, sums of powers of the distances from the mean, minimum
and maximum. It is written beside a file as it arrives; states of any number
of files merge into that of all their rows without reading these again, and
the 3-sigma filter and the min-max scale take their numbers from it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.stats import scalar_struct, without_nan

#: Columns of a state besides the names of the grouping columns.
STATE = ("column_name", "other_name", "n", "mean", "m2", "m3", "min", "max", "other_mean", "other_m2", "co")


def _finite(df: DataFrame, c: str) -> Column:
    x = without_nan(df, c).cast("double")
    return F.when(F.abs(x) < F.lit(math.inf), x)


def moment_state(df: DataFrame, cols: Sequence[str], pairs: Sequence[tuple[str, str]] = (),
                 by: Sequence[str] = ()) -> DataFrame:
    """The state of ``cols`` and ``pairs`` in one pass, one for each value of ``by``.

    NULL, NaN and infinite values are not counted; a pair counts rows that
    have both. A column without a value has a row with ``n = 0``, and NULLs.
    A single column has ``other_name = ''``.
    """
    aggs = []
    for c in cols:
        x = _finite(df, c)
        m2 = F.var_pop(x) * F.count(x)
        # skewness is m3 / m2^1.5 * sqrt(n), NULL or NaN where there is no spread
        m3 = F.when(m2 > 0, F.skewness(x) * F.pow(m2, F.lit(1.5)) / F.sqrt(F.count(x).cast("double"))).otherwise(F.lit(0.0))
        aggs.append(F.struct(F.lit(c).alias("column_name"), F.lit("").alias("other_name"), F.count(x).alias("n"),
                             F.avg(x).alias("mean"), m2.alias("m2"), F.when(F.count(x) > 0, m3).alias("m3"),
                             F.min(x).alias("min"), F.max(x).alias("max"), F.lit(None).cast("double").alias("other_mean"),
                             F.lit(None).cast("double").alias("other_m2"), F.lit(None).cast("double").alias("co")))
    for a, b in pairs:
        both = _finite(df, a).isNotNull() & _finite(df, b).isNotNull()
        x, y = F.when(both, _finite(df, a)), F.when(both, _finite(df, b))
        aggs.append(F.struct(F.lit(a).alias("column_name"), F.lit(b).alias("other_name"), F.count(x).alias("n"),
                             F.avg(x).alias("mean"), (F.var_pop(x) * F.count(x)).alias("m2"),
                             F.lit(None).cast("double").alias("m3"), F.min(x).alias("min"), F.max(x).alias("max"),
                             F.avg(y).alias("other_mean"), (F.var_pop(y) * F.count(y)).alias("other_m2"),
                             (F.covar_pop(x, y) * F.count(x)).alias("co")))
    row = df.groupBy(*by).agg(F.array(*aggs).alias("__s"))
    return row.select(*by, F.explode("__s").alias("__s")).select(*by, "__s.*")


def merge_states(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One state for each column (pair) and value of ``by`` out of any number
    of states, of files or of days: means are weighted, and each state's sums
    are moved from its own mean to the common one. Rows with ``n = 0`` add
    nothing; all states must be of disjoint rows."""
    keys = [*by, "column_name", "other_name"]
    some = F.col("n") > 0
    total = F.sum("n").cast("double")
    centre = states.groupBy(*keys).agg(
        F.try_divide(F.sum(F.when(some, F.col("n") * F.col("mean"))), total).alias("__m"),
        F.try_divide(F.sum(F.when(some, F.col("n") * F.col("other_mean"))), total).alias("__o"))
    # null-safe on the names of the groups, whose value may be NULL
    left, right = states.alias("s"), centre.alias("c")
    same = None
    for c in keys:
        one = F.col(f"s.`{c}`").eqNullSafe(F.col(f"c.`{c}`"))
        same = one if same is None else same & one
    moved = left.join(right, same).select("s.*", "c.__m", "c.__o")
    dx, dy, n = F.col("mean") - F.col("__m"), F.col("other_mean") - F.col("__o"), F.col("n")
    return moved.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.max("__m").alias("mean"), F.sum(F.col("m2") + n * dx * dx).alias("m2"),
        F.sum(F.col("m3") + 3 * dx * F.col("m2") + n * dx * dx * dx).alias("m3"), F.min("min").alias("min"),
        F.max("max").alias("max"), F.max("__o").alias("other_mean"),
        F.sum(F.col("other_m2") + n * dy * dy).alias("other_m2"), F.sum(F.col("co") + n * dx * dy).alias("co"))


def state_statistics(state: DataFrame) -> DataFrame:
    """The usual numbers of a state: ``n, mean, stddev, skewness, min, max``
    of columns, ``corr`` and ``slope`` (of the first on the second) of pairs;
    NULL where undefined."""
    n, spread = F.col("n").cast("double"), F.col("m2") > 0
    return state.select(
        *[c for c in state.columns if c not in STATE], "column_name", "other_name", "n", "mean",
        F.when(n > 1, F.sqrt(F.try_divide(F.col("m2"), n - 1))).alias("stddev"),
        F.when(spread, F.sqrt(n) * F.col("m3") / F.pow("m2", F.lit(1.5))).alias("skewness"), "min", "max",
        F.try_divide(F.col("co"), F.sqrt(F.col("m2") * F.col("other_m2"))).alias("corr"),
        F.try_divide(F.col("co"), F.col("other_m2")).alias("slope"))


def _of(state: DataFrame, c: str) -> Column:
    """The statistics of one column as a scalar-subquery struct. A state with
    two rows for it was not merged, and fails."""
    return scalar_struct(state_statistics(state).where((F.col("column_name") == c) & (F.col("other_name") == "")))


def sigma_filter_by_state(df: DataFrame, state: DataFrame, c: str, k: float = 3.0) -> DataFrame:
    """D3 with the stored statistics: rows within ``k`` standard deviations of
    the mean (open interval); missing values go."""
    s = _of(state, c)
    x = without_nan(df, c)
    return df.where((x < s["mean"] + k * s["stddev"]) & (x > s["mean"] - k * s["stddev"]))


def min_max_scale_by_state(df: DataFrame, state: DataFrame, cols: Sequence[str], prefix: str = "scaled_") -> DataFrame:
    """E2 with the stored bounds: ``(x - min) / (max - min)``; NULL for a
    missing value or a column without a spread. Rows newer than the state may
    lie outside 0 to 1."""
    out = {}
    for c in cols:
        s = _of(state, c)
        out[f"{prefix}{c}"] = F.try_divide(without_nan(df, c).cast("double") - s["min"], s["max"] - s["min"])
    return df.withColumns(out)
