"""Exact quantiles and lags over an order, without a single-task bottleneck.

Spark's exact ``percentile``/``median`` keeps a map of every distinct value of
a group in one aggregation buffer, and a window without ``partitionBy``
moves every row into one partition. Both break when one group (or the whole
table) is large. Here the rows are dealt by Spark's own range partitioning on
(group, value): a large group is cut into ranges, small groups share one, and
no switch depends on sizes. The partition number is written with the rows, so
all steps after it, and any task that runs again, see the same ranges. What
is left per (group, range) is one row of counts, or the few rows at its
edges. Group columns may be NULL, which is a group like any other.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .stats import cut_lineage

RANGE = "__range"


def _in_ranges(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """``df`` dealt by ranges of ``order`` and written once with the number of
    each row's range; ranges rise with the order."""
    return cut_lineage(df.repartitionByRange(*[F.col(c) for c in order])
                       .withColumn(RANGE, F.spark_partition_id()))


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str], suffix: str) -> Column:
    """Null-safe equality of ``keys`` with the suffixed columns of ``right``."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k + suffix]) for k in keys])


def _renamed(df: DataFrame, suffix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(c + suffix) for c in df.columns])


def exact_quantile(df: DataFrame, value_col: str, q: float = 0.5,
                   group_cols: Sequence[str] = (), out_col: str = "quantile") -> DataFrame:
    """Exact interpolated quantile per group (``percentile`` semantics:
    position ``q * (n - 1)``, linear between the two neighbouring values).

    Values are reduced to distinct (group, value) counts before they are
    dealt; only the ranges that hold a group's target ranks are ranked value
    by value, the others are only counted. NULL values do not count; a group
    of NULL values only has a NULL quantile, as with the built-in.
    """
    if not 0.0 <= q <= 1.0:
        raise ValueError("q must be in [0, 1]")
    g = [f"__g{i}" for i in range(len(group_cols))] or ["__g0"]
    named = [F.col(c).alias(k) for c, k in zip(group_cols, g)] or [F.lit(0).alias("__g0")]
    counted = (df.select(*named, F.col(value_col).alias("__v"))
               .groupBy(*g, "__v").agg(F.count(F.lit(1)).alias("__c"))
               .withColumn("__c", F.when(F.col("__v").isNotNull(), F.col("__c")).otherwise(0)))
    values = _in_ranges(counted, [*g, "__v"])
    # One row per (group, range) it has values in.
    by_group = Window.partitionBy(*g)
    before = by_group.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    ranges = (values.groupBy(*g, RANGE).agg(F.sum("__c").alias("__rc"))
              .withColumn("__off", F.coalesce(F.sum("__rc").over(before), F.lit(0)))
              .withColumn("__n", F.sum("__rc").over(by_group)))
    pos = F.lit(q) * (F.col("__n") - 1).cast("double")
    low, high = F.floor(pos), F.ceil(pos)

    def covers(rank: Column, start: str, size: str) -> Column:
        return (F.col(start) <= rank) & (rank < F.col(start) + F.col(size))

    # The ranges with a target rank; a group without values keeps a row too.
    targets = ranges.where(covers(low, "__off", "__rc") | covers(high, "__off", "__rc") | (F.col("__n") == 0))
    t = _renamed(targets, "_t")
    within = Window.partitionBy(*g, RANGE).orderBy("__v").rowsBetween(Window.unboundedPreceding, -1)
    ranked = (values.join(t, _same(values, t, [*g, RANGE], "_t"))
              .withColumn("__before", F.col("__off_t") + F.coalesce(F.sum("__c").over(within), F.lit(0)))
              .withColumn("__n", F.col("__n_t")))
    v = F.col("__v").cast("double")
    picked = ranked.groupBy(*g).agg(
        F.max(F.when(covers(low, "__before", "__c"), v)).alias("__low"),
        F.max(F.when(covers(high, "__before", "__c"), v)).alias("__high"),
        F.first(pos).alias("__pos"))
    lo, hi = F.floor("__pos"), F.ceil("__pos")
    value = F.when(lo == hi, F.col("__low")).otherwise(
        (hi - F.col("__pos")) * F.col("__low") + (F.col("__pos") - lo) * F.col("__high"))
    return picked.select(*[F.col(k).alias(c) for c, k in zip(group_cols, g)], value.alias(out_col))


def lag_rows(df: DataFrame, value_col: str, order_col: str, out_col: str,
             partition_cols: Sequence[str] = (), offset: int = 1) -> DataFrame:
    """``df`` with ``out_col`` = the value of ``value_col`` ``offset`` rows
    before, in the order of ``order_col`` within ``partition_cols``
    (``Window.lag``; NULL order values come first, rows of equal order value
    are taken in the order of ``value_col``).

    Inside a range the lag is a window over that range; only its first
    ``offset`` rows look further back, at the last ``offset`` rows of the
    ranges before, which are joined by row number.
    """
    if offset < 1:
        raise ValueError("offset must be at least 1")
    p = list(partition_cols)
    order = list(dict.fromkeys([order_col, value_col]))
    rows = _in_ranges(df, [*p, *order])
    chunk = Window.partitionBy(*p, RANGE)
    forward = chunk.orderBy(*order)
    numbered = (rows.withColumn("__i", F.row_number().over(forward))
                .withColumn("__left", F.count(F.lit(1)).over(chunk) - F.col("__i"))
                .withColumn(out_col, F.lag(value_col, offset).over(forward)))
    inner = numbered.where(F.col("__i") > offset).select(*df.columns, out_col)
    # One row per (partition, range): rows of the partition in earlier ranges.
    by_partition = Window.partitionBy(*p) if p else Window.partitionBy(F.lit(0))
    before = by_partition.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = _renamed(rows.groupBy(*p, RANGE).agg(F.count(F.lit(1)).alias("__rc"))
                       .withColumn("__off", F.coalesce(F.sum("__rc").over(before), F.lit(0))), "_o")
    edges = numbered.where((F.col("__i") <= offset) | (F.col("__left") < offset))
    # A few rows a range, written once for both sides of the join.
    edges = cut_lineage(edges.join(offsets, _same(edges, offsets, [*p, RANGE], "_o"))
                        .withColumn("__i", F.col("__i"))
                        .withColumn("__at", F.col("__off_o") + F.col("__i")))
    heads = edges.where(F.col("__i") <= offset)
    tails = _renamed(edges.where(F.col("__left") < offset).select(
        *p, (F.col("__at") + offset).alias("__at"), F.col(value_col).alias("__lagged")), "_t")
    # heads' own window value is NULL: nothing of their range lies before.
    outer = heads.join(tails, _same(heads, tails, [*p, "__at"], "_t"), "left") \
        .select(*df.columns, F.col("__lagged_t").alias(out_col))
    return inner.unionByName(outer)
