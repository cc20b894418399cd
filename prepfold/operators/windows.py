"""Lag features and report-gap audits.

``lag`` over ``Window.orderBy(date)`` without ``partitionBy`` moves every
row into one task. Here the rows are dealt by ranges of the order
(``plans.quantiles.lag_rows``), so the work spreads over the cluster whatever
the size of the frame or of one partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.quantiles import lag_rows


def lag_feature(df: DataFrame, order_col: str, out_col: str, partition_cols: Sequence[str] = (),
                value_col: str | None = None, offset: int = 1) -> DataFrame:
    """H1: ``out_col`` = ``value_col`` (by default ``order_col`` itself)
    ``offset`` rows before, in the order of ``order_col`` within
    ``partition_cols``."""
    return lag_rows(df, value_col or order_col, order_col, out_col, partition_cols, offset)


def report_gap_audit(df: DataFrame, date_col: str, partition_cols: Sequence[str] = (),
                     out_col: str = "days_between_report") -> DataFrame:
    """H2: distribution of the gaps between consecutive report dates:
    ``(*partition_cols, days_between_report, n_reports)``. The first date of
    each partition has a NULL gap; rows without a date are no report. A
    weekly series shows a single gap of 7.
    """
    p = list(partition_cols)
    dates = df.where(F.col(date_col).isNotNull()).select(*p, date_col).distinct()
    before = lag_rows(dates, date_col, date_col, "__before", p)
    gaps = before.select(*p, F.datediff(F.col(date_col), F.col("__before")).alias(out_col))
    return gaps.groupBy(*p, out_col).agg(F.count(F.lit(1)).alias("n_reports"))
