"""Global aggregates in the reference's dict form.

``df.agg({'c': 'max'})`` names its output ``max(c)`` and computes one
function per column; ``global_aggregates`` takes several functions per
column, names every output ``<fn>_<column>`` and runs them all in one pass.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_FUNCS = {
    "mean": F.avg, "avg": F.avg, "stddev": F.stddev_samp, "stddev_pop": F.stddev_pop,
    "max": F.max, "min": F.min, "sum": F.sum, "count": F.count, "skewness": F.skewness,
    "kurtosis": F.kurtosis, "variance": F.var_samp,
}


def aggregate_expr(fn: str, c: str) -> Column:
    try:
        return _FUNCS[fn](F.col(c))
    except KeyError:
        raise ValueError(f"unknown aggregate {fn!r}; use one of {sorted(_FUNCS)}") from None


def global_aggregates(df: DataFrame, spec: Mapping[str, str | Sequence[str]]) -> DataFrame:
    """G1: one row with ``<fn>_<column>`` for every requested pair."""
    exprs = []
    for c, fns in spec.items():
        for fn in ([fns] if isinstance(fns, str) else list(fns)):
            exprs.append(aggregate_expr(fn, c).alias(f"{fn}_{c}"))
    return df.agg(*exprs)
