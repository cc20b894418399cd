"""Load validation and reports.

Reports are DataFrames, not console prints, so they can be joined, stored or
checked like any other result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.stats import one_row

PASSED = "Validation Passed"
FAILED = "Validation Failed"


def check_load(df: DataFrame, num_records: int, num_columns: int) -> DataFrame:
    """B1: one row ``(expected_records, actual_records, expected_columns,
    actual_columns, status)``; status passes only if both counts match."""
    actual_cols = len(df.columns)
    row = one_row(df, {"actual_records": F.count(F.lit(1))})
    ok = (F.col("actual_records") == F.lit(num_records)) & F.lit(actual_cols == num_columns)
    return row.select(F.lit(num_records).cast("long").alias("expected_records"),
                      "actual_records",
                      F.lit(num_columns).cast("int").alias("expected_columns"),
                      F.lit(actual_cols).cast("int").alias("actual_columns"),
                      F.when(ok, F.lit(PASSED)).otherwise(F.lit(FAILED)).alias("status"))


def check_load_message(df: DataFrame, num_records: int, num_columns: int) -> str:
    """B1 in the reference's form: the status string (one small action)."""
    return check_load(df, num_records, num_columns).first()["status"]


def check_dtypes(df: DataFrame, expected: Mapping[str, str]) -> DataFrame:
    """B2: compare ``df.dtypes`` with an expected ``{column: type}`` map.

    One row per column of either side: ``status`` is ``expected``,
    ``mismatch``, ``missing`` (expected but absent) or ``unchecked`` (present,
    not in the map). Schema only, no job runs.
    """
    actual = dict(df.dtypes)
    rows = []
    for name, dtype in df.dtypes:
        if name in expected:
            status = "expected" if expected[name] == dtype else "mismatch"
            rows.append((name, expected[name], dtype, status))
        else:
            rows.append((name, None, dtype, "unchecked"))
    for name, dtype in expected.items():
        if name not in actual:
            rows.append((name, dtype, None, "missing"))
    schema = T.StructType([T.StructField("column_name", T.StringType(), False),
                           T.StructField("expected_type", T.StringType(), True),
                           T.StructField("actual_type", T.StringType(), True),
                           T.StructField("status", T.StringType(), False)])
    return df.sparkSession.createDataFrame(rows, schema)


def summary_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Typed ``describe``: ``(position, column_name, count, mean, stddev,
    min, max)`` for numeric columns, all in one aggregate pass.

    ``describe()`` returns strings and skips timestamp columns; this keeps
    doubles. ``stddev`` is the sample deviation, as in ``describe``.
    """
    cols = list(cols)
    named = {}
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        named[f"__c{i}"] = F.count(x)
        named[f"__m{i}"] = F.avg(x)
        named[f"__s{i}"] = F.stddev_samp(x)
        named[f"__lo{i}"] = F.min(x)
        named[f"__hi{i}"] = F.max(x)
    row = one_row(df, named)
    items = [F.struct(F.lit(i).alias("position"), F.lit(c).alias("column_name"),
                      F.col(f"__c{i}").alias("count"), F.col(f"__m{i}").alias("mean"),
                      F.col(f"__s{i}").alias("stddev"), F.col(f"__lo{i}").alias("min"),
                      F.col(f"__hi{i}").alias("max"))
             for i, c in enumerate(cols)]
    return row.select(F.explode(F.array(*items)).alias("s")).select("s.*")


def shape_report(frames: Mapping[str, DataFrame]) -> DataFrame:
    """``(stage, n_rows, n_columns)`` for several frames, one action."""
    parts = [one_row(f, {"n_rows": F.count(F.lit(1))})
             .select(F.lit(stage).alias("stage"), "n_rows",
                     F.lit(len(f.columns)).cast("int").alias("n_columns"))
             for stage, f in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def conditional_counts(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """Total row count plus ``count_if`` of each condition, one pass."""
    named = {"n_rows": F.count(F.lit(1))}
    named.update({name: F.count_if(cond) for name, cond in conditions.items()})
    return one_row(df, named)


def preview(df: DataFrame, n: int, order_by: Sequence[str | Column]) -> DataFrame:
    """First ``n`` rows in a fixed order (``show(n)`` made deterministic).

    ``orderBy`` + ``limit`` plans as ``TakeOrderedAndProject``: each task
    keeps its own top ``n``, so no full sort happens.
    """
    return df.orderBy(*order_by).limit(n)
