"""Audited joins.

Only equi left joins occur in the reference. The physical strategy is left
to Spark: AQE turns a sort-merge join into a broadcast join only when the
runtime size of a side is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``
(a checked size), and splits skewed partitions otherwise. Keys are joined by
name so each key column appears once in the result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.stats import attach, cut_lineage
from ..sources.parquet import register_view


def align_keys(df: DataFrame, round_keys: Sequence[str], digits: int) -> DataFrame:
    """Cast ``round_keys`` to double (bad text -> NULL) and round them to
    ``digits`` places (``round``: half away from zero in decimal)."""
    return df.withColumns({k: F.round(F.col(k).try_cast("double"), digits) for k in round_keys})


def precision_join(df: DataFrame, lookup: DataFrame, round_keys: Sequence[str],
                   exact_keys: Sequence[str] = (), digits: int = 5,
                   how: str = "left") -> DataFrame:
    """F1: join on keys brought to the same type and precision on both sides.

    The reference rounds only the left side; here both sides are cast and
    rounded, so the join holds whatever precision the lookup was stored in.
    ``exact_keys`` are cast to the left side's types; a lookup value that is
    none of that type is NULL and matches nothing.
    """
    left = align_keys(df, round_keys, digits)
    right = align_keys(lookup, round_keys, digits)
    types = dict(df.dtypes)
    right = right.withColumns({k: F.col(k).try_cast(types[k]) for k in exact_keys})
    return left.join(right, on=list(exact_keys) + list(round_keys), how=how)


def sql_left_join(df: DataFrame, lookup: DataFrame, keys: Sequence[str]) -> DataFrame:
    """the same left join written as SQL text over temp views.

    ``SELECT *`` would return both copies of each key (and a frame that
    cannot be written); the select list names the left columns and the
    lookup's non-key columns.
    """
    spark = df.sparkSession
    lv, rv = register_view(df), register_view(lookup)
    right_cols = [c for c in lookup.columns if c not in keys]
    select = ", ".join([f"l.`{c}`" for c in df.columns] + [f"r.`{c}`" for c in right_cols])
    cond = " AND ".join(f"l.`{k}` = r.`{k}`" for k in keys)
    out = spark.sql(f"SELECT {select} FROM {lv} l LEFT JOIN {rv} r ON {cond}")
    # The views are resolved into the plan at analysis; drop them so repeated
    # calls do not fill the session catalog.
    spark.catalog.dropTempView(lv)
    spark.catalog.dropTempView(rv)
    return out


def _key_counts(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Rows per key value (partial aggregation before the shuffle, so a hot
    key costs one row per task)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def _join_size(lc: DataFrame, rc: DataFrame, keys: list[str]) -> DataFrame:
    """One row ``(n_left, n_rows, n_unmatched, n_dup_right_keys)`` from rows
    per key of both sides (``__lc``, ``__rc``)."""
    # NULL keys are grouped but never equal in the join: they stay unmatched.
    j = lc.join(rc, on=keys, how="left")
    left = j.agg(F.sum("__lc").alias("n_left"),
                 F.sum(F.col("__lc") * F.coalesce(F.col("__rc"), F.lit(1))).alias("n_rows"),
                 F.coalesce(F.sum(F.when(F.col("__rc").isNull(), F.col("__lc"))), F.lit(0)).alias("n_unmatched"))
    dups = rc.agg(F.count_if(F.col("__rc") > 1).alias("n_dup_right_keys"))
    return attach(left, dups).select(
        F.coalesce(F.col("n_left"), F.lit(0)).cast("long").alias("n_left"),
        F.coalesce(F.col("n_rows"), F.lit(0)).cast("long").alias("n_rows"),
        F.col("n_unmatched").cast("long").alias("n_unmatched"),
        F.col("n_dup_right_keys").cast("long").alias("n_dup_right_keys"))


def left_join_counts(df: DataFrame, lookup: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row ``(n_left, n_rows, n_unmatched, n_dup_right_keys)`` describing
    ``df LEFT JOIN lookup USING (keys)`` without running the join itself.

    Both sides are reduced to rows per key; the result size of the left join
    is ``sum(left_rows * coalesce(right_rows, 1))`` and a left key without a
    right row is unmatched (NULL keys never match). No pair of rows is ever
    emitted, so a hot key on both sides costs two counts, not their product.
    """
    keys = list(keys)
    return _join_size(_key_counts(df, keys, "__lc"), _key_counts(lookup, keys, "__rc"), keys)


def join_audit(df: DataFrame, lookup: DataFrame, variants: Mapping[str, Mapping[str, Column] | Sequence[str]]) -> DataFrame:
    """``(variant, n_left, n_rows, n_unmatched, n_dup_right_keys)`` for
    several ways of left-joining the same two frames.

    A variant names its keys, e.g. too few of them (F4: ``n_rows > n_left``
    because lookup keys repeat), or maps each key to what the left side puts
    in its place, an expression over the left key columns, e.g. its rounded
    value (F3: keys at the wrong precision leave many rows unmatched). Each
    frame is read once: rows are counted per full key, written, and every
    variant sums these counts up; none materialises its join.
    """
    named = {name: dict(v) if isinstance(v, Mapping) else {k: F.col(k) for k in v} for name, v in variants.items()}
    every = list(dict.fromkeys(k for keys in named.values() for k in keys))
    left = cut_lineage(_key_counts(df, every, "__n"))
    right = cut_lineage(_key_counts(lookup, every, "__n"))
    out = None
    for name, keys in named.items():
        lc = (left.select(*[c.alias(k) for k, c in keys.items()], "__n")
              .groupBy(*keys).agg(F.sum("__n").alias("__lc")))
        rc = right.groupBy(*keys).agg(F.sum("__n").alias("__rc"))
        part = _join_size(lc, rc, list(keys)).select(F.lit(name).alias("variant"), "*")
        out = part if out is None else out.unionByName(part)
    return out


def unmatched_audit(df: DataFrame, lookup: DataFrame,
                    variants: Mapping[str, Mapping[str, Column] | Sequence[str]]) -> DataFrame:
    """``(variant, n_rows, n_unmatched)``."""
    return join_audit(df, lookup, variants).select("variant", "n_rows", "n_unmatched")


def fanout_audit(df: DataFrame, lookup: DataFrame, variants: Mapping[str, Sequence[str]]) -> DataFrame:
    """``(variant, n_left, n_rows, n_dup_right_keys)`` for the same
    frames joined on different key sets."""
    return join_audit(df, lookup, variants).select("variant", "n_left", "n_rows", "n_dup_right_keys")


def prior_period_join(df: DataFrame, lookup: DataFrame, key: str, date_col: str,
                      lookup_key: str, lookup_year: str, shift: int = 1,
                      year_col: str = "list_year", report_col: str = "report_year") -> DataFrame:
    """attach the lookup row of the period before the row's own year.

    ``report_year = year(date) - shift`` joined with ``(lookup_key,
    lookup_year)``: only figures published before the row's period are
    used (no leakage from the same year). An equi join on a shifted key.
    """
    left = df.withColumn(year_col, F.year(date_col)) \
        .withColumn(report_col, F.col(year_col) - F.lit(shift))
    right = lookup.withColumnRenamed(lookup_key, key).withColumnRenamed(lookup_year, report_col)
    return left.join(right, on=[key, report_col], how="left")
