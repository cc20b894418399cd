"""Queries for SURVEY 2.4 (cleaning)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .fixed import MAX_MISSING_SHARE, MIN_OBSERVATIONS, SIGMA_WIDTH
from ..catalog import Tables, hu, register
from ..functions.scalar import half_up
from ..operators import clean
from ..plans.stats import to_long
from ..operators.features import discover_values
from .common import priced_orders


@register("sigma_filter", headline=True, sql=f"""
    WITH p AS (SELECT o_orderkey, o_totalprice, ln(o_totalprice) AS log_price FROM orders),
         s AS (SELECT avg(log_price) AS m, stddev_samp(log_price) AS sd FROM p)
    SELECT o_orderkey, o_totalprice, {hu('log_price', 9)} AS log_price
    FROM p, s
    WHERE log_price < m + 3 * sd AND log_price > m - 3 * sd
""")
def sigma_filter(spark, sf_dir):
    """D3 on E4: orders whose log price lies strictly within 3 sigma."""
    p = priced_orders(Tables(spark, sf_dir)).select("o_orderkey", "o_totalprice", "log_price")
    kept = clean.sigma_filter(p, "log_price", SIGMA_WIDTH)
    return kept.select("o_orderkey", "o_totalprice", half_up("log_price", 9).alias("log_price"))


from .common import DOCS_LABELED_SQL, docs_labeled  # noqa: E402


@register("drop_columns", sql="SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders")
def drop_columns(spark, sf_dir):
    """Drop two columns (the scan then never reads them)."""
    o = Tables(spark, sf_dir).orders
    return clean.drop_columns(o, ["o_orderstatus", "o_orderpriority"])


@register("exclude_values", sql=f"""
    SELECT doc_id, quality, toxic FROM ({DOCS_LABELED_SQL}) j
    WHERE toxic NOT IN (1) OR toxic IS NULL
""")
def exclude_values(spark, sf_dir):
    """Drop toxic documents, keep the unlabeled (NULL) ones."""
    j = docs_labeled(Tables(spark, sf_dir)).select("doc_id", "quality", "toxic")
    return clean.exclude_values(j, "toxic", [1], keep_null=True)


@register("impute_mean", sql=f"""
    WITH j AS ({DOCS_LABELED_SQL}),
         s AS (SELECT avg(quality) AS mq, avg(toxic) AS mt FROM j)
    SELECT doc_id, {hu('coalesce(CAST(quality AS DOUBLE), mq)', 9)} AS quality,
           {hu('coalesce(CAST(toxic AS DOUBLE), mt)', 9)} AS toxic
    FROM j, s
""")
def impute_mean(spark, sf_dir):
    """Mean imputation of the label columns (as double)."""
    j = docs_labeled(Tables(spark, sf_dir), ["doc_id", "quality", "toxic"])
    out = clean.impute_mean(j, ["quality", "toxic"])
    return out.select("doc_id", half_up("quality", 9).alias("quality"),
                      half_up("toxic", 9).alias("toxic"))


@register("impute_median", sql=f"""
    WITH j AS ({DOCS_LABELED_SQL}),
         s AS (SELECT median(CAST(quality AS DOUBLE)) AS mq, median(CAST(toxic AS DOUBLE)) AS mt FROM j)
    SELECT doc_id, coalesce(CAST(quality AS DOUBLE), mq) AS quality,
           coalesce(CAST(toxic AS DOUBLE), mt) AS toxic
    FROM j, s
""")
def impute_median(spark, sf_dir):
    """Exact median imputation of the label columns."""
    j = docs_labeled(Tables(spark, sf_dir), ["doc_id", "quality", "toxic"])
    return clean.impute_median(j, ["quality", "toxic"])


MEDIAN_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("column_medians", sql="\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, {hu(f'median({c})', 6)} AS median FROM lineitem"
    for c in MEDIAN_COLS))
def column_medians(spark, sf_dir):
    """D5's statistic on its own: exact medians of four columns in one
    distributed job."""
    m = clean.column_medians(Tables(spark, sf_dir).lineitem, MEDIAN_COLS)
    return m.withColumn("median", half_up("median", 6))


@register("impute_constant", sql=f"""
    SELECT doc_id, coalesce(quality, -1) AS quality, coalesce(toxic, -1) AS toxic
    FROM ({DOCS_LABELED_SQL}) j
""")
def impute_constant(spark, sf_dir):
    """Sentinel -1 for missing label values."""
    j = docs_labeled(Tables(spark, sf_dir)).select("doc_id", "quality", "toxic")
    return clean.impute_constant(j, -1, ["quality", "toxic"])


DOC_COLS = ["doc_id", "lang", "source", "n_chars", "quality", "toxic"]


@register("drop_sparse_columns", sql=f"""
    WITH j AS ({DOCS_LABELED_SQL}),
         c AS (""" + "\nUNION ALL\n".join(
    f"SELECT {i} AS position, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count, "
    "count(*) AS total FROM j" for i, c in enumerate(DOC_COLS)) + f""")
    SELECT position, column_name, null_count, total,
           CAST(null_count AS DOUBLE) / total AS null_share,
           coalesce(CAST(null_count AS DOUBLE) / total > {MAX_MISSING_SHARE}, false) AS dropped
    FROM c
""")
def drop_sparse_columns(spark, sf_dir):
    """Which columns are more than 60% missing (the drop decision)."""
    return clean.null_share_report(docs_labeled(Tables(spark, sf_dir)), MAX_MISSING_SHARE)


@register("drop_low_obs", sql=f"""
    SELECT row_number() OVER (ORDER BY p_size) - 1 AS position, 'size_' || p_size AS column_name,
           count(*) AS obs_count, count(*) <= {MIN_OBSERVATIONS} AS dropped
    FROM part WHERE p_size IS NOT NULL GROUP BY p_size
""")
def drop_low_obs(spark, sf_dir):
    """Binary indicators of the table's sizes with at most 30 ones."""
    part = Tables(spark, sf_dir).part
    sizes = discover_values(part, "p_size")
    flags = part.select("p_partkey", *[(F.col("p_size") == k).cast("int").alias(f"size_{k}") for k in sizes])
    rep = clean.low_observation_report(flags, [f"size_{k}" for k in sizes], MIN_OBSERVATIONS)
    return rep.select(F.col("position").cast("bigint").alias("position"), "column_name",
                      F.col("obs_count").cast("bigint").alias("obs_count"), "dropped")


@register("drop_sparse_columns_applied", sql="""
    SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity > 20 THEN l_extendedprice END AS often_known FROM lineitem
""")
def drop_sparse_columns_applied(spark, sf_dir):
    """The columns that are more than 60% missing are gone (a price known
    for one line in ten); one known more often stays."""
    price = F.col("l_extendedprice")
    li = Tables(spark, sf_dir).lineitem.select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_quantity") > 45, price).alias("rarely_known"),
        F.when(F.col("l_quantity") > 20, price).alias("often_known"))
    return clean.drop_sparse_columns(li, MAX_MISSING_SHARE)


@register("drop_low_obs_applied", sql="""
    SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS is_returned FROM lineitem
""")
def drop_low_obs_applied(spark, sf_dir):
    """An indicator without 30 ones is gone, the others stay."""
    li = Tables(spark, sf_dir).lineitem.select(
        "l_orderkey", "l_linenumber", (F.col("l_returnflag") == "R").cast("int").alias("is_returned"),
        (F.col("l_quantity") > 1000).cast("int").alias("is_huge"))
    return clean.drop_low_observation_columns(li, ["is_returned", "is_huge"], MIN_OBSERVATIONS)


@register("zero_fill", sql="""
    WITH v AS (SELECT DISTINCT l_returnflag AS flag FROM lineitem WHERE l_returnflag IS NOT NULL),
         n AS (SELECT l_partkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY l_partkey, l_returnflag)
    SELECT p.p_partkey, v.flag AS column_name, coalesce(n.n, 0) AS value
    FROM part p CROSS JOIN v LEFT JOIN n ON n.l_partkey = p.p_partkey AND n.l_returnflag = v.flag
""")
def zero_fill(spark, sf_dir):
    """Pivoted counts joined back to every part, zero-filled on the
    pivoted columns only; the flags are the table's."""
    t = Tables(spark, sf_dir)
    flags = discover_values(t.lineitem, "l_returnflag")
    piv = (t.lineitem.groupBy("l_partkey").pivot("l_returnflag", flags)
           .agg(F.count(F.lit(1))).withColumnRenamed("l_partkey", "p_partkey"))
    joined = t.part.select("p_partkey").join(piv, on="p_partkey", how="left")
    # The columns are the table's flags, which static SQL cannot name: rows (id, column, value).
    return to_long(clean.zero_fill(joined, flags), flags, ids=["p_partkey"])


@register("null_out_outlier", sql=f"""
    SELECT l_orderkey, l_linenumber,
           {hu("CASE WHEN l_quantity / (l_extendedprice / 1000) > 1.0 THEN NULL ELSE l_quantity / (l_extendedprice / 1000) END", 9)}
               AS qty_per_1000
    FROM lineitem
""")
def null_out_outlier(spark, sf_dir):
    """A compound ratio with values above 1.0 overwritten by NULL."""
    from ..functions.scalar import safe_div
    li = Tables(spark, sf_dir).lineitem
    r = li.select("l_orderkey", "l_linenumber",
                  safe_div("l_quantity", F.col("l_extendedprice") / 1000).alias("qty_per_1000"))
    out = clean.null_out_above(r, "qty_per_1000", 1.0)
    return out.withColumn("qty_per_1000", half_up("qty_per_1000", 9))
