"""Queries for SURVEY 2.5 (scaling)."""

from __future__ import annotations

from ..catalog import Tables, hu, register
from ..functions.scalar import half_up
from ..operators import scale


@register("log_transform", sql=f"""
    SELECT o_orderkey, {hu('ln(o_totalprice)', 9)} AS log_price FROM orders
""")
def log_transform(spark, sf_dir):
    """Natural log of the price."""
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_totalprice")
    out = scale.log_transform(o, "o_totalprice", "log_price")
    return out.select("o_orderkey", half_up("log_price", 9).alias("log_price"))


from pyspark.sql import functions as F  # noqa: E402

from .common import LISTINGS_SQL, listings  # noqa: E402


@register("percent_scale", sql=f"""
    WITH l AS ({LISTINGS_SQL}),
         s AS (SELECT min(days_on_market) AS lo, max(days_on_market) AS hi FROM l)
    SELECT l_orderkey, l_linenumber, days_on_market,
           round((CAST(days_on_market - lo AS DOUBLE) / CAST(hi - lo AS DOUBLE)) * 100.0, 0) AS percentage_scaled_days
    FROM l, s
""")
def percent_scale(spark, sf_dir):
    """Days on market on a 0..100 scale."""
    lst = listings(Tables(spark, sf_dir), ["l_orderkey", "l_linenumber", "days_on_market"])
    return scale.percent_scale(lst, "days_on_market", "percentage_scaled_days")


@register("percent_scale_round_first", sql=f"""
    WITH l AS ({LISTINGS_SQL}),
         s AS (SELECT min(days_on_market) AS lo, max(days_on_market) AS hi FROM l)
    SELECT l_orderkey, l_linenumber, days_on_market,
           round(CAST(days_on_market - lo AS DOUBLE) / CAST(hi - lo AS DOUBLE), 0) * 100.0 AS percentage_scaled_days
    FROM l, s
""")
def percent_scale_round_first(spark, sf_dir):
    """E1 as the reference wrote it (round, then times 100)."""
    lst = listings(Tables(spark, sf_dir), ["l_orderkey", "l_linenumber", "days_on_market"])
    return scale.percent_scale_round_first(lst, "days_on_market", "percentage_scaled_days")


MINMAX_COLS = ["l_quantity", "l_extendedprice", "l_linenumber"]


@register("min_max_scale", sql="""
    WITH s AS (SELECT """ + ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in MINMAX_COLS) + """
               FROM lineitem)
    SELECT l_orderkey, l_linenumber AS line, """ + ", ".join(
    f"CAST({c} - lo_{c} AS DOUBLE) / CAST(hi_{c} - lo_{c} AS DOUBLE) AS scaled_{c}" for c in MINMAX_COLS) + """
    FROM lineitem, s
""")
def min_max_scale(spark, sf_dir):
    """Three columns scaled to [0, 1] with one statistics pass."""
    li = Tables(spark, sf_dir).lineitem.select("l_orderkey", F.col("l_linenumber").alias("line"),
                                               *MINMAX_COLS)
    out = scale.min_max_scale(li, MINMAX_COLS)
    return out.select("l_orderkey", "line", *[f"scaled_{c}" for c in MINMAX_COLS])


@register("reflect_log", sql=f"""
    WITH y AS (SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS order_year FROM orders),
         s AS (SELECT max(order_year) AS mx FROM y)
    SELECT o_orderkey, order_year, (mx + 1) - order_year AS reflected_year,
           {hu('CASE WHEN ln((mx + 1) - order_year) = 0 THEN NULL ELSE 1.0 / ln((mx + 1) - order_year) END', 9)}
               AS adj_year
    FROM y, s
""")
def reflect_log(spark, sf_dir):
    """Reflect the order year and take 1/ln (the max year gives NULL)."""
    o = Tables(spark, sf_dir).orders.select("o_orderkey", F.year("o_orderdate").alias("order_year"))
    out = scale.reflect_log(o, "order_year", "reflected_year", "adj_year")
    return out.withColumn("adj_year", half_up("adj_year", 9))
