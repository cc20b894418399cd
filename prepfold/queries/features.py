"""Queries for SURVEY 2.10-2.12 (arithmetic, date, text features) and the
token pivot of 2.7 (G5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .fixed import ACRES_TO_SQFT
from ..catalog import Tables, hu, register
from ..functions.scalar import half_up
from ..operators import features
from ..plans.stats import to_long


def _lines(spark, sf_dir):
    return Tables(spark, sf_dir).lineitem


@register("unit_convert", sql=f"""
    SELECT l_orderkey, l_linenumber, l_quantity * {ACRES_TO_SQFT} AS lot_size_sqft FROM lineitem
""")
def unit_convert(spark, sf_dir):
    """K1: quantity times 43560 (acres to square feet)."""
    li = _lines(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_quantity")
    return features.unit_convert(li, "l_quantity", ACRES_TO_SQFT, "lot_size_sqft") \
        .select("l_orderkey", "l_linenumber", "lot_size_sqft")


@register("difference_feature", sql=f"""
    SELECT l_orderkey, l_linenumber, l_quantity * {ACRES_TO_SQFT} - l_extendedprice AS yard_size FROM lineitem
""")
def difference_feature(spark, sf_dir):
    """K2: a derived column minus another."""
    li = _lines(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    li = features.unit_convert(li, "l_quantity", ACRES_TO_SQFT, "lot_size_sqft")
    return features.difference(li, "lot_size_sqft", "l_extendedprice", "yard_size") \
        .select("l_orderkey", "l_linenumber", "yard_size")


def _div_sql(a, b):
    return f"CASE WHEN {b} = 0 THEN NULL ELSE CAST({a} AS DOUBLE) / {b} END"


RATIOS = {"unit_price": ("l_extendedprice", "l_quantity"),
          "tax_to_discount": ("l_tax", "l_discount"),
          "line_to_quantity": ("l_linenumber", "l_quantity")}


@register("ratio_features", sql="SELECT l_orderkey, l_linenumber, " + ", ".join(
    f"{hu(_div_sql(a, b), 9)} AS {out}" for out, (a, b) in RATIOS.items()) + " FROM lineitem")
def ratio_features(spark, sf_dir):
    """K3: three ratios; a zero divisor gives NULL instead of an error."""
    li = _lines(spark, sf_dir)
    out = features.ratios(li, RATIOS)
    return out.select("l_orderkey", "l_linenumber", *[half_up(c, 9).alias(c) for c in RATIOS])


@register("sum_feature", sql="""
    SELECT l_orderkey, l_linenumber, l_quantity + l_linenumber AS total_units FROM lineitem
""")
def sum_feature(spark, sf_dir):
    """K4."""
    li = _lines(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_quantity")
    return features.sum_feature(li, "l_quantity", "l_linenumber", "total_units") \
        .select("l_orderkey", "l_linenumber", "total_units")


@register("compound_ratio", sql=f"""
    SELECT l_orderkey, l_linenumber,
           {hu(_div_sql('l_linenumber', '(l_extendedprice / 1000)'), 9)} AS lines_per_1000
    FROM lineitem
""")
def compound_ratio(spark, sf_dir):
    """K5: a count per 1000 units of another column."""
    li = _lines(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_extendedprice")
    out = features.per_unit(li, "l_linenumber", "l_extendedprice", 1000.0, "lines_per_1000")
    return out.select("l_orderkey", "l_linenumber", half_up("lines_per_1000", 9).alias("lines_per_1000"))


@register("parse_date", sql="""
    SELECT o_orderkey,
           CAST(CAST(try_strptime(strftime(o_orderdate, '%Y-%m-%d'), '%Y-%m-%d') AS DATE) AS VARCHAR) AS list_date,
           CAST(TRY_CAST(o_orderpriority AS DATE) AS VARCHAR) AS bad_date
    FROM orders
""")
def parse_date(spark, sf_dir):
    """Date text to date; text that is no date gives NULL."""
    o = Tables(spark, sf_dir).orders.select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("list_date"),
        F.col("o_orderpriority").alias("bad_date"))
    o = features.to_date_column(o, "list_date", "yyyy-MM-dd")
    o = features.to_date_column(o, "bad_date")
    return o.select("o_orderkey", *[F.col(c).cast("string").alias(c) for c in ("list_date", "bad_date")])


@register("day_of_week", sql="""
    SELECT o_orderkey, CAST(dayofweek(o_orderdate) + 1 AS BIGINT) AS list_day_of_week FROM orders
""")
def day_of_week(spark, sf_dir):
    """Sunday=1 .. Saturday=7."""
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_orderdate")
    out = features.day_of_week_column(o, "o_orderdate", "list_day_of_week")
    return out.select("o_orderkey", F.col("list_day_of_week").cast("bigint"))


@register("text_flag", sql="""
    SELECT p_partkey, p_name,
           CASE WHEN p_name LIKE '%blue%' THEN 1 WHEN p_name LIKE '%red%' THEN 0 ELSE NULL END AS is_blue
    FROM part
""")
def text_flag(spark, sf_dir):
    """1 for blue, 0 for red, NULL otherwise."""
    p = Tables(spark, sf_dir).part.select("p_partkey", "p_name")
    return features.text_flag(p, "p_name", "%blue%", "%red%", "is_blue")


@register("split_list", sql="SELECT p_partkey, CAST(to_json(string_split(p_name, ' ')) AS VARCHAR) AS name_tokens FROM part")
def split_list(spark, sf_dir):
    """I2."""
    p = Tables(spark, sf_dir).part.select("p_partkey", "p_name")
    out = features.split_list(p, "p_name", " ", "name_tokens")
    return out.select("p_partkey", F.to_json("name_tokens").alias("name_tokens"))


def _tokens(spark, sf_dir):
    p = Tables(spark, sf_dir).part.select("p_partkey", "p_name")
    p = features.split_list(p, "p_name", " ", "name_tokens")
    return features.explode_list(p, "name_tokens", "token").select("p_partkey", "token")


@register("explode_tokens", sql="SELECT p_partkey, unnest(string_split(p_name, ' ')) AS token FROM part")
def explode_tokens(spark, sf_dir):
    """One row per name token."""
    return _tokens(spark, sf_dir)


@register("token_vocabulary", sql="""
    SELECT token, count(*) AS n_rows
    FROM (SELECT unnest(string_split(p_name, ' ')) AS token FROM part) GROUP BY token
""")
def token_vocabulary(spark, sf_dir):
    """I4."""
    return features.token_vocabulary(_tokens(spark, sf_dir), "token")


_TOKENS_SQL = "SELECT p_partkey, unnest(string_split(p_name, ' ')) AS token FROM part"
# The columns are the tokens of the table, as in the queries.
_MULTI_HOT_SQL = f"""
    WITH t AS (SELECT DISTINCT p_partkey, token FROM ({_TOKENS_SQL})),
         v AS (SELECT DISTINCT token FROM t WHERE token IS NOT NULL)
    SELECT p.p_partkey, 'name_' || v.token AS column_name,
           CAST(CASE WHEN t.token IS NULL THEN 0 ELSE 1 END AS BIGINT) AS value
    FROM part p CROSS JOIN v LEFT JOIN t ON t.p_partkey = p.p_partkey AND t.token = v.token
"""


def _vocabulary(spark, sf_dir):
    return features.discover_values(features.token_vocabulary(_tokens(spark, sf_dir), "token"), "token")


def _with_list(spark, sf_dir):
    p = Tables(spark, sf_dir).part.select("p_partkey", "p_name")
    return features.split_list(p, "p_name", " ", "name_tokens")


def _as_long(df):
    """The wide result as rows (id, column, value): its columns are the
    table's tokens, which static SQL cannot name."""
    values = [c for c in df.columns if c != "p_partkey"]
    wide = df.select("p_partkey", *[F.col(f"`{c}`").cast("bigint").alias(c) for c in values])
    return to_long(wide, [F.col(f"`{c}`") for c in values], ids=["p_partkey"])


@register("multi_hot", sql=_MULTI_HOT_SQL)
def multi_hot(spark, sf_dir):
    """One 0/1 column per name token of the table, computed per row (no
    shuffle)."""
    out = features.multi_hot(_with_list(spark, sf_dir), "name_tokens", _vocabulary(spark, sf_dir), prefix="name_")
    return _as_long(out.drop("p_name", "name_tokens"))


@register("multi_hot_long", sql=f"SELECT DISTINCT p_partkey, token, 1 AS present FROM ({_TOKENS_SQL})")
def multi_hot_long(spark, sf_dir):
    """I5 in sparse form: no vocabulary is gathered."""
    return features.multi_hot_long(_with_list(spark, sf_dir), "p_partkey", "name_tokens")


@register("multi_hot_pivot_join", sql=_MULTI_HOT_SQL)
def multi_hot_pivot_join(spark, sf_dir):
    """I5 with the reference's plan: explode, pivot by id, left join back on
    the id (F6), zero-fill the pivoted columns (D9)."""
    out = features.multi_hot(_with_list(spark, sf_dir), "name_tokens", _vocabulary(spark, sf_dir), prefix="name_",
                             id_col="p_partkey", strategy="pivot_join")
    return _as_long(out.drop("p_name", "name_tokens"))


@register("pivot_tokens", sql=f"""
    WITH t AS ({_TOKENS_SQL}), v AS (SELECT DISTINCT token FROM t WHERE token IS NOT NULL),
         d AS (SELECT DISTINCT p_partkey, token FROM t WHERE token IS NOT NULL)
    SELECT i.p_partkey, v.token AS column_name, CAST(CASE WHEN d.token IS NOT NULL THEN 1 END AS BIGINT) AS value
    FROM (SELECT DISTINCT p_partkey FROM d) i CROSS JOIN v
    LEFT JOIN d ON d.p_partkey = i.p_partkey AND d.token = v.token
""")
def pivot_tokens(spark, sf_dir):
    """Tokens pivoted by part key; the value list is the table's."""
    return _as_long(features.pivot_tokens(_tokens(spark, sf_dir), "p_partkey", "token", _vocabulary(spark, sf_dir)))
