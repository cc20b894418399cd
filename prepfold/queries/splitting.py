"""Queries for SURVEY 2.14 (time-aware splits)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from .fixed import TEST_DAYS
from ..catalog import Tables, register
from ..operators import split
from .common import LISTINGS_SQL, listings

def _dates_as_text(df):
    """Dates rendered as ISO text for the comparison (see ``catalog``)."""
    return df.withColumns({c: F.col(c).cast("string") for c in ("list_date", "offmkt_date")})


SPLIT_SQL = f"SELECT CAST(max(offmkt_date) - {TEST_DAYS} AS DATE) AS split_date FROM ({LISTINGS_SQL})"

# Fixed value: the as-of date of the leakage correction (a date literal, as
# in the reference), inside the driver data's order-date range.
AS_OF_DATE = dt.date(2000, 12, 10)


@register("split_date", sql=f"SELECT CAST(split_date AS VARCHAR) AS split_date FROM ({SPLIT_SQL})")
def split_date(spark, sf_dir):
    """Q1: last off-market date minus 45 days."""
    s = split.split_date(listings(Tables(spark, sf_dir)), "offmkt_date", TEST_DAYS)
    return s.select(F.col("split_date").cast("string").alias("split_date"))


def _label_sql(split_expr: str) -> str:
    return f"""
    WITH l AS ({LISTINGS_SQL}), s AS ({split_expr})
    SELECT l_orderkey, l_linenumber, CAST(list_date AS VARCHAR) AS list_date,
           CAST(offmkt_date AS VARCHAR) AS offmkt_date,
           CASE WHEN offmkt_date < split_date THEN 'train'
                WHEN offmkt_date >= split_date AND list_date <= split_date THEN 'test'
                ELSE 'neither' END AS split
    FROM l, s
"""


@register("time_split", sql=_label_sql(SPLIT_SQL))
def time_split(spark, sf_dir):
    """Q2: train / test / neither around the split date."""
    lst = listings(Tables(spark, sf_dir), ["l_orderkey", "l_linenumber", "list_date", "offmkt_date"])
    return _dates_as_text(
        split.label_split(lst, "list_date", "offmkt_date", split.split_date(lst, "offmkt_date", TEST_DAYS)))


@register("asof_days_open", sql=f"""
    SELECT l_orderkey, l_linenumber, CAST(list_date AS VARCHAR) AS list_date,
           CAST(offmkt_date AS VARCHAR) AS offmkt_date, days_on_market AS days_on_market_Original,
           CAST(date_diff('day', list_date, DATE '{AS_OF_DATE}') AS INTEGER) AS days_on_market
    FROM ({LISTINGS_SQL})
    WHERE offmkt_date >= DATE '{AS_OF_DATE}' AND list_date <= DATE '{AS_OF_DATE}'
""")
def asof_days_open(spark, sf_dir):
    """Q3: test rows as of a date, with days on market recomputed from what
    was known on that date."""
    lst = listings(Tables(spark, sf_dir)).select("l_orderkey", "l_linenumber", "list_date", "offmkt_date",
                                                 "days_on_market")
    _, test = split.train_test(lst, "list_date", "offmkt_date", AS_OF_DATE)
    return _dates_as_text(split.as_of_days(test, "list_date", "days_on_market", AS_OF_DATE))


@register("time_split_pct", sql=_label_sql(f"""
    SELECT CAST(lo + CAST(floor(date_diff('day', lo, hi) * 0.8) AS INTEGER) AS DATE) AS split_date
    FROM (SELECT min(list_date) AS lo, max(list_date) AS hi FROM ({LISTINGS_SQL}))
"""))
def time_split_pct(spark, sf_dir):
    """Q4: split at 80% of the listing-date span."""
    lst = listings(Tables(spark, sf_dir), ["l_orderkey", "l_linenumber", "list_date", "offmkt_date"])
    return _dates_as_text(
        split.label_split(lst, "list_date", "offmkt_date", split.pct_split_date(lst, "list_date", 0.8)))
