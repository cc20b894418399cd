"""Stand-in frames shared by several queries (FIXTURES.md section 3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..catalog import Tables
from ..plans.stats import cut_lineage


def priced_orders(t: Tables) -> DataFrame:
    """Orders with the log of the price (the reference's log_SalesClosePrice)."""
    return t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate",
                           "o_orderpriority", F.ln("o_totalprice").alias("log_price"))


def listings(t: Tables, written: Sequence[str] = ()) -> DataFrame:
    """Lines as listings: listed on the order date, off market on the ship
    date (the stand-in data ship half the lines before the order; their days
    on market are negative).

    ``lineitem`` joins ``orders`` on its key (a sort-merge join at scale; AQE
    splits a skewed key). The columns named in ``written`` are written once
    (``cut_lineage``) for transforms that read them twice - a statistic and
    the rows - so the large join runs a single time.
    """
    o = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice",
                           "l_shipdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    out = j.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice",
                   "o_totalprice",
                   F.col("o_orderdate").cast("date").alias("list_date"),
                   F.col("l_shipdate").cast("date").alias("offmkt_date"),
                   F.datediff(F.col("l_shipdate").cast("date"),
                              F.col("o_orderdate").cast("date")).alias("days_on_market"))
    return cut_lineage(out.select(*written)) if written else out


LISTINGS_SQL = """
    SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, o_totalprice,
           CAST(o_orderdate AS DATE) AS list_date, CAST(l_shipdate AS DATE) AS offmkt_date,
           CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INTEGER)
               AS days_on_market
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""


def docs_labeled(t: Tables, written: Sequence[str] = ()) -> DataFrame:
    """Documents left-joined to labels: ``quality``/``toxic`` are NULL for
    unlabeled documents (the NULL-bearing stand-in). The columns named in
    ``written`` are written once for two-pass transforms (see ``listings``)."""
    d = t.documents.select("doc_id", "lang", "source", "n_chars")
    lab = t.labels.select("doc_id", "quality", "toxic")
    out = d.join(lab, on="doc_id", how="left")
    return cut_lineage(out.select(*written)) if written else out


DOCS_LABELED_SQL = """
    SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""
