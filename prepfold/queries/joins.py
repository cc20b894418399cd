"""Queries for SURVEY 2.6 (joins) and 2.8 (windows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import Tables, hu, register
from ..functions.scalar import half_up
from ..operators import joins, tolerance, windows
from ..plans.quantiles import exact_quantile
from ..plans.stats import cut_lineage


def walk_lookup(t: Tables):
    """Stand-in for the walk-score table: one row per (user, value rounded to
    one digit) with a score, keys stored as text like the reference's."""
    e = t.events.select("user_id", F.round("value", 1).alias("value"))
    g = e.groupBy("user_id", "value").agg(F.count(F.lit(1)).alias("walkscore"))
    return g.select(F.col("user_id").cast("string").alias("user_id"),
                    F.col("value").cast("string").alias("value"), "walkscore")


# DuckDB's own round on the decimal text of the double, as Spark's round works.
RK = "CAST(round(CAST(CAST(value AS VARCHAR) AS DECIMAL(38, 12)), 1) AS DOUBLE)"
RK_E = RK.replace("(value ", "(e.value ")

WALK_SQL = f"""
    SELECT user_id, {RK} AS value, count(*) AS walkscore
    FROM events GROUP BY 1, 2
"""


@register("precision_join", sql=f"""
    WITH w AS ({WALK_SQL})
    SELECT e.event_id, e.user_id, {RK_E} AS value, w.walkscore
    FROM events e LEFT JOIN w ON e.user_id = w.user_id AND {RK_E} = w.value
""")
def precision_join(spark, sf_dir):
    """events joined to the lookup on user and value at one digit."""
    t = Tables(spark, sf_dir)
    e = t.events.select("event_id", "user_id", "value")
    return joins.precision_join(e, walk_lookup(t), round_keys=["value"], exact_keys=["user_id"],
                                digits=1).select("event_id", "user_id", "value", "walkscore")


_APART = ("(a.value / 2.0 - b.value / 2.0) * (a.value / 2.0 - b.value / 2.0)"
          " + (a.hour / 6.0 - b.hour / 6.0) * (a.hour / 6.0 - b.hour / 6.0)")


@register("tolerance_join", sql=f"""
    WITH e AS (SELECT event_id, event_type, user_id, value,
                      CAST(epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01') AS DOUBLE) / 3600000000.0 AS hour FROM events),
         p AS (SELECT a.event_id, b.event_id AS near_id, sqrt({_APART}) AS d
               FROM e a JOIN e b ON a.user_id = b.user_id WHERE a.event_type = 'click' AND b.event_type = 'error'),
         n AS (SELECT * FROM p WHERE d <= 1.0 QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY d, near_id) = 1)
    SELECT a.event_id, n.near_id, {hu('n.d', 6)} AS distance
    FROM e a LEFT JOIN n ON a.event_id = n.event_id WHERE a.event_type = 'click'
""")
def tolerance_join(spark, sf_dir):
    """F1 without rounding: each click with its user's nearest error, at most
    6 hours and 2 of the value away."""
    start = F.lit("2024-01-01").cast("timestamp_ntz")
    e = Tables(spark, sf_dir).events.select(
        "event_id", "event_type", "user_id", "value",
        (F.timestamp_diff("MICROSECOND", start, F.col("ts").cast("timestamp_ntz")).cast("double")
         / F.lit(3600000000.0)).alias("hour"))
    errors = e.where("event_type = 'error'").withColumnRenamed("event_id", "near_id")
    out = tolerance.tolerance_join(e.where("event_type = 'click'"), errors, {"value": 2.0, "hour": 6.0},
                                   ["near_id"], ["near_id"], ["user_id"])
    return out.select("event_id", "near_id", half_up("distance", 6).alias("distance"))


@register("sql_left_join", sql=f"""
    WITH w AS ({WALK_SQL})
    SELECT e.event_id, e.user_id, {RK_E} AS value, w.walkscore
    FROM events e LEFT JOIN w ON e.user_id = w.user_id AND {RK_E} = w.value
""")
def sql_left_join(spark, sf_dir):
    """the same join as SQL text over temp views."""
    t = Tables(spark, sf_dir)
    e = joins.align_keys(t.events.select("event_id", "user_id", "value"), ["value"], 1)
    w = joins.align_keys(walk_lookup(t), ["value"], 1).withColumn("user_id", F.col("user_id").try_cast("bigint"))
    return joins.sql_left_join(e, w, ["user_id", "value"])


@register("join_audit_unmatched", sql=f"""
    WITH w AS ({WALK_SQL})
    SELECT 'raw_keys' AS variant, count(*) AS n_rows, count(*) FILTER (WHERE w.walkscore IS NULL) AS n_unmatched
    FROM events e LEFT JOIN w ON e.user_id = w.user_id AND e.value = w.value
    UNION ALL
    SELECT 'rounded_keys', count(*), count(*) FILTER (WHERE w.walkscore IS NULL)
    FROM events e LEFT JOIN w ON e.user_id = w.user_id AND {RK_E} = w.value
""")
def join_audit_unmatched(spark, sf_dir):
    """unmatched rows when the keys keep their raw precision against
    the join on aligned keys."""
    t = Tables(spark, sf_dir)
    e = t.events.select("event_id", "user_id", "value")
    w = joins.align_keys(walk_lookup(t), ["value"], 1).withColumn("user_id", F.col("user_id").try_cast("bigint"))
    return joins.unmatched_audit(e, w, {
        "raw_keys": ["user_id", "value"],
        "rounded_keys": {"user_id": F.col("user_id"), "value": F.round(F.col("value").try_cast("double"), 1)}})


@register("join_audit_fanout", sql=f"""
    WITH w AS ({WALK_SQL}),
         e AS (SELECT event_id, user_id, {RK} AS value FROM events)
    SELECT 'all_keys' AS variant, (SELECT count(*) FROM e) AS n_left,
           (SELECT count(*) FROM e LEFT JOIN w ON e.user_id = w.user_id AND e.value = w.value) AS n_rows,
           (SELECT count(*) FROM (SELECT user_id, value FROM w GROUP BY 1, 2 HAVING count(*) > 1)) AS n_dup_right_keys
    UNION ALL
    SELECT 'too_few_keys', (SELECT count(*) FROM e),
           (SELECT count(*) FROM e LEFT JOIN w ON e.user_id = w.user_id),
           (SELECT count(*) FROM (SELECT user_id FROM w GROUP BY 1 HAVING count(*) > 1))
""")
def join_audit_fanout(spark, sf_dir):
    """row counts of the join on all keys against the join on too few
    keys, with the duplicate lookup keys that cause the fan-out."""
    t = Tables(spark, sf_dir)
    e = joins.align_keys(t.events.select("event_id", "user_id", "value"), ["value"], 1)
    w = joins.align_keys(walk_lookup(t), ["value"], 1).withColumn("user_id", F.col("user_id").try_cast("bigint"))
    return joins.fanout_audit(e, w, {"all_keys": ["user_id", "value"], "too_few_keys": ["user_id"]})


def orders_with_nation(t: Tables):
    """Orders with their customer's nation, joined once and written once:
    both the yearly price lookup and the rows read it, so the large
    orders-customer shuffle join runs a single time."""
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    c = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    return cut_lineage(o.join(c, on="o_custkey", how="inner").drop("o_custkey"))


def nation_year_prices(oc):
    """Stand-in for the yearly median home value per city: exact median
    order price per (nation, year)."""
    y = oc.select("c_nationkey", F.year("o_orderdate").alias("year"), "o_totalprice")
    return exact_quantile(y, "o_totalprice", 0.5, ["c_nationkey", "year"], out_col="median_price") \
        .withColumnRenamed("c_nationkey", "nation")


@register("prior_period_join", headline=True, sql=f"""
    WITH oc AS (SELECT o_orderkey, o_orderdate, o_totalprice, c_nationkey
                FROM orders JOIN customer ON o_custkey = c_custkey),
         p AS (SELECT c_nationkey AS nation, CAST(year(o_orderdate) AS INTEGER) AS year,
                      median(o_totalprice) AS median_price
               FROM oc GROUP BY 1, 2)
    SELECT oc.o_orderkey, oc.c_nationkey, CAST(year(oc.o_orderdate) AS INTEGER) AS list_year,
           CAST(year(oc.o_orderdate) AS INTEGER) - 1 AS report_year, {hu('p.median_price', 6)} AS median_price
    FROM oc LEFT JOIN p ON oc.c_nationkey = p.nation AND year(oc.o_orderdate) - 1 = p.year
""")
def prior_period_join(spark, sf_dir):
    """F5 (flagship): each order gets last year's median order price of its
    customer's nation."""
    oc = orders_with_nation(Tables(spark, sf_dir))
    out = joins.prior_period_join(oc.select("o_orderkey", "c_nationkey", "o_orderdate"),
                                  nation_year_prices(oc), key="c_nationkey", date_col="o_orderdate",
                                  lookup_key="nation", lookup_year="year", shift=1)
    return out.select("o_orderkey", "c_nationkey", "list_year", "report_year",
                      half_up("median_price", 6).alias("median_price"))


def report_dates(t: Tables):
    """Stand-in for the weekly mortgage series: one row per order date."""
    return t.orders.select(F.col("o_orderdate").cast("date").alias("report_date")).distinct()


@register("lag_feature", sql="""
    SELECT CAST(report_date AS VARCHAR) AS report_date,
           CAST(lag(report_date, 1) OVER (ORDER BY report_date) AS VARCHAR) AS previous_date
    FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS report_date FROM orders)
""")
def lag_feature(spark, sf_dir):
    """H1: previous report date of each report date."""
    out = windows.lag_feature(report_dates(Tables(spark, sf_dir)), "report_date", "previous_date")
    return out.select(*[F.col(c).cast("string").alias(c) for c in ("report_date", "previous_date")])


@register("lag_other_column", sql="""
    SELECT o_orderpriority, CAST(d AS VARCHAR) AS report_date, price,
           lag(price, 2) OVER (PARTITION BY o_orderpriority ORDER BY d) AS price_2_before
    FROM (SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS d, max(o_totalprice) AS price
          FROM orders GROUP BY 1, 2)
""")
def lag_other_column(spark, sf_dir):
    """H1 of a column that is not the order: the highest price of each order
    date, and that of two order dates before, within each priority."""
    daily = (Tables(spark, sf_dir).orders.groupBy("o_orderpriority", F.col("o_orderdate").cast("date").alias("d"))
             .agg(F.max("o_totalprice").alias("price")))
    out = windows.lag_feature(daily, "d", "price_2_before", ["o_orderpriority"], "price", 2)
    return out.select("o_orderpriority", F.col("d").cast("string").alias("report_date"), "price", "price_2_before")


@register("report_gap_audit", sql="""
    SELECT days_between_report, count(*) AS n_reports FROM (
        SELECT CAST(date_diff('day', lag(report_date, 1) OVER (ORDER BY report_date), report_date) AS INTEGER)
                   AS days_between_report
        FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS report_date FROM orders))
    GROUP BY 1
""")
def report_gap_audit(spark, sf_dir):
    """H2: the gaps between consecutive order dates and how often each occurs."""
    return windows.report_gap_audit(report_dates(Tables(spark, sf_dir)), "report_date")


@register("report_gap_by_type", sql="""
    SELECT event_type, days_between_report, count(*) AS n_reports FROM (
        SELECT event_type,
               CAST(date_diff('day', lag(d, 1) OVER (PARTITION BY event_type ORDER BY d), d) AS INTEGER)
                   AS days_between_report
        FROM (SELECT DISTINCT event_type, CAST(ts AS DATE) AS d FROM events))
    GROUP BY 1, 2
""")
def report_gap_by_type(spark, sf_dir):
    """H2 with ``partitionBy``: reporting gaps of each event type's days."""
    e = Tables(spark, sf_dir).events.select("event_type", F.col("ts").cast("date").alias("d"))
    return windows.report_gap_audit(e, "d", ["event_type"])
