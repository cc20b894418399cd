"""Queries for SURVEY 2.2 (validation, reports) and 2.3 (profiling)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .fixed import SAMPLE_FRACTION, SEED
from ..catalog import Tables, hu, register
from ..functions.scalar import half_up
from ..operators import clean, density, mergeable, profile, validate
from ..plans.stats import cut_lineage
from .common import DOCS_LABELED_SQL, docs_labeled, priced_orders

LINE_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("scan_parquet", sql="SELECT * FROM orders")
def scan_parquet(spark, sf_dir):
    """A1: the whole table as read from Parquet."""
    return Tables(spark, sf_dir).orders


@register("check_load", sql="""
    SELECT CAST(15000 AS BIGINT) AS expected_records, count(*) AS actual_records,
           6 AS expected_columns, 6 AS actual_columns,
           CASE WHEN count(*) = 15000 THEN 'Validation Passed' ELSE 'Validation Failed' END AS status
    FROM orders
""")
def check_load(spark, sf_dir):
    """B1: orders validated against 15000 rows and 6 columns."""
    return validate.check_load(Tables(spark, sf_dir).orders, 15000, 6)


def _summary_sql(cols):
    parts = []
    for i, c in enumerate(cols):
        parts.append(f"""SELECT {i} AS position, '{c}' AS column_name, count({c}) AS count,
            {hu(f'avg({c})', 6)} AS mean, {hu(f'stddev_samp({c})', 6)} AS stddev,
            CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM lineitem""")
    return "\nUNION ALL\n".join(parts)


@register("summary_stats", sql=_summary_sql(LINE_NUMERIC))
def summary_stats(spark, sf_dir):
    """Typed describe() of four lineitem columns, one pass."""
    s = validate.summary_stats(Tables(spark, sf_dir).lineitem, LINE_NUMERIC)
    return s.withColumn("mean", half_up("mean", 6)).withColumn("stddev", half_up("stddev", 6))


@register("shape_report", sql="""
    WITH p AS (SELECT o_orderkey, o_totalprice, ln(o_totalprice) AS log_price FROM orders),
         s AS (SELECT avg(log_price) AS m, stddev_samp(log_price) AS sd FROM p)
    SELECT 'orders' AS stage, count(*) AS n_rows, 6 AS n_columns FROM orders
    UNION ALL
    SELECT 'sigma_filtered' AS stage, count(*) AS n_rows, 3 AS n_columns
    FROM p, s WHERE log_price < m + 3 * sd AND log_price > m - 3 * sd
""")
def shape_report(spark, sf_dir):
    """Rows and columns before and after the 3-sigma filter."""
    t = Tables(spark, sf_dir)
    p = priced_orders(t).select("o_orderkey", "o_totalprice", "log_price")
    return validate.shape_report({"orders": t.orders,
                                  "sigma_filtered": clean.sigma_filter(p, "log_price")})


@register("conditional_counts", sql="""
    SELECT count(*) AS n_rows,
           count(*) FILTER (WHERE l_returnflag = 'R') AS n_returned,
           count(*) FILTER (WHERE l_tax = 0) AS n_no_tax,
           count(*) FILTER (WHERE l_quantity > 45) AS n_large,
           count(*) FILTER (WHERE l_linestatus = 'O') AS n_open
    FROM lineitem
""")
def conditional_counts(spark, sf_dir):
    """Several counts on conditions in one pass."""
    return validate.conditional_counts(Tables(spark, sf_dir).lineitem, {
        "n_returned": F.col("l_returnflag") == "R",
        "n_no_tax": F.col("l_tax") == 0,
        "n_large": F.col("l_quantity") > 45,
        "n_open": F.col("l_linestatus") == "O",
    })


@register("preview", sql="SELECT * FROM orders ORDER BY o_orderkey LIMIT 30")
def preview(spark, sf_dir):
    """show(30), in key order."""
    return validate.preview(Tables(spark, sf_dir).orders, 30, ["o_orderkey"])


CORR_COLS = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]


def _corr_sql(a, b):
    return hu(f"corr({a}, {b})", 6)


@register("max_corr", sql="\n".join([
    "WITH c AS (",
    "\nUNION ALL\n".join(
        f"SELECT {i} AS position, '{c}' AS column_name, {_corr_sql('l_extendedprice', c)} AS corr "
        "FROM lineitem" for i, c in enumerate(CORR_COLS)),
    ")",
    "SELECT position, column_name, corr, rank, rank = 1 AS is_best FROM (",
    "  SELECT *, row_number() OVER (ORDER BY corr DESC NULLS LAST, position) AS rank FROM c)",
]))
def max_corr(spark, sf_dir):
    """Every column's correlation with the target in one pass, ranked."""
    li = Tables(spark, sf_dir).lineitem
    r = profile.correlation_ranking(li, "l_extendedprice", CORR_COLS)
    return r.withColumn("corr", half_up("corr", 6)).withColumn("rank", F.col("rank").cast("long"))


CORR_PAIRS = [("l_extendedprice", "l_quantity"), ("l_extendedprice", "l_discount"),
              ("l_quantity", "l_tax")]


@register("corr_report", sql="SELECT " + ", ".join(
    f"{_corr_sql(a, b)} AS corr_{a}_{b}" for a, b in CORR_PAIRS) + " FROM lineitem")
def corr_report(spark, sf_dir):
    """Correlations of named pairs, one pass."""
    r = profile.correlation_report(Tables(spark, sf_dir).lineitem, CORR_PAIRS)
    return r.select(*[half_up(c, 6).alias(c) for c in r.columns])


SKEW_COLS = ["l_quantity", "l_extendedprice", "l_discount"]


@register("skewness", sql="\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, "
    f"{hu(f'(SELECT avg(power({c} - m, 3)) FROM lineitem, (SELECT avg({c}) AS m FROM lineitem)) / power(var_pop({c}), 1.5)', 9)} AS skewness "
    "FROM lineitem" for c in SKEW_COLS))
def skewness(spark, sf_dir):
    """Population skewness."""
    s = profile.skewness(Tables(spark, sf_dir).lineitem, SKEW_COLS)
    return s.withColumn("skewness", half_up("skewness", 9))


@register("sample")
def sample(spark, sf_dir):
    """C4: Bernoulli sample without replacement, fraction 0.5, seed 42."""
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_totalprice")
    return profile.bernoulli_sample(o, SAMPLE_FRACTION, SEED)


@register("hash_sample", sql=f"""
    SELECT o_orderkey, o_totalprice FROM orders
    WHERE CAST('0x' || substr(md5('{SEED}|' || o_orderkey), 1, 13) AS BIGINT) < {SAMPLE_FRACTION} * pow(2, 52)
""")
def hash_sample(spark, sf_dir):
    """C4, layout-independent: half of the orders chosen by key hash."""
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_totalprice")
    return profile.hash_sample(o, ["o_orderkey"], SAMPLE_FRACTION, SEED)


@register("distinct_values", sql="SELECT DISTINCT o_orderpriority FROM orders")
def distinct_values(spark, sf_dir):
    """C5/G4."""
    return profile.distinct_values(Tables(spark, sf_dir).orders, "o_orderpriority")


@register("histogram", sql=f"""
    WITH s AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
         b AS (SELECT CAST(least(coalesce(floor((o_totalprice - lo) * 20.0 / (hi - lo)), 0), 19) AS INTEGER) AS bin,
                      lo, hi
               FROM orders, s)
    SELECT bin, {hu('lo + bin * ((hi - lo) / 20.0)', 6)} AS bin_low,
           {hu('lo + (bin + 1) * ((hi - lo) / 20.0)', 6)} AS bin_high, count(*) AS count
    FROM b GROUP BY bin, lo, hi
""")
def histogram(spark, sf_dir):
    """20 equal-width bins of the order price."""
    h = profile.histogram(Tables(spark, sf_dir).orders, "o_totalprice", 20)
    return h.select("bin", half_up("bin_low", 6).alias("bin_low"),
                    half_up("bin_high", 6).alias("bin_high"), "count")


@register("density_curve", sql=f"""
    WITH x AS (SELECT ln(o_totalprice) AS x FROM orders),
         s AS (SELECT count(x) AS n, stddev_samp(x) * power(count(x), -0.2) AS bw, min(x) AS lo, max(x) AS hi FROM x),
         g AS (SELECT n, bw, lo - 3 * bw AS start, (hi - lo + 6 * bw) / 127 AS step FROM s),
         c AS (SELECT least(floor((x - start) / step), 126) AS j, (x - start) / step AS place FROM x, g),
         w AS (SELECT j, sum(w) AS w
               FROM (SELECT j, count(*) - sum(place - j) AS w FROM c GROUP BY j
                     UNION ALL SELECT j + 1, sum(place - j) FROM c GROUP BY j) GROUP BY j)
    SELECT CAST(point AS INTEGER) AS point, {hu('start + point * step', 6)} AS x,
           {hu('sum(w * exp(-power((point - j) * step / bw, 2) / 2)) / (n * bw * sqrt(2 * pi()))', 6)} AS density
    FROM w, g, range(0, 128) AS k(point) GROUP BY point, n, bw, start, step
""")
def density_curve(spark, sf_dir):
    """The smooth curve of the log price's distribution."""
    d = density.density_curve(priced_orders(Tables(spark, sf_dir)), "log_price", 128)
    return d.select("point", half_up("x", 6).alias("x"), half_up("density", 6).alias("density"))


@register("linear_trend", sql=f"""
    SELECT l_returnflag, CAST(regr_count(l_extendedprice, l_quantity) AS BIGINT) AS n,
           {hu('regr_slope(l_extendedprice, l_quantity)', 6)} AS slope,
           {hu('regr_intercept(l_extendedprice, l_quantity)', 6)} AS intercept,
           {hu('regr_r2(l_extendedprice, l_quantity)', 6)} AS r2
    FROM lineitem GROUP BY l_returnflag
""")
def linear_trend(spark, sf_dir):
    """Price against quantity, per return flag."""
    r = profile.linear_trend(Tables(spark, sf_dir).lineitem, "l_extendedprice", "l_quantity",
                             ["l_returnflag"])
    return r.select("l_returnflag", F.col("n").cast("long").alias("n"),
                    *[half_up(c, 6).alias(c) for c in ("slope", "intercept", "r2")])


DOC_COLS = ["doc_id", "lang", "source", "n_chars", "quality", "toxic"]


@register("null_profile", sql=f"""
    WITH j AS ({DOCS_LABELED_SQL}),
         c AS (""" + "\nUNION ALL\n".join(
    f"SELECT {i} AS position, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count, "
    "count(*) AS total FROM j" for i, c in enumerate(DOC_COLS)) + """)
    SELECT position, column_name, null_count, total,
           CAST(null_count AS DOUBLE) / total AS null_share,
           row_number() OVER (ORDER BY null_count DESC, position) = 1 AS most_missing
    FROM c
""")
def null_profile(spark, sf_dir):
    """Missing values per column of documents left-joined to labels."""
    return profile.null_profile(docs_labeled(Tables(spark, sf_dir)), DOC_COLS)


@register("null_patterns", sql=f"""
    WITH j AS ({DOCS_LABELED_SQL})
    SELECT quality IS NULL AS quality_missing, toxic IS NULL AS toxic_missing, count(*) AS n_rows
    FROM j GROUP BY 1, 2
""")
def null_patterns(spark, sf_dir):
    """Co-missing patterns of the label columns."""
    return profile.null_patterns(docs_labeled(Tables(spark, sf_dir)), ["quality", "toxic"])


@register("category_counts", sql="""
    SELECT o_orderpriority, count(*) AS n_rows FROM orders GROUP BY o_orderpriority
""")
def category_counts(spark, sf_dir):
    """C9."""
    return profile.category_counts(Tables(spark, sf_dir).orders, "o_orderpriority")


from ..operators.aggregates import global_aggregates as _global_aggregates  # noqa: E402

_G1 = ["mean", "stddev", "max", "min", "sum", "skewness"]


@register("global_aggregates", sql=f"""
    WITH s AS (SELECT avg(o_totalprice) AS m, var_pop(o_totalprice) AS v FROM orders)
    SELECT {hu('avg(o_totalprice)', 6)} AS mean_o_totalprice,
           {hu('stddev_samp(o_totalprice)', 6)} AS stddev_o_totalprice,
           max(o_totalprice) AS max_o_totalprice, min(o_totalprice) AS min_o_totalprice,
           {hu('sum(o_totalprice)', 2)} AS sum_o_totalprice,
           {hu('avg(power(o_totalprice - s.m, 3)) / power(s.v, 1.5)', 9)} AS skewness_o_totalprice
    FROM orders, s GROUP BY s.m, s.v
""")
def global_aggregates(spark, sf_dir):
    """G1: six aggregates of the order price in one pass."""
    g = _global_aggregates(Tables(spark, sf_dir).orders, {"o_totalprice": _G1})
    digits = {"mean": 6, "stddev": 6, "sum": 2, "skewness": 9}
    return g.select(*[half_up(f"{fn}_o_totalprice", digits[fn]).alias(f"{fn}_o_totalprice")
                      if fn in digits else F.col(f"{fn}_o_totalprice") for fn in _G1])


_STATE_DIGITS = {"mean": 4, "stddev": 4, "skewness": 6, "corr": 6, "slope": 4}


def _state_sql(c):
    return f"""SELECT '{c}' AS column_name, '' AS other_name, count({c}) AS n, {hu(f'avg({c})', 4)} AS mean,
        {hu(f'stddev_samp({c})', 4)} AS stddev,
        {hu(f'avg(power({c} - m, 3)) / power(var_pop({c}), 1.5)', 6)} AS skewness,
        CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max,
        CAST(NULL AS DOUBLE) AS corr, CAST(NULL AS DOUBLE) AS slope
        FROM lineitem, (SELECT avg({c}) AS m FROM lineitem)"""


@register("merged_state", sql=f"""
    {_state_sql('l_extendedprice')}
    UNION ALL
    {_state_sql('l_quantity')}
    UNION ALL
    SELECT 'l_extendedprice', 'l_quantity', count(*), {hu('avg(l_extendedprice)', 4)},
           {hu('stddev_samp(l_extendedprice)', 4)}, NULL, min(l_extendedprice), max(l_extendedprice),
           {hu('corr(l_extendedprice, l_quantity)', 6)}, {hu('regr_slope(l_extendedprice, l_quantity)', 4)}
    FROM lineitem WHERE l_extendedprice IS NOT NULL AND l_quantity IS NOT NULL
""")
def merged_state(spark, sf_dir):
    """Statistics of all lines out of one stored state a month of shipping."""
    li = Tables(spark, sf_dir).lineitem.select("l_extendedprice", "l_quantity",
                                               F.date_format("l_shipdate", "yyyy-MM").alias("month"))
    months = cut_lineage(mergeable.moment_state(li, ["l_extendedprice", "l_quantity"],
                                                [("l_extendedprice", "l_quantity")], by=["month"]))
    s = mergeable.state_statistics(mergeable.merge_states(months.drop("month")))
    return s.withColumns({c: half_up(c, d) for c, d in _STATE_DIGITS.items()})
