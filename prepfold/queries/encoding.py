"""Queries for SURVEY 2.13 (Spark ML feature transformers)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .fixed import BUCKET_SPLITS, WEEKEND_THRESHOLD
from ..catalog import Tables, register
from ..operators import dictionary, encode
from .common import DOCS_LABELED_SQL, docs_labeled


@register("binarize_weekend", sql=f"""
    SELECT o_orderkey, CAST(isodow(o_orderdate) AS DOUBLE) AS list_day_of_week,
           CAST(CASE WHEN isodow(o_orderdate) > {WEEKEND_THRESHOLD} THEN 1 ELSE 0 END AS DOUBLE) AS listed_on_weekend
    FROM orders
""")
def binarize_weekend(spark, sf_dir):
    """Monday=1..Sunday=7, Binarizer(5.0) marks the weekend."""
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_orderdate")
    out = encode.weekend_flag(o, "o_orderdate", "list_day_of_week", "listed_on_weekend", WEEKEND_THRESHOLD)
    return out.select("o_orderkey", "list_day_of_week", "listed_on_weekend")


@register("bucketize", sql="""
    SELECT l_orderkey, l_linenumber,
           CAST(CASE WHEN l_linenumber >= 5 THEN 5 WHEN l_linenumber >= 4 THEN 4 WHEN l_linenumber >= 3 THEN 3
                     WHEN l_linenumber >= 2 THEN 2 WHEN l_linenumber >= 1 THEN 1 ELSE 0 END AS DOUBLE) AS line_bucket
    FROM lineitem
""")
def bucketize(spark, sf_dir):
    """Splits 0,1,2,3,4,5,inf; five and above share the last bucket."""
    li = Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_linenumber")
    return encode.bucketize(li, "l_linenumber", BUCKET_SPLITS, "line_bucket")


_SEGMENT_LABELS = """
    SELECT c_mktsegment, row_number() OVER (ORDER BY count(*) DESC, c_mktsegment) - 1 AS idx
    FROM customer GROUP BY c_mktsegment
"""


@register("string_index", sql=f"""
    WITH l AS ({_SEGMENT_LABELS})
    SELECT c.c_custkey, c.c_mktsegment, CAST(l.idx AS DOUBLE) AS segment_index
    FROM customer c JOIN l ON c.c_mktsegment = l.c_mktsegment
""")
def string_index(spark, sf_dir):
    """Market segment to an index (most frequent = 0)."""
    c = Tables(spark, sf_dir).customer.select("c_custkey", "c_mktsegment")
    out, _ = encode.string_index(c, "c_mktsegment", "segment_index")
    return out


@register("one_hot", sql=f"""
    WITH l AS ({_SEGMENT_LABELS}),
         n AS (SELECT count(*) AS k FROM l)
    SELECT c.c_custkey, CAST(l.idx AS DOUBLE) AS segment_index,
           CAST(to_json(CAST(list_transform(range(n.k - 1), lambda i: CASE WHEN i = l.idx THEN 1.0 ELSE 0.0 END)
                             AS DOUBLE[])) AS VARCHAR) AS segment_vec
    FROM customer c JOIN l ON c.c_mktsegment = l.c_mktsegment, n
""")
def one_hot(spark, sf_dir):
    """Index then one-hot vector with the last category dropped."""
    c = Tables(spark, sf_dir).customer.select("c_custkey", "c_mktsegment")
    idx, _ = encode.string_index(c, "c_mktsegment", "segment_index")
    out, _ = encode.one_hot(idx, "segment_index", "segment_vec")
    return out.select("c_custkey", "segment_index", F.to_json(encode.as_array("segment_vec")).alias("segment_vec"))


CATEGORICALS = ["lang", "source", "quality_label"]


def _labels_sql(c):
    return (f"SELECT {c}, row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS idx "
            f"FROM j WHERE {c} IS NOT NULL GROUP BY {c}")


@register("index_categoricals", sql=f"""
    WITH j AS (SELECT doc_id, n_chars, lang, source, CAST(quality AS VARCHAR) AS quality_label
               FROM ({DOCS_LABELED_SQL})),
    """ + ",\n".join(f"l_{c} AS ({_labels_sql(c)}), n_{c} AS (SELECT count(*) AS k FROM l_{c})"
                     for c in CATEGORICALS) + """
    SELECT j.doc_id, j.n_chars, """ + ", ".join(
    f"CAST(coalesce(l_{c}.idx, n_{c}.k) AS DOUBLE) AS {c}_IDX" for c in CATEGORICALS) + """
    FROM j """ + " ".join(f"LEFT JOIN l_{c} ON j.{c} = l_{c}.{c} CROSS JOIN n_{c}" for c in CATEGORICALS))
def index_categoricals(spark, sf_dir):
    """Three categorical columns indexed in one fit, NULL kept as its
    own index, originals dropped."""
    j = docs_labeled(Tables(spark, sf_dir)).select(
        "doc_id", "n_chars", "lang", "source", F.col("quality").cast("string").alias("quality_label"))
    out, _ = encode.index_categoricals(j, CATEGORICALS)
    return out


ASSEMBLED = ["l_quantity", "l_extendedprice", "l_linenumber"]


@register("assemble_features", sql="SELECT l_orderkey, CAST(to_json([" + ", ".join(
    f"CAST({c} AS DOUBLE)" for c in ASSEMBLED) + "]) AS VARCHAR) AS features FROM lineitem")
def assemble_features(spark, sf_dir):
    """Numeric columns into one feature vector."""
    li = Tables(spark, sf_dir).lineitem.select("l_orderkey", *ASSEMBLED)
    out = encode.assemble(li, ASSEMBLED)
    return out.select("l_orderkey", F.to_json(encode.as_array("features")).alias("features"))


@register("label_dictionary", sql="""
    SELECT label, count(*) AS n_rows, row_number() OVER (ORDER BY count(*) DESC, label) - 1 AS label_id
    FROM (SELECT unnest(string_split(p_name, ' ')) AS label FROM part) WHERE label IS NOT NULL GROUP BY label
""")
def label_dictionary(spark, sf_dir):
    """The label list as a table, numbered by ranges and their sizes."""
    p = Tables(spark, sf_dir).part.select(F.explode(F.split("p_name", " ")).alias("token"))
    return dictionary.label_dictionary(p, "token")


@register("index_labels", sql="""
    WITH l AS (SELECT l_partkey, row_number() OVER (ORDER BY count(*) DESC, l_partkey) - 1 AS id
               FROM lineitem WHERE l_partkey IS NOT NULL GROUP BY l_partkey)
    SELECT l_orderkey, l_linenumber, coalesce(l.id, (SELECT count(*) FROM l)) AS part_index
    FROM lineitem LEFT JOIN l ON lineitem.l_partkey = l.l_partkey
""")
def index_labels(spark, sf_dir):
    """J5 on an id-like column: as many labels as parts."""
    li = Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    out = dictionary.index_labels(li, "l_partkey", "part_index", dictionary.label_dictionary(li, "l_partkey"))
    return out.drop("l_partkey")


@register("sparse_multi_hot", sql="""
    WITH t AS (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS token FROM part),
         v AS (SELECT token, row_number() OVER (ORDER BY count(*) DESC, token) - 1 AS id FROM t
               WHERE token IS NOT NULL GROUP BY token),
         s AS (SELECT p_partkey, list(DISTINCT id ORDER BY id) AS ids FROM t JOIN v ON t.token = v.token GROUP BY p_partkey)
    SELECT p.p_partkey, CAST(to_json(coalesce(s.ids, [])) AS VARCHAR) AS indices
    FROM part p LEFT JOIN s ON s.p_partkey = p.p_partkey
""")
def sparse_multi_hot(spark, sf_dir):
    """Token lists as sparse vectors on the dictionary's ids."""
    p = Tables(spark, sf_dir).part.select("p_partkey", F.split("p_name", " ").alias("tokens"))
    ids = dictionary.label_dictionary(p.select(F.explode("tokens").alias("token")), "token")
    out = dictionary.sparse_multi_hot(p, "p_partkey", "tokens", ids)
    return out.select("p_partkey", F.to_json("indices").alias("indices"))
