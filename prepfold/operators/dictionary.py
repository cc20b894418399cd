"""Label dictionaries and sparse features that never reach the driver
(SURVEY 2.12, 2.13 at scale).

``encode.string_index`` keeps the label list on the driver and in every task,
which suits categories. Here the dictionary is a table: labels are counted,
dealt to ranges by falling count, numbered inside each range, and the sizes of
the ranges, summed up, shift the numbers. The ids are those of
``StringIndexer`` (most frequent first, ties by label).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.stats import cut_lineage

#: Labels joined by broadcast: the most frequent ones, so any other label has
#: less than one in HEAD rows and its join cannot be skewed by more.
HEAD = 1000
_WITHIN = (1 << 33) - 1


def label_dictionary(df: DataFrame, c: str, ranges: int | None = None) -> DataFrame:
    """``(label, n_rows, label_id)``, one row per distinct value of ``c``;
    ids count up from 0 by falling ``n_rows``, then by label. NULL gets none.

    ``ranges`` (default: the shuffle partitions) bounds the only frame that is
    summed in one place: a row for each range.
    """
    spark = df.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = cut_lineage(df.select(F.col(f"`{c}`").alias("label")).where("label IS NOT NULL")
                         .groupBy("label").agg(F.count(F.lit(1)).alias("n_rows")))
    order = [F.desc("n_rows"), F.asc("label")]
    # Range number in the upper bits, place within the range in the lower; the
    # written table keeps both as they were dealt.
    dealt = cut_lineage(counts.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
                        .withColumn("at", F.monotonically_increasing_id()))
    dealt = dealt.select("label", "n_rows", F.shiftright("at", 33).alias("range"),
                         F.col("at").bitwiseAND(F.lit(_WITHIN)).alias("place"))
    sizes = dealt.groupBy("range").agg(F.count(F.lit(1)).alias("size"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("range", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    return (dealt.join(F.broadcast(starts), "range")
            .select("label", "n_rows", (F.col("start") + F.col("place")).alias("label_id")))


def index_labels(df: DataFrame, c: str, out_col: str, dictionary: DataFrame,
                 handle_invalid: str = "keep") -> DataFrame:
    """``df`` with the id of ``c``; what the dictionary lacks, and NULL, gets
    the number of labels (``keep``) or loses its row (``skip``).

    The ``HEAD`` most frequent labels are joined by broadcast where the rows
    are; only rows of rarer labels shuffle.
    """
    if handle_invalid not in ("keep", "skip"):
        raise ValueError("handle_invalid must be 'keep' or 'skip'")
    ids = dictionary.select(F.col("label").alias("__label"), F.col("label_id").alias("__id"))
    key = F.col(f"`{c}`")
    head = F.broadcast(ids.where(F.col("__id") < HEAD))
    met = df.join(head, key == F.col("__label"), "left")
    hot = met.where(F.col("__id").isNotNull() | key.isNull())
    rare = met.where(F.col("__id").isNull() & key.isNotNull()).drop("__label", "__id")
    tail = ids.where(F.col("__id") >= HEAD)
    out = hot.unionByName(rare.join(tail, key == F.col("__label"), "left"))
    if handle_invalid == "skip":
        value = F.col("__id")
        out = out.where(value.isNotNull())
    else:
        value = F.coalesce(F.col("__id"), dictionary.agg(F.count(F.lit(1))).scalar())
    return out.withColumn(out_col, value).drop("__label", "__id")


def sparse_multi_hot(df: DataFrame, id_col: str, list_col: str, dictionary: DataFrame,
                     out_col: str = "indices") -> DataFrame:
    """I5 as sparse vectors: ``df`` with the ascending ids of the distinct
    values of its list, one row per row of ``df``.

    No column is named after a value, so any spelling is kept apart (``A`` and
    ``a``, dots, blanks) and the vocabulary may have any size. Rows with a
    NULL or empty list, or values that the dictionary lacks, keep an empty
    array. ``id_col`` is unique; rows with a NULL id get an empty array.
    """
    long = df.select(F.col(f"`{id_col}`").alias("__key"),
                     F.explode(F.array_distinct(F.col(f"`{list_col}`"))).alias("__value"))
    long = long.where("__key IS NOT NULL AND __value IS NOT NULL")
    indexed = index_labels(long, "__value", "__index", dictionary, "skip")
    # A group is one row's own list, so its size is bounded by that row.
    sets = indexed.groupBy("__key").agg(F.sort_array(F.collect_list("__index")).alias(out_col))
    joined = df.join(sets, F.col(f"`{id_col}`") == F.col("__key"), "left").drop("__key")
    return joined.withColumn(out_col, F.coalesce(F.col(out_col), F.array().cast("array<bigint>")))
