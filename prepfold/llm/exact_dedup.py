"""Exact deduplication by distributed MSD radix partitioning.

Texts are split into ever smaller groups by successive digits, a digit being
a block of bytes: round 0 groups by the first 64 bytes, the next rounds go up
to 4 KiB, 256 KiB, ... (each ends 64 times further into the text). A group is named by its smallest row, so equality is decided by
the bytes alone; no digest takes part. A group that is down to one row, or
whose texts have ended, is done and leaves; the others take the next digit.
The number of rounds grows with the logarithm of the longest text that still
has a twin, and only rows that still share a prefix are read again.

Each round aggregates (group, digit) with map-side combine, so a hot prefix
is reduced before it is shuffled, writes the groups that have more than one
row, and joins them back; both join sides are exchanges of their own, which
AQE splits where one prefix holds a large share of the rows. Only the bytes
after the digit travel beside it, so a round moves each open text once.

Defined results: a null text counts as empty and all empty texts are equal;
of equal texts the row with the smallest doc_id stays (a null doc_id sorts
last; of rows that repeat text and doc_id one, and only one, stays); an empty
table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import free_name, table, written

FIRST_DIGIT = 64
GROWTH = 64
ROW = "__row"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """Every white-space run as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_RUN, " ")


def _digit(start: int, end: int) -> list[Column]:
    """The bytes [start, end) of a text, whether it ends there, and the bytes
    after them; ``rest`` holds its bytes from start."""
    return [F.substring("rest", 1, end - start).alias("digit"),
            (F.octet_length("rest") <= end - start).alias("ended"),
            F.expr(f"substring(rest, {end - start + 1})").alias("tail")]


def numbered(docs: DataFrame, row_col: str) -> DataFrame:
    """``docs`` written once with a number for each row, which stays the same
    whichever task reads it later."""
    return written(docs.withColumn(row_col, F.monotonically_increasing_id()))


def _rounds(rows: DataFrame, first_digit: int, growth: int) -> DataFrame:
    """rows: id, row, sha, rest -> id, row, sha, first (null if alone), n."""
    first = F.struct(F.col("id").isNull().alias("unnamed"), "id", "row")
    rows = rows.withColumn("grp", F.lit(-1).cast("long"))
    done = None
    start, end = 0, first_digit
    while True:
        keyed = rows.select("id", "row", "sha", "grp", *_digit(start, end))
        groups = (keyed.groupBy("grp", "digit", "ended")
                  .agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("n"))
                  .filter("n > 1"))
        # A row that is alone finds no group and is done.
        joined = keyed.join(written(groups).hint("merge"), ["grp", "digit", "ended"], "left")
        rest = F.when(~F.col("ended") & F.col("n").isNotNull(), F.col("tail"))
        after = written(joined.select(
            "id", "row", "sha", "first", F.coalesce("n", F.lit(1)).alias("n"), rest.alias("rest")))
        closed = after.filter("rest is null").select("id", "row", "sha", "first", "n")
        done = closed if done is None else done.unionByName(closed)
        rows = after.filter("rest is not null").select(
            "id", "row", "sha", "rest", F.col("first.row").alias("grp"))
        if rows.isEmpty():
            return done
        start, end = end, end * growth


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 row_col: str | None = None, first_digit: int = FIRST_DIGIT,
                 growth: int = GROWTH) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    ``text_sha256`` is carried for the caller; it decides nothing. With
    ``row_col`` (of a table from ``numbered``) that column comes along.
    """
    rest = F.encode(normalised(F.col(f"`{text_col}`").cast("string")), "UTF-8")
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), rest.alias("rest"),
                       *([F.col(f"`{row_col}`").alias("row")] if row_col else []))
    rows = rows.select("*", F.sha2("rest", 256).alias("sha"))
    done = _rounds(rows if row_col else numbered(rows, "row"), first_digit, growth)
    alone = F.col("first").isNull()
    return done.select(
        F.col("id").alias(id_col),
        F.when(alone, F.col("id")).otherwise(F.col("first.id")).alias("keep_id"),
        F.col("n").alias("group_size"),
        (alone | (F.col("first.row") == F.col("row"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
        *([F.col("row").alias(row_col)] if row_col else []))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that repeat an earlier row's text; columns
    and their names stay as they are."""
    number = free_name(docs.columns, ROW)
    rows = numbered(docs, number)
    dropped = exact_groups(rows, id_col, text_col, number).filter("not kept").select(number)
    return rows.join(dropped, number, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


ORACLE_SQL = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY body) AS keep_id,
       count(*) OVER (PARTITION BY body) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY body) AS kept,
       sha256(body) AS text_sha256
FROM t
"""


def op10_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))
