"""URL verdicts: rules first, gradient-boosted trees for the rest.

A rule is a host and a path prefix; it fits its host and all subdomains, the
longest rule that fits decides. Other URLs are judged by gradient-boosted
trees (Spark ML) over lexical features: lengths, depth, digit ratio, entropy,
parameter counts, marks, and statistics of the host's suffixes and the first
path segment.

Labels are URLs with a verdict; in the query these are the rows a rule fits.
Half of them, by hash, give the suffix statistics (share of blocked URLs,
drawn towards the overall share, and how many there are), all rows of that
half; suffixes are hashed to ``BUCKETS`` counters, so that what the tasks get
has a bound. Of the other half, at most ``TRAIN_ROWS`` rows, those of the
smallest hashes, train the trees, whose statistics then do not hold their own
labels.

Defined results: host and path of a null URL or one without ``://`` are empty
and no rule fits them; without labels every verdict is ``default``, with labels
of one kind that kind; rows that repeat get a result each; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .shared import table

#: The contract's rules.
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"),
         ("com/fr/", "allow"), ("com/de/", "block"))
BUCKETS = 1 << 16
TRAIN_ROWS = 20_000
TREES = 20
DEPTH = 4
SEED = 42
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HOLDING = 10.0  # how many URLs the overall share counts as


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules) -> Column:
    """The longest rule that fits, or null."""
    found = F.lit(None).cast("string")
    for rule in sorted((r for r, _ in rules), key=len):  # the longest is asked first
        own, slash, prefix = rule.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(slash + prefix)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


# --- features

DIGITS = re.compile(r"\d")


def suffixes(host: str, path: str) -> list[str]:
    """The last one, two and three labels of a host, and the first segment of
    a path."""
    labels = host.rsplit(".", 3)[-3:]
    segment = path.split("/", 2)[1] if path.startswith("/") else ""
    return ["1." + labels[-1], "2." + ".".join(labels[-2:]), "3." + ".".join(labels), "/" + segment]


def bucket(suffix: str) -> int:
    return xxhash.xxh64_intdigest(suffix.encode("utf-8", "replace")) % BUCKETS


def entropy(text: str) -> float:
    n = len(text)
    return -sum(c / n * math.log2(c / n) for c in Counter(text).values()) if n else 0.0


def lexical(url: str | None, host: str, path: str) -> list[float]:
    url = url or ""
    query = url.partition("?")[2].partition("#")[0]
    n = max(1, len(url))
    segments = [s for s in path.split("/") if s]
    return [
        len(url), len(host), len(path), len(query), len(segments), host.count("."), len(DIGITS.findall(url)) / n,
        len(DIGITS.findall(host)) / max(1, len(host)), entropy(url), entropy(host), entropy(path),
        sum(1 for x in query.split("&") if x), query.count("="), float("#" in url), float(url.startswith("https:")),
        host.count("-"), url.count("%"), url.count("_"), max(map(len, segments), default=0),
        float("." in (segments[-1] if segments else "")), max((len(x) for x in host.split(".")), default=0),
    ]


def _counters(labelled: DataFrame) -> np.ndarray:
    """(BUCKETS, 2): URLs and blocked URLs of each suffix bucket, over all
    rows; each task adds up its own."""

    def run(batches):
        own = np.zeros((BUCKETS, 2))
        for batch in batches:
            for host, path, label in zip(*(c.to_pylist() for c in batch.columns)):
                at = [bucket(s) for s in suffixes(host, path)]
                own[at] += (1, label)
        used = np.flatnonzero(own[:, 0])
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(own[used, 0]), pa.array(own[used, 1])],
                                         names=["bucket", "n", "blocked"])

    counted = (labelled.select("host", "path", "label").mapInArrow(run, "bucket long, n double, blocked double")
               .groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("blocked").alias("blocked")))
    out = np.zeros((BUCKETS, 2))
    for b, n, blocked in counted.collect():  # at most BUCKETS rows
        out[b] = n, blocked
    return out


def _features(rows: DataFrame, counters: np.ndarray, share: float) -> DataFrame:
    """``rows`` (with url, host, path) and an array column ``features``."""
    shared = rows.sparkSession.sparkContext.broadcast(counters)
    names = rows.columns
    url, host, path = (names.index(c) for c in ("url", "host", "path"))

    def run(batches):
        counters = shared.value
        for batch in batches:
            values = []
            for u, h, p in zip(*(batch.column(k).to_pylist() for k in (url, host, path))):
                own = lexical(u, h, p)
                for s in suffixes(h, p):
                    n, blocked = counters[bucket(s)]
                    own += [(blocked + HOLDING * share) / (n + HOLDING), math.log1p(n)]
                values.append(own)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.list_(pa.float64()))],
                                             names=[*names, "features"])

    return rows.mapInArrow(run, rows.selectExpr("*", "array(0D) as features").schema)


# --- model

class Model:
    """Counters, the overall share of blocked URLs, and the trees (None where
    there is only one kind of label, or none)."""

    def __init__(self, counters: np.ndarray, share: float, trees):
        self.counters, self.share, self.trees = counters, share, trees


def train(labelled: DataFrame, max_rows: int = TRAIN_ROWS, trees: int = TREES, depth: int = DEPTH,
          seed: int = SEED) -> Model:
    """labelled: url, host, path and label (1 to block)."""
    spark = labelled.sparkSession
    order = F.xxhash64(F.coalesce("url", F.lit("")))
    n, blocked = labelled.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    share = blocked / n if n else 0.0
    counters = _counters(labelled.filter(F.pmod(order, F.lit(2)) == 0))
    if not 0 < share < 1:
        return Model(counters, share, None)
    chosen = (labelled.filter(F.pmod(order, F.lit(2)) == 1).orderBy(order, "url", "label").limit(max_rows)
              .select("url", "host", "path", "label"))
    rows = sorted((r.url, r.label, r.features) for r in _features(chosen, counters, share).collect())
    if len({label for _, label, _ in rows}) < 2:
        return Model(counters, share, None)
    frame = spark.createDataFrame([(float(label), f) for _, label, f in rows], "label double, features array<double>")
    ensure_checkpoint_dir(spark)
    learner = GBTClassifier(labelCol="label", featuresCol="vector", maxIter=trees, maxDepth=depth, seed=seed)
    return Model(counters, share, learner.fit(frame.select("label", array_to_vector("features").alias("vector"))))


def scored(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` (with url, host, path) and the probability to be blocked."""
    if model.trees is None:
        return rows.withColumn("score", F.lit(model.share))
    names = rows.columns
    vectors = _features(rows, model.counters, model.share).withColumn("vector", array_to_vector("features"))
    return model.trees.transform(vectors).select(*names, vector_to_array("probability")[1].alias("score"))


def judge(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url",
          labelled: DataFrame | None = None, default: str = "allow", max_rows: int = TRAIN_ROWS) -> DataFrame:
    """One row per page: id, host, path, rule, verdict, score. ``labelled``
    (url, label: 1 to block) are the labels; by default the rows a rule fits."""
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").cast("string").alias("url"))
    host, path = host_and_path(F.col("url"))
    rows = rows.select("id", "url", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    by_rule = F.lit(None).cast("string")
    for rule, verdict in rules:
        by_rule = F.when(F.col("rule") == rule, F.lit(verdict)).otherwise(by_rule)
    rows = rows.withColumn("by_rule", by_rule)
    if labelled is None:
        labelled = rows.filter("rule is not null").withColumn("label", (F.col("by_rule") == "block").cast("int"))
    else:
        labelled = labelled.select(F.col("url").cast("string").alias("url"), F.col("label").cast("int").alias("label"))
        labelled = labelled.filter("url is not null and label in (0, 1)").select("url", "label", host.alias("host"), path.alias("path"))
    model = train(labelled, max_rows)
    by_method = F.when(F.col("score") > 0.5, "block").when(F.col("score") < 0.5, "allow").otherwise(default)
    return scored(rows, model).select(F.col("id").alias(id_col), "host", "path", "rule",
                                      F.coalesce("by_rule", by_method).alias("verdict"), "score")


def op2_url_filters(spark, sf_dir: str) -> DataFrame:
    """No SQL form for the trees; the tests hold host, path and rule against
    plain Python, and the trees' accuracy on held-out URLs."""
    return judge(table(spark, sf_dir, "pages"))
