"""Hard-negative mining with Fagin's threshold algorithm.

Vectors are quantised to integers, so every score is exact. The anchors are
written as a table in groups of at most about ``group_anchors``; a group is
broadcast (its size does not grow with the data) and every task runs the
threshold algorithm over its own rows, a block at a time: per dimension a list
of the block's rows sorted by value, read from the top where the anchor's
component is positive and from the bottom where it is negative (*sorted
access*); rows met for the first time are scored whole (*random access*); the
threshold is the score that a row not met in any list could still reach, and
an anchor is done with a block once its threshold is strictly below the k-th
score of each of its windows. What a task found carries over to its next block,
so later blocks stop sooner. Tasks send at most k rows for each window, which
are merged by map-side-limited ranking.

Two rounds: the first finds an anchor's positives (one window, rows of its
label), the second the negatives (a window of scores for each positive, rows
of other labels). A full window's k-th score is its worst kept one, the lower
bound of an unfilled window its floor.

Defined results: rows with a null id, label or vector, or a null or
non-finite component take no part; vectors are compared with those of the same
length only, and vectors without components score zero; ties go to the smaller
id; rows that agree in id and score with an anchor are one row; an anchor is
never its own positive, by id; rows repeated whole are one anchor; a window of
a negative positive_score is empty; an empty table gives no rows. Scores past
64 bits fail. Other columns play no part, whatever their names.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_path
from .shared import table, written

POSITIVES = 5
NEGATIVES = 10
#: A negative's score lies between LOW and HIGH hundredths of its positive's.
LOW, HIGH = 30, 90
SCALE = 256
#: Anchors broadcast at once, and rows of a block of sorted lists.
GROUP_ANCHORS = 2048
BLOCK_ROWS = 8192
#: Rows read from each list before the threshold is first tested, and the growth of the next readings.
FIRST_DEPTH, DEPTH_GROWTH = 16, 4
NO_FLOOR = -(1 << 62)


def quantised(vectors: pa.Array, scale: int) -> list:
    """floor(scale * x) of each vector as an integer array; None where a
    component is null or not finite, or the vector is null."""
    flat = vectors.flatten()
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False) if len(flat) else np.empty(0)
    bad = ~np.isfinite(values)  # a null component reads as NaN
    with np.errstate(over="ignore", invalid="ignore"):
        values = np.floor(values * scale)
    bad |= ~np.isfinite(values)
    lengths = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    fault = np.concatenate([[0], np.cumsum(bad)])
    out = []
    for end, n, valid in zip(ends.tolist(), lengths.tolist(), vectors.is_valid().to_pylist()):
        whole = valid and fault[end] == fault[end - n]
        out.append(values[end - n:end] if whole else None)
    return out


def exact_type(rows: np.ndarray, anchors: np.ndarray):
    """The fastest type in which all inner products are exact."""
    if not rows.size or not anchors.size:
        return np.float64
    bound = rows.shape[1] * float(np.abs(rows).max()) * float(np.abs(anchors).max())
    return np.float32 if bound < 2 ** 24 else np.float64 if bound < 2 ** 53 else object


def as_type(matrix: np.ndarray, kind) -> np.ndarray:
    if kind is object:
        return np.array([[int(x) for x in row] for row in matrix.tolist()], object).reshape(matrix.shape)
    return matrix.astype(kind)


class Lists:
    """The sorted lists of one block of rows of equal vector length."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, anchors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels = ids[order], labels[order]
        kind = exact_type(vectors, anchors)
        self.vectors = as_type(vectors[order], kind)
        # lists[0] falls, lists[1] rises: (dimension, place) -> row
        rise = np.argsort(vectors[order], axis=0, kind="stable").T.astype(np.int32)
        self.lists = np.stack([np.ascontiguousarray(rise[:, ::-1]), np.ascontiguousarray(rise)])
        n = len(ids)
        depths = [FIRST_DEPTH]
        while depths[-1] < n:
            depths.append(depths[-1] * DEPTH_GROWTH)
        self.depths = [min(d, n) for d in depths]
        self.weights = as_type(anchors, kind)
        # thresholds[i][a]: what a row unread after depths[i] can score at most with anchor a
        low = np.minimum(self.weights, 0)
        high = np.maximum(self.weights, 0)
        values = self.vectors[rise.T, np.arange(vectors.shape[1])] if vectors.shape[1] else self.vectors
        self.thresholds = [values[n - 1 - d] @ high.T + values[d] @ low.T if d < n else None for d in self.depths]

    def search(self, at: int, windows: list, wanted) -> None:
        """Anchor ``at`` against this block: ``windows`` take what they need
        of the rows for which ``wanted(ids, labels)`` holds."""
        anchor = self.weights[at]
        dims = np.flatnonzero(anchor != 0)
        side = (anchor[dims] < 0).astype(np.int8)
        seen = np.zeros(len(self.ids), bool)
        done = np.zeros(len(self.ids), bool)
        last = 0
        for depth, threshold in zip(self.depths, self.thresholds):
            if depth >= len(self.ids):
                seen[:] = True  # every list is read to its end
            else:
                seen[self.lists[side, dims, last:depth]] = True
            rows = np.flatnonzero(seen & ~done)
            if len(rows):
                done[rows] = True
                rows = rows[wanted(self.ids[rows], self.labels[rows])]
                scores = (self.vectors[rows] @ anchor).astype(np.int64)
                floor = min(w.kth for w in windows)
                good = scores >= floor
                if good.any():
                    ids, scores = self.ids[rows[good]], scores[good]
                    for w in windows:
                        w.offer(ids, scores)
            if threshold is not None and all(int(threshold[at]) < w.kth for w in windows):
                return
            if done.all():
                return
            last = depth


class Best:
    """The first k (id, score) by falling score, then id, with scores from low to high."""

    def __init__(self, k: int, low: int = NO_FLOOR, high: int = -NO_FLOOR):
        self.k, self.low, self.high, self.kth = k, low, high, low
        self.ids, self.scores = np.empty(0, np.int64), np.empty(0, np.int64)

    def offer(self, ids: np.ndarray, scores: np.ndarray) -> None:
        fit = (scores >= self.kth) & (scores <= self.high)
        if not fit.any():
            return
        ids, scores = np.concatenate([self.ids, ids[fit]]), np.concatenate([self.scores, scores[fit]])
        order = np.lexsort((ids, -scores))
        ids, scores = ids[order], scores[order]
        new = np.ones(len(ids), bool)
        new[1:] = (ids[1:] != ids[:-1]) | (scores[1:] != scores[:-1])
        self.ids, self.scores = ids[new][:self.k], scores[new][:self.k]
        self.kth = int(self.scores[-1]) if len(self.ids) == self.k else self.low


def searched(rows: DataFrame, group: list, k: int, same_label: bool, scale: int, block_rows: int) -> DataFrame:
    """(anchor, window, id, score): each task's best k rows for each window.

    ``group``: plain (key, id, label, vector, [(low, high), ...]) of anchors.
    Only plain values are broadcast, so workers need no copy of this package.
    """
    shared = rows.sparkSession.sparkContext.broadcast(group)

    def run(batches):
        by_length: dict[int, list] = {}
        for key, own, label, vector, bounds in shared.value:
            by_length.setdefault(len(vector), []).append(
                (key, own, label, vector, [Best(k, low, high) for low, high in bounds]))
        matrices = {n: np.array([a[3] for a in found], np.float64).reshape(len(found), n)
                    for n, found in by_length.items()}
        blocks: dict[tuple, list] = {}

        def close(kind):
            part = blocks.pop(kind)
            anchors = by_length[kind[0]]
            if same_label:  # only anchors of the block's label look at it
                use = [i for i, a in enumerate(anchors) if a[2] == kind[1]]
            else:
                use = range(len(anchors))
            lists = Lists(np.array([p[0] for p in part], np.int64), np.array([p[1] for p in part], np.int64),
                          np.array([p[2] for p in part], np.float64).reshape(len(part), kind[0]),
                          matrices[kind[0]][list(use)])
            for at, i in enumerate(use):
                _, own, label, _, windows = anchors[i]
                if same_label:
                    lists.search(at, windows, lambda ids, labels: ids != own)
                else:
                    lists.search(at, windows, lambda ids, labels: labels != label)

        labels_asked = {(n, a[2]) for n, found in by_length.items() for a in found}
        for batch in batches:
            vectors = quantised(batch.column(2), scale)
            for own, label, vector in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), vectors):
                if vector is None or len(vector) not in by_length:
                    continue
                kind = (len(vector), label if same_label else None)
                if same_label and kind not in labels_asked:
                    continue
                part = blocks.setdefault(kind, [])
                part.append((own, label, vector))
                if len(part) >= block_rows:
                    close(kind)
        for kind in list(blocks):
            close(kind)
        out = [(key, w, b) for found in by_length.values() for key, _, _, _, own in found
               for w, b in enumerate(own) if len(b.ids)]
        sizes = [len(b.ids) for _, _, b in out]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.array([key for key, _, _ in out], np.int64), sizes)),
             pa.array(np.repeat(np.array([w for _, w, _ in out], np.int32), sizes)),
             pa.array(np.concatenate([b.ids for _, _, b in out]) if out else np.empty(0, np.int64)),
             pa.array(np.concatenate([b.scores for _, _, b in out]) if out else np.empty(0, np.int64))],
            names=["anchor", "window", "id", "score"])

    return rows.mapInArrow(run, "anchor long, window int, id long, score long")


def best(found: DataFrame, k: int) -> DataFrame:
    """(anchor, window, rank, id, score): the first k of all tasks."""
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), F.asc("id"))
    return (found.repartition("anchor", "window").distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("anchor", "window", "rank", "id", "score"))


def _anchor_table(rows: DataFrame, is_anchor: Column, scale: int, group_anchors: int) -> tuple[DataFrame, int]:
    """(group, key, id, label, vector) written, and the number of groups."""

    def run(batches):
        for batch in batches:
            vectors = quantised(batch.column(2), scale)
            keep = [i for i, v in enumerate(vectors) if v is not None]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(keep, pa.int64())), batch.column(1).take(pa.array(keep, pa.int64())),
                 pa.array([vectors[i].tolist() for i in keep], pa.list_(pa.float64()))],
                names=["id", "label", "vector"])

    found = written(rows.filter(is_anchor).mapInArrow(run, "id long, label long, vector array<double>").distinct()
                    .withColumn("key", F.monotonically_increasing_id()))
    groups = -(-found.count() // group_anchors)
    return found.withColumn("group", F.pmod(F.xxhash64("key"), F.lit(max(groups, 1)))), groups


def hard_negatives(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                   anchor_every: int = 100, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW,
                   high: int = HIGH, scale: int = SCALE, group_anchors: int = GROUP_ANCHORS,
                   block_rows: int = BLOCK_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose id is divisible by ``anchor_every``. An anchor's
    positives are its first rows of the same label, a positive's negatives the
    first rows of other labels that score between ``low`` and ``high``
    hundredths of it.
    """
    spark = rows.sparkSession
    own = (rows.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("long").alias("label"),
                       F.col(f"`{vector_col}`").alias("vector"))
           .filter("id is not null and label is not null and vector is not null"))
    anchors, groups = _anchor_table(own, F.col("id") % anchor_every == 0, scale, group_anchors)
    folder = shared_path(spark, "hard_negatives", uuid.uuid4().hex)
    schema = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
              "negative_score long")
    spark.createDataFrame([], schema).write.parquet(folder)
    for g in range(groups):
        # At most about group_anchors rows, whatever the table's size.
        group = [(r.key, r.id, r.label, r.vector) for r in anchors.filter(F.col("group") == g).collect()]
        first = searched(own, [(*a, [(NO_FLOOR, -NO_FLOOR)]) for a in group], positives, True, scale, block_rows)
        near = best(first, positives).orderBy("anchor", "rank").collect()  # positives of one group
        of: dict[int, list] = {}
        for r in near:
            if r.score >= 0:
                of.setdefault(r.anchor, []).append((r.id, r.score))
        asked = [(*a, [(-(-low * s // 100), high * s // 100) for _, s in of[a[0]]]) for a in group if a[0] in of]
        if not asked:
            continue
        pairs = spark.createDataFrame([(a[0], w, a[1], p, s) for a in asked for w, (p, s) in enumerate(of[a[0]])],
                                      "anchor long, window int, anchor_id long, positive_id long, positive_score long")
        (best(searched(own, asked, negatives, False, scale, block_rows), negatives).join(pairs, ["anchor", "window"])
         .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
                 F.col("score").alias("negative_score")).write.mode("append").parquet(folder))
    return spark.read.schema(schema).parquet(folder)


ORACLE_SQL = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
), scored AS (
  SELECT a.vec_id AS anchor, b.vec_id AS other, a.label = b.label AS same,
         CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM rows a JOIN rows b ON len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
  WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor, other AS positive, score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other) <= 5
)
SELECT p.anchor AS anchor_id, p.positive AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor, p.positive ORDER BY s.score DESC, s.other) AS INTEGER) AS rank,
       s.other AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor = p.anchor AND NOT s.same
  AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
QUALIFY rank <= 10
"""


def op13_hard_negative_mining(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    relabelled = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", relabelled))
