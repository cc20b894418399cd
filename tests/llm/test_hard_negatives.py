"""op13: the threshold algorithm against brute force."""

import math

import numpy as np
import pytest

from prepfold.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, id string, anchor int, `a.b` int"


def brute(rows, every=100, positives=5, negatives=10, low=30, high=90, scale=256):
    use = [(i, x, [math.floor(scale * float(c)) for c in v]) for i, v, x in rows
           if i is not None and v is not None and x is not None and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    for i, x, v in use:
        if i % every:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j, y) for j, y, w in use if len(w) == len(v) and j != i]
        for s, p, _ in sorted(r for r in scored if r[2] == x)[:positives]:
            fit = sorted(r for r in scored if r[2] != x and low * -s <= 100 * -r[0] <= high * -s)[:negatives]
            out += [(i, p, k, j, -s, -t) for k, (t, j, _) in enumerate(fit, 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, x, "y", 3, None) for i, v, x in rows], SCHEMA)


def as32(values):
    return [float(np.float32(x)) for x in values]


@pytest.mark.parametrize("limits", [{}, {"group_anchors": 2, "block_rows": 9}])
def test_random_vectors(spark, limits):
    rng = np.random.default_rng(11)
    rows = [(k, as32(rng.normal(size=4) if k % 2 else rng.integers(-1, 2, 4)), int(rng.integers(0, 3))) for k in range(160)]
    got = sorted(tuple(r) for r in hn.hard_negatives(frame(spark, rows), anchor_every=20, **limits).collect())
    assert got == brute(rows, every=20) and len(got) > 50


def test_edge_rows(spark):
    same = [1.0, 1.0]
    rows = [(0, same, 1), (1, same, 1), (2, [0.5, 0.5], 2), (3, [0.5, 0.5], 2), (4, [float("nan"), 1.0], 1),
            (5, [None, 1.0], 2), (6, None, 1), (7, same, None), (8, [float("inf"), 1.0], 2), (9, [1.0], 2),
            (10, [0.1, -0.3], 3), (11, [-1.0, -1.0], 1), (100, [0.0, 0.0], 1), (200, [], 1), (None, same, 2)]
    got = sorted(tuple(r) for r in hn.hard_negatives(frame(spark, rows)).collect())
    assert got == brute(rows)
    assert (0, 1, 1, 2, 131072, 65536) in got and (0, 1, 2, 3, 131072, 65536) in got
    assert hn.hard_negatives(frame(spark, rows).limit(0)).count() == 0


def test_search_stops_at_the_threshold(monkeypatch):
    """Far fewer rows are scored than a block has where a list leads to the best."""
    rng = np.random.default_rng(2)
    vectors = np.floor(256 * rng.normal(size=(4000, 2)))
    lists = hn.Lists(np.arange(4000), np.zeros(4000, np.int64), vectors, np.array([[256.0, 0.0]]))
    looked = []
    window = hn.Best(5)
    lists.search(0, [window], lambda ids, labels: looked.append(len(ids)) or np.ones(len(ids), bool))
    order = np.lexsort((np.arange(4000), -(vectors @ np.array([256.0, 0.0]))))[:5]
    assert window.ids.tolist() == order.tolist()
    assert sum(looked) < 400
