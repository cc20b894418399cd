"""op7: accuracy on held-out labels, and what each view may see."""

import zlib

import numpy as np
import pytest

from prepfold.llm import quality_classifier as qc
from prepfold.llm.shared import table

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    got = {r.doc_id: r for r in qc.op7_quality_classifier(spark, SF).collect()}
    assert len(got) == 10_000
    test = [(got[k], y) for k, y in labels.items() if zlib.crc32(str(k).encode()) % 5 == 0]
    assert all(r.held_out for r, _ in test)

    def accuracy(column):
        return np.mean([(getattr(r, column) >= 0.5) == (y == 1) for r, y in test])

    share = np.mean([y for _, y in test])
    assert accuracy("score") > 0.97
    assert accuracy("score_content") > 0.95 and accuracy("score_metadata") > share
    good = [r.score for r, y in test if y == 1]
    assert np.mean([s >= 0.5 for s in good]) > 0.97


def test_views_help_each_other():
    rng = np.random.default_rng(3)
    y = (rng.random(3000) < 0.7).astype(float)
    views = [np.stack([y + rng.normal(0, s, 3000), rng.normal(size=3000)], 1) for s in (0.35, 0.45)]
    few = [v[:40] for v in views]
    pool = [v[40:2000] for v in views]
    test = [v[2000:] for v in views]

    def accuracy(model):
        return ((model.scores(test)[:, 0] >= 0.5) == (y[2000:] == 1)).mean()

    alone = accuracy(qc.co_train(few, y[:40], [p[:0] for p in pool]))
    together = accuracy(qc.co_train(few, y[:40], pool))
    assert together > 0.93 and together >= alone - 0.01


def test_no_held_out_label_is_read(spark):
    docs = spark.createDataFrame([(k, f"text {k} " * (1 + k % 3), "en", "s") for k in range(200)],
                                 "doc_id long, text string, lang string, source string")
    kept = [(k, int(k % 3 > 0)) for k in range(200)]
    flipped = [(k, y if zlib.crc32(str(k).encode()) % 5 else 1 - y) for k, y in kept]
    scores = []
    for rows in (kept, flipped):
        model = qc.fit(docs, spark.createDataFrame(rows, "doc_id long, quality int"))
        scores.append(sorted(tuple(r) for r in qc.scored(docs, model).select("doc_id", "score").collect()))
    assert scores[0] == scores[1]


EDGE = [(1, None, None, None, "c"), (1, None, None, None, "c"), (None, "", "en", "s", None), (3, "w " * 400_000, "xx", "t", "d"),
        (4, "ok text here", "en", "s", "e")]


@pytest.mark.parametrize("labels", [[], [(1, 1), (4, 1)], [(1, None), (None, 0), (4, 5)],
                                    [(k, k % 2) for k in range(5, 60)]])
def test_edge_rows(spark, labels):
    rows = EDGE + [(k, ("good words here " if k % 2 else "### ") * k, "en", "s", "f") for k in range(5, 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, quality string")
    model = qc.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    got = qc.scored(docs, model, score_col="goodness").collect()
    assert len(got) == len(rows) and all(0 <= r.goodness <= 1 for r in got)
    if len(labels) < 5:
        assert {r.goodness for r in got} == {1.0}
    assert qc.scored(docs.limit(0), model, score_col="goodness").count() == 0


def test_every_unlabelled_row_may_take_part(spark, monkeypatch):
    """A pool larger than any sample: its rows are all counted, in the table
    and in memory alike, and about the share asked for gets a label."""
    seen = {}
    total = qc.Stored.total

    def counted(self, run):
        got = total(self, run)
        seen.setdefault("rows", got[0])
        return got

    monkeypatch.setattr(qc.Stored, "total", counted)
    docs = spark.range(7000).selectExpr("id as doc_id", "repeat(if(id % 2 = 0, 'Good words here. ', '### '), int(1 + id % 9)) as text",
                                        "if(id < 200, 'en', 'fr') as lang", "'s' as source")
    labels = spark.range(200).selectExpr("id as doc_id", "int(id % 2 = 0) as quality")
    model = qc.fit(docs, labels)
    assert seen["rows"] == 6800
    got = qc.scored(docs, model).select("doc_id", "score", "lang").collect()
    assert np.mean([(r.score >= 0.5) == (r.doc_id % 2 == 0) for r in got]) > 0.99


def test_a_cut_takes_the_surest_rows():
    logit = np.random.default_rng(1).normal(0, 8, 50_000)
    own = qc._bins(logit)
    at, share = qc._cut(np.bincount(own[own >= 0], minlength=qc.BINS), 2000)
    taken = (own > at) | ((own == at) & (np.random.default_rng(2).random(50_000) < share))
    assert abs(taken.sum() - 2000) <= 50 and logit[taken].min() > np.sort(logit)[-2200]
