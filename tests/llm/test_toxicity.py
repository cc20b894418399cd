"""op8: n-gram sums against plain Python, accuracy on held-out rows."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from prepfold.llm import toxicity as tx

SCHEMA = "doc_id long, text string, score string, label int"
MEAN = ["gruffle", "snarkbit", "vexpot", "blightly"]


def corpus(n=1500, seed=4):
    rng = np.random.default_rng(seed)
    syllables = ["an", "the", "or", "ing", "ou", "est", "re", "ti", "lo", "mi", "ka", "su"]
    rows = []
    for k in range(n):
        words = ["".join(rng.choice(syllables, rng.integers(1, 4))) for _ in range(rng.integers(5, 60))]
        bad = int(k % 4 == 0)
        for _ in range(2 * bad):
            words[rng.integers(0, len(words))] = str(rng.choice(MEAN))
        rows.append((k, " ".join(words), bad))
    return rows


def test_word_scores_are_averages_of_ngrams():
    weight = np.random.default_rng(0).normal(size=tx.BUCKETS)
    documents = [b"A cat, the cat", b"", "été  cat".encode(), b"... !", b"a"]
    data, at, n_words = tx._prepared(documents)
    assert n_words.tolist() == [4, 0, 2, 0, 1]
    got = tx.word_scores(data, at, weight)
    own = []
    for word in [b"a", b"cat", b"the", b"cat", "été".encode(), b"cat", b"a"]:
        marked = b" " + word + b" "
        values = []
        for n in tx.GRAMS:
            for k in range(len(marked) - n + 1):
                h = n
                for c in marked[k:k + n]:
                    h = (h * 16777619 & 0xFFFFFFFF) ^ c
                values.append(weight[(h * 2654435761 & 0xFFFFFFFF) >> 15])
        own.append(np.mean(values) if values else 0.0)
    assert np.allclose(got, own)


def test_passages_of_all_lengths(monkeypatch):
    monkeypatch.setattr(tx, "PASSAGE", 8)
    n_words = np.array([0, 1, 8, 9, 0, 17])
    start, counts = tx.passages(n_words)
    assert counts.tolist() == [0, 1, 1, 2, 0, 3]
    assert start.tolist() == [0, 1, 9, 17, 18, 26, 34]
    score = tx.passage_scores(np.arange(35.0), start, counts, n_words)
    assert score.tolist() == [0, 4.5, 12.5, 17, 21.5, 29.5, 34]


def test_held_out_accuracy_and_unseen_forms(spark):
    rows = corpus()
    docs = spark.createDataFrame([(k, t, "x", 1) for k, t, _ in rows], SCHEMA).select("doc_id", "text")
    labels = spark.createDataFrame([(k, y) for k, _, y in rows], "doc_id long, toxic int")
    model = tx.fit(docs, labels)
    got = {r.doc_id: r.score for r in tx.scored(docs, model).collect()}
    test = [(got[k], y) for k, _, y in rows if zlib.crc32(str(k).encode()) % 5 == 0]
    assert np.mean([(s >= 0.5) == (y == 1) for s, y in test]) > 0.97
    frame = spark.createDataFrame(rows[:50], "doc_id long, text string, y int").withColumn("out", tx.held_out(F.col("doc_id")))
    assert all(r.out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in frame.collect())
    clean, seen, unseen = model.best([b"ing the an or", b"ing gruffle an or", b"ing gruffled an or"])[0]
    assert clean < unseen < seen


def test_training_reads_no_held_out_label(spark):
    rows = corpus(300)
    docs = spark.createDataFrame([(k, t) for k, t, _ in rows], "doc_id long, text string")
    flip = [(k, y if zlib.crc32(str(k).encode()) % 5 else 1 - y) for k, _, y in rows]
    models = [tx.fit(docs, spark.createDataFrame(x, "doc_id long, toxic int"))
              for x in ([(k, y) for k, _, y in rows], flip)]
    assert np.array_equal(models[0].weight, models[1].weight)


def test_edge_rows(spark):
    rows = corpus(300)
    model = tx.train([t.encode() for _, t, _ in rows], np.array([y for *_, y in rows]))
    odd = [(1, None, "a", 1), (1, None, "a", 1), (2, "", None, None), (None, " .,!", "b", 2), (3, "the " * 300_000, "c", 3)]
    got = tx.scored(spark.createDataFrame(odd, SCHEMA), model, score_col="toxicity").collect()
    assert len(got) == 5
    assert all(0 <= r.toxicity <= 1 for r in got)
    assert [r.toxicity for r in got[:4]] == [model.prior] * 4
    assert tx.scored(spark.createDataFrame([], SCHEMA), model, score_col="toxicity").count() == 0


@pytest.mark.parametrize("labels", [[], [(0, 0), (1, 0)], [(0, None), (None, 1), (1, 7)]])
def test_nothing_to_learn(spark, labels):
    docs = spark.createDataFrame([(k, t) for k, t, _ in corpus(10)], "doc_id long, text string")
    model = tx.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert {r.score for r in tx.scored(docs, model).collect()} == {0.0}


def test_query(spark):
    got = tx.op8_toxicity(spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = got.collect()
    assert len(rows) == 200 and all(r.predicted == int(r.score >= 0.5) for r in rows)
