"""op12: repeated windows against brute force."""

import hashlib
import re

import numpy as np
import pytest

from prepfold.llm import substring_dedup as sd

SCHEMA = "doc_id long, text string, chunk string, ids int, `a.b` string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs, window):
    first = {}
    lists = [(d, WORD.findall(t or "")) for d, t in docs]
    for d, ws in lists:
        for k in range(len(ws) - window + 1):
            if d is not None:
                key = tuple(ws[k:k + window])
                first[key] = min(first.get(key, d), d)
    out = []
    for d, ws in lists:
        gone = set()
        for k in range(len(ws) - window + 1):
            if d is not None and first[tuple(ws[k:k + window])] < d:
                gone.update(range(k, k + window))
        kept = " ".join(w for k, w in enumerate(ws) if k not in gone)
        out.append((-1 if d is None else d, len(ws), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out)


def result(spark, docs, **options):
    frame = spark.createDataFrame([(d, t, "x", 1, None) for d, t in docs], SCHEMA)
    return sorted((-1 if r[0] is None else r[0], *r[1:])
                  for r in sd.drop_repeated_windows(frame, with_text=True, **options).collect())


@pytest.mark.parametrize("window,chunk", [(13, 1 << 22), (3, 200), (1, 50), (5, 1)])
def test_random_texts(spark, window, chunk):
    rng = np.random.default_rng(window)
    passages = [[f"w{k}" for k in rng.integers(0, 9, 30)] for _ in range(4)]
    docs = []
    for d in range(60):
        ws = []
        for _ in range(int(rng.integers(0, 4))):
            ws += passages[int(rng.integers(0, 4))][int(rng.integers(0, 9)):] if rng.random() < 0.5 else \
                [f"É{k}" for k in rng.integers(0, 1000, int(rng.integers(0, 25)))]
        docs.append((int(rng.integers(0, 50)), "\x0b\t ".join(ws) + " \n"))
    got = result(spark, docs, window=window, chunk_bytes=chunk)
    assert got == brute(docs, window)
    assert any(r[2] for r in got)


def test_full_counters_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(sd, "MAX_BITS", 1)
    docs = [(k, " ".join(f"a{j % 40}" for j in range(k, k + 30))) for k in range(50)]
    assert result(spark, docs) == brute(docs, sd.WINDOW)


def test_estimates_never_fall_short():
    rng = np.random.default_rng(1)
    cells = rng.integers(0, 500, 3000).astype(np.uint32)
    counts = np.bincount(cells)[cells]
    assert (sd.estimates(cells, max_bits=4) >= counts).all()


def test_edge_rows(spark):
    long = " ".join(f"k{j}" for j in range(60000)) + " " + "y" * 100000
    passage = " ".join(f"p{j}" for j in range(20))
    docs = [(1, None), (2, ""), (3, " \t\n"), (4, passage), (5, passage), (5, passage), (None, passage),
            (6, long), (7, "z " + long), (8, "one two")]
    got = result(spark, docs)
    assert got == brute(docs, sd.WINDOW)
    frame = spark.createDataFrame([], SCHEMA)
    assert sd.drop_repeated_windows(frame).count() == 0
