"""op11: phrases and their scores against brute force."""

import re
from collections import Counter

import numpy as np
import pytest

from prepfold.llm import collocations as cl

SCHEMA = "doc_id long, text string, lang string, phrase string, n long, `a.b` string"


def pieces(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def brute(docs, min_count, max_words=5, top=2000):
    f, n = Counter(), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for ws in pieces(text):
            n[lang] += len(ws)
            for k in range(1, max_words + 1):
                for i in range(len(ws) - k + 1):
                    f[lang, tuple(ws[i:i + k])] += 1
    cand = {x: a for x, a in f.items() if len(x[1]) > 1 and a >= min_count}
    inside = {}
    for (lang, w), a in cand.items():
        for i in range(len(w)):
            for j in range(i + 2, len(w) + 1):
                if j - i < len(w):
                    inside[lang, w[i:j]] = max(inside.get((lang, w[i:j]), 0), a)
    out = {}
    for (lang, w), a in cand.items():
        if inside.get((lang, w), 0) >= a:
            continue
        score, _, left, right = min((1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]],
                                     f[lang, w[k:]]) for k in range(1, len(w)))
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), left, right))
    return {(lang, r, p.decode(), -a, x, y, n[lang], -s)
            for lang, rows in out.items() for r, (s, a, p, x, y) in enumerate(sorted(rows)[:top], 1)}


def frame(spark, docs):
    return spark.createDataFrame([(k % 7, t, x, "x", 1, None) for k, (t, x) in enumerate(docs)], SCHEMA)


def random_docs(rng, n):
    ends = [" ", " ", " ", "  ", "\t", ". ", ",", "\r\n", "\x0b"]
    words = ["Aa", "b", "é", "ÀB", "c-c", "d d", "e\x00", "日本"]
    return [("".join(words[i] + ends[j] for i, j in zip(rng.integers(0, 8, m) // rng.integers(1, 3), rng.integers(0, 9, m))),
             [None, "und", "fr", ""][int(rng.integers(0, 4))]) for m in rng.integers(0, 60, n)]


@pytest.mark.parametrize("limits", [{}, {"BURST": 3, "MAX_PHRASES": 20, "MAX_NUMBERS": 6, "BATCH": 40, "SLICE": 16}])
def test_against_brute_force(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(cl, name, value)
    docs = random_docs(np.random.default_rng(3), 150)
    got = cl.collocations(frame(spark, docs), min_count=4).collect()
    wanted = brute(docs, 4)
    assert {tuple(r) for r in got} == wanted and len(got) == len(wanted) > 20


def test_full_filter_loses_nothing(spark):
    docs = random_docs(np.random.default_rng(5), 80)
    got = cl.collocations(frame(spark, docs), min_count=3, top=5, max_filter_bytes=1024)
    assert {tuple(r) for r in got.collect()} == brute(docs, 3, top=5)


def test_edge_rows(spark):
    long = "x y " * 20000 + "q" * 200000
    docs = [(None, "en"), ("", None), (" . ,\n", "en"), (long, "en"), ("A b. a B", None), ("a b", "und"), ("a b", "und")]
    got = {tuple(r) for r in cl.collocations(frame(spark, docs), min_count=4).collect()}
    assert got == brute(docs, 4)
    assert ("und", 1, "a b", 4, 4, 4, 8, 2000) in got
    assert cl.collocations(frame(spark, docs).limit(0)).count() == 0
    assert cl.collocations(frame(spark, docs), min_count=10 ** 6).count() == 0


def test_products_beyond_64_bits(spark, monkeypatch):
    """Counts of a very large corpus, put in for the counted ones."""
    totals = spark.createDataFrame([("en", 3 * 10 ** 14)], "lang string, n long")
    one = spark.createDataFrame([("en", "a", 10 ** 13), ("en", "b", 10 ** 12 + 1)], "lang string, phrase string, f long")
    two = spark.createDataFrame([("en", "a b", 10 ** 12 - 7)], "lang string, phrase string, f long")
    monkeypatch.setattr(cl, "phrase_counts", lambda *a, **k: (totals, [one, two]))
    row = cl.collocations(spark.createDataFrame([("x", "en")], "text string, lang string")).first()
    assert row.score == 1000 * (10 ** 12 - 7) * 3 * 10 ** 14 // (10 ** 13 * (10 ** 12 + 1))


def test_containers_burst_and_spill_whole_subtrees():
    trie = cl.HatTrie(4, burst=2)
    rows = np.array([[2, 2, a, b] for a in range(2, 5) for b in range(2, 4)] + [[2, 3, 2, 2]])
    for _ in range(2):
        trie.add(rows, np.ones(len(rows), np.int64))
    top = rows[0, :2].astype(np.uint32).tobytes()
    assert not isinstance(trie.root[top], cl.Container)
    assert isinstance(next(iter(trie.root[top].values())), cl.Container)
    assert trie.total == 7
    taken = trie.take(3)
    assert len(taken) == 6 and trie.total == 1 and {n for _, n in taken} == {2}
