"""op6: windows, hits and longest matches against brute force."""

import hashlib
import re

import numpy as np
import pytest

from prepfold.llm import decontamination as dc
from prepfold.llm.shared import table

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, n_hit int, item_id string"


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window=10):
    windows = {}
    for item, text in items:
        ws = words(text)
        size = min(window, len(ws))
        for k in range(len(ws) - size + 1 if ws else 0):
            windows.setdefault(tuple(ws[k:k + size]), set()).add(str(item))
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        ws, hit, found = words(text), set(), set()
        for size in sizes:
            for k in range(len(ws) - size + 1):
                own = windows.get(tuple(ws[k:k + size]))
                if own:
                    hit.update(range(k, k + size))
                    found |= own
        out.append((doc, len(ws), len(hit), sorted(found)))
    return out


def test_whole_table_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in table(spark, sf, "documents").collect()]
    items = [(r.item_id, r.text) for r in table(spark, sf, "benchmark").collect()]
    wanted = {d: (n, h, len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), h > 0)
              for d, n, h, i in brute(docs, items)}
    got = {r.doc_id: tuple(r)[1:] for r in dc.op6_benchmark_decontamination(spark, sf).collect()}
    assert got == wanted
    assert any(v[1] for v in wanted.values())


@pytest.mark.parametrize("shard,block", [(1 << 21, 1 << 22), (200, 60)])
def test_random_texts(spark, monkeypatch, shard, block):
    monkeypatch.setattr(dc, "SHARD", shard)
    monkeypatch.setattr(dc, "BLOCK_WORDS", block)
    rng = np.random.default_rng(7)
    text = lambda n: " ".join(f"W{k}" if k % 3 else f"é{k}" for k in rng.integers(0, 3, n))
    docs = [(k, text(int(n)), 0, "x") for k, n in enumerate(rng.integers(0, 60, 80))]
    items = [(str(k), text(int(n))) for k, n in enumerate(rng.integers(0, 25, 12))] + [("3", text(12)), ("99", None)]
    frame, bench = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, "item_id string, text string")
    got = dc.contamination(frame, bench, window=5).collect()
    wanted = {d: (n, h, i) for d, n, h, i in brute([d[:2] for d in docs], items, 5)}
    assert {r.doc_id: (r.n_words, r.n_hit, r.item_ids) for r in got} == wanted
    for r in got:
        ends = [x for s in r.spans for x in (s.start, s.end)]
        assert ends == sorted(set(ends))


def test_longest_matches(spark, monkeypatch):
    monkeypatch.setattr(dc, "SHARD", 50)
    item = [f"t{k}" for k in range(30)]
    docs = [(1, "a b " + " ".join(item[3:15]) + " c"), (2, " ".join(["z"] * 60)), (3, "q " + " ".join(item[2:20])), (4, None)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(7, " ".join(item).upper())], "item_id long, text string")
    got = {r.item_start: (r.length, r.doc_id, r.doc_start) for r in dc.longest_matches(frame, bench).collect()}
    assert got == {k: (20 - k, 3, k - 1) for k in range(2, 11)}


def test_edge_rows(spark):
    passage = " ".join(f"p{k}" for k in range(12))
    rows = [(1, None, 1, "a"), (1, "", 1, "a"), (None, f"x {passage} y", None, None), (5, passage.upper(), 1, "b"),
            (5, passage.upper(), 1, "b"), (6, passage.replace("p5 ", "p5,\n"), 0, "c"), (7, "p0 p1 p2", 0, "c"),
            (8, "one two " * 100_000 + passage, 0, "d")]
    docs = spark.createDataFrame(rows, SCHEMA)
    bench = spark.createDataFrame([(1, passage), (1, passage), (2, "Two one"), (None, "p0"), (3, None), (4, " .")],
                                  "item_id long, text string")
    got = sorted((r.doc_id or 0, r.n_words, r.n_hit, r.item_ids) for r in dc.contamination(docs, bench).collect())
    assert got == [(0, 14, 12, ["1"]), (1, 0, 0, []), (1, 0, 0, []), (5, 12, 12, ["1"]), (5, 12, 12, ["1"]),
                   (6, 12, 12, ["1"]), (7, 3, 0, []), (8, 200_012, 200_010, ["1", "2"])]
    left = dc.decontaminate(docs, bench)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [1, 1, 7]
    assert dc.contamination(docs, bench.limit(0)).filter("n_hit > 0").count() == 0
    assert dc.contamination(docs.limit(0), bench).count() == 0
    assert dc.longest_matches(docs.limit(0), bench).count() == 0
