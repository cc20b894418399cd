"""op5: fingerprints, Golay keys and components against brute force."""

import itertools

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from prepfold.llm import simhash_dedup as sh
from prepfold.llm.components import components
from prepfold.llm.shared import table

SCHEMA = "doc_id long, text string, component_id int, row string"


def slow_fingerprint(text):
    words = bytes(text or "", "utf-8").lower().split()
    if not words:
        return 0
    grams = [words[i:i + 3] for i in range(len(words) - 2)] or [words]
    counts = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(b" ".join(g), 42)
        for k in range(64):
            counts[k] += h >> k & 1
    return sum(1 << k for k in range(64) if 2 * counts[k] > len(grams))


def slow_components(ids, prints, max_bits=2):
    prints = np.array(prints, np.uint64)
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(prints[i] ^ prints[i + 1:]) <= max_bits):
            a, b = find(i), find(i + 1 + int(j))
            root[max(a, b)] = min(a, b)
    groups = {}
    for i in range(len(ids)):
        groups.setdefault(find(i), []).append(ids[i])
    return {i: min((x for x in g if x is not None), default=None) for g in groups.values() for i in g}


def test_whole_table_against_brute_force(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = docs.select("doc_id", "text").orderBy("doc_id").collect()
    prints = [slow_fingerprint(r.text) for r in rows]
    wanted = slow_components([r.doc_id for r in rows], prints)
    got = sh.op5_simhash_dedup(spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(rows)
    assert {r.doc_id: r.fingerprint for r in got} == {r.doc_id: f"{p:016x}" for r, p in zip(rows, prints)}
    assert {r.doc_id: r.component_id for r in got} == wanted


def test_golay_lists_meet_every_pair_within_two_bits():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 23, 300).astype(np.uint32)
    flips = [0] + [1 << a for a in range(23)] + [1 << a | 1 << b for a, b in itertools.combinations(range(23), 2)]
    base = sh.golay_indices(words)
    counts = (base >= 0).sum(1)
    assert set(counts) <= {1, 6}
    for flip in flips:
        other = sh.golay_indices(words ^ np.uint32(flip))
        assert all(set(a[a >= 0]) & set(b[b >= 0]) for a, b in zip(base, other))


@pytest.mark.parametrize("dense", [8, 10_000])
def test_links_span_components_of_a_crowd(spark, monkeypatch, dense):
    monkeypatch.setattr(sh, "DENSE", dense)
    rng = np.random.default_rng(2)
    centre = int(rng.integers(0, 1 << 62))
    prints = {centre ^ (1 << int(a)) ^ (1 << int(b)) ^ (1 << int(c)) for a, b, c in rng.integers(0, 64, (400, 3))}
    prints = sorted(prints | {int(x) for x in rng.integers(0, 1 << 62, 300)})
    frame = spark.createDataFrame([(int(np.uint64(p).view(np.int64)),) for p in prints], "fp long")
    found = components(sh.links(frame))
    roots = {r.node: r.root for r in found.collect()}
    signed = [int(np.uint64(p).view(np.int64)) for p in prints]
    order = sorted(range(len(prints)), key=lambda k: signed[k])
    wanted = slow_components([signed[k] for k in order], [prints[k] for k in order])
    assert {x: roots.get(x, x) for x in signed} == wanted


def test_edge_rows(spark):
    rows = [(3, None, 1, "x"), (1, "", 2, "y"), (7, " \t\n", 3, "z"), (None, "a b c d", 4, None), (9, "A  b C d", 5, "q"),
            (9, "A  b C d", 5, "q"), (11, "one", 1, None), (None, "only here, alone", None, None),
            (12, "word " * 50_000, 1, "long")]
    got = sh.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    assert {(r.doc_id, r.component_id) for r in got} == {
        (3, 1), (1, 1), (7, 1), (None, 9), (9, 9), (11, 11), (None, None), (12, 12)}
    assert sum(r.kept for r in got) == 5
    left = sh.deduplicate(spark.createDataFrame(rows, SCHEMA))
    assert left.columns == ["doc_id", "text", "component_id", "row"]
    assert sorted(r.doc_id or 0 for r in left.collect()) == [0, 1, 9, 11, 12]


def test_empty_table(spark):
    assert sh.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_components_of_a_long_chain(spark):
    chain = spark.range(1, 60).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = {r.node: r.root for r in components(chain).collect()}
    assert got == {k: 1 for k in range(2, 61)}


def test_more_than_two_bits_is_refused(spark):
    with pytest.raises(ValueError):
        sh.links(spark.range(1).select(F.col("id").alias("fp")), 3)
