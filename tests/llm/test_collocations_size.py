"""op11: what a task holds at a time."""

import tracemalloc

import numpy as np
from .test_collocations import brute, frame, random_docs

from prepfold.llm import collocations as cl


def test_spill_takes_the_memory_of_a_run():
    trie = cl.HatTrie(3, burst=1 << 12)
    rows = np.stack([np.full(200000, 2), np.arange(200000) // 20, np.arange(200000) % 20], axis=1)
    trie.add(rows, np.ones(len(rows), np.int64))
    seen, sizes = 0, []
    tracemalloc.start()
    for found, counts in trie.runs(0, 1 << 12):
        seen += int(counts.sum())
        sizes.append(len(found))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert seen == 200000 and max(sizes) < 1 << 13 and trie.total == 0
    assert peak < 2 << 20  # a row as a key, a pair and a list entry takes over 100 bytes: 20 MB


def test_few_chunks_a_batch_and_settings_restored(spark, monkeypatch):
    monkeypatch.setattr(cl, "BATCH", 40)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    chunks = cl._chunks(frame(spark, random_docs(np.random.default_rng(3), 150)).select("lang", "text").coalesce(1))

    def count(batches):
        for batch in batches:
            yield batch.select(["sizes"]).set_column(0, "n", cl.pa.array([batch.num_rows] * batch.num_rows))

    with cl.few_chunks(spark):
        got = [r.n for r in chunks.mapInArrow(count, "n long").collect()]
    assert len(got) > 50 and max(got) <= cl.CHUNKS
    assert spark.conf.get(key) == before


def test_numbers_spill_in_the_middle_of_a_batch(spark, monkeypatch):
    for name, value in {"BUFFER": 30, "RUN_PHRASES": 5, "BURST": 2, "MAX_PHRASES": 50, "MAX_NUMBERS": 7,
                        "BATCH": 25, "CHUNKS": 2}.items():
        monkeypatch.setattr(cl, name, value)
    docs = random_docs(np.random.default_rng(11), 120)
    assert {tuple(r) for r in cl.collocations(frame(spark, docs), min_count=3).collect()} == brute(docs, 3)


def test_rare_pairs_are_not_counted_as_phrases(spark, monkeypatch):
    """Pairs of frequent words that are rare themselves stay out of the runs."""
    runs, kept = cl._runs, {}
    monkeypatch.setattr(cl, "_runs", lambda chunks, size, *a: kept.setdefault(size, runs(chunks, size, *a)))
    docs = [(" ".join(f"w{(i * k + j) % 97}" for i in range(97)) + " a b.", "en") for j in range(12) for k in range(1, 9)]
    got = cl.collocations(frame(spark, docs), min_count=96).collect()
    assert {tuple(r) for r in got} == brute(docs, 96) == {("en", 1, "a b", 96, 96, 96, 96 * 99, 99000)}
    with cl.few_chunks(spark):
        assert kept[2].select("phrase").distinct().count() < 700  # of 776 + 2 and more known by their words
