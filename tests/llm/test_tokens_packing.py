"""op1 and op4: ids against the library's, the packing rule, the round trip."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from prepfold.llm import huffman_output as ho
from prepfold.llm import packing
from prepfold.llm.shared import table
from prepfold.llm.tokens import Encoder, vocabulary_path

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, length string, ids string"


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(vocabulary_path())
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def same(texts, library):
    ids, at = Encoder(vocabulary_path()).encode(pa.array(texts, pa.string()))
    return all(ids[a:b].tolist() == library(t) for t, a, b in zip(texts, at, at[1:])) and len(at) == len(texts) + 1


def test_ids_are_the_library_s(spark, library):
    rng = random.Random(3)
    letters = "ab \n.,'sé  \t 1ñ_-　日<|endoftext|>́\x85\x1c"
    words = ["it's'", "of%%%", "ñandú,&", "x'", "the", "été", "I'm", "a,b", "x\ny", "\nz", "fin.", "\n", "1,234.5", "y'll'"]
    assert same(["".join(rng.choice(letters) for _ in range(rng.randint(0, 14))) for _ in range(3000)] + [None, ""], library)
    assert same([" ".join(rng.choice(words) for _ in range(rng.randint(0, 9))) for _ in range(2000)], library)
    assert same([r.text for r in table(spark, SF, "documents").collect()], library)
    assert same([], library)


def test_added_tokens_are_the_plain_call_s():
    plain = Tokenizer.from_file(vocabulary_path())
    of = lambda text: plain.encode(text or "", add_special_tokens=False).ids
    mark = "<|endoftext|>"
    assert of(f" {mark}") == [220, 50256]
    beside = ["", " ", "  ", "\n", "\n\n", " \n", "\t", "word", "été", "fin.", "%%", "<|", "|>", mark, "x\ny", "1"]
    assert same([f"{a}{mark}{b}" for a in beside for b in beside], of)
    rng = random.Random(4)
    assert same(["".join(rng.choice([*beside, mark, "<|endoftext", " endoftext|>"]) for _ in range(rng.randint(1, 9)))
                 for _ in range(3000)], of)


def plain_sum_of_squares(lengths, capacity):
    """The rule itself: try every choice and count the squares anew."""
    bins, filled = [], []
    for size in lengths:
        def squares(fills):
            gaps = [capacity - f for f in fills if f < capacity]
            return sum(gaps.count(g) ** 2 for g in set(gaps))
        options = [(squares([f + size if k == b else f for k, f in enumerate(filled)]), capacity - filled[b], b)
                   for b in range(len(filled)) if filled[b] + size <= capacity]
        options.append((squares([*filled, size]), capacity, len(filled)))
        best = min(x[:2] for x in options)
        chosen = [x[2] for x in options if x[:2] == best]
        if chosen[0] == len(filled):
            filled.append(0)
        bins.append(best)
        filled[chosen[-1]] += size
    return bins, sorted(filled)


def test_rule_against_every_choice():
    rng = np.random.default_rng(5)
    lengths = rng.integers(1, 20, 150)
    sequence, offset = packing.sum_of_squares(lengths, 20)
    filled = sorted(np.bincount(sequence, lengths).astype(int).tolist())
    assert filled == plain_sum_of_squares(lengths.tolist(), 20)[1]


def check_packing(rows, texts, library, capacity=2048):
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_seq.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    assert set(by_doc) == set(texts)
    for doc, parts in by_doc.items():
        ids = np.array(library(texts[doc]) + [0], "<u4")
        parts.sort(key=lambda r: r.piece)
        assert [p.piece for p in parts] == list(range(len(parts)))
        assert sum(p.length for p in parts) == len(ids)
        assert len(parts) == max(1, -(-len(ids) // capacity))
        assert all(p.length == capacity for p in parts[1:])
        for p in parts:
            assert p.ids_crc32 == zlib.crc32(ids[p.start:p.start + p.length].tobytes())
    return len(by_seq)


def test_whole_table(spark, library):
    texts = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    rows = packing.op1_best_fit_packing(spark, SF).collect()
    n = check_packing(rows, texts, library)
    assert n <= 1.05 * sum(r.length for r in rows) / 2048 + 2


def test_groups_and_edge_rows(spark, library):
    rows = [(1, None, "x", "y"), (2, "", "x", "y"), (3, "word " * 9000, None, "z"), (4, "a b", "1", "2")]
    rows += [(k, f"text {k} " * (k % 37), "l", "i") for k in range(5, 200)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = packing.pack_documents(docs, group=64, with_ids=True).collect()
    check_packing(got, {r[0]: r[1] for r in rows}, library)
    assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in got)
    twice = packing.pack_documents(docs.filter("doc_id < 3").unionByName(docs.filter("doc_id < 3"))).collect()
    assert len(twice) == 4 and len({(r.sequence_id, r.offset) for r in twice}) == 4
    assert packing.pack_documents(spark.createDataFrame([], SCHEMA)).count() == 0
    assert packing.piece_bounds(2048, 2048) == [(0, 2048)] and packing.piece_bounds(2049, 2048) == [(0, 1), (1, 2049)]


# --- Huffman output

def test_code_lengths_are_optimal_and_limited():
    rng = np.random.default_rng(1)
    import heapq
    for n in (2, 3, 17, 300):
        counts = rng.integers(1, 1000, n)
        heap = [int(c) for c in counts]
        heapq.heapify(heap)
        cost = 0
        while len(heap) > 1:
            a = heapq.heappop(heap) + heapq.heappop(heap)
            cost += a
            heapq.heappush(heap, a)
        lengths = ho.code_lengths(counts, 30)
        assert int((counts * lengths).sum()) == cost
    skew = 2 ** np.arange(20)
    lengths = ho.code_lengths(skew, 6)
    assert lengths.max() <= 6 and (0.5 ** lengths).sum() <= 1
    assert ho.code_lengths(np.array([0, 5, 0]), 16).tolist() == [0, 1, 0]
    with pytest.raises(ValueError):
        ho.code_lengths(np.ones(9), 3)


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 5000])
def test_block_round_trip(n):
    rng = np.random.default_rng(n)
    ids = np.concatenate([rng.geometric(0.05, n), rng.integers(0, 400, 300)]).astype(np.int64)
    at = np.array([0, n, n, n + 1, len(ids)])
    counts = np.bincount(ids)
    lengths = ho.code_lengths(counts, 11)
    bits, byte_at, marks, mark_at = ho.encode_ids(ids, at, lengths, ho.canonical_codes(lengths))
    places = np.concatenate([marks[a:b] + 8 * byte_at[k] for k, (a, b) in enumerate(zip(mark_at, mark_at[1:]))])
    got = ho.decode_block(bits[:byte_at[-1]], np.diff(at), places.astype("<u4"), *ho.decoding_tables(lengths, 11), 11)
    assert got.tolist() == ids.tolist()


def check_file_rows(rows, texts, library):
    start = 0
    assert [r.doc_id for r in rows] == sorted(texts)
    for r in rows:
        ids = np.array(library(texts[r.doc_id]) + [2], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_files_round_trip(spark, library):
    texts = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    check_file_rows(sorted(ho.op4_huffman_output(spark, SF).collect()), texts, library)


def test_files_of_edge_rows(spark, library, monkeypatch):
    monkeypatch.setattr(ho, "BLOCK", 100)
    rows = [(9, None, "a", "b"), (2, "", None, None), (7, "word " * 3000, "l", "i"), (1, "a b c", "x", "y")]
    docs = spark.createDataFrame(rows, SCHEMA)
    folder = ho.write_ids(docs)
    check_file_rows(sorted(ho.read_ids(spark, folder).collect()), {r[0]: r[1] for r in rows}, library)
    blocks = spark.read.parquet(f"{folder}/blocks").orderBy("segment", "block").collect()
    assert [d for b in blocks for d in b.doc_ids] == [1, 2, 7, 9]
    got = ho.read_ids(spark, folder, with_ids=True).filter("doc_id = 1").first()
    assert np.frombuffer(got.ids, "<u4").tolist() == library("a b c") + [2]
    both = docs.unionByName(docs).withColumn("doc_id", F.when(F.col("doc_id") > 1, F.col("doc_id")))
    again = ho.read_ids(spark, ho.write_ids(both)).collect()
    assert sorted((r.doc_id or 0) for r in again) == [0, 0, 2, 2, 7, 7, 9, 9]
    assert len({r.start for r in again}) == 8
    empty = ho.write_ids(spark.createDataFrame([], SCHEMA))
    assert ho.read_ids(spark, empty).count() == 0
