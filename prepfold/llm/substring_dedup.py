"""Substring deduplication with a Count-min prefilter.

Documents are written once in chunks: white space made one space, a few MB of
text a row. Then two rounds of the same exchange, in which a chunk sends each
of its distinct keys once to the key's slot and gets the slot's answer back:
no key, however common, takes more than one entry a chunk, and no document's
text ever moves to a slot.

Round 1, the Count-min sketch. The cell of a window is given by the smallest
hash of the 5-word runs inside it, so neighbouring windows share cells, equal
windows always do, and a sketch has about a fifth as many entries as there are
windows. A chunk's sketch travels as the list of its non-empty cells (a cell
of two documents or more twice), cut by slot. A slot adds the sketches of all
chunks up in ``DEPTH`` rows of counters; the least counter of a cell
overestimates in how many documents its windows occur, and never falls short.
Cells estimated at two documents or more go back to the chunks.

Round 2, exactly. Only windows of such cells are looked at again, by a 128-bit
BLAKE2b of their words: a chunk sends each distinct one with its smallest
document, the slot finds the smallest of all, and sends back a bit for each:
whether that is smaller. Fuller counters only let more windows through to this round, which
decides alone.

Texts of documents without a suspected window are final after round 1; only
the others travel on, and only chunks, never a document's windows, are joined.
A chunk's text and the places of its suspected windows are written and moved
compressed.

Defined results: a null or empty text has no words; texts of fewer words than
a window stay whole; a document is a doc_id, so rows that repeat a doc_id lose
nothing to each other, and each gets a result; rows with a null doc_id keep
everything and count for no one; very long texts are one chunk each; windows
are judged on the input, so a word goes if any repeated window covers it; an
empty table gives no rows. Other columns play no part, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import shuffle_partitions, table, texts, written

WINDOW = 13
#: Words of the runs whose smallest hash names a window's cell.
RUN = 5
#: Bytes of text in a chunk.
CHUNK_BYTES = 4 << 20
#: Rows of counters, counters for each entry of a slot, and the most counters of a row (2 to the power).
DEPTH, COUNTERS_PER_ENTRY, MAX_BITS = 2, 4, 24

MIX = np.uint64(0x9E3779B97F4A7C15)
PIECE, LONG_WORD = 1 << 20, 4096


def mixed(h: np.ndarray) -> np.ndarray:
    """Scrambled 64-bit values; one to one."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def packed(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def unpacked(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def packed_places(at: np.ndarray) -> bytes:
    """Rising numbers as compressed steps; no bytes for none."""
    return packed(np.diff(at, prepend=0).astype(np.int64).tobytes()) if len(at) else b""


def places(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(unpacked(data), np.int64)) if data else np.empty(0, np.int64)


class Words:
    """The words of a chunk's normalised texts, which are joined by newlines."""

    def __init__(self, norm: bytes):
        self.norm = norm
        buf = np.frombuffer(norm, np.uint8)
        cuts = np.flatnonzero((buf == 32) | (buf == 10))
        starts, ends = np.concatenate([[0], cuts + 1]), np.concatenate([cuts, [len(buf)]])
        some = ends > starts
        self.starts, self.ends = starts[some], ends[some]
        self.doc = np.searchsorted(np.flatnonzero(buf == 10), self.starts)

    def hashes(self) -> np.ndarray:
        """64 bits a word: differences of running sums of bytes times powers."""
        buf = np.frombuffer(self.norm, np.uint8)
        size = min(PIECE + LONG_WORD, len(buf))
        up = np.cumprod(np.full(size, MIX | np.uint64(1)))
        down = np.cumprod(np.full(size, np.uint64(pow(int(MIX), -1, 1 << 64))))
        out = np.empty(len(self.starts), np.uint64)
        long = self.ends - self.starts > LONG_WORD
        for at in range(0, len(buf), PIECE):
            lo, hi = np.searchsorted(self.starts, [at, at + PIECE])
            part = buf[at:at + PIECE + LONG_WORD].astype(np.uint64) + np.uint64(1)
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part * up[:len(part)])])
            s = self.starts[lo:hi] - at
            e = np.minimum(self.ends[lo:hi] - at, len(part))
            out[lo:hi] = mixed((sums[e] - sums[s]) * down[s])
        for i in np.flatnonzero(long).tolist():
            out[i] = xxhash.xxh64_intdigest(self.norm[self.starts[i]:self.ends[i]])
        return out

    def cells(self, window: int, slots: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, cell) of every window; a cell is its slot's number
        times 2**32 plus its number in the slot."""
        n = len(self.starts) - window + 1
        if n <= 0:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        run = min(RUN, window)
        words = self.hashes()
        count = len(words) - run + 1
        least = np.zeros(count, np.uint64)
        for k in range(run):
            least = least * MIX + words[k:k + count]
        least = mixed(least)
        have, want = 1, window - run + 1  # least over `have` runs in a row, until `want`
        while have < want:
            step = min(have, want - have)
            least = np.minimum(least[:-step], least[step:])
            have += step
        at = np.flatnonzero(self.doc[:n] == self.doc[window - 1:])
        h = mixed(least[at] + MIX)
        slot = ((h >> np.uint64(32)) * np.uint64(slots)) >> np.uint64(32)
        return at, (slot << np.uint64(32)) | (h & np.uint64(0xFFFFFFFF))

    def digests(self, at: np.ndarray, window: int) -> np.ndarray:
        """(windows, 2) numbers: the 128-bit BLAKE2b of each window's words."""
        norm, made = self.norm, hashlib.blake2b
        return np.frombuffer(b"".join(
            [made(norm[s:e], digest_size=16).digest()
             for s, e in zip(self.starts[at].tolist(), self.ends[at + window - 1].tolist())]), ">u8").reshape(-1, 2)


def _chunks(docs: DataFrame, chunk_bytes: int) -> DataFrame:
    """(chunk, ids, norm), written."""

    def run(batches):
        number = TaskContext.get().partitionId() << 32
        ids, parts, size = [], [], 0

        def flush():
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                 pa.array([packed(b"\n".join(parts))], pa.large_binary()).cast(pa.binary())], names=["chunk", "ids", "norm"])

        for batch in batches:
            for own, text in zip(batch.column(0).to_pylist(), texts(batch.column(1))):
                norm = b" ".join(text.split())
                if ids and size + len(norm) > chunk_bytes:
                    yield flush()
                    number, ids, parts, size = number + 1, [], [], 0
                ids.append(own)
                parts.append(norm)
                size += len(norm) + 1
        if ids:
            yield flush()

    return written(docs.mapInArrow(run, "chunk long, ids array<long>, norm binary"))


def _by_slot(chunk: int, slot: np.ndarray, columns: list[np.ndarray]) -> list[tuple]:
    """One row a slot of entries sorted by slot."""
    cuts = np.flatnonzero(np.diff(slot, prepend=-1)).tolist() + [len(slot)]
    return [(chunk, int(slot[a]), *[c[a:b].tobytes() for c in columns]) for a, b in zip(cuts, cuts[1:])]


def _rows(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32()] + [pa.binary()] * (len(names) - 2)
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=names)


def _sketches(chunks: DataFrame, window: int, slots: int) -> DataFrame:
    """(chunk, slot, cells): the non-empty cells of each chunk's sketch."""

    def run(batches):
        for batch in batches:
            for chunk, ids, norm in zip(*[c.to_pylist() for c in batch.columns]):
                words = Words(unpacked(norm))
                at, cell = words.cells(window, slots)
                own = np.array([i is not None for i in ids], bool)
                doc = words.doc[at]
                use = own[doc]
                cell, doc = cell[use], doc[use]
                if not len(cell):
                    continue
                # neighbours first, which are mostly equal
                new = np.concatenate([[True], (cell[1:] != cell[:-1]) | (doc[1:] != doc[:-1])])
                cell, doc = cell[new], doc[new]
                order = np.lexsort((doc, cell))
                cell, doc = cell[order], doc[order]
                new = np.concatenate([[True], (cell[1:] != cell[:-1]) | (doc[1:] != doc[:-1])])
                found, docs = np.unique(cell[new], return_counts=True)
                found = np.repeat(found, np.minimum(docs, 2))
                yield _rows(_by_slot(chunk, (found >> np.uint64(32)).astype(np.int64),
                                     [(found & np.uint64(0xFFFFFFFF)).astype(np.uint32)]), ["chunk", "slot", "cells"])

    return chunks.mapInArrow(run, "chunk long, slot int, cells binary")


def _slotted(rows: DataFrame, slots: int, answer, names: list[str], schema: str) -> DataFrame:
    """``answer(list of a slot's rows)`` gives its rows back to the chunks."""

    def run(batches):
        slot, own = None, []
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if row[1] != slot:
                    if own:
                        yield _rows(answer(own), names)
                    slot, own = row[1], []
                own.append(row)
        if own:
            yield _rows(answer(own), names)

    return rows.repartition(slots, "slot").sortWithinPartitions("slot").mapInArrow(run, schema)


def estimates(cells: np.ndarray, depth: int = DEPTH, max_bits: int = MAX_BITS) -> np.ndarray:
    """Count-min estimate of how often each 32-bit cell of a slot's merged
    sketches occurs: the least of ``depth`` counters, never below the count."""
    bits = int(np.clip(np.ceil(np.log2(COUNTERS_PER_ENTRY * max(len(cells), 1))), 10, max_bits))
    least = None
    for row in range(depth):
        odd = np.uint64((0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)[row % 4] + 2 * (row // 4))
        place = ((cells.astype(np.uint64) * odd & np.uint64(0xFFFFFFFF)) >> np.uint64(32 - bits)).astype(np.int64)
        counted = np.bincount(place, minlength=1 << bits)[place]
        least = counted if least is None else np.minimum(least, counted)
    return least


def _suspected(sketches: DataFrame, slots: int) -> DataFrame:
    """(chunk, slot, cells): a chunk's cells estimated at two documents or more."""

    def answer(rows):
        lists = [np.frombuffer(r[2], np.uint32) for r in rows]
        merged = np.concatenate(lists)
        often = estimates(merged) >= 2
        ends = np.cumsum([len(x) for x in lists])
        out = []
        for row, cells, end in zip(rows, lists, ends.tolist()):
            hit = np.unique(cells[often[end - len(cells):end]])
            if len(hit):
                out.append((row[0], row[1], hit.tobytes()))
        return out

    return _slotted(sketches, slots, answer, ["chunk", "slot", "cells"], "chunk long, slot int, cells binary")


def _answers(replies: DataFrame, *columns: str) -> DataFrame:
    return replies.groupBy("chunk").agg(F.collect_list(F.struct("slot", *columns)).alias("answers"))


def _judged(chunks: DataFrame, suspected: DataFrame, window: int, slots: int, with_text: bool) -> DataFrame:
    """(chunk, ids, n_words, shas, has, norm, at), written: what is final of
    each document, the texts of those with suspected windows, and these."""
    names = ["chunk", "ids", "n_words", "shas", "has", "norm", "at"]

    def run(batches):
        for batch in batches:
            for chunk, ids, norm, answers in zip(*[c.to_pylist() for c in batch.columns]):
                norm = unpacked(norm)
                words = Words(norm)
                at, cell = words.cells(window, slots)
                if answers:
                    known = np.sort(np.concatenate(
                        [np.frombuffer(a["cells"], np.uint32).astype(np.uint64) | np.uint64(a["slot"] << 32)
                         for a in answers]))
                    place = np.minimum(np.searchsorted(known, cell), len(known) - 1)
                    at = at[known[place] == cell]
                else:
                    at = at[:0]
                own = norm.split(b"\n")
                n_words = np.bincount(words.doc, minlength=len(own))
                has = np.zeros(len(own), bool)
                has[words.doc[at]] = True
                if with_text:
                    has[:] = True
                # numbers of the suspected windows' first words among the words that stay
                gone = np.concatenate([[0], np.cumsum(np.where(has, 0, n_words))])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                     pa.array([n_words.astype(np.int64).tobytes()]),
                     pa.array([b"".join([hashlib.sha256(t).digest() for t in own])]),
                     pa.array([has.tobytes()]), pa.array([packed(b"\n".join([t for t, h in zip(own, has) if h]))]),
                     pa.array([packed_places(at - gone[words.doc[at]])])], names=names)

    joined = chunks.join(_answers(suspected, "cells"), "chunk", "left").select("chunk", "ids", "norm", "answers")
    return written(joined.mapInArrow(
        run, "chunk long, ids array<long>, n_words binary, shas binary, has binary, norm binary, at binary"))


class Keys:
    """A chunk's suspected windows: their documents, and the distinct digests
    in order, each with its smallest document."""

    def __init__(self, ids: list, has: bytes, norm: bytes, at: bytes, window: int, slots: int):
        self.words = Words(norm)
        self.at = places(at)
        rows = np.flatnonzero(np.frombuffer(has, bool))
        usable = np.array([ids[i] is not None for i in rows.tolist()], bool)
        number = np.array([ids[i] or 0 for i in rows.tolist()], np.int64)
        doc = self.words.doc[self.at]
        self.at, doc = self.at[usable[doc]], doc[usable[doc]]
        self.doc = number[doc]
        pairs = self.words.digests(self.at, window).astype(np.uint64)
        order = np.lexsort((self.doc, pairs[:, 1], pairs[:, 0]))
        pairs = pairs[order]
        new = np.ones(len(order), bool)
        new[1:] = (pairs[1:] != pairs[:-1]).any(axis=1)
        self.key = np.empty(len(order), np.int64)
        self.key[order] = np.cumsum(new) - 1
        self.pairs, self.first = pairs[new], self.doc[order][new]
        self.slot = (((self.pairs[:, 0] >> np.uint64(32)) * np.uint64(slots)) >> np.uint64(32)).astype(np.int64)


def _windows(judged: DataFrame, window: int, slots: int) -> DataFrame:
    """(chunk, slot, digests, firsts) of the suspected windows; the firsts, few different numbers, compressed."""

    def run(batches):
        for batch in batches:
            for chunk, ids, has, norm, at in zip(*[c.to_pylist() for c in batch.columns]):
                if not at:
                    continue
                own = Keys(ids, has, unpacked(norm), at, window, slots)
                yield _rows([(*row, packed(firsts)) for *row, firsts in _by_slot(chunk, own.slot, [own.pairs, own.first])],
                            ["chunk", "slot", "digests", "firsts"])

    return (judged.select("chunk", "ids", "has", "norm", "at")
            .mapInArrow(run, "chunk long, slot int, digests binary, firsts binary"))


def _smaller(windows: DataFrame, slots: int) -> DataFrame:
    """(chunk, slot, less): of a chunk's windows in a slot, in order, a bit
    for each that also starts in a document smaller than the chunk's; no row
    where none does."""

    def answer(rows):
        lists = [np.frombuffer(r[2], np.uint64).reshape(-1, 2) for r in rows]
        pairs = np.concatenate(lists)
        docs = np.concatenate([np.frombuffer(unpacked(r[3]), np.int64) for r in rows])
        order = np.lexsort((docs, pairs[:, 1], pairs[:, 0]))
        ranked = pairs[order]
        new = np.ones(len(order), bool)
        new[1:] = (ranked[1:] != ranked[:-1]).any(axis=1)
        least = np.empty(len(order), np.int64)
        least[order] = docs[order][new][np.cumsum(new) - 1]
        out, end = [], 0
        for row, own in zip(rows, lists):
            part = slice(end, end := end + len(own))
            less = least[part] < docs[part]
            if less.any():
                out.append((row[0], row[1], np.packbits(less).tobytes()))
        return out

    return _slotted(windows, slots, answer, ["chunk", "slot", "less"], "chunk long, slot int, less binary")


def drop_repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                          chunk_bytes: int = CHUNK_BYTES, with_text: bool = False) -> DataFrame:
    """One row per input row: id, n_words, n_removed, kept_sha256 and, with
    ``with_text``, kept_text: its words without those that a window covers
    which also starts in a document with a smaller id."""
    slots = shuffle_partitions(docs.sparkSession)
    own = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    chunks = _chunks(own, chunk_bytes)
    suspected = _suspected(_sketches(chunks, window, slots), slots)
    judged = _judged(chunks, suspected, window, slots, with_text)
    answers = _answers(_smaller(_windows(judged, window, slots), slots), "less")

    def run(batches):
        for batch in batches:
            for _, ids, n_words, shas, has, norm, at, answers in zip(*[c.to_pylist() for c in batch.columns]):
                n_words = np.frombuffer(n_words, np.int64)
                removed = np.zeros(len(ids), np.int64)
                shas = [shas[i:i + 32].hex() for i in range(0, len(shas), 32)]
                rows = np.flatnonzero(np.frombuffer(has, bool))
                norm = unpacked(norm)
                texts_of = norm.split(b"\n") if len(rows) else []
                if at:
                    own = Keys(ids, has, norm, at, window, slots)
                    less = np.zeros(len(own.slot), bool)
                    for a in answers or []:
                        lo, hi = np.searchsorted(own.slot, [a["slot"], a["slot"] + 1])
                        less[lo:hi] = np.unpackbits(np.frombuffer(a["less"], np.uint8), count=hi - lo)
                    lost = own.at[less[own.key] | (own.first[own.key] < own.doc)]
                    gone = np.zeros(len(own.words.starts) + 1, np.int64)
                    np.add.at(gone, lost, 1)
                    np.add.at(gone, lost + window, -1)
                    gone = np.cumsum(gone[:-1]) > 0
                    in_doc = np.bincount(own.words.doc, weights=gone, minlength=len(rows)).astype(np.int64)
                    begins = np.searchsorted(own.words.doc, np.arange(len(rows) + 1))
                    for i in np.flatnonzero(in_doc).tolist():
                        kept = [w for w, g in zip(texts_of[i].split(b" "), gone[begins[i]:begins[i + 1]].tolist())
                                if not g]
                        texts_of[i] = b" ".join(kept)
                        shas[rows[i]] = hashlib.sha256(texts_of[i]).hexdigest()
                    removed[rows] = in_doc
                columns = [pa.array(ids, pa.int64()), pa.array(n_words, pa.int64()), pa.array(removed, pa.int64()),
                           pa.array(shas, pa.string())]
                if with_text:
                    columns.append(pa.array(texts_of, pa.binary()).cast(pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["id", "n_words", "n_removed", "kept_sha256"] + ["kept_text"] * with_text
    joined = judged.join(answers, "chunk", "left").select(*judged.columns, "answers")
    schema = "id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    return joined.mapInArrow(run, schema).withColumnRenamed("id", id_col)


ORACLE_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, p, list_aggregate(w[p:p + 12], 'string_agg', ' ') AS win
  FROM words, unnest(range(1, greatest(len(w) - 11, 1))) AS t(p)
), firsts AS (
  SELECT win, min(doc_id) AS first FROM windows GROUP BY win HAVING min(doc_id) <> max(doc_id)
), gone AS (
  SELECT DISTINCT w.doc_id, w.p + k AS pos
  FROM windows w JOIN firsts f ON f.win = w.win AND f.first < w.doc_id, unnest(range(0, 13)) AS t(k)
), positions AS (
  SELECT doc_id, unnest(range(1, len(w) + 1)) AS pos, unnest(w) AS word FROM words
), kept AS (
  SELECT p.doc_id, count(*) FILTER (WHERE g.pos IS NOT NULL) AS n_removed,
         string_agg(p.word, ' ' ORDER BY p.pos) FILTER (WHERE g.pos IS NULL) AS text
  FROM positions p LEFT JOIN gone g ON g.doc_id = p.doc_id AND g.pos = p.pos GROUP BY p.doc_id
)
SELECT w.doc_id, len(w.w) AS n_words, coalesce(k.n_removed, 0) AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM words w LEFT JOIN kept k ON k.doc_id = w.doc_id
"""


def op12_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return drop_repeated_windows(table(spark, sf_dir, "documents"))
