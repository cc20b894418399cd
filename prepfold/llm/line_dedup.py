"""Line deduplication with two Bloom filters.

Pass 1 hashes the distinct line keys of every document (64 bits, 8 bytes a
key; a task sends a hash at most twice, however many of its documents hold
it) to slots of the hash range. Each slot runs its hashes through a Bloom
filter of keys seen once and gathers those met again; these fill the slot's
Bloom filter of keys seen twice. The once-seen filters never leave their
slots; the twice-seen filters together are at most ``max_filter_bytes``, and
every task gets them. Pass 2 tests each line key against them: only suspected
repeats shuffle, with their whole text, to be confirmed exactly and to find
the smallest document that holds them. Bloom filters have no false negatives,
so every repeat is suspected; a filter that is too full only lets more lines
through to the exact step, which decides alone.

Defined results: a null or empty text is one empty line; a key is a line
without the white space at its ends, A-Z lower-cased; keys shorter than
``min_chars`` code points stay; a document is a doc_id, so lines of rows that
repeat a doc_id count as one document's; rows with a null doc_id keep all
lines and count for no one; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import shuffle_partitions, table, texts, written

MIN_CHARS = 10
#: Bits of the once-seen filter for each hash of a slot, and of the twice-seen.
BITS_PER_KEY = 16
PROBES = 4
#: Bound of what every task gets; beyond it the filters are fuller, not the result poorer.
MAX_FILTER_BYTES = 256 << 20
#: Hashes a task gathers before it sends them to their slots.
FLUSH = 1 << 20


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """The key of a line (bytes.strip and bytes.lower know ASCII only), or
    None where it is too short to count."""
    key = line.strip().lower()
    if len(key) < min_chars or (not key.isascii() and len(key.decode("utf-8", "replace")) < min_chars):
        return None
    return key


def _keys(text: bytes, min_chars: int) -> set[bytes]:
    keys = {line_key(line, min_chars) for line in text.split(b"\n")}
    keys.discard(None)
    return keys


def _slots(hashes: np.ndarray, slots: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(slots)) >> np.uint64(32)


def _probes(hashes: np.ndarray, mask) -> list[np.ndarray]:
    """PROBES bit places of each hash by double hashing; mask: size - 1, a
    power of two less one, one for all or one for each."""
    step = (hashes * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(17)) | np.uint64(1)
    return [(hashes + np.uint64(k) * step) & mask for k in range(PROBES)]


def _power(bits: float) -> int:
    return 1 << max(10, int(np.ceil(np.log2(max(bits, 1)))))


class Bloom:
    """A Bloom filter over numpy arrays of 64-bit hashes."""

    def __init__(self, bits: int):
        self.mask = np.uint64(bits - 1)
        self.bytes = np.zeros(bits // 8, np.uint8)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for p in _probes(hashes, self.mask):
            found &= (self.bytes[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return found

    def add(self, hashes: np.ndarray) -> None:
        for p in _probes(hashes, self.mask):
            np.bitwise_or.at(self.bytes, (p >> np.uint64(3)).astype(np.int64),
                             np.uint8(1) << (p & np.uint64(7)).astype(np.uint8))


def _hash_lists(docs: DataFrame, slots: int, min_chars: int) -> DataFrame:
    """(slot, n, hashes): what each task sends to each slot."""

    def run(batches):
        once: dict[int, int] = {}  # hash -> the document that had it
        twice: set[int] = set()

        def flush():
            found = np.fromiter(once, np.uint64, len(once))
            found = np.sort(np.concatenate([found, np.fromiter(twice, np.uint64, len(twice))]))
            slot = _slots(found, slots).astype(np.int64)
            cuts = np.flatnonzero(np.diff(slot, prepend=-1))
            parts = np.split(found, cuts[1:]) if len(found) else []
            once.clear()
            twice.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(slot[cuts], pa.int32()), pa.array([len(p) for p in parts], pa.int64()),
                 pa.array([p.tobytes() for p in parts], pa.binary())], names=["slot", "n", "hashes"])

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), texts(batch.column(1))):
                for key in _keys(text, min_chars):
                    h = xxhash.xxh64_intdigest(key)
                    if once.setdefault(h, doc) != doc:
                        twice.add(h)
                if len(once) >= FLUSH:
                    yield flush()
        yield flush()

    return docs.mapInArrow(run, "slot int, n long, hashes binary")


def _twice_filters(lists: DataFrame, slots: int, once_bits: int, max_slot_bits: int) -> DataFrame:
    """(slot, bits): the filter of hashes a slot got more than once."""

    def run(batches):
        slot, once, twice = None, None, []

        def close():
            found = np.unique(np.concatenate(twice)) if twice else np.empty(0, np.uint64)
            seen = Bloom(min(_power(BITS_PER_KEY * len(found)), max_slot_bits))
            seen.add(found)
            return pa.RecordBatch.from_arrays(
                [pa.array([slot], pa.int32()), pa.array([seen.bytes.tobytes()], pa.binary())],
                names=["slot", "bits"])

        for batch in batches:
            for s, hashes in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if s != slot:
                    if twice:
                        yield close()
                    slot, once, twice = s, Bloom(once_bits), []
                found, counts = np.unique(np.frombuffer(hashes, np.uint64), return_counts=True)
                again = once.holds(found) | (counts > 1)
                if again.any():
                    twice.append(found[again])
                once.add(found[~again])
        if twice:
            yield close()

    return (lists.select("slot", "hashes").repartition(slots, "slot").sortWithinPartitions("slot")
            .mapInArrow(run, "slot int, bits binary"))


def _suspects(docs: DataFrame, filters: list, slots: int, min_chars: int) -> DataFrame:
    """(key, doc): each line key that the twice-seen filters hold, once a row."""
    base = np.zeros(slots, np.int64)
    mask = np.zeros(slots, np.uint64)
    bits = np.concatenate([np.zeros(128, np.uint8), *[np.frombuffer(b, np.uint8) for _, b in filters]])
    at = 128  # the first bytes stay empty, for slots without a repeat
    for slot, b in filters:
        base[slot], mask[slot] = at, len(b) * 8 - 1
        at += len(b)
    shared = docs.sparkSession.sparkContext.broadcast((base, mask, bits))

    def run(batches):
        base, mask, bits = shared.value
        for batch in batches:
            keys, owners = [], []
            for doc, text in zip(batch.column(0).to_pylist(), texts(batch.column(1))):
                own = _keys(text, min_chars)
                keys.extend(own)
                owners.extend([doc] * len(own))
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, keys), np.uint64, len(keys))
            slot = _slots(hashes, slots).astype(np.int64)
            found = np.ones(len(keys), bool)
            for p in _probes(hashes, mask[slot]):
                at = base[slot] + (p >> np.uint64(3)).astype(np.int64)
                found &= (bits[at] >> (p & np.uint64(7)).astype(np.uint8)) & 1 == 1
            hit = np.flatnonzero(found).tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([keys[i] for i in hit], pa.binary()), pa.array([owners[i] for i in hit], pa.int64())],
                names=["key", "doc"])

    return docs.mapInArrow(run, "key binary, doc long")


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   min_chars: int = MIN_CHARS, max_filter_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """(doc, key): the line keys that each document has to drop."""
    spark = docs.sparkSession
    slots = shuffle_partitions(spark)
    own = (docs.select(F.col(f"`{id_col}`").cast("long").alias("doc"),
                       F.col(f"`{text_col}`").cast("string").alias("text")).filter("doc is not null"))
    lists = written(_hash_lists(own, slots, min_chars))
    total = lists.agg(F.sum("n")).first()[0] or 0
    once_bits = _power(BITS_PER_KEY * total / slots)
    max_slot_bits = 1 << int(np.log2(max(1024, max_filter_bytes * 8 // slots)))
    # At most max_filter_bytes in all, by the size of each slot's filter.
    filters = [tuple(r) for r in _twice_filters(lists, slots, once_bits, max_slot_bits).collect()]
    suspects = written(_suspects(own, filters, slots, min_chars))
    first = (suspects.groupBy("key").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
             .filter("first < last").select("key", "first"))
    return suspects.join(written(first), "key").filter("doc > first").select("doc", "key")


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        min_chars: int = MIN_CHARS, max_filter_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """One row per input row: id, n_lines, n_dropped, kept_sha256, kept_text."""
    drops = (repeated_lines(docs, id_col, text_col, min_chars, max_filter_bytes)
             .groupBy("doc").agg(F.collect_set("key").alias("keys")))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))
    joined = rows.join(drops, rows["id"] == drops["doc"], "left").select("id", "text", "keys")

    def run(batches):
        for batch in batches:
            n, dropped, shas, kept = [], [], [], []
            for text, keys in zip(texts(batch.column(1)), batch.column(2).to_pylist()):
                lines = text.split(b"\n")
                n.append(len(lines))
                if keys:
                    gone = set(keys)
                    lines = [x for x in lines if x.strip().lower() not in gone]
                    text = b"\n".join(lines)
                dropped.append(n[-1] - len(lines))
                shas.append(hashlib.sha256(text).hexdigest())
                kept.append(text)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(dropped, pa.int64()), pa.array(shas),
                 pa.array(kept, pa.binary()).cast(pa.string())],
                names=["id", "n_lines", "n_dropped", "kept_sha256", "kept_text"])

    return joined.mapInArrow(
        run, "id long, n_lines long, n_dropped long, kept_sha256 string, kept_text string",
    ).withColumnRenamed("id", id_col)


ORACLE_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents
), keyed AS (
  SELECT doc_id, pos, line,
         translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), firsts AS (
  SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), marked AS (
  SELECT k.doc_id, k.pos, k.line, f.first IS NOT NULL AND f.first <> k.doc_id AS gone
  FROM keyed k LEFT JOIN firsts f ON f.key = k.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def op3_line_dedup(spark, sf_dir: str) -> DataFrame:
    return drop_repeated_lines(table(spark, sf_dir, "documents")).drop("kept_text")
