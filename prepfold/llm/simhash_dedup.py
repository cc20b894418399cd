"""SimHash near-duplicates found by Golay-code fuzzy hashing.

A document's 64-bit fingerprint has a bit set where over half of its word
shingles' XXH64 hashes have it. Fingerprints within ``max_bits`` bits are
linked, and linked documents form a component.

Search. A fingerprint is cut into three segments (22, 21 and 21 bits). With at
most two differing bits, one segment at least is equal, and the next one has
at most two errors. That one is decoded by the perfect binary Golay code
(23, 12, 7): every codeword within four bits of it gives an index, which is
one or six indices. Two words within two bits of each other share one: take
a word between them, at most one bit from either; the code is perfect, so a
codeword lies within three bits of it and within four of both. So the key
(segment number, equal segment, Golay index of the next segment), 3 to 18
keys a fingerprint, meets every linked pair in some bucket, with no cap.

Verification. Equal fingerprints are one row from the start, however many
documents have them. Buckets are sorted runs in the partitions of the key; a
run's fingerprints are compared by bit count, in blocks, and only the links of
a spanning forest leave it, never all pairs. In a run of over ``DENSE``
fingerprints each looks up its neighbours' values instead (at most 1 + 43 +
903 of them), so the work stays in proportion to the run.

Defined results: a null or empty text has no words and fingerprint zero,
linked like any other; fewer words than a shingle make one shingle; a null
doc_id takes part but is never a component_id unless the component has no
other; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import free_name, shuffle_partitions, table, texts, written

SHINGLE = 3
SEED = 42
MAX_BITS = 2
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # start and width
#: Generator polynomial of the Golay code: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GOLAY = 0b110001110101
SHORT = 16
DENSE = 4096
BLOCK = 256
ROW = "__row"


# --- fingerprints

def _spread() -> np.ndarray:
    """For each byte, its eight bits as eight bytes of a 64-bit word."""
    bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
    return np.ascontiguousarray(bits).view("<u8").ravel()


def fingerprint(text: bytes, size: int, seed: int, spread: np.ndarray) -> int:
    """bytes.lower and bytes.split know ASCII letters and white space only."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < size:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*(words[k:] for k in range(size)))))
    n = len(shingles)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(seed)), "<u8", n)
    lanes = np.add.reduceat(spread[hashes.view(np.uint8).reshape(n, 8)], np.arange(0, n, 255), axis=0)
    counts = lanes.view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """docs: id, row, text -> id, row, fp (the fingerprint's bits as a long)."""

    def run(batches):
        spread = _spread()
        for batch in batches:
            found = [fingerprint(t, size, seed, spread) for t in texts(batch.column(2))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.array(found, np.uint64).view(np.int64))],
                names=["id", "row", "fp"])

    return docs.select("id", "row", "text").mapInArrow(run, "id long, row long, fp long")


# --- Golay keys

def _syndromes(words: np.ndarray) -> np.ndarray:
    """Remainder of 23-bit words by the generator polynomial."""
    left = words.astype(np.uint32)
    for bit in range(22, 10, -1):
        left = np.where(left >> np.uint32(bit) & np.uint32(1), left ^ np.uint32(GOLAY << (bit - 11)), left)
    return left


def _error_patterns() -> np.ndarray:
    """For each of the 2048 syndromes the one error of at most three bits."""
    one = np.uint32(1) << np.arange(23, dtype=np.uint32)
    two = (one[:, None] | one).ravel()
    three = (two[:, None] | one).ravel()
    errors = np.unique(np.concatenate([np.zeros(1, np.uint32), three]))
    found = np.zeros(2048, np.uint32)
    found[_syndromes(errors)] = errors
    return found


def golay_indices(words: np.ndarray) -> np.ndarray:
    """Indices (n, 6) of the codewords within four bits of 23-bit words; -1
    where there are fewer. A codeword within four bits of a word is the one
    nearest to the word itself or to a word one bit away."""
    errors = _error_patterns()
    near = np.concatenate([np.zeros(1, np.uint32), np.uint32(1) << np.arange(23, dtype=np.uint32)])
    words = words.astype(np.uint32)
    index = np.empty((len(words), 24), np.int32)
    for k, flip in enumerate(near):
        word = words ^ flip
        index[:, k] = (word ^ errors[_syndromes(word)]) >> np.uint32(11)
    index.sort(axis=1)
    index[:, 1:][index[:, 1:] == index[:, :-1]] = -1
    index.sort(axis=1)
    return index[:, -6:]


def golay_keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position in fp, key) of every key of every fingerprint."""
    parts = [(fp >> np.uint64(a)) & np.uint64((1 << w) - 1) for a, w in SEGMENTS]
    at, keys = [], []
    for s in range(3):
        index = golay_indices(parts[(s + 1) % 3])
        own = (np.uint64(s) << np.uint64(34) | parts[s] << np.uint64(12)).astype(np.int64)[:, None] | index
        row, col = np.nonzero(index >= 0)
        at.append(row)
        keys.append(own[row, col])
    return np.concatenate(at), np.concatenate(keys)


def _keyed(distinct: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            at, keys = golay_keys(fp.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(fp[at])], names=["key", "fp"])

    return distinct.select("fp").mapInArrow(run, "key long, fp long")


# --- verification inside the buckets

def _root(parent: dict, x):
    while (up := parent.get(x, x)) != x:
        parent[x] = x = parent.get(up, up)
    return x


def _join(parent: dict, a: np.ndarray, b: np.ndarray) -> None:
    pairs = np.unique(np.stack([a, b], 1), axis=0)
    for x, y in pairs[pairs[:, 0] != pairs[:, 1]].tolist():
        x, y = _root(parent, x), _root(parent, y)
        if x != y:
            parent[max(x, y)] = min(x, y)


def _forest(fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (i, root of i) of the fingerprints of one long run."""
    m, parent, label = len(fp), {}, np.arange(len(fp))

    def relabel():
        known = np.unique(label)
        label[:] = np.array([_root(parent, x) for x in known.tolist()])[np.searchsorted(known, label)]

    if m <= DENSE:
        for i in range(0, m, BLOCK):
            near = np.bitwise_count(fp[i:i + BLOCK, None] ^ fp[None, i:]) <= max_bits
            row, col = np.nonzero(near)
            _join(parent, label[row + i], label[col + i])
            relabel()
    else:
        order = np.argsort(fp)
        ranked = fp[order]
        varies = [b for b in range(64) if int(np.bitwise_or.reduce(fp ^ fp[0])) >> b & 1]
        flips = [1 << b for b in varies] if max_bits else []
        if max_bits > 1:
            flips += [1 << b | 1 << c for k, b in enumerate(varies) for c in varies[:k]]
        for k, flip in enumerate(flips):
            wanted = ranked ^ np.uint64(flip)
            at = np.minimum(np.searchsorted(ranked, wanted), m - 1)
            hit = np.flatnonzero(ranked[at] == wanted)
            _join(parent, label[order[hit]], label[order[at[hit]]])
            relabel()
    linked = np.flatnonzero(label != np.arange(m))
    return linked, label[linked]


def _links_of(key: np.ndarray, fp: np.ndarray, max_bits: int) -> pa.RecordBatch:
    """Verified links in whole runs of sorted keys: all of short runs, a
    spanning forest of long ones."""
    a, b = [], []
    bits = fp.view(np.uint64)
    starts = np.flatnonzero(np.diff(key, prepend=key[0] - 1)) if len(key) else np.empty(0, np.int64)
    sizes = np.diff(np.append(starts, len(key)))
    for o in range(1, min(SHORT, int(sizes.max(initial=1)))):
        i = np.flatnonzero(key[:-o] == key[o:])
        i = i[np.repeat(sizes, sizes)[i] <= SHORT]
        i = i[np.bitwise_count(bits[i] ^ bits[i + o]) <= max_bits]
        a.append(fp[i])
        b.append(fp[i + o])
    for start, size in zip(starts[sizes > SHORT], sizes[sizes > SHORT]):
        own = slice(start, start + size)
        i, root = _forest(bits[own], max_bits)
        a.append(fp[own][i])
        b.append(fp[own][root])
    none = np.empty(0, np.int64)
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate([none, *a])), pa.array(np.concatenate([none, *b]))],
                                      names=["a", "b"])


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """distinct: fp, each once -> (a, b) links that span every component."""
    if not 0 <= max_bits <= 2:
        raise ValueError("the Golay keys meet every pair of at most 2 differing bits, not more")

    def run(batches):
        key, fp = [], []
        for batch in batches:
            k, f = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
            if not len(k):
                continue
            if key and k[-1] != key[0][-1]:
                cut = int(np.searchsorted(k, k[-1]))
                yield _links_of(np.concatenate([*key, k[:cut]]), np.concatenate([*fp, f[:cut]]), max_bits)
                key, fp, k, f = [], [], k[cut:], f[cut:]
            key.append(k)
            fp.append(f)
        if key:
            yield _links_of(np.concatenate(key), np.concatenate(fp), max_bits)

    n = shuffle_partitions(distinct.sparkSession)
    return (_keyed(distinct).repartition(n, "key").sortWithinPartitions("key")
            .mapInArrow(run, "a long, b long"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    row_col: str | None = None, size: int = SHINGLE, seed: int = SEED,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """One row per input row: id, fingerprint, component_id, kept.

    ``kept`` marks one row of each component, the one of the smallest id (null
    last). With ``row_col`` (a column that numbers the rows) that column comes
    along; without it rows are numbered as they are written.
    """
    row = F.col(f"`{row_col}`") if row_col else F.monotonically_increasing_id()
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), row.cast("long").alias("row"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))
    prints = written(fingerprints(rows, size, seed))
    first = F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "row")).alias("first")
    classes = written(prints.groupBy("fp").agg(first))
    roots = components(links(classes, max_bits))  # node, root
    members = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
    grouped = written(members.join(classes, members["node"] == classes["fp"]).select("node", "root", "first"))
    heads = written(grouped.groupBy("root").agg(F.min("first").alias("head")))
    named = grouped.join(heads, "root").select(F.col("node").alias("fp"), "head")
    heads_of = written(classes.join(named, "fp", "left").select("fp", F.coalesce("head", "first").alias("head")))
    return prints.join(heads_of, "fp").select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("head.id").alias("component_id"),
        (F.col("head.row") == F.col("row")).alias("kept"),
        *([F.col("row").alias(row_col)] if row_col else []))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
                max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each component; columns stay as they are."""
    number = free_name(docs.columns, ROW)
    rows = written(docs.withColumn(number, F.monotonically_increasing_id()))
    dropped = near_duplicates(rows, id_col, text_col, number, size, max_bits=max_bits).filter("not kept").select(number)
    return rows.join(dropped, number, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def op5_simhash_dedup(spark, sf_dir: str) -> DataFrame:
    """No SQL form: DuckDB has no XXH64; the tests hold it against brute force."""
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")
