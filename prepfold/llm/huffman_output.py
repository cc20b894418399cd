"""Token ids as files of canonical, length-limited Huffman codes.

Ids are counted over all documents, the code lengths (at most ``MAX_LENGTH``
bits) come from package-merge over those counts, and canonical codes follow
from the lengths alone. The files are a table of blocks in Parquet, so that
Spark's commit protocol protects them from lost executors, in segments that
rise with doc_id; the code lengths are a table beside them:

    codebook: id, length (bits; ids that occur)
    blocks: segment, block, start (ids of the segment before the block),
      doc_ids, n_tokens (a list each), bits (binary: the documents' codes,
      each document from a whole byte on), checkpoints (binary, unsigned 32
      bits: the bit offset of every 64th id of each document, in order)

A block holds whole documents and can be decoded with the codebook alone.
Decoding is table-driven: the next ``MAX_LENGTH`` bits index a table of id and
length. All stretches between checkpoints of a block advance together, a
table look-up for each in every step.

The ids are made once and kept as a table; counts, codes and files are made
from it. A first look at the doc_ids alone cuts them into as many ranges as
there are shuffle partitions, which are the segments.

Defined results: a null text counts as empty and has the end id alone; rows
with a null doc_id come first; rows that repeat a doc_id follow each other; an
empty table gives empty files and no rows; other columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_path
from .shared import shuffle_partitions, table, written
from .tokens import encoder, vocabulary_path

END_ID = 2
MAX_LENGTH = 16
STRIDE = 64
#: Ids in a block, as far as whole documents allow.
BLOCK = 1 << 18


# --- the code

def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Code lengths of at most ``limit`` bits that make the counted text
    shortest (package-merge); 0 for ids that do not occur."""
    lengths = np.zeros(len(counts), np.int64)
    used = np.flatnonzero(counts)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids need codes of more than {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.float64)
    levels, items = [], leaves
    is_leaf = np.ones(len(leaves), bool)
    for _ in range(limit):
        levels.append(is_leaf)
        packages = items[:len(items) // 2 * 2].reshape(-1, 2).sum(1)
        merged = np.concatenate([leaves, packages])
        turn = np.argsort(merged, kind="stable")
        items, is_leaf = merged[turn], turn < len(leaves)
    take = 2 * len(leaves) - 2
    for is_leaf in reversed(levels):
        own = int(is_leaf[:take].sum())
        lengths[order[:own]] += 1
        take = 2 * (take - own)
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes by length, then id."""
    used = np.flatnonzero(lengths)
    order = used[np.argsort(lengths[used], kind="stable")]
    codes = np.zeros(len(lengths), np.int64)
    size = lengths[order]
    top = int(size.max(initial=1))
    starts = np.cumsum(1 << (top - size)) - (1 << (top - size))
    codes[order] = starts >> (top - size)
    return codes


def encode_ids(ids: np.ndarray, at: np.ndarray, lengths: np.ndarray, codes: np.ndarray):
    """(bits, first byte of each document, checkpoints, first checkpoint of
    each): documents ids[at[k]:at[k + 1]], each from a whole byte on."""
    size = lengths[ids]
    upto = np.concatenate([[0], np.cumsum(size)])
    n_bytes = (upto[at[1:]] - upto[at[:-1]] + 7) // 8
    byte_at = np.concatenate([[0], np.cumsum(n_bytes)])
    counts = np.diff(at)
    shift = np.repeat(byte_at[:-1] * 8 - upto[at[:-1]], counts)
    place = upto[:-1] + shift
    out = np.zeros(int(byte_at[-1]) // 4 + 3, np.uint64)  # 32-bit words
    if len(ids):
        # A code lies in one or two words; codes of one word follow each other.
        value = (codes[ids].astype(np.uint64) << (64 - size - (place & 31)).astype(np.uint64))
        word = place >> 5
        first = np.flatnonzero(np.diff(word, prepend=-1))
        out[word[first]] += np.add.reduceat(value >> np.uint64(32), first)
        out[word[first] + 1] += np.add.reduceat(value & np.uint64(0xFFFFFFFF), first)
    bits = out.astype(">u4").tobytes()
    marks = np.concatenate([[0], np.cumsum(-(-counts // STRIDE))])
    k = np.arange(marks[-1]) - np.repeat(marks[:-1], np.diff(marks))
    every = np.repeat(at[:-1], np.diff(marks)) + k * STRIDE
    # Bit offsets from the document's first bit.
    checkpoints = upto[every] - np.repeat(upto[at[:-1]], np.diff(marks))
    return bits, byte_at, checkpoints, marks


def decode_block(bits: bytes, n_tokens: np.ndarray, checkpoints: np.ndarray, ids_of: np.ndarray,
                 length_of: np.ndarray, limit: int) -> np.ndarray:
    """The ids of a block's documents, one after the other."""
    data = np.frombuffer(bits + b"\0" * 8, np.uint8).astype(np.uint32)
    # The 32 bits from each byte on, so that a look-up is one shift.
    words = data[:-3] << 24 | data[1:-2] << 16 | data[2:-1] << 8 | data[3:]
    left = np.concatenate([np.minimum(STRIDE, n - STRIDE * np.arange(-(-n // STRIDE))) for n in n_tokens.tolist()])
    starts = np.cumsum(left) - left
    out = np.empty(int(left.sum()), np.uint32)
    order = np.argsort(-left, kind="stable")
    place, at = checkpoints[order].astype(np.int64), starts[order]
    going = np.searchsorted(-left[order], -np.arange(STRIDE), "left")  # stretches of more than k ids
    for k in range(STRIDE):
        n = going[k]
        if not n:
            break
        p = place[:n]
        look = (words[p >> 3] << (p & 7).astype(np.uint32)) >> np.uint32(32 - limit)
        out[at[:n] + k] = ids_of[look]
        place[:n] += length_of[look]
    return out


def decoding_tables(lengths: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """(id, length) for each value of the next ``limit`` bits."""
    codes = canonical_codes(lengths)
    used = np.flatnonzero(lengths)
    ids_of, length_of = np.zeros(1 << limit, np.uint32), np.ones(1 << limit, np.int64)
    order = used[np.argsort(codes[used] << (limit - lengths[used]))]
    reach = 1 << (limit - lengths[order])
    n = int(reach.sum())
    ids_of[:n], length_of[:n] = np.repeat(order, reach), np.repeat(lengths[order], reach)
    return ids_of, length_of


# --- writing

def _tokenised(docs: DataFrame, id_col: str, text_col: str, end_id: int, path: str) -> DataFrame:
    """(doc, n, ids): a document each; and rows (null, -1, counts) of what a
    task has seen. Ids take two bytes where the vocabulary allows."""

    def run(batches):
        own_encoder = encoder(path)
        size = max(own_encoder.tokenizer.get_vocab_size(), end_id + 1)
        kind = "<u2" if size <= 1 << 16 else "<u4"
        counts = np.zeros(size, "<i8")
        for batch in batches:
            for first, ids, at in own_encoder.slices(batch.column(1)):
                counts += np.bincount(ids, minlength=size)
                counts[end_id] += len(at) - 1
                data = np.insert(ids.astype(kind), at[1:], end_id)
                ends = ((at[1:] + np.arange(1, len(at))) * data.itemsize).tolist()
                blob = data.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(at) - 1), pa.array(np.diff(at) + 1, pa.int64()),
                     pa.array([blob[a:b] for a, b in zip([0, *ends], ends)], pa.binary())], names=["doc", "n", "ids"])
        yield pa.RecordBatch.from_arrays(
            [pa.array([None], pa.int64()), pa.array([-1], pa.int64()), pa.array([counts.tobytes()], pa.binary())],
            names=["doc", "n", "ids"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc long, n long, ids binary")


def _counts(tokens: DataFrame) -> np.ndarray:
    """Global counts; each task's were added up in the task already, and are
    added up again by id in Spark."""

    def run(batches):
        total = None
        for batch in batches:
            for b in batch.column(0).to_pylist():
                own = np.frombuffer(b, "<i8")
                total = own.copy() if total is None else total + own
        if total is not None:
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["id", "count"])

    rows = (tokens.filter("n = -1").select("ids").mapInArrow(run, "id long, count long")
            .groupBy("id").agg(F.sum("count").alias("count")).collect())  # at most the vocabulary
    counts = np.zeros(max((r[0] for r in rows), default=0) + 1, np.int64)
    for i, n in rows:
        counts[i] = n
    return counts


def write_ids(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID,
              path: str | None = None, out: str | None = None, limit: int = MAX_LENGTH) -> str:
    """Write the files; returns their folder (by default one in the shared
    folder of the session)."""
    spark = docs.sparkSession
    path = path or vocabulary_path()
    out = out or shared_path(spark, "ids", uuid.uuid4().hex)
    tokens = written(_tokenised(docs, id_col, text_col, end_id, path))
    counts = _counts(tokens)
    limit = max(limit, int(np.ceil(np.log2(max(2, np.count_nonzero(counts))))))
    lengths = code_lengths(counts, limit)
    used = np.flatnonzero(lengths)
    (spark.createDataFrame([(int(i), int(lengths[i])) for i in used], "id int, length int")
     .coalesce(1).write.parquet(f"{out}/codebook"))
    rows = tokens.filter("n >= 0")
    n = shuffle_partitions(spark)
    bounds = np.unique(rows.filter("doc is not null").approxQuantile("doc", [k / n for k in range(1, n)], 1 / (4 * n)))
    codes = canonical_codes(lengths)
    kind = "<u2" if len(counts) <= 1 << 16 else "<u4"

    def encode(batches):
        for batch in batches:
            upto = np.cumsum(batch.column(1).to_numpy())
            lo = 0
            while lo < batch.num_rows:  # about BLOCK ids at a time
                hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + BLOCK, "right")))
                yield coded_rows(batch.slice(lo, hi - lo))
                lo = hi

    def coded_rows(batch):
        at = np.concatenate([[0], np.cumsum(batch.column(1).to_numpy())])
        ids = np.frombuffer(b"".join(batch.column(2).to_pylist()), kind).astype(np.int64)
        bits, byte_at, marks, mark_at = encode_ids(ids, at, lengths, codes)
        doc = batch.column(0)
        segment = np.searchsorted(bounds, doc.fill_null(-(1 << 62)).to_numpy(), "right")
        byte_at, mark_at = byte_at.tolist(), mark_at.tolist()
        return pa.RecordBatch.from_arrays(
            [pa.array(segment, pa.int32()), doc, batch.column(1),
             pa.array([bits[a:b] for a, b in zip(byte_at, byte_at[1:])], pa.binary()),
             pa.array([marks[a:b].astype("<u4").tobytes() for a, b in zip(mark_at, mark_at[1:])], pa.binary())],
            names=["segment", "doc", "n", "bits", "marks"])

    coded = rows.mapInArrow(encode, "segment int, doc long, n long, bits binary, marks binary")
    sorted_rows = coded.repartition(n, "segment").sortWithinPartitions("segment", "doc", "n")
    (sorted_rows.mapInArrow(_blocks, "segment int, block int, start long, doc_ids array<long>, "
                            "n_tokens array<long>, bits binary, checkpoints binary")
     .write.option("compression", "none").parquet(f"{out}/blocks"))
    return out


def _blocks(batches):
    """Documents, sorted, to blocks of about BLOCK ids."""
    segment, block, start = None, 0, 0
    held: list = []

    def close():
        sizes = [len(r[2]) for r in held]
        at = np.cumsum([0, *sizes[:-1]])
        marks = b"".join((np.frombuffer(r[3], "<u4") + np.uint32(8 * a)).tobytes() for r, a in zip(held, at.tolist()))
        return pa.RecordBatch.from_arrays(
            [pa.array([segment], pa.int32()), pa.array([block], pa.int32()), pa.array([start], pa.int64()),
             pa.array([[r[0] for r in held]], pa.list_(pa.int64())),
             pa.array([[r[1] for r in held]], pa.list_(pa.int64())),
             pa.array([b"".join(r[2] for r in held)], pa.binary()), pa.array([marks], pa.binary())],
            names=["segment", "block", "start", "doc_ids", "n_tokens", "bits", "checkpoints"])

    total = 0
    for batch in batches:
        for s, *row in zip(*(c.to_pylist() for c in batch.columns)):
            if held and (s != segment or total >= BLOCK):
                yield close()
                block, start, held, total = block + 1, start + total, [], 0
            if s != segment:
                segment, block, start = s, 0, 0
            held.append(row)
            total += row[1]
    if held:
        yield close()


# --- reading

def read_ids(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) from the files alone."""
    book = spark.read.parquet(f"{folder}/codebook").collect()  # at most the vocabulary
    lengths = np.zeros(max((r[0] for r in book), default=0) + 1, np.int64)
    for i, n in book:
        lengths[i] = n
    limit = max(1, int(lengths.max(initial=1)))
    blocks = spark.read.parquet(f"{folder}/blocks")
    sizes = (blocks.select("segment", F.explode("n_tokens").alias("n")).groupBy("segment")
             .agg(F.sum("n").alias("n")).collect())  # a row for each segment
    before, upto = {}, 0
    for s, n in sorted(tuple(r) for r in sizes):
        before[s] = upto
        upto += n

    def run(batches):
        ids_of, length_of = decoding_tables(lengths, limit)
        for batch in batches:
            for segment, start, docs, n_tokens, bits, marks in zip(*(c.to_pylist() for c in batch.columns)):
                n_tokens = np.array(n_tokens, np.int64)
                ids = decode_block(bits, n_tokens, np.frombuffer(marks, "<u4"), ids_of, length_of, limit)
                data = ids.astype("<u4", copy=False).tobytes()
                ends = np.cumsum(n_tokens)
                parts = [data[4 * a:4 * b] for a, b in zip([0, *ends.tolist()], ends.tolist())]
                columns = [pa.array(docs, pa.int64()), pa.array(before[segment] + start + ends - n_tokens),
                           pa.array(n_tokens), pa.array([zlib.crc32(x) for x in parts], pa.int64())]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns, names = [*columns, pa.array(parts, pa.binary())], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else "")
    return (blocks.select("segment", "start", "doc_ids", "n_tokens", "bits", "checkpoints")
            .mapInArrow(run, schema))


def op4_huffman_output(spark, sf_dir: str) -> DataFrame:
    """No SQL form: DuckDB has no tokenizer; the tests check an exact round
    trip against the library's ids."""
    return read_ids(spark, write_ids(table(spark, sf_dir, "documents")))
