"""Best-fit packing of documents into token sequences by sum of squares.

A document's ids with the end id are cut only if they are more than a
sequence holds; then the first piece takes what is over, and the others are
full and make a sequence each. Every other piece goes where the sum of
squares of the number of open sequences per residual gap becomes smallest (a
new sequence counts as the gap of the whole capacity; of equal choices the
tightest wins, an open one before a new one). Counts that stay level over the
gaps leave a partner for whatever length comes next, so the waste grows far
more slowly than the number of pieces.

Pieces are dealt by hash to groups of about ``GROUP``, packed independently:
the rule is sequential, and each group ends with no more open sequences than
one run over everything would. Within a group, pieces come in hash order,
those under an eighth of the capacity last and longest first, to fill gaps.
The number of groups follows the number of pieces; no group grows with the
input. The pieces (not their texts) are written before they are dealt.

Defined results: a null text counts as empty, which is one piece of the end
id alone; repeated rows are packed as often as they come; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import table, written
from .tokens import encoder, vocabulary_path

CAPACITY = 2048
END_ID = 0
#: Pieces packed by one run of the rule.
GROUP = 1 << 16


def piece_bounds(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, end) of the pieces of n ids: the first takes the rest."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(k, k + capacity) for k in range(first, n, capacity)]


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
           end_id: int = END_ID, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every document; ids
    are little-endian unsigned 32-bit integers."""
    path = path or vocabulary_path()
    end = int(end_id).to_bytes(4, "little")

    def run(batches):
        own_encoder = encoder(path)
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()][:5 + with_ids]
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][:5 + with_ids]
        for batch in batches:
            for first, ids, at in own_encoder.slices(batch.column(1)):
                data = memoryview(ids.astype("<u4", copy=False)).cast("B")
                out = []
                for d, doc in enumerate(batch.column(0).slice(first, len(at) - 1).to_pylist()):
                    own = bytes(data[4 * at[d]:4 * at[d + 1]]) + end
                    for k, (a, b) in enumerate(piece_bounds(len(own) // 4, capacity)):
                        part = own[4 * a:4 * b]
                        out.append((doc, k, a, b - a, zlib.crc32(part), *([part] if with_ids else [])))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return rows.mapInArrow(run, schema + (", ids binary" if with_ids else ""))


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence number, offset) of each length, in the order given."""
    counts = np.zeros(capacity + 1, np.int64)  # open sequences per gap
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    never = np.int64(1) << 60
    sequence = np.empty(len(lengths), np.int64)
    offset = np.empty(len(lengths), np.int64)
    made = 0
    for i, size in enumerate(lengths.tolist()):
        here = counts[size:]
        # Placing into gap g changes the sum by 2 (N[g - size] - N[g]) + 2; filling it up by 1 - 2 N[g].
        change = np.where(here > 0, 2 * (counts[:capacity + 1 - size] - here) + 2, never)
        if here[0] > 0:
            change[0] = 1 - 2 * here[0]
        k = int(change.argmin())
        if change[k] <= (2 * counts[capacity - size] + 1 if size < capacity else 0):
            gap = k + size
            counts[gap] -= 1
            s = open_at[gap].pop()
        else:
            gap, s = capacity, made
            made += 1
        sequence[i], offset[i] = s, capacity - gap
        if gap > size:
            counts[gap - size] += 1
            open_at[gap - size].append(s)
    return sequence, offset


def pack(rows: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """``rows`` (with a length of 1 to capacity, and any other columns) with
    sequence_id and offset."""
    rows = written(rows.withColumn("__row", F.monotonically_increasing_id()))
    names = [c for c in rows.columns if c != "__row"]
    full = rows.filter(F.col("length") == capacity).select(
        *names, (-1 - F.col("__row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    short = rows.filter(F.col("length") < capacity)
    groups = max(1, -(-short.count() // group))
    late = F.col("length") < capacity // 8
    dealt = (short.withColumn("__hash", F.xxhash64("__row"))
             .withColumn("__group", F.pmod("__hash", F.lit(groups)).cast("long"))
             .withColumn("__turn", F.when(late, capacity - F.col("length")).otherwise(-1))
             .repartition(groups, "__group").sortWithinPartitions("__group", "__turn", "__hash")
             .drop("__turn", "__hash", "__row"))

    def run(batches):
        held = []
        for batch in batches:
            own = batch.column("__group").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(own)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                if held and b > a and held[0].column("__group")[0].as_py() != own[a]:
                    yield placed(held)
                    held = []
                if b > a:
                    held.append(batch.slice(a, b - a))
        if held:
            yield placed(held)

    def placed(parts):
        whole = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        first = whole.column("__group")[0].as_py() << 32
        sequence, offset = sum_of_squares(whole.column("length").to_numpy(), capacity)
        return pa.RecordBatch.from_arrays(
            [*(whole.column(c) for c in names), pa.array(sequence + first), pa.array(offset)],
            names=[*names, "sequence_id", "offset"])

    return dealt.mapInArrow(run, full.schema).unionByName(full)


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = CAPACITY, end_id: int = END_ID, path: str | None = None,
                   with_ids: bool = False, group: int = GROUP) -> DataFrame:
    """Every piece of every document with its place in a sequence."""
    return pack(pieces(docs, id_col, text_col, capacity, end_id, path, with_ids), capacity, group)


def op1_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    """No SQL form: DuckDB has no tokenizer; the tests check ids, cuts and
    places against the library and against the rule in plain Python."""
    return pack_documents(table(spark, sf_dir, "documents"))
