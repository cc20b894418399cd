"""Phrase collocations, counted in HAT-tries.

Phrases are counted length by length, from words to ``max_words``. A phrase of
k words can only reach ``min_count`` if both phrases of k - 1 words inside it
do, so the counts of one length give a Bloom filter for the next: a filter
has no false negatives, and a fuller one only lets more phrases be counted.
Most pairs of frequent words are rare, so pairs are first counted by slots of
their hashes, and only those in slots that reach ``min_count`` by their phrases
(each of which goes there in all tasks) are counted as phrases.

Texts are numbered once, in chunks with a dictionary of their own, written to
the shared folder; every length is counted from these. Each task counts in a
HAT-trie. Languages and words get numbers in the task; a
shallow trie over them has the language and the first word as its upper
levels, and hash containers below, keyed by the numbers that are left of a
phrase. A container with more than ``BURST`` phrases bursts into a node with a
container for each next word. Beyond ``MAX_PHRASES`` phrases the largest
subtrees are spilled whole, as sorted runs of about ``RUN_PHRASES`` phrases with
the words spelt out, so that a spill adds a run to a task's memory and not a
second copy of its trie; chunks reach a task ``CHUNKS`` at a time. The runs
are a table in the shared folder; range partitioning by language and phrase
deals them to prefix partitions (a hot prefix spans several), where the counts
of each phrase are added up. No text moves between tasks, and a phrase is one
row a run however often it occurs.

Counts of parts are joined to the cuts of each candidate (any part of a
candidate is as frequent as the candidate, so it was counted too), and scores
are decimals of 38 digits: exact.

Defined results: null and empty texts have no words; a null language is
``und``; phrases do not cross pieces or documents; repeated rows count each
time; very long texts are taken in slices cut between pieces, or whole if they
are one piece; ties in score go to the larger count, then to the phrase that is
smaller by its UTF-8 bytes; an empty table gives no rows. Other columns play no
part, whatever their names.
"""

from __future__ import annotations

from array import array
from contextlib import contextmanager
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import shuffle_partitions, table, texts, written

MIN_COUNT = 100
MAX_WORDS = 5
TOP = 2000
#: Phrases of a container before it bursts, of a task's trie before it spills, and of a run.
BURST, MAX_PHRASES, RUN_PHRASES = 1 << 12, 1 << 19, 1 << 17
#: Phrases that are sorted together before a trie takes them.
BUFFER = 1 << 19
#: Words that get numbers before a task spills all and numbers anew.
MAX_NUMBERS = 1 << 19
#: Words of a chunk, bytes of a slice of text, and chunks read or sent to a worker at once.
BATCH, SLICE, CHUNKS = 1 << 18, 4 << 20, 4
#: Rows of a run sent at a time.
RUN_ROWS = 1 << 15
BITS_PER_KEY, PROBES = 16, 4
#: Bound of the filter that every task gets; beyond it the filter is fuller.
MAX_FILTER_BYTES = 64 << 20

MIX = np.uint64(0x9E3779B97F4A7C15)
GAP, BREAK = 0, 1
#: A-Z to a-z; ends of pieces to a line feed; tabs to spaces.
_BYTES = bytes(c + 32 if 65 <= c <= 90 else 10 if chr(c) in ".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c
               for c in range(256))


class Names(dict):
    """Numbers of words in the order they are met."""

    def __init__(self):
        super().__init__({b"": GAP, b"\n": BREAK})
        self.names = [b"", b"\n"]

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.names)
        self.names.append(word)
        return number


class Numbers(Names):
    """The same with the words' hashes."""

    def __init__(self):
        super().__init__()
        self.hashes = array("Q", [0, 0])

    def __missing__(self, word: bytes) -> int:
        number = super().__missing__(word)
        self.hashes.append(xxhash.xxh64_intdigest(word))
        return number


def _slices(text: bytes, size: int):
    """Parts of a translated text of about ``size`` bytes, cut between pieces."""
    at = 0
    while at < len(text):
        end = len(text)
        if end - at > size:
            cut = text.rfind(b"\n", at, at + size)
            if cut < at:
                cut = text.find(b"\n", at + size)
            end = cut + 1 if cut >= 0 else end
        yield text[at:end]
        at = end


def word_numbers(part: bytes, numbers: Numbers) -> np.ndarray:
    """The words of a slice as numbers, BREAK between pieces and at the end."""
    tokens = part.replace(b"\n", b" \n ").split(b" ")
    tokens.append(b"\n")
    found = np.fromiter(map(numbers.__getitem__, tokens), np.int64, len(tokens))
    return found[found != GAP]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def phrase_hashes(lang: np.ndarray, words: list[np.ndarray]) -> np.ndarray:
    h = lang
    for w in words:
        h = mixed(h * MIX + w)
    return h


def _slotted(hashes: np.ndarray, masks: np.ndarray, slots: int):
    """The slot of each hash, its mask, and the hash."""
    slot = (((hashes >> np.uint64(32)) * np.uint64(slots)) >> np.uint64(32)).astype(np.int64)
    return slot, masks[slot], hashes


def _places(hashes: np.ndarray, mask) -> list[np.ndarray]:
    """Bit places of each hash in its slot."""
    step = (hashes * MIX >> np.uint64(17)) | np.uint64(1)
    return [(hashes + np.uint64(k) * step) & mask for k in range(PROBES)]


def grouped(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of number columns, in order, and how often each occurs."""
    code, span = columns[0], int(columns[0].max()) + 1
    for column in columns[1:]:
        wide = int(column.max()) + 1
        if span * wide >= 1 << 62:
            distinct, code = np.unique(code, return_inverse=True)
            span = len(distinct)
        code, span = code * wide + column, span * wide
    _, first, counts = np.unique(code, return_index=True, return_counts=True)
    return np.stack([c[first] for c in columns], axis=1), counts


class HatTrie:
    """Counts of rows of numbers: nodes map a number to what is below it;
    below are further nodes, or containers keyed by the bytes of the rest."""

    def __init__(self, width: int, burst: int):
        self.width, self.burst = width, burst
        self.upper = min(2, width - 1)  # levels that are always nodes, kept as one
        self.root: dict = {}
        self.sizes: dict = {}  # phrases of each subtree, by its two upper numbers
        self.total = 0

    def add(self, rows: np.ndarray, counts: np.ndarray) -> None:
        """Distinct rows in ascending order, and their counts."""
        raw, width = np.ascontiguousarray(rows[:, self.upper:], np.uint32).tobytes(), 4 * (self.width - self.upper)
        rests = [raw[i:i + width] for i in range(0, len(raw), width)]
        tops = rows[:, :self.upper].astype(np.uint32)
        starts = np.flatnonzero(np.any(tops[1:] != tops[:-1], axis=1)) + 1
        bounds = [0, *starts.tolist(), len(rows)]
        raw, width = tops[bounds[:-1]].tobytes(), 4 * self.upper
        counts = counts.tolist()
        for k, (a, b) in enumerate(zip(bounds, bounds[1:])):
            top = raw[k * width:(k + 1) * width]
            below = self.root.get(top)
            new, self.root[top] = self._into(Container() if below is None else below, self.upper,
                                             rests[a:b], counts[a:b])
            self.sizes[top] = self.sizes.get(top, 0) + new
            self.total += new

    def _into(self, below, depth: int, rests: list, counts: list):
        """(new phrases, what is below now)."""
        if isinstance(below, Container):
            before = len(below)
            if before:
                get = below.get
                for rest, n in zip(rests, counts):
                    below[rest] = get(rest, 0) + n
            else:
                below.update(zip(rests, counts))
            new = len(below) - before
            if len(below) > self.burst and depth + 1 < self.width:
                node: dict = {}
                for rest, n in below.items():
                    child = node.get(rest[:4])
                    if child is None:
                        child = node[rest[:4]] = Container()
                    child[rest[4:]] = n
                below = node
            return new, below
        new, i = 0, 0
        while i < len(rests):
            step = rests[i][:4]
            j = i + 1
            while j < len(rests) and rests[j][:4] == step:
                j += 1
            child = below.get(step)
            more, below[step] = self._into(Container() if child is None else child, depth + 1,
                                           [rest[4:] for rest in rests[i:j]], counts[i:j])
            new, i = new + more, j
        return new, below

    def _containers(self, below, prefix: bytes):
        if isinstance(below, Container):
            yield prefix, below
        else:
            for step, child in below.items():
                yield from self._containers(child, prefix + step)

    def runs(self, keep: int, size: int):
        """Takes whole subtrees out, the largest first, until ``keep`` phrases
        are left: rows and counts of about ``size`` phrases at a time."""
        raw, counts = [], []

        def run():
            return np.frombuffer(b"".join(raw), np.uint32).reshape(-1, self.width), np.array(counts, np.int64)

        for top in sorted(self.sizes, key=self.sizes.get, reverse=True):
            if self.total <= keep:
                break
            self.total -= self.sizes.pop(top)
            for prefix, found in self._containers(self.root.pop(top), top):
                raw += [prefix, prefix.join(found)]
                counts += found.values()
                if len(counts) >= size:
                    yield run()
                    raw, counts = [], []
        if counts:
            yield run()

    def take(self, keep: int) -> list[tuple[bytes, int]]:
        """The same as a list of the rows' bytes and counts."""
        return [(row.tobytes(), n) for rows, counts in self.runs(keep, RUN_PHRASES)
                for row, n in zip(rows, counts.tolist())]


class Container(dict):
    """A burstable hash container."""

    __slots__ = ()


@contextmanager
def few_chunks(spark):
    """Chunks are rows of megabytes: plans that run in here read them, and send
    them to a worker, ``CHUNKS`` at a time, however large a partition is."""
    keys = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize")
    before = [(key, spark.conf.get(key)) for key in keys]
    for key in keys:
        spark.conf.set(key, str(CHUNKS))
    try:
        yield
    finally:
        for key, value in before:
            spark.conf.set(key, value)


def chunk_rows(batch):
    """The chunks of a batch one at a time: languages, words, and the other
    columns as views of the batch."""
    for i in range(batch.num_rows):
        langs, words, *rest = (c[i] for c in batch.columns)
        yield [b"", b"\n"] + langs.as_py(), [b"", b"\n"] + words.as_py().split(b"\n"), *(x.as_buffer() for x in rest)


def _chunks(docs: DataFrame) -> DataFrame:
    """Texts as numbers, about ``BATCH`` words a row, written: the distinct
    words, joined by line feeds, their hashes, the text as places among them,
    and the language and length of each part."""
    batch_words, slice_bytes = BATCH, SLICE
    names = ["langs", "words", "hashes", "lang_of", "sizes", "ids"]

    def run(batches):
        numbers, langs, parts, size = Numbers(), Numbers(), [], 0

        def flush():
            return pa.RecordBatch.from_arrays(
                [pa.array([langs.names[2:]], pa.list_(pa.binary())), pa.array([b"\n".join(numbers.names[2:])]),
                 pa.array([numbers.hashes.tobytes()]),
                 pa.array([np.array([x for x, _ in parts], np.int32).tobytes()]),
                 pa.array([np.array([len(x) for _, x in parts], np.int64).tobytes()]),
                 pa.array([b"".join([x.astype(np.int32).tobytes() for _, x in parts])])], names=names)

        for batch in batches:
            for own, text in zip(texts(batch.column(0)), texts(batch.column(1))):
                for part in _slices(text.translate(_BYTES), slice_bytes):
                    found = word_numbers(part, numbers)
                    parts.append((langs[own] if own else GAP, found))
                    size += len(found)
                    if size >= batch_words:
                        yield flush()
                        numbers, langs, parts, size = Numbers(), Numbers(), [], 0
        if parts:
            yield flush()

    return written(docs.mapInArrow(
        run, "langs array<binary>, words binary, hashes binary, lang_of binary, sizes binary, ids binary"))


def _word_runs(chunks: DataFrame) -> DataFrame:
    """(lang, phrase, n): sorted runs of the counts of single words. They are
    all first words, so one hash container a language holds them."""
    max_phrases, run_phrases = MAX_PHRASES, RUN_PHRASES

    def run(batches):
        found: dict[bytes, Container] = {}

        def spill():
            for own, below in found.items():
                words = iter(below.items())
                while part := list(islice(words, run_phrases)):
                    done = pa.table({"lang": pa.array([own] * len(part), pa.binary()).cast(pa.string()),
                                     "phrase": pa.array([w for w, _ in part], pa.binary()).cast(pa.string()),
                                     "n": pa.array([n for _, n in part], pa.int64())})
                    yield from done.sort_by("phrase").to_batches(RUN_ROWS)
            found.clear()

        for batch in batches:
            for langs, words, lang_of, sizes, ids in chunk_rows(batch):
                ids = np.frombuffer(ids, np.int32)
                lang = np.repeat(np.frombuffer(lang_of, np.int32), np.frombuffer(sizes, np.int64))
                both = lang.astype(np.int64) * len(words) + ids
                codes, counts = np.unique(both[ids != BREAK], return_counts=True)
                own, at = np.divmod(codes, len(words))
                for x, w, n in zip(own.tolist(), at.tolist(), counts.tolist()):
                    below = found.get(langs[x])
                    if below is None:
                        below = found[langs[x]] = Container()
                    below[words[w]] = below.get(words[w], 0) + n
                if sum(map(len, found.values())) > max_phrases:
                    yield from spill()
        yield from spill()

    return (chunks.select("langs", "words", "lang_of", "sizes", "ids")
            .mapInArrow(run, "lang string, phrase string, n long"))


def starts(ids: np.ndarray, lang: np.ndarray, hashes: np.ndarray, langs: list, size: int, known):
    """Where phrases of ``size`` words stand of which both shorter ones are
    known, and the phrases' hashes."""
    lang_hash = np.array([xxhash.xxh64_intdigest(x) if x else 0 for x in langs], np.uint64)
    plain = ids != BREAK
    slots, masks, base, bits = known
    shorter = len(ids) - size + 2
    if shorter < 2:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    use = plain[:shorter].copy()
    for k in range(1, size - 1):
        use &= plain[k:k + shorter]
    at = np.flatnonzero(use)
    short = np.zeros(shorter, np.uint64)
    short[at] = phrase_hashes(lang_hash[lang[at]], [hashes[ids[at + k]] for k in range(size - 1)])
    slot, mask, h = _slotted(short[at], masks, slots)
    found = np.ones(len(h), bool)
    for p in _places(h, mask):
        found &= (bits[base[slot] + (p >> np.uint64(3)).astype(np.int64)]
                  >> (p & np.uint64(7)).astype(np.uint8)) & 1 == 1
    use[at[~found]] = False
    at = np.flatnonzero(use[:-1] & use[1:])
    return at, mixed(short[at] * MIX + hashes[ids[at + size - 1]])


def planes(numbers: np.ndarray) -> bytes:
    """32-bit numbers as their first bytes, second bytes and so on, which the
    shuffle's compression shortens where they are small."""
    return numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def _dense(chunks: DataFrame, size: int, known, words: int, min_count: int, parts: int, max_bytes: int):
    """A bit for each slot of the phrases' hashes, set where phrases of the slot
    occur ``min_count`` times or more together, as (bits of a slot number,
    flags). A frequent phrase's slot is always set: a part's count is bounded
    by ``min_count``, so no bounded sum that matters falls below it. About one
    slot for eight words, ``max_bytes`` at most; a fuller one lets more phrases
    be counted."""
    bits = max(10, min(int(words // 8).bit_length(), int(max_bytes * 8).bit_length() - 1, 32))
    ranges = min(128, 1 << (parts - 1).bit_length())
    each, buffer = (1 << bits) // ranges, 4 * BUFFER  # of 8 slots at least: whole bytes of flags

    def counted(batches):
        pending = []

        def flush():
            slot, counts = np.unique(np.concatenate(pending), return_counts=True)
            pending.clear()
            counts = np.minimum(counts, min_count)
            cuts = np.searchsorted(slot, np.arange(ranges + 1, dtype=np.int64) * each).tolist()
            full = [(r, a, b) for r, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b]
            return pa.RecordBatch.from_arrays(
                [pa.array([r for r, _, _ in full], pa.int32()),
                 pa.array([planes(np.diff(slot[a:b].astype(np.int64), prepend=r * each)) for r, a, b in full], pa.binary()),
                 pa.array([planes(counts[a:b]) for _, a, b in full], pa.binary())], names=["range", "slots", "counts"])

        for batch in batches:
            for langs, _, hashes, lang_of, sizes, ids in chunk_rows(batch):
                ids = np.frombuffer(ids, np.int32)
                lang = np.repeat(np.frombuffer(lang_of, np.int32), np.frombuffer(sizes, np.int64))
                h = starts(ids, lang, np.frombuffer(hashes, np.uint64), langs, size, known.value)[1]
                pending.append((h >> np.uint64(64 - bits)).astype(np.uint32))
                if sum(map(len, pending)) >= buffer:
                    yield flush()
        if sum(map(len, pending)):
            yield flush()

    def summed(batches):
        found = {}
        for batch in batches:
            for r, slots, counts in zip(*[c.to_pylist() for c in batch.columns]):
                own = found.get(r)
                if own is None:
                    own = found[r] = np.zeros(each, np.uint32)
                own[np.cumsum(from_planes(slots), dtype=np.int64)] += np.minimum(from_planes(counts), min_count)
                np.minimum(own, min_count, out=own)
        for r, own in found.items():
            flags = np.packbits(own >= min_count, bitorder="little")
            yield pa.RecordBatch.from_arrays([pa.array([r], pa.int32()), pa.array([flags.tobytes()])],
                                             names=["range", "flags"])

    flags = np.zeros(max(1, (1 << bits) // 8), np.uint8)
    with few_chunks(chunks.sparkSession):
        for r, own in (chunks.mapInArrow(counted, "range int, slots binary, counts binary")
                       .repartition(parts, "range").mapInArrow(summed, "range int, flags binary").collect()):
            own = np.frombuffer(own, np.uint8)
            flags[r * each // 8:r * each // 8 + len(own)] |= own
    return bits, flags


def _runs(chunks: DataFrame, size: int, known, dense=None) -> DataFrame:
    """(lang, phrase, n): sorted runs of the counts of phrases of ``size``
    words; known: the filter of phrases one word shorter; dense: the slots
    that may hold frequent phrases, if only these shall be counted."""
    max_phrases, max_numbers, burst, run_phrases, buffer = MAX_PHRASES, MAX_NUMBERS, BURST, RUN_PHRASES, BUFFER

    def run(batches):
        langs, words, trie = Names(), Names(), HatTrie(size + 1, burst)

        def spill(keep):
            names = pa.array(words.names, pa.binary())
            for rows, counts in trie.runs(keep, run_phrases):
                spelt = [names.take(pa.array(rows[:, k])) for k in range(1, size + 1)]
                phrase = pc.binary_join_element_wise(*spelt, b" ")
                done = pa.table({"lang": pa.array(langs.names, pa.binary()).take(pa.array(rows[:, 0])).cast(pa.string()),
                                 "phrase": phrase.cast(pa.string()), "n": pa.array(counts)})
                yield from done.sort_by([("lang", "ascending"), ("phrase", "ascending")]).to_batches(RUN_ROWS)

        def renumbered(columns, names, numbers):
            new = np.zeros(len(names), np.uint32)
            for column in columns:
                new[column] = 1
            used = np.flatnonzero(new)
            new[used] = np.fromiter(map(numbers.__getitem__, map(names.__getitem__, used.tolist())), np.uint32, len(used))
            return [new[column] for column in columns]

        def add():
            if pending:
                trie.add(*grouped([c.astype(np.int64) for c in np.concatenate(pending, axis=1)]))
                pending.clear()

        pending = []
        for batch in batches:
            for own_langs, own_words, hashes, lang_of, sizes, ids in chunk_rows(batch):
                ids = np.frombuffer(ids, np.int32)
                lang = np.repeat(np.frombuffer(lang_of, np.int32), np.frombuffer(sizes, np.int64))
                at, h = starts(ids, lang, np.frombuffer(hashes, np.uint64), own_langs, size, known.value)
                if dense is not None:
                    bits, flags = dense.value
                    slot = h >> np.uint64(64 - bits)
                    at = at[(flags[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1]
                if not len(at):
                    continue
                pending.append(np.stack(renumbered([lang[at]], own_langs, langs)
                                        + renumbered([ids[at + k] for k in range(size)], own_words, words)))
                full = len(words) > max_numbers or len(langs) > max_numbers
                if full or sum(x.shape[1] for x in pending) >= buffer:
                    add()
                if full:
                    yield from spill(0)
                    langs, words = Names(), Names()
                elif trie.total > max_phrases:
                    yield from spill(max_phrases // 2)
        add()
        yield from spill(0)

    return chunks.mapInArrow(run, "lang string, phrase string, n long")


def _filter(counted: DataFrame, slots: int, max_bytes: int):
    """A Bloom filter of phrases, a part for each slot of the hash range, as
    plain arrays for broadcast: (slots, masks, base, bits), at most
    ``max_bytes`` in all; None where there is no phrase."""
    total = counted.count()
    if not total:
        return None
    wanted = 1 << max(10, int(np.ceil(np.log2(BITS_PER_KEY * total / slots))))
    size = min(wanted, 1 << int(np.log2(max(1024, max_bytes * 8 // slots))))
    masks = np.full(slots, size - 1, np.uint64)

    def hashed(batches):
        for batch in batches:
            rows = [(xxhash.xxh64_intdigest(own) if own else 0, p.split(b" "))
                    for own, p in zip(texts(batch.column(0)), texts(batch.column(1)))]
            if not rows:
                continue
            words = np.array([[xxhash.xxh64_intdigest(w) for w in ws] for _, ws in rows], np.uint64)
            h = phrase_hashes(np.array([own for own, _ in rows], np.uint64), list(words.T))
            slot = _slotted(h, masks, slots)[0]
            order = np.argsort(slot, kind="stable")
            h, slot = h[order], slot[order]
            cuts = np.flatnonzero(np.diff(slot, prepend=-1)).tolist() + [len(slot)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(slot[a]) for a in cuts[:-1]], pa.int32()),
                 pa.array([h[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary())], names=["slot", "hashes"])

    def built(batches):
        parts = {}
        for batch in batches:
            for slot, hashes in zip(*[c.to_pylist() for c in batch.columns]):
                bits = parts.setdefault(slot, np.zeros(size // 8, np.uint8))
                for p in _places(np.frombuffer(hashes, np.uint64), np.uint64(size - 1)):
                    np.bitwise_or.at(bits, (p >> np.uint64(3)).astype(np.int64),
                                     np.left_shift(1, (p & np.uint64(7)).astype(np.uint8)).astype(np.uint8))
        for slot, bits in parts.items():
            yield pa.RecordBatch.from_arrays([pa.array([slot], pa.int32()), pa.array([bits.tobytes()])],
                                             names=["slot", "bits"])

    parts = (counted.select("lang", "phrase").mapInArrow(hashed, "slot int, hashes binary")
             .repartition(slots, "slot").mapInArrow(built, "slot int, bits binary").collect())
    bits = np.zeros(slots * (size // 8), np.uint8)
    for slot, own in parts:
        bits[slot * (size // 8):(slot + 1) * (size // 8)] = np.frombuffer(own, np.uint8)
    return (slots, masks, np.arange(slots, dtype=np.int64) * (size // 8), bits)


def phrase_counts(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", min_count: int = MIN_COUNT,
                  max_words: int = MAX_WORDS, max_filter_bytes: int = MAX_FILTER_BYTES,
                  ) -> tuple[DataFrame, list[DataFrame]]:
    """(lang, n): all words of a language; and, for each length from 1 on,
    (lang, phrase, f) of the phrases that occur ``min_count`` times or more."""
    spark = docs.sparkSession
    slots = shuffle_partitions(spark)
    own = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"),
                      F.col(f"`{text_col}`").cast("string").alias("text"))
    chunks = _chunks(own)
    totals, levels, known = None, [], None
    for size in range(1, max_words + 1):
        # By far the most phrases that are known by their parts alone have two words.
        dense = None if size != 2 else spark.sparkContext.broadcast(
            _dense(chunks, size, known, n_words, min_count, slots, max_filter_bytes // 2))
        with few_chunks(spark):
            runs = written(_word_runs(chunks) if known is None else _runs(chunks, size, known, dense))
        if dense is not None:
            dense.unpersist()
        if totals is None:
            totals = written(runs.groupBy("lang").agg(F.sum("n").alias("n")))
            n_words = totals.agg(F.sum("n")).first()[0] or 0
        level = written(runs.repartitionByRange(slots, "lang", "phrase").groupBy("lang", "phrase")
                        .agg(F.sum("n").alias("f")).filter(F.col("f") >= min_count))
        levels.append(level)
        if known is not None:
            known.unpersist()
        bloom = _filter(level, slots, max_filter_bytes) if size < max_words else None
        if bloom is None:
            break
        known = spark.sparkContext.broadcast(bloom)
    return totals, levels


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", min_count: int = MIN_COUNT,
                 max_words: int = MAX_WORDS, top: int | None = TOP, inside_percent: int = 100,
                 max_filter_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: a language's first ``top``
    phrases (None: all, without a rank) of two words or more by their
    weakest cut, without those inside a longer one that is at least
    ``inside_percent`` as frequent."""
    slots = shuffle_partitions(docs.sparkSession)
    totals, levels = phrase_counts(docs, lang_col, text_col, min_count, max_words, max_filter_bytes)
    counted = levels[0]
    for level in levels[1:]:
        counted = counted.unionByName(level)
    words = F.split("phrase", " ")
    longer = counted.withColumn("w", words).filter(F.size("w") > 1)
    # A phrase inside a longer one is inside one longer by a word, which is as frequent or more.
    inside = (longer.filter(F.size("w") > 2)
              .select("lang", F.col("f").alias("g"), F.explode(F.array(
                  F.expr("array_join(slice(w, 1, size(w) - 1), ' ')"),
                  F.expr("array_join(slice(w, 2, size(w) - 1), ' ')"))).alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("g").alias("g")))
    # Each phrase has one row on either side, so no key of this join is hot.
    kept = (longer.join(inside, ["lang", "phrase"], "left")
            .filter(F.col("g").isNull() | (F.lit(100) * F.col("g") < F.lit(inside_percent) * F.col("f")))
            .select("lang", "phrase", "w", F.col("f").alias("a")))
    cuts = written(kept.select(
        "lang", "phrase", "a", F.posexplode(F.expr(
            "transform(sequence(1, size(w) - 1), k -> struct("
            "array_join(slice(w, 1, k), ' ') AS first, array_join(slice(w, k + 1, size(w)), ' ') AS rest))"))
        .alias("k", "cut")).select("lang", "phrase", "a", "k", "cut.first", "cut.rest"))
    with_l = cuts.join(counted.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    parts = with_l.join(counted.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    scored = parts.join(totals, "lang").withColumn("score", F.expr(
        "(CAST(a AS DECIMAL(18,0)) * CAST(n AS DECIMAL(17,0)) * CAST(1000 AS DECIMAL(4,0)))"
        " div (CAST(l AS DECIMAL(18,0)) * CAST(r AS DECIMAL(18,0)))"))
    best = (scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
            .select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score"))
    if top is None:
        return best
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = best.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(slots)))
    first = (salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
             .filter(F.col("rank") <= top).drop("rank", "salt"))
    return (first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
            .filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))


ORACLE_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), words AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), grams AS (
  SELECT lang, k, list_aggregate(w[p:p + k - 1], 'string_agg', ' ') AS phrase
  FROM words, unnest(range(1, len(w) + 1)) AS t(p), (VALUES (1), (2), (3), (4), (5)) AS s(k)
  WHERE p + k - 1 <= len(w)
), totals AS (
  SELECT lang, count(*) AS n FROM grams WHERE k = 1 GROUP BY lang
), f AS (
  SELECT lang, k, phrase, string_split(phrase, ' ') AS w, count(*) AS f
  FROM grams GROUP BY lang, k, phrase HAVING count(*) >= 100
), inside AS (
  SELECT DISTINCT lang, f, list_aggregate(w[i:j], 'string_agg', ' ') AS phrase
  FROM f, unnest(range(1, k)) AS a(i), unnest(range(2, k + 1)) AS b(j) WHERE j > i AND j - i + 1 < k
), kept AS (
  SELECT c.* FROM f c WHERE c.k >= 2 AND NOT EXISTS (
    SELECT 1 FROM inside s WHERE s.lang = c.lang AND s.phrase = c.phrase AND s.f >= c.f)
), cuts AS (
  SELECT lang, phrase, f AS a, cut, list_aggregate(w[1:cut], 'string_agg', ' ') AS first,
         list_aggregate(w[cut + 1:k], 'string_agg', ' ') AS rest
  FROM kept, unnest(range(1, k)) AS t(cut)
), scored AS (
  SELECT c.lang, c.phrase, c.a, x.f AS l, y.f AS r, t.n, c.cut,
         CAST((1000::HUGEINT * c.a * t.n) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.first
  JOIN f y ON y.lang = c.lang AND y.phrase = c.rest JOIN totals t ON t.lang = c.lang
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score
FROM best QUALIFY rank <= 2000
"""


def op11_phrase_collocation_mining(spark, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))
