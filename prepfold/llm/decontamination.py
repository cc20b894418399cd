"""Benchmark decontamination with suffix arrays of the training documents.

A shard is a run of documents of about ``SHARD`` words inside one task. Its
words become one array of numbers, and a suffix array over that array is
built by prefix doubling. Every suffix of every benchmark item is searched in
it by binary search, all of them at once: the neighbours of the place where a
suffix would stand give its longest verbatim match in the shard and where it
is, and the range of suffixes that start with the suffix's window gives every
occurrence of the window. A document's words inside any occurrence are hit.

Only words of the benchmark get a number of their own; any other word cannot
take part in a match, nor can one between documents, so suffixes that start
within less than the shortest window of such a word are left out of the
array (they can hold no window). No text moves between tasks. The benchmark
is the query set; it goes to the tasks in blocks of at most ``BLOCK_WORDS``
words, a pass over the documents each, so its size has no bound either.

Words are runs of digits, letters (A-Z lower-cased) and anything beyond
ASCII. A window is ``window`` consecutive words of an item; an item of fewer
words is one window.

Defined results: null and empty texts have no words; repeated rows get a
result each; items that share an item_id count once; a null item_id is left
out; an empty table, or benchmark, hits nothing; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Shared, mapped, table, texts, written

WINDOW = 10
SHARD = 1 << 21
BLOCK_WORDS = 1 << 22

#: A-Z to a-z; ASCII that is no letter and no digit to a space.
_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def words(text: bytes) -> list[bytes]:
    return text.translate(_BYTES).split()


class Queries:
    """The words of some items as numbers from 1 on, and their windows."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.items = [i for i, _ in items]
        lists = [words(t) for _, t in items]
        self.vocabulary = {w: k for k, w in enumerate(sorted({w for ws in lists for w in ws}), 1)}
        sizes = np.array([len(ws) for ws in lists], np.int64)
        ends = np.cumsum(sizes)
        self.text = np.array([self.vocabulary[w] for ws in lists for w in ws], np.int64)
        self.longest, need = int(sizes.max(initial=0)), np.minimum(window, sizes)
        self.shortest = int(need[need > 0].min(initial=window))
        owner = np.repeat(np.arange(len(lists)), sizes)
        at = np.arange(len(self.text))
        self.item, self.left = owner, ends[owner] - at  # of each suffix: its item, and the words to the item's end
        # Suffixes long enough for a window, those of equal windows as one class.
        start = np.flatnonzero(self.left >= need[owner]) if len(at) else at
        classes: dict[bytes, list[int]] = {}
        for p in start.tolist():
            classes.setdefault(self.text[p:p + need[owner[p]]].tobytes(), []).append(p)
        self.members = [np.unique(owner[ps]) for ps in classes.values()]
        self.start = np.array([ps[0] for ps in classes.values()], np.int64)
        self.size = need[owner[self.start]] if len(self.start) else self.start


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Places of the words of ``text`` in the order of their suffixes, as far
    as ``depth`` words or the first zero (which no query has; what follows one
    does not matter)."""
    places = np.flatnonzero(text)
    bits = max(1, int(text.max(initial=1)).bit_length())
    reach = min(max(1, 62 // bits), max(depth, 1))
    padded = np.concatenate([text, np.zeros(reach, np.int64)])
    key = np.zeros(len(places), np.int64)
    for k in range(reach):
        key = key << bits | padded[places + k]
    rank = np.zeros(len(text) + 1, np.int64)  # 0 for zeros and the end
    while True:
        order = np.argsort(key, kind="stable")
        own = key[order]
        new = np.cumsum(np.diff(own, prepend=own[:1] - 1) != 0)
        rank[places[order]] = new
        if reach >= depth or not len(new) or new[-1] == len(new):
            return places[order]
        key = rank[places] * (len(places) + 1) + rank[np.minimum(places + reach, len(text))]
        reach *= 2


class Shard:
    """The suffix array of some documents and what the queries find in it."""

    def __init__(self, docs: list[np.ndarray], queries: Queries):
        self.queries = queries
        self.sizes = np.array([len(d) for d in docs], np.int64)
        self.doc_at = np.cumsum(self.sizes + 1) - self.sizes - 1
        text = np.concatenate([x for d in docs for x in (d, np.zeros(1, np.int64))]) if docs else np.empty(0, np.int64)
        # Runs of benchmark words too short for any window cannot match.
        known = np.concatenate([[0], (text > 0).astype(np.int8), [0]])
        first, end = np.flatnonzero(np.diff(known) == 1), np.flatnonzero(np.diff(known) == -1)
        long = end - first >= queries.shortest
        first, end = first[long], end[long]
        # They alone are kept, a zero behind each; place[k] is where word k stands in the documents.
        size = end - first + 1
        self.place = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())
        self.text = text[self.place]
        self.suffixes = suffix_array(self.text, queries.longest)

    def _search(self, start: np.ndarray, size: np.ndarray, after: bool) -> np.ndarray:
        """For each query suffix, cut to ``size`` words: how many suffixes of
        the array stand before it (or before what follows its range)."""
        q = self.queries.text
        lo, hi = np.zeros(len(start), np.int64), np.full(len(start), len(self.suffixes))
        width = int(size.max(initial=1))
        wanted = _words_at(q, start, size, width)
        while (open_ := np.flatnonzero(lo < hi)).size:
            mid = (lo[open_] + hi[open_]) // 2
            own = _words_at(self.text, self.suffixes[mid], size[open_], width)
            differs = own != wanted[open_]
            k = differs.argmax(1)
            rows = np.arange(len(open_))
            less = np.where(differs[rows, k], own[rows, k] < wanted[open_, k], after)
            lo[open_] = np.where(less, mid + 1, lo[open_])
            hi[open_] = np.where(less, hi[open_], mid)
        return lo

    def occurrences(self) -> tuple[np.ndarray, np.ndarray]:
        """(class, place) of every occurrence of every window."""
        start, size = self.queries.start, self.queries.size
        lo = self._search(start, size, False)
        n = self._search(start, size, True) - lo
        kind = np.repeat(np.arange(len(start)), n)
        at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return kind, self.place[self.suffixes[at]]

    def hits(self):
        """For each document: hit spans [start, end) in words, and items."""
        kind, place = self.occurrences()
        edge = np.zeros(len(self.place) and int(self.sizes.sum() + len(self.sizes)) + 1, np.int64)
        np.add.at(edge, place, 1)
        np.add.at(edge, place + self.queries.size[kind], -1)
        hit = np.concatenate([[0], (np.cumsum(edge) > 0).astype(np.int8), [0]])
        start, end = np.flatnonzero(np.diff(hit) == 1), np.flatnonzero(np.diff(hit) == -1)
        doc = np.searchsorted(self.doc_at, start, "right") - 1
        spans = [[] for _ in self.sizes]
        for d, a, b in zip(doc.tolist(), (start - self.doc_at[doc]).tolist(), (end - self.doc_at[doc]).tolist()):
            spans[d].append((a, b))
        items: list[set] = [set() for _ in self.sizes]
        owner = np.searchsorted(self.doc_at, place, "right") - 1
        for d, c in np.unique(np.stack([owner, kind], 1), axis=0).tolist():
            items[d].update(self.queries.members[c].tolist())
        return spans, items

    def longest(self):
        """(query suffix, length, document, first word) of each query suffix's
        longest match, where there is one of a window's words or more."""
        q = self.queries
        start = np.flatnonzero(q.left >= np.minimum(q.shortest, q.left)) if len(self.suffixes) else np.empty(0, np.int64)
        best, at = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
        width = int(q.left.max(initial=1))
        where = self._search(start, q.left[start], False)
        wanted = _words_at(q.text, start, q.left[start], width)
        for side in (where - 1, where):
            ok = np.flatnonzero((side >= 0) & (side < len(self.suffixes)))
            p = self.suffixes[side[ok]]
            same = _words_at(self.text, p, q.left[start[ok]], width) == wanted[ok]
            n = np.minimum(np.where(same.all(1), width, same.argmin(1)), q.left[start[ok]])
            better = n > best[ok]
            best[ok[better]], at[ok[better]] = n[better], self.place[p[better]]
        found = np.flatnonzero(best >= q.shortest)
        doc = np.searchsorted(self.doc_at, at[found], "right") - 1
        return start[found], best[found], doc, at[found] - self.doc_at[doc]


def _words_at(text: np.ndarray, start: np.ndarray, size: np.ndarray, width: int) -> np.ndarray:
    """(n, width) words from each start, -1 from ``size`` on."""
    at = start[:, None] + np.arange(width)
    own = text[np.minimum(at, len(text) - 1)]
    own[at >= len(text)] = 0
    own[np.arange(width) >= size[:, None]] = -1
    return own


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, window: int) -> list[Queries]:
    """The items in blocks of at most BLOCK_WORDS words (an item at least)."""
    rows = (benchmark.select(F.col(f"`{item_col}`").cast("string").alias("item"),
                             F.col(f"`{text_col}`").cast("string").alias("text"))
            .filter("item is not null and text is not null").distinct())
    out, own, size = [], [], 0
    for r in rows.toLocalIterator():
        text = r.text.encode()
        n = len(words(text))
        if own and size + n > BLOCK_WORDS:
            out.append(Queries(own, window))
            own, size = [], 0
        own.append((r.item, text))
        size += n
    return [*out, Queries(sorted(own), window)]


def _shards(batches, queries: Queries, text_at: int):
    """(other columns of the documents, shard) for each run of documents."""
    held, docs, size = [], [], 0
    number = queries.vocabulary.get
    for batch in batches:
        first = 0
        for k, text in enumerate(texts(batch.column(text_at))):
            ws = words(text)
            docs.append(np.fromiter((number(w, 0) for w in ws), np.int64, len(ws)))
            size += len(ws)
            if size >= SHARD:
                held.append(batch.slice(first, k + 1 - first))
                yield held, Shard(docs, queries)
                held, docs, size, first = [], [], 0, k + 1
        if first < batch.num_rows:
            held.append(batch.slice(first))
    if docs:
        yield held, Shard(docs, queries)


SPANS = "array<struct<start:int,end:int>>"


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                  row_col: str | None = None) -> DataFrame:
    """One row per document: id, n_words, n_hit, spans (hit words, [start,
    end) each), item_ids (strings, sorted) and, if named, ``row_col``."""
    blocks = _blocks(benchmark, item_col, item_text_col, window)
    row = F.col(f"`{row_col}`") if row_col else F.monotonically_increasing_id()
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), row.cast("long").alias("row"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))
    if len(blocks) > 1 and not row_col:
        rows = written(rows)  # each pass has to see the same numbers
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, row long, n_words long, spans {SPANS}, items array<string>"
    spans_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run_with(queries):
        shared = Shared(docs.sparkSession, queries)

        def run(batches):
            queries = shared.value
            for held, shard in _shards(batches, queries, 2):
                spans, items = shard.hits()
                front = pa.Table.from_batches(held).select([0, 1]).combine_chunks().to_batches()[0]
                yield pa.RecordBatch.from_arrays(
                    [*front.columns, pa.array(shard.sizes),
                     pa.array([[{"start": a, "end": b} for a, b in s] for s in spans], spans_type),
                     pa.array([sorted({queries.items[k] for k in i}) for i in items], pa.list_(pa.string()))],
                    names=["id", "row", "n_words", "spans", "items"])

        return rows.mapInArrow(run, schema)

    found = [run_with(b) for b in blocks]
    result = found[0]
    for more in found[1:]:
        result = result.unionByName(more)
    if len(found) > 1:
        result = (result.groupBy("row").agg(
            F.first("id").alias("id"), F.first("n_words").alias("n_words"),
            F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
            .withColumn("spans", _merged("spans")))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return result.select(F.col("id").alias(id_col), "n_words", n_hit.alias("n_hit"), "spans",
                         F.col("items").alias("item_ids"), *([F.col("row").alias(row_col)] if row_col else []))


def _merged(column: str):
    """Sorted spans, those that touch or overlap as one."""
    def add(done, s):
        last = F.element_at(done, -1)
        joined = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
            last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))))
        return F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= s["start"]), joined).otherwise(
            F.concat(done, F.array(s)))
    return F.aggregate(column, F.array().cast(SPANS), add)


def longest_matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """For each suffix of each item with a match of at least a window: item_id
    (string), item_start, length, and where its longest match stands (the
    smallest document and word of those equally long in different shards)."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"item_id string, item_start long, length long, {id_col} {kind}, doc_start long"

    def run_with(queries):
        shared = Shared(docs.sparkSession, queries)

        def run(batches):
            q = shared.value
            for held, shard in _shards(batches, q, 1):
                start, length, doc, at = shard.longest()
                ids = pa.Table.from_batches(held).column(0).combine_chunks().take(pa.array(doc, pa.int64()))
                first = start - (np.cumsum(np.bincount(q.item, minlength=len(q.items))) - np.bincount(
                    q.item, minlength=len(q.items)))[q.item[start]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([q.items[k] for k in q.item[start]], pa.string()), pa.array(first), pa.array(length),
                     ids, pa.array(at)], names=["item_id", "item_start", "length", id_col, "doc_start"])

        return rows.mapInArrow(run, schema)

    found = None
    for block in _blocks(benchmark, item_col, item_text_col, window):
        own = run_with(block)
        found = own if found is None else found.unionByName(own)
    best = F.max_by(F.struct(id_col, "doc_start"), F.struct("length", -F.col("doc_start")))
    return (found.groupBy("item_id", "item_start").agg(F.max("length").alias("length"), best.alias("at"))
            .select("item_id", "item_start", "length", f"at.{id_col}", "at.doc_start"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` without the rows that hold a window of the benchmark; columns
    stay as they are. No row moves: a task drops what its shards hit."""
    at = docs.columns.index(text_col)

    def clean(queries):
        shared = Shared(docs.sparkSession, queries)

        def run(batches):
            for held, shard in _shards(batches, shared.value, at):
                spans, _ = shard.hits()
                yield from pa.Table.from_batches(held).filter(pa.array([not s for s in spans])).to_batches()

        return run

    for block in _blocks(benchmark, item_col, item_text_col, window):
        docs = mapped(docs, clean(block))
    return docs


_WORDS_SQL = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                               'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

ORACLE_SQL = f"""
WITH docs AS (SELECT doc_id, {_WORDS_SQL} AS w FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS_SQL} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, size, list_slice(w, p, p + size - 1) AS g
  FROM (SELECT item, w, least({WINDOW}, len(w)) AS size,
               unnest(range(1, len(w) - least({WINDOW}, len(w)) + 2)) AS p FROM items WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT size FROM windows),
grams AS (
  SELECT doc_id, p, size, list_slice(w, p, p + size - 1) AS g
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS p FROM docs, sizes WHERE len(w) >= size)
), hits AS (
  SELECT doc_id, p, grams.size AS size, item FROM grams JOIN windows ON grams.size = windows.size AND grams.g = windows.g
), hit_words AS (
  SELECT doc_id, count(DISTINCT k) AS n FROM (
    SELECT doc_id, unnest(range(p, p + size)) AS k FROM (SELECT DISTINCT doc_id, p, size FROM hits)) GROUP BY doc_id
), hit_items AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(i.n, 0) AS n_items,
       sha256(coalesce(i.ids, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit_words h ON d.doc_id = h.doc_id LEFT JOIN hit_items i ON d.doc_id = i.doc_id
"""


def op6_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))
