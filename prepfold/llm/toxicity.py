"""Toxicity by subword-bag embeddings averaged into a linear softmax.

A word is the bag of its byte n-grams (2 to 5 bytes, with a mark at either
end), each hashed to a row of an embedding table; a passage of ``PASSAGE``
words is the average of its words, a word the average of its n-grams. A
linear softmax over the two classes reads the average; embeddings and softmax
are trained together in numpy by mini-batch AdaGrad. Words that were never
seen share n-grams with those that were.

A document is toxic if some passage is, so the passages of a toxic document
that say nothing must not teach the model: after a first epoch a toxic
document trains on the passages the model finds most toxic only. A document's
score is that of its most toxic passage, calibrated on training documents by
a logistic curve over the passage score and the logarithm of the number of
passages (long clean documents have higher maxima).

Training reads at most ``TRAIN_DOCS`` labelled documents, those of the
smallest hashes of (doc_id, text), and their whole texts. Scoring reads every
whole text; as the softmax is linear, each n-gram has one number, and numpy
adds them up over the bytes of a batch.

Defined results: a null or empty text, or one without words, has no passage
and gets the share of toxic documents among the training documents; without
labelled rows, or with one class only, the score is that share for all (0
without rows); labels that are null or neither 0 nor 1 are left out; rows
that repeat are scored each; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import Shared, mapped, table, texts

GRAMS = (2, 3, 4, 5)
BUCKETS = 1 << 17
DIMENSIONS = 8
PASSAGE = 3
TRAIN_DOCS = 6000
EPOCHS = 6
BATCH = 4096
KEEP = 0.5
CLEAN = 1 / 3
RATE = 0.5
#: Text scored at a time.
SLICE_BYTES = 1 << 20
SEED = 42

#: A-Z to a-z; ASCII that is no letter and no digit to a space.
_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def _grams(data: np.ndarray):
    """For bytes with a space before, between and after words: for each size
    of n-gram, (start, bucket) of those inside a word with its two spaces."""
    space = data == 32
    spaces = np.concatenate([[0], np.cumsum(space)])
    wide = data.astype(np.uint32)
    for n in GRAMS:
        if len(data) < n:
            continue
        m = len(data) - n + 1
        value = np.full(m, n, np.uint32)
        for k in range(n):
            value *= np.uint32(16777619)
            value ^= wide[k:k + m]
        value *= np.uint32(2654435761)
        inner = spaces[n - 1:n - 1 + m] - spaces[1:1 + m]  # spaces that are neither first nor last byte
        start = np.flatnonzero(inner == 0)
        yield start, (value[start] >> np.uint32(32 - BUCKETS.bit_length() + 1)).astype(np.int32)


def _words(text: bytes) -> list[bytes]:
    """The words of a text; one that follows itself counts once."""
    return [w for w, _ in groupby(text.translate(_BYTES).split())]


def _joined(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bytes with a space before, between and after words, start of each word:
    the space before it)."""
    sizes = np.fromiter((len(w) + 1 for w in words), np.int64, len(words))
    return np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8), np.cumsum(sizes) - sizes


def _prepared(documents: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, start of each word, words per document)."""
    lists = [_words(t) for t in documents]
    return *_joined([w for ws in lists for w in ws]), np.array([len(ws) for ws in lists], np.int64)


def word_scores(data: np.ndarray, word_at: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The average weight of the n-grams of each word."""
    if not len(word_at):
        return np.empty(0)
    total, count = np.zeros(len(word_at)), np.zeros(len(word_at))
    for start, bucket in _grams(data):
        if not len(start):
            continue
        # start is sorted, and so are the words.
        first = np.searchsorted(start, word_at)
        upto = np.concatenate([[0.0], np.cumsum(weight[bucket], dtype=np.float64)])
        ends = np.append(first[1:], len(start))
        total += upto[ends] - upto[first]
        count += ends - first
    return total / np.maximum(count, 1)


def passages(n_words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first word of each passage, number of passages of each document)."""
    counts = -(-n_words // PASSAGE)
    at = np.cumsum(n_words) - n_words
    k = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return np.repeat(at, counts) + PASSAGE * k, counts


def passage_scores(words: np.ndarray, start: np.ndarray, counts: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    """The average of each passage's words; its last words are the last
    passage, however few."""
    if not len(start):
        return np.empty(0)
    size = np.diff(np.append(start, n_words.sum()))
    return np.add.reduceat(words, start) / size


class Model:
    """Score of each n-gram, bias and calibration; empty if nothing to learn."""

    def __init__(self, prior: float, weight=None, bias: float = 0.0, calibration=(0.0, 0.0, 0.0)):
        self.prior, self.weight, self.bias, self.calibration = prior, weight, bias, calibration

    def scores(self, documents: list[bytes]) -> np.ndarray:
        out = np.full(len(documents), float(self.prior))
        if self.weight is None or not documents:
            return out
        best, counts = self.best(documents)
        some = counts > 0
        a, b, c = self.calibration
        out[some] = _sigmoid(a * best[some] + b * np.log(counts[some]) + c)
        return out

    def best(self, documents: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(logit of the most toxic passage, number of passages)."""
        data, word_at, n_words = _prepared(documents)
        start, counts = passages(n_words)
        score = passage_scores(word_scores(data, word_at, self.weight), start, counts, n_words) + self.bias
        best = np.full(len(documents), -np.inf)
        some = np.flatnonzero(counts)
        if len(some):
            best[some] = np.maximum.reduceat(score, (np.cumsum(counts) - counts)[some])
        return best, counts


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _calibrate(best: np.ndarray, counts: np.ndarray, label: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression on (best passage, log of passages), by Newton."""
    x = np.stack([best, np.log(counts), np.ones(len(best))], 1)
    w = np.zeros(3)
    for _ in range(50):
        p = _sigmoid(x @ w)
        gradient = x.T @ (p - label) + 1e-2 * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(3)
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(w.tolist())


def train(documents: list[bytes], label: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> Model:
    """documents and 0/1 labels -> model."""
    prior = float(label.mean()) if len(label) else 0.0
    if len(np.unique(label)) < 2:
        return Model(prior)
    # Words as numbers of distinct words, a document at a time.
    known: dict[bytes, int] = {}
    lists = [np.array([known.setdefault(w, len(known)) for w in _words(t)], np.int32) for t in documents]
    n_words, word = np.array([len(x) for x in lists], np.int64), np.concatenate(lists)
    if not len(word):
        return Model(prior)
    bucket, size = _grams_of(list(known))
    first = np.cumsum(size) - size
    del known, lists

    def scores_now(model: Model) -> np.ndarray:
        upto = np.concatenate([[0.0], np.cumsum(model.weight[bucket], dtype=np.float64)])
        own = (upto[first + size] - upto[first]) / np.maximum(size, 1)
        return passage_scores(own[word], start, counts, n_words) + model.bias

    start, counts = passages(n_words)
    length = np.diff(np.append(start, n_words.sum()))
    doc = np.repeat(np.arange(len(counts)), counts)
    target = label[doc].astype(np.float64)
    rng = np.random.default_rng(seed)
    table_ = rng.uniform(-1, 1, (BUCKETS, DIMENSIONS)) / DIMENSIONS
    softmax, bias = rng.uniform(-1, 1, (DIMENSIONS, 2)) / DIMENSIONS, np.zeros(2)
    grown_t, grown_s, grown_b = np.full(BUCKETS, 1e-2), np.full(softmax.shape, 1e-2), np.full(2, 1e-2)
    toxic = np.ones(len(start), bool)  # passages a toxic document trains on
    size_of_batch = min(BATCH, max(64, len(start) // 384))
    for epoch in range(epochs):
        if epoch:
            score = scores_now(_linear(prior, table_, softmax, bias)) - float(bias[1] - bias[0])
            top = np.maximum.reduceat(score, (np.cumsum(counts) - counts)[counts > 0])
            best = np.repeat(top, counts[counts > 0])
            toxic = (score >= best - 1e-9) | ((epoch < 2) & (score > best / 2))
        # Clean passages are many; an epoch sees a third of them, another each time.
        chosen = np.flatnonzero(np.where(target == 1, toxic, rng.random(len(start)) < CLEAN))
        for batch in np.array_split(rng.permutation(chosen), -(-len(chosen) // size_of_batch)):
            n = length[batch]
            where = np.repeat(start[batch] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            used, own = np.unique(word[where], return_inverse=True)
            g = size[used]
            gram_at = np.repeat(first[used] - (np.cumsum(g) - g), g) + np.arange(g.sum())
            # Half of a word's n-grams are left out, so that each learns to speak for itself.
            keep = rng.random(len(gram_at)) < KEEP
            keep[np.cumsum(g) - g + (rng.random(len(g)) * g).astype(np.int64)] = True
            rows = bucket[gram_at[keep]]
            g = np.bincount(np.repeat(np.arange(len(g)), g)[keep], minlength=len(g))
            share = 1 / np.maximum(g, 1)
            vector = np.add.reduceat(table_[rows], np.cumsum(g) - g) * share[:, None]
            passage = np.repeat(np.arange(len(batch)), n)
            mean = np.add.reduceat(vector[own], np.cumsum(n) - n) / n[:, None]
            logits = mean @ softmax + bias
            p = _sigmoid(logits[:, 1] - logits[:, 0])
            # Both classes weigh the same, whichever is rarer.
            y = target[batch]
            weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-6), 0.5 / max(1 - y.mean(), 1e-6))
            error = np.stack([-(p - y), p - y], 1) * (weight / len(batch))[:, None]
            to_mean = error @ softmax.T / n[:, None]
            to_word = np.stack([np.bincount(own, to_mean[passage, k], len(used)) for k in range(DIMENSIONS)], 1)
            to_gram = np.repeat(to_word * share[:, None], g, axis=0)
            hit, slot = np.unique(rows, return_inverse=True)
            change = np.stack([np.bincount(slot, to_gram[:, k], len(hit)) for k in range(DIMENSIONS)], 1)
            grad_s, grad_b = mean.T @ error, error.sum(0)
            grown_t[hit] += (change ** 2).sum(1) * len(batch) ** 2
            table_[hit] -= RATE * len(batch) * change / np.sqrt(grown_t[hit])[:, None]
            grown_s += grad_s ** 2
            softmax -= RATE * grad_s / np.sqrt(grown_s)
            grown_b += grad_b ** 2
            bias -= RATE * grad_b / np.sqrt(grown_b)
    model = _linear(prior, table_, softmax, bias)
    some = counts > 0
    best = np.maximum.reduceat(scores_now(model), (np.cumsum(counts) - counts)[some])
    model.calibration = _calibrate(best, counts[some], label[some])
    return model


def _grams_of(words: list[bytes], step: int = 1 << 15) -> tuple[np.ndarray, np.ndarray]:
    """(buckets of the n-grams of each word, one word after the other; how
    many each has)."""
    buckets, sizes = [], []
    for k in range(0, len(words), step):
        data, at = _joined(words[k:k + step])
        parts = [(np.searchsorted(at, start, "right") - 1, own) for start, own in _grams(data)]
        owner = np.concatenate([p[0] for p in parts])
        order = np.argsort(owner, kind="stable")
        buckets.append(np.concatenate([p[1] for p in parts])[order])
        sizes.append(np.bincount(owner, minlength=len(at)))
    return np.concatenate(buckets), np.concatenate(sizes)


def _linear(prior: float, table_: np.ndarray, softmax: np.ndarray, bias: np.ndarray) -> Model:
    """The difference of the two classes' logits, by n-gram."""
    return Model(prior, (table_ @ (softmax[:, 1] - softmax[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def held_out(id_col: Column) -> Column:
    """Rows whose crc32(doc_id as text) is a multiple of 5."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", max_docs: int = TRAIN_DOCS, **params) -> Model:
    """Train on at most ``max_docs`` labelled rows that are not held out."""
    key = F.col(f"`{id_col}`")
    own = (labels.select(key.alias("id"), F.col(f"`{label_col}`").cast("int").alias("label"))
           .filter("id is not null and label in (0, 1)").filter(~held_out(F.col("id"))).distinct())
    rows = docs.select(key.alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    # The choice is made among the labels alone; only chosen rows' texts are joined.
    chosen = own.orderBy(F.xxhash64("id", "label"), "id", "label").limit(max_docs)
    got = rows.join(chosen, "id").select("text", "label").toArrow()
    pairs = sorted(zip(texts(got.column("text").combine_chunks()), got.column("label").to_pylist()))
    return train([t for t, _ in pairs], np.array([y for _, y in pairs], np.int64), **params)


def scored(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with a score; all other columns stay."""
    shared = Shared(docs.sparkSession, model)
    at = docs.columns.index(text_col)

    def run(batches):
        model = shared.value
        for batch in batches:
            score, own, size = [np.empty(0)], [], 0
            for text in texts(batch.column(at)):
                own.append(text)
                size += len(text)
                if size >= SLICE_BYTES:
                    score.append(model.scores(own))
                    own, size = [], 0
            score = np.concatenate([*score, model.scores(own)])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)],
                                             names=[*batch.schema.names, "score"])

    return mapped(docs, run, [T.StructField(score_col, T.DoubleType())])


def op8_toxicity(spark, sf_dir: str) -> DataFrame:
    """No SQL form; the tests measure accuracy on held-out labels."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return scored(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
