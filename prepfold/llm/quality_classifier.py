"""Document quality by co-training two views.

One view sees a text's content: shares of kinds of bytes and of each ASCII
mark, and how words repeat. The other sees the page's metadata: language,
source, size, and how its lines are laid out. Each view has a logistic
regression of its own. Both start from the labelled documents; then, in every
round, both views are fitted and each labels the unlabelled documents it is
most sure of (the same share of each class as the labelled ones have), and
these join the other view's training set. Each view is calibrated on the labelled documents by a
logistic curve over cross-fitted scores, and the calibrated views are combined
as independent evidence: their log odds add up, less the log odds of the
labels.

Training reads at most ``TRAIN_DOCS`` labelled rows, those of the smallest
hashes, and every unlabelled one. The unlabelled rows' features are written
once as a table and stay in their tasks: a pass over them counts how many rows
a view is how sure of, or adds up gradient and Hessian for a Newton step, and
only these sums reach the driver. Which rows a view got in earlier rounds
follows from the models and thresholds of these rounds. Scoring reads every
whole text.

Defined results: a null text counts as empty, null metadata as a value of its
own; without labelled rows, or with one class only, the score is the share
of good ones among them (1 without rows: nothing is known against a
document); labels that are null or neither 0 nor 1 are left out; rows that
repeat are scored each; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import Shared, mapped, table, texts, written
from .toxicity import held_out

TRAIN_DOCS = 6000
ROUNDS = 5
#: Share of the pool that a view labels in a round, and how sure it has to be.
SHARE = 0.05
SURE = 0.95
#: Bins of sureness; the last one a share reaches into is divided by a hash.
BINS = 2048
HASHED = 32
RIDGE = 1.0

_MARKS = [c for c in range(33, 127) if not chr(c).isalnum()]


def content(text: bytes) -> list[float]:
    """The content view of a text."""
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    n = max(1, len(text))
    words = text.split()
    m = max(1, len(words))
    seen = Counter(words)
    top = max(seen.values(), default=0)
    same = sum(map(bytes.__eq__, words, words[1:]))
    kinds = [counts[65:91].sum(), counts[97:123].sum(), counts[48:58].sum(), counts[128:].sum(), counts[9:14].sum(),
             counts[32], counts[:9].sum() + counts[14:32].sum()]
    return [*np.log1p(100 * np.array(kinds) / n).tolist(), *np.log1p(1000 * counts[_MARKS] / n).tolist(),
            np.log1p(len(words)), n / m, len(seen) / m, top / m, same / m, float(not words)]


def metadata(text: bytes, lang: str | None, source: str | None) -> list[float]:
    """The metadata view: language and source hashed, sizes, line layout."""
    own = np.zeros(2 * HASHED)
    own[zlib.crc32((lang or "\0").encode()) % HASHED] = 1
    own[HASHED + zlib.crc32((source or "\0").encode()) % HASHED] = 1
    sizes = np.array([len(x) for x in text.split(b"\n")])
    stops = sum(x.rstrip().endswith((b".", b"!", b"?")) for x in text.split(b"\n"))
    # How much shorter the text gets says how often it repeats itself.
    packed = len(zlib.compress(text, 1)) / max(1, len(text))
    return [*own.tolist(), np.log1p(len(text)), np.log1p(len(sizes)), np.log1p(sizes.mean()), np.log1p(sizes.max()),
            np.log1p(sizes.std()), float((sizes == 0).mean()), stops / len(sizes), packed]


class Logistic:
    """Ridge logistic regression over standardised features."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, w: np.ndarray | None = None):
        self.mean, self.scale = mean, scale
        self.w = np.zeros(len(mean) + 1) if w is None else w

    def _wide(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.concatenate([z, np.ones((len(x), 1))], 1)

    def logit(self, x: np.ndarray) -> np.ndarray:
        return self._wide(x) @ self.w

    def sums(self, x: np.ndarray, y: np.ndarray, weight: float) -> np.ndarray:
        """What rows add to the Hessian and, in a last column, to the gradient."""
        z = self._wide(x)
        p = _sigmoid(z @ self.w)
        return weight * np.concatenate([(z * (p * (1 - p))[:, None]).T @ z, (z.T @ (p - y))[:, None]], 1)


def _newton(models: list[Logistic], sums) -> None:
    """Fits the models side by side; ``sums`` gives what all rows add to each."""
    for _ in range(30):
        largest = 0.0
        for model, own in zip(models, sums(models)):
            ridge = np.full(len(model.w), RIDGE)
            ridge[-1] = 1e-6
            step = np.linalg.solve(own[:, :-1] + np.diag(ridge + 1e-9), own[:, -1] + ridge * model.w)
            model.w = model.w - step * min(1.0, 10 / max(np.abs(step).max(), 1e-9))
            largest = max(largest, np.abs(step).max())
        if largest < 1e-5:  # the error left is about its square
            break


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _curve(logit: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve; the slope is never negative."""
    x = np.stack([logit, np.ones(len(logit))], 1)
    w = np.array([0.0, 0.0])
    for _ in range(50):
        p = _sigmoid(x @ w)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (p - y) + 1e-3 * w)
        w -= step * min(1.0, 5 / max(np.abs(step).max(), 1e-9))
    return max(0.0, float(w[0])), float(w[1])


class Model:
    """The calibrated views, or the share of good labels alone."""

    def __init__(self, prior: float, views=()):
        self.prior, self.views = prior, views  # (logistic, slope, offset) each

    def scores(self, features: list[np.ndarray]) -> np.ndarray:
        """(n, 3): all evidence, content view, metadata view."""
        n = len(features[0])
        if not self.views or not n:
            return np.full((n, 3), float(self.prior))
        base = np.log(self.prior / (1 - self.prior))
        odds = [a * v.logit(x) + b for (v, a, b), x in zip(self.views, features)]
        return np.stack([_sigmoid(sum(odds) - base), *map(_sigmoid, odds)], 1)


class Held:
    """A pool in memory: feature matrices of the two views."""

    def __init__(self, views: list[np.ndarray]):
        self.views, self.tie = views, np.random.default_rng(0).random(len(views[0]))

    def total(self, run) -> np.ndarray:
        return run(self.views, self.tie)


class Stored:
    """A pool in a table (content, metadata, tie); only sums leave its tasks."""

    def __init__(self, rows: DataFrame):
        self.rows = rows

    def total(self, run) -> np.ndarray:
        """``run`` (both views' matrices, ties) -> array, added up over all rows."""
        width = [len(x[0]) for x in _views([(b"", None, None)])]

        def task(batches):
            total = 0
            for batch in batches:
                views = [batch.column(k).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, width[k])
                         for k in (0, 1)]
                total = total + run(views, batch.column(2).to_numpy(zero_copy_only=False))
            if not np.isscalar(total):
                yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

        parts = [np.frombuffer(r.sums) for r in self.rows.mapInArrow(task, "sums binary").collect()]
        return sum(parts) if parts else run([np.empty((0, n)) for n in width], np.empty(0))


def _bins(logit: np.ndarray) -> np.ndarray:
    """The bin of how sure a view is; under 0 where it is not sure enough."""
    low = np.log(SURE / (1 - SURE))
    return np.floor((np.minimum(logit, 35 - 1e-6) - low) / (35 - low) * BINS).astype(np.int64)


def _cut(counts: np.ndarray, n: int) -> tuple[int, float]:
    """The surest ``n`` rows: the last bin they reach, and their share of it."""
    upto = np.cumsum(counts[::-1])
    if upto[-1] <= n:
        return 0, 1.0
    k = int(np.searchsorted(upto, n))
    at = BINS - 1 - k
    return at, float((n - (upto[k] - counts[at])) / counts[at])


def _given(picks: list, x: np.ndarray, tie: np.ndarray) -> np.ndarray:
    """The labels (-1: none) that the other view gave rows in the rounds so
    far; x: the other view's features."""
    out = np.full(len(tie), -1.0)
    for model, *cuts in picks:
        logit, free = model.logit(x), out < 0
        for label, (at, share) in zip((1.0, 0.0), cuts):
            own = _bins(logit if label else -logit)
            out[free & ((own > at) | ((own == at) & (tie < share)))] = label
    return out


def co_train(labelled: list[np.ndarray], y: np.ndarray, pool, rounds: int = ROUNDS) -> Model:
    """labelled: feature matrices of the two views; pool: these, or a Stored."""
    prior = float(y.mean()) if len(y) else 1.0
    if len(np.unique(y)) < 2:
        return Model(prior)
    pool = pool if hasattr(pool, "total") else Held(pool)
    middle = [x.mean(axis=0) for x in labelled]

    def moments(views, tie):
        off = [x - m for x, m in zip(views, middle)]
        return np.concatenate([[len(tie)], *(x.sum(axis=0) for x in off), *((x ** 2).sum(axis=0) for x in off)])

    found = pool.total(moments)
    m = int(found[0])
    n = m + len(y)
    first, second = np.split((found + moments(labelled, y))[1:] / n, 2)
    scale = np.sqrt(np.maximum(second - first ** 2, 0)) + 1e-6
    split = [len(middle[0])]
    kinds = list(zip([a + b for a, b in zip(middle, np.split(first, split))], np.split(scale, split)))
    picks: list[list] = [[], []]  # what each view trains on in the pool: by which model, from which sureness

    def fit_all(models: list[Logistic], of: list[int], rows: list[np.ndarray]) -> None:
        def sums(models):
            own = [model.sums(labelled[v][r], y[r], 1.0) for model, v, r in zip(models, of, rows)]
            if not picks[0]:
                return own

            def run(views, tie):
                given = [_given(picks[v], views[1 - v], tie) for v in (0, 1)]
                has = [g >= 0 for g in given]
                # A pseudo-label counts less than a label.
                return np.concatenate([model.sums(views[v][has[v]], given[v][has[v]], 0.25).ravel()
                                       for model, v in zip(models, of)])

            parts = np.split(pool.total(run), np.cumsum([x.size for x in own])[:-1])
            return [x + part.reshape(x.shape) for x, part in zip(own, parts)]

        _newton(models, sums)

    everything = np.arange(len(y))
    last = [Logistic(*kinds[v]) for v in (0, 1)]
    for _ in range(rounds if m else 0):
        models = [Logistic(*kinds[v], last[v].w) for v in (0, 1)]
        fit_all(models, [0, 1], [everything] * 2)
        last = models

        def sure(views, tie):
            out = []
            for v in (0, 1):
                logit = models[v].logit(views[v])[_given(picks[1 - v], views[v], tie) < 0]
                for own in (_bins(logit), _bins(-logit)):
                    out.append(np.bincount(own[own >= 0], minlength=BINS))
            return np.concatenate(out).astype(float)

        counts = np.split(pool.total(sure), 4)
        for v in (0, 1):
            cuts = [_cut(counts[2 * v + k], max(1, round(SHARE * share * m))) for k, share in enumerate((prior, 1 - prior))]
            picks[1 - v].append((models[v], *cuts))
    fold = np.arange(len(y)) % 5
    rows = [everything, *(everything[fold != k] for k in range(5))]
    models = [Logistic(*kinds[v], last[v].w) for v in (0, 1) for _ in rows]
    fit_all(models, [0] * 6 + [1] * 6, rows * 2)
    views = []
    for v in (0, 1):
        crossed = np.empty(len(y))
        for k in range(5):
            crossed[fold == k] = models[6 * v + 1 + k].logit(labelled[v][fold == k])
        views.append((models[6 * v], *_curve(crossed, y)))
    return Model(prior, views)


def _views(docs: list[tuple[bytes, str | None, str | None]]) -> list[np.ndarray]:
    x = np.array([content(t) for t, _, _ in docs], float).reshape(len(docs), -1)
    return [x, np.array([metadata(*d) for d in docs], float).reshape(len(docs), -1)]


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        source_col: str = "source", label_col: str = "quality", train_docs: int = TRAIN_DOCS,
        rounds: int = ROUNDS) -> Model:
    """Co-train on labelled rows that are not held out and all rows without a label."""
    key = F.col(f"`{id_col}`")
    known = labels.select(key.alias("id"), F.col(f"`{label_col}`").cast("int").alias("label"))
    own = known.filter("id is not null and label in (0, 1)").filter(~held_out(F.col("id"))).distinct()
    rows = docs.select(key.alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"),
                       F.col(f"`{lang_col}`").cast("string").alias("lang"),
                       F.col(f"`{source_col}`").cast("string").alias("source"))
    chosen = own.orderBy(F.xxhash64("id", "label"), "id", "label").limit(train_docs)
    got = rows.join(chosen, "id").select("label", "text", "lang", "source")

    def run(batches):
        for batch in batches:
            made = _views(list(zip(texts(batch.column(1)), batch.column(2).to_pylist(), batch.column(3).to_pylist())))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(list(x), pa.list_(pa.float64())) for x in made), *batch.columns[4:]],
                names=["label", "content", "metadata", *batch.schema.names[4:]])

    made = "content array<double>, metadata array<double>"
    found = sorted((r.label, r.content, r.metadata) for r in got.mapInArrow(run, f"label int, {made}").collect())
    width = [len(x[0]) for x in _views([(b"", None, None)])]
    train = [found[k] for k in np.random.default_rng(0).permutation(len(found))]
    y = np.array([r[0] for r in train], float)
    if len(np.unique(y)) < 2:
        return Model(float(y.mean()) if len(y) else 1.0)
    tie = F.xxhash64("id", "text").bitwiseAND(F.lit((1 << 52) - 1)) / float(1 << 52)
    features = (rows.select(F.lit(-1).alias("label"), "text", "lang", "source", "id", tie.alias("tie"))
                .mapInArrow(run, f"label int, {made}, id {dict(rows.dtypes)['id']}, tie double")
                .select("id", F.col("content").cast("array<float>"), F.col("metadata").cast("array<float>"), "tie"))
    # Texts stay where they are; rows of a null or invalid label have none.
    pool = written(features.join(known.filter("label in (0, 1)").select("id"), "id", "left_anti")
                   .select("content", "metadata", "tie"))
    return co_train([np.array([r[1 + k] for r in train], float).reshape(len(train), width[k]) for k in (0, 1)], y,
                    Stored(pool), rounds)


def scored(docs: DataFrame, model: Model, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
           score_col: str = "score") -> DataFrame:
    """``docs`` with three scores: ``score_col``, and the same with _content
    and _metadata behind it; all other columns stay."""
    shared = Shared(docs.sparkSession, model)
    names = docs.columns
    at = [names.index(c) for c in (text_col, lang_col, source_col)]
    added = [score_col, f"{score_col}_content", f"{score_col}_metadata"]

    def run(batches):
        model = shared.value
        for batch in batches:
            text, lang, source = (batch.column(k) for k in at)
            made = _views(list(zip(texts(text), lang.cast(pa.string()).to_pylist(), source.cast(pa.string()).to_pylist())))
            score = model.scores(made)
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(score[:, k]) for k in range(3))],
                                             names=[*batch.schema.names, *added])

    return mapped(docs, run, [T.StructField(c, T.DoubleType()) for c in added])


def op7_quality_classifier(spark, sf_dir: str) -> DataFrame:
    """One row per document: doc_id, held_out, score (higher: quality 1
    likelier), predicted, and each view's own score. No SQL form; the tests
    measure accuracy on held-out labels."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return scored(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "score_content", "score_metadata")
