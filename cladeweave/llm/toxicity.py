"""Toxicity by a factorization machine over hashed terms.

Terms are the words of a text in lower case and the first letters of longer words, each
hashed into 2**20 buckets. A text is the set of its buckets. The model is fitted on a
bounded sample, at most ``ROWS`` labelled documents of the training fold and ``TERMS``
terms of them in all, those with the least hashes of their ids. The machine has a weight
and a vector of ``FACTORS`` numbers for every bucket seen in the sample:

    logit = w0 + sum_i w_i + sum_{i<j} <v_i, v_j>,

so pairs of terms count beyond their sum. No term is left out beforehand, by count or by
what it tells alone. What keeps the rest from being learned by heart is a penalty on the
size of each weight and each vector, in proportion to the noise of its gradient and to
sqrt(2 ln terms), the size that noise reaches among so many terms; it weakens as a weight
or vector grows. A vector's gradient is that of its pairs, and all vectors start at
random, so a pair is learned although neither of its terms tells anything alone. Only terms
that no gradient could move against the penalty keep zero from the start, which is exact.

The fit takes ``STEPS`` steps of gradients over the whole sample for the weights and as
many for weights and vectors, on the driver, which gets the numbers of the sample's terms
packed. Only terms whose weight or vector is not zero change a score; they go to the tasks
as a broadcast.

Nulls and odd cases: a null or empty text has no terms and scores the model's bias;
labels that are null or neither 0 nor 1 are ignored, and so are documents whose labels
contradict each other; repeated documents each give a row, and one of them is learned
from; without labelled documents of both kinds every score is the share of label 1, or 0
when there are none.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import materialize, temporary
from .common import claim, keep_texts, map_batches, utf8

BUCKETS = 1 << 20
PREFIX = 5
FACTORS, ROWS, TERMS = 8, 20_000, 8_000_000
#: steps of each phase of the fit, step size, first size of vectors
STEPS, RATE, START = 50, 0.1, 0.1
#: shares of the noise that the penalties on weights and vectors take, how they weaken, decay
WEIGHT_NOISE, VECTOR_NOISE, WEAKEN, DECAY = 0.8, 0.5, 10.0, 1.0
#: entries summed together
SLICE = 1 << 16
#: weights or vectors that take a step together
ROWS_AT_ONCE = 1 << 14
FOLDS = 5

_WORD = re.compile(r"\w+")
_SCORED = "doc_id long, score double"


@lru_cache(maxsize=1 << 16)
def word_terms(word: str) -> tuple[int, ...]:
    own = zlib.crc32(b"w " + utf8(word)) % BUCKETS
    if len(word) <= PREFIX:
        return (own,)
    return own, zlib.crc32(b"p " + utf8(word[:PREFIX])) % BUCKETS


def _forget() -> None:
    word_terms.cache_clear()
    _word_rows.cache_clear()


def terms(text: str | None) -> set[int]:
    claim("toxicity", _forget)
    found: set[int] = set()
    if text:
        for word in set(_WORD.findall(text.lower())):
            found.update(word_terms(word))
    return found


def held_out(doc_id: Column | str) -> Column:
    """True for the documents whose labels are not learned from."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


@dataclass(frozen=True)
class Machine:
    """A fitted factorization machine; ``term`` gives the row of a bucket."""

    term: dict[int, int]
    bias: float
    weights: np.ndarray
    vectors: np.ndarray
    key: str

    def score(self, found: set[int]) -> float:
        rows = [self.term[t] for t in found if t in self.term]
        return float(_sigmoid(np.array([_logit(self.bias, self.weights[rows], self.vectors[rows])]))[0])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _logit(bias: float, w: np.ndarray, v: np.ndarray) -> float:
    total = v.sum(0)
    return bias + w.sum() + 0.5 * float((total * total).sum() - (v * v).sum())


def labelled(docs: DataFrame, labels: DataFrame, label: str, max_rows: int = ROWS) -> DataFrame:
    """Training rows: doc_id, y, terms, of at most ``max_rows`` labels of the training fold.

    The labels are chosen before the texts are looked up, so what is broadcast has at most
    ``max_rows`` rows and no other text is shuffled. Of rows that share a doc_id the least
    text counts.
    """
    y = (
        labels.select(F.col("doc_id").cast("long"), F.col(label).cast("int").alias("y"))
        .filter(F.col("y").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
        .groupBy("doc_id")
        .agg(F.min("y").alias("y"), F.max("y").alias("_most"))
        .filter(F.col("y") == F.col("_most"))
        .drop("_most")
    )
    chosen = materialize(y.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows), "labels")
    known = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = known.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))

    def batch(rows: dict[str, list]) -> dict[str, list]:
        return {"doc_id": rows["doc_id"], "y": rows["y"], "terms": [sorted(terms(t)) for t in rows["text"]]}

    return map_batches(rows.select("doc_id", "text", "y"), batch, "doc_id long, y int, terms array<int>")


class _Adam:
    """Steps for parameters that a penalty on their size keeps at zero.

    A parameter is a row: one weight, or a vector. At zero it stays while its gradient is
    not longer than the penalty; where a step would turn it around it becomes zero. Rows
    do not depend on each other and go by ranges, so what a step holds beside its results
    is bounded.
    """

    def __init__(self, like: np.ndarray):
        self._mean, self._square, self._step = np.zeros_like(like), np.zeros((len(like), 1), like.dtype), 0

    def step(self, values: np.ndarray, gradient: np.ndarray, penalty: np.ndarray) -> None:
        """Change ``values``."""
        self._step += 1
        for a in range(0, len(values), ROWS_AT_ONCE):
            rows = slice(a, a + ROWS_AT_ONCE)
            values[rows] = self._shrunk(rows, values[rows], gradient[rows], penalty[rows])

    def _shrunk(self, rows: slice, values: np.ndarray, gradient: np.ndarray, penalty: np.ndarray) -> np.ndarray:
        size = np.sqrt((values**2).sum(1))
        length = np.sqrt((gradient**2).sum(1))
        on = size > 0
        pull = penalty / (1 + WEAKEN * size) / np.where(on, size, 1)
        left = np.maximum(1 - penalty / np.maximum(length, 1e-12), 0)
        moved = np.where(on[:, None], gradient + pull[:, None] * values, gradient * left[:, None])
        self._mean[rows][~on & (left == 0)] = 0
        new = values - self._moved(rows, moved)
        new[on & ((new * values).sum(1) < 0)] = 0
        return new

    def move(self, gradient: np.ndarray) -> np.ndarray:
        self._step += 1
        return self._moved(slice(None), gradient)

    def _moved(self, rows: slice, gradient: np.ndarray) -> np.ndarray:
        mean, square = self._mean[rows], self._square[rows]
        mean += 0.1 * (gradient - mean)
        square += 0.01 * ((gradient**2).sum(1, keepdims=True) - square)
        mean, square = mean / (1 - 0.9**self._step), square / (1 - 0.99**self._step)
        return RATE * mean / (np.sqrt(square) + 1e-8)


class _Incidence:
    """Which term is in which document, ordered by document and by term.

    Sums over the terms of every document, or over the documents of every term, go by
    ranges of ``SLICE`` entries, so what they hold beside the sums does not grow with them.
    """

    def __init__(self, flat: np.ndarray, sizes: np.ndarray, n_terms: int):
        self.docs = _counts(flat, sizes, n_terms)
        self._flat, self._sizes, self._by_term = flat, sizes, _turned(flat, sizes, self.docs)
        self._cuts = _cuts(self.docs)
        self._live = self._members = None

    def by_term(self, values: np.ndarray) -> np.ndarray:
        """Sums of a row of ``values`` per document over the documents of every term."""
        return _sums(values, self._by_term, self.docs, self._cuts)

    def by_doc(self, values: np.ndarray, live: np.ndarray) -> np.ndarray:
        """Sums of a row of ``values`` per term over the terms of every document, those that
        are ``live``, as the others are zero."""
        if self._live is None or (live != self._live).any():
            self._members = None  # the ones before go first
            flat, sizes = _only(self._flat, self._sizes, live)
            self._live, self._members = live, (flat, sizes, _cuts(sizes))
        return _sums(values, *self._members)


def _cuts(sizes: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of groups of about ``SLICE`` entries."""
    part = np.cumsum(sizes) // SLICE
    cuts = np.flatnonzero(np.diff(part)) + 1
    return list(zip([0, *cuts.tolist()], [*cuts.tolist(), len(sizes)]))


def _slices(sizes: np.ndarray) -> Iterator[tuple[slice, slice]]:
    """The documents of every range of about ``SLICE`` entries, and these entries."""
    ends = np.cumsum(sizes, dtype=np.int64)
    for a, b in _cuts(sizes):
        if b > a:
            yield slice(a, b), slice(int(ends[a] - sizes[a]), int(ends[b - 1]))


def _counts(flat: np.ndarray, sizes: np.ndarray, n_terms: int) -> np.ndarray:
    """Documents of every term."""
    docs = np.zeros(n_terms, np.int64)
    for _, at in _slices(sizes):
        np.add.at(docs, flat[at], 1)
    return docs


def _turned(flat: np.ndarray, sizes: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """The documents of every term in order, one term after the other."""
    turned = np.empty(len(flat), np.int32)
    free = np.cumsum(docs) - docs  # the next place of every term
    for some, at in _slices(sizes):
        order = np.argsort(flat[at], kind="stable")
        term, first, count = np.unique(flat[at][order], return_index=True, return_counts=True)
        place = np.arange(len(order)) + np.repeat(free[term] - first, count)
        turned[place] = np.repeat(np.arange(some.start, some.stop, dtype=np.int32), sizes[some])[order]
        free[term] += count
    return turned


def _only(flat: np.ndarray, sizes: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What of ``flat`` is among ``terms``, and its sizes."""
    if terms.all():
        return flat, sizes
    left, parts = np.zeros(len(sizes), np.int64), [flat[:0]]
    for some, at in _slices(sizes):
        stays = terms[flat[at]]
        parts.append(flat[at][stays])
        left[some] = np.diff(np.append(0, np.cumsum(stays))[np.append(0, np.cumsum(sizes[some]))])
    return np.concatenate(parts), left


def _sums(values: np.ndarray, at: np.ndarray, sizes: np.ndarray, cuts: list[tuple[int, int]]) -> np.ndarray:
    """Sums of ``values[at]`` over consecutive groups of ``sizes`` entries."""
    sums = np.zeros((len(sizes), values.shape[1]), values.dtype)
    ends = np.cumsum(sizes, dtype=np.int64)
    for a, b in cuts:
        some = a + np.flatnonzero(sizes[a:b])  # reduceat takes no empty group
        if len(some):
            first = ends[a] - sizes[a]
            picked = values.take(at[first : ends[b - 1]], axis=0)
            sums[some] = np.add.reduceat(picked, ends[some] - sizes[some] - first, axis=0)
    return sums


def _movable(flat: np.ndarray, sizes: np.ndarray, weight: np.ndarray, noise: float, n_terms: int) -> np.ndarray:
    """Which terms some gradient could move away from zero; leaving out the others is exact.

    The error of a document is at most its weight. So the gradient of a weight is at most
    the sum of them, and that of a vector at most the root of the sum of their squares
    times the root of what the penalty on it is in proportion to.
    """
    docs, most, square = _counts(flat, sizes, n_terms), np.zeros(n_terms), np.zeros(n_terms)
    for some, at in _slices(sizes):
        each = np.repeat(weight[some], sizes[some])
        np.add.at(most, flat[at], each)
        np.add.at(square, flat[at], each**2)
    penalty = WEIGHT_NOISE * noise * np.sqrt(docs * (1 - docs / len(sizes)))
    return (most > penalty) | (np.sqrt(square) > VECTOR_NOISE * noise)


def _fit(flat: np.ndarray, sizes: np.ndarray, y: np.ndarray, n_terms: int) -> tuple[float, np.ndarray, np.ndarray]:
    """Logistic loss with penalties; positives and negatives weigh the same in sum.

    ``flat`` holds the terms of all documents one after the other, ``sizes`` of each.
    """
    share = y.mean()
    weight = np.where(y == 1, 0.5 / share, 0.5 / (1 - share))
    noise = float(np.sqrt(2 * np.log(max(n_terms, 2)) * np.mean((0.5 * weight) ** 2)))
    movable = _movable(flat, sizes, weight, noise, n_terms)
    flat, sizes = _only(flat, sizes, movable)
    flat = (np.cumsum(movable, dtype=np.int32) - 1)[flat]
    bias, of_weights, of_vectors = _descend(_Incidence(flat, sizes, int(movable.sum())), y, weight, noise)
    w, v = np.zeros(n_terms), np.zeros((n_terms, FACTORS))
    w[movable], v[movable] = of_weights, of_vectors
    return bias, w, v


def _descend(terms_of: _Incidence, y: np.ndarray, weight: np.ndarray, noise: float) -> tuple[float, np.ndarray, np.ndarray]:
    rng = np.random.default_rng(0)
    n, n_terms = len(y), len(terms_of.docs)
    penalty = WEIGHT_NOISE * noise * np.sqrt(terms_of.docs * (1 - terms_of.docs / n))
    bias, w, v = np.zeros((1, 1)), np.zeros((n_terms, 1)), np.zeros((n_terms, FACTORS), np.float32)
    adam = [_Adam(x) for x in (bias, w, v)]
    for step in range(2 * STEPS):
        if step == STEPS:
            # pairs of first vectors that mean nothing add about 1 to a text of usual length
            usual = max(terms_of.docs.sum() / n, 1)
            first = np.full((n_terms, 1), min(START, 1 / np.sqrt(2 * usual)), np.float32)
            first[w[:, 0] != 0] = START
            v = first * rng.standard_normal((n_terms, FACTORS), np.float32)
        live = v.any(1)
        of_docs = terms_of.by_doc(np.hstack([w, v, (v * v).sum(1, keepdims=True)]), live | (w[:, 0] != 0))
        total = of_docs[:, 1:-1]
        logit = bias[0, 0] + of_docs[:, 0] + 0.5 * ((total**2).sum(1) - of_docs[:, -1])
        error = ((_sigmoid(logit) - y) * weight)[:, None]
        known = [error, error * total, (total**2).sum(1, keepdims=True)] if live.any() else [error]
        sums = terms_of.by_term(np.hstack(known).astype(np.float32))
        by_w = sums[:, :1].astype(float)
        if live.any():
            by_v = sums[:, 1:-1] + (np.float32(DECAY) - sums[:, :1]) * v
            adam[2].step(v, by_v, (VECTOR_NOISE * noise * np.sqrt(sums[:, -1])).astype(np.float32))
        adam[1].step(w, by_w + DECAY * w, penalty)
        bias = bias - adam[0].move(np.array([[error.sum()]]))
    return float(bias[0, 0]), w[:, 0], v


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_rows: int = ROWS) -> Machine:
    """Learn ``label`` from the training fold."""
    with temporary(docs.sparkSession):
        return _fitted(docs, labels, label, max_rows)


def _bounded(rows: DataFrame) -> DataFrame:
    """Rows of :func:`labelled` in the order of their hashes, as far as ``TERMS`` terms go."""
    sized = rows.select(F.xxhash64("doc_id").alias("h"), "doc_id", F.size("terms").alias("n")).collect()
    total = 0
    for at, (h, doc_id, n) in enumerate(sorted(map(tuple, sized))):
        total += n
        if total > TERMS and at:
            before = (F.xxhash64("doc_id") < h) | (F.xxhash64("doc_id") == h) & (F.col("doc_id") < doc_id)
            return rows.filter(before)
    return rows


def _fitted(docs: DataFrame, labels: DataFrame, label: str, max_rows: int) -> Machine:
    rows = _bounded(materialize(labelled(docs, labels, label, max_rows), "terms"))
    n, positive = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0))).first()
    key = uuid.uuid4().hex
    if not positive or positive == n:
        share = min(max(positive / n if n else 0.0, 1e-9), 1 - 1e-9)
        return Machine({}, float(np.log(share / (1 - share))), np.zeros(0), np.zeros((0, FACTORS)), key)

    def batch(rows: dict[str, list]) -> dict[str, list]:
        packed = [np.array(found, "<i4").tobytes() for found in rows["terms"]]
        return {"doc_id": rows["doc_id"], "y": rows["y"], "terms": packed}

    sample = map_batches(rows.select("doc_id", "y", "terms"), batch, "doc_id long, y int, terms binary")
    # at most max_rows documents and about TERMS terms, in 32 bits each
    got = sorted((r["doc_id"], r["y"], r["terms"]) for r in sample.toLocalIterator())
    y, sizes = np.array([g[1] for g in got], float), np.array([len(g[2]) // 4 for g in got])
    flat = np.frombuffer(b"".join(g[2] for g in got), "<i4")
    del got
    present = np.zeros(BUCKETS, bool)
    present[flat] = True
    seen = np.flatnonzero(present)
    flat = (np.cumsum(present, dtype=np.int32) - 1)[flat]
    bias, weights, vectors = _fit(flat, sizes, y, len(seen))
    live = np.flatnonzero((weights != 0) | vectors.any(1))  # the others add nothing to a score
    term = {t: i for i, t in enumerate(seen[live].tolist())}
    return Machine(term, bias, weights[live], vectors[live], key)


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """``doc_id`` and ``score`` of every document."""
    model = docs.sparkSession.sparkContext.broadcast(machine)

    def batch(rows: dict[str, list]) -> dict[str, list]:
        return {"doc_id": rows["doc_id"], "score": _scores(model, rows["text"])}

    return map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), batch, _SCORED)


@lru_cache(maxsize=1)
def _word_rows(key: str, model) -> dict[str, tuple[int, ...]]:
    return {}


def _scores(model, texts: list[str | None]) -> list[float]:
    """Scores by way of a memo from words to the rows of their terms."""
    claim("toxicity", _forget)
    machine: Machine = model.value
    memo = _word_rows(machine.key, model)
    found = []
    for text in texts:
        rows: set[int] = set()
        for word in set(_WORD.findall(text.lower())) if text else ():
            known = memo.get(word)
            if known is None:
                if len(memo) > 1 << 17:
                    memo.clear()
                known = memo[word] = tuple(machine.term[t] for t in word_terms(word) if t in machine.term)
            rows.update(known)
        at = sorted(rows)
        found.append(_logit(machine.bias, machine.weights[at], machine.vectors[at]))
    return _sigmoid(np.array(found, float)).tolist()


def keep_clean(docs: DataFrame, machine: Machine, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns."""
    model = docs.sparkSession.sparkContext.broadcast(machine)

    def decide(texts: list[str | None]) -> np.ndarray:
        return np.array(_scores(model, texts), float) < threshold

    return keep_texts(docs, decide)
