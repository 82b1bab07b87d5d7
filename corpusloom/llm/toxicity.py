"""Toxicity by subword-bag embeddings averaged into a linear softmax.

A word is its character n-grams and itself, hashed into rows of an embedding matrix. A text is the
average of its subwords' vectors; a softmax over two classes reads that average. Embeddings and
softmax are trained jointly in numpy, on a bounded sample of labelled texts. An unseen misspelling
shares most n-grams, and so most of its vector, with the word it disguises. A word that stands n times
weighs log(1 + n), so that a repeated line does not decide alone.

All parts of the score but the softmax are sums over words, so a task scores each distinct word once.
"""

from __future__ import annotations

import functools
import math
import re
import zlib
from array import array
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import id_text

#: At most so many labelled texts of each class, chosen by hash and taken whole, are what the model is
#: fitted on.
SAMPLE_TOXIC, SAMPLE_CLEAN = 2_000, 4_000
#: Rows and width of the embedding matrix, lengths of n-grams.
ROWS, WIDTH, GRAMS = 1 << 17, 3, (3, 4, 5)
#: Passes over the sample, step sizes of embeddings and softmax, pull of the embeddings towards zero.
PASSES, ROW_STEP, SOFT_STEP, DECAY = 45, 0.06, 0.2, 3e-5
#: A subword keeps a vector if so many texts have it; one text in CALIBRATE sets the threshold only.
LEAST_TEXTS, CALIBRATE = 3, 5
#: Values that the fit holds at once besides its arrays.
CHUNK = 1 << 17
#: Words whose sums a worker remembers.
MEMO_WORDS = 150_000

_WORD = re.compile(r"[^\W_]+")


def subwords(word: str) -> list[int]:
    """Rows of a word: its n-grams with marked ends, and the word itself."""
    data = f"<{word}>"
    parts = [data[i : i + n] for n in GRAMS for i in range(len(data) - n + 1)]
    return [zlib.crc32(p.encode()) % ROWS for p in (*parts, data)]


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


@dataclass(frozen=True)
class Model:
    """Per row of the embeddings the difference of the two classes' logits, and its calibration."""

    logit: np.ndarray
    slope: float
    offset: float

    def probability(self, mean: np.ndarray | float):
        return 1 / (1 + np.exp(-np.clip(self.slope * mean + self.offset, -40, 40)))


def _row_sums(values: np.ndarray, at: np.ndarray, to: np.ndarray, size: int, weight: np.ndarray | None = None) -> np.ndarray:
    """Sums rows `at` of the values into rows `to`, one after the other, a chunk at a time."""
    out = np.zeros((values.shape[1], size))
    for begin in range(0, len(at), CHUNK):
        part = slice(begin, begin + CHUNK)
        taken, into = values.take(at[part], 0), to[part].astype(np.intp)
        if weight is not None:
            taken *= weight[part, None]
        for k in range(len(out)):
            np.add.at(out[k], into, np.ascontiguousarray(taken[:, k]))
    return np.ascontiguousarray(out.T)


def fit(texts: list[str], toxic: list[int], share: float, seed: int = 7) -> Model:
    """share: of toxic texts among all labelled ones, which the sample need not have."""
    y = np.array(toxic, float)
    if not len(y) or y.min() == y.max():
        return Model(np.zeros(ROWS, np.float32), 1.0, _logit(share))
    vocabulary: dict[str, int] = {}
    each = []
    for text in texts:
        own = np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words(text)], np.int32)
        which, times = np.unique(own, return_counts=True)
        each.append((which, times.astype(np.int32)))
    flat, ends = array("i"), array("i", [0])
    for w in vocabulary:
        flat.extend(subwords(w))
        ends.append(len(flat))
    del vocabulary
    gram_of, ends = np.array(flat, np.int32), ends.tolist()
    n_grams = np.diff(np.array(ends, np.int64))
    word_of = np.repeat(np.arange(len(n_grams), dtype=np.int32), n_grams)
    del flat
    # Subwords of one or two texts tell texts apart, not classes; common ones tell little.
    texts_with = np.zeros(ROWS, np.int64)
    for which, _ in each:
        if len(which):
            texts_with[np.unique(np.concatenate([gram_of[ends[w] : ends[w + 1]] for w in which.tolist()]))] += 1
    n = len(texts)
    kept = texts_with >= LEAST_TEXTS
    scale = np.where(kept, np.log(n / np.maximum(texts_with, 1)) + 1e-3, 0.0)
    del ends
    word = np.concatenate([w for w, _ in each])
    times = np.log1p(np.concatenate([t for _, t in each]))
    doc = np.repeat(np.arange(n, dtype=np.int32), [len(w) for w, _ in each])
    del each
    total = _row_sums(n_grams[:, None].astype(float), word, doc, n, times)[:, 0]
    part = times  # of a word's sum in its document's average
    for begin in range(0, len(part), CHUNK):
        part[begin : begin + CHUNK] /= np.maximum(total, 1)[doc[begin : begin + CHUNK]]

    rng = np.random.default_rng(seed)
    rows = rng.uniform(-0.1 / WIDTH, 0.1 / WIDTH, (ROWS, WIDTH))
    soft = rng.normal(0, 1, (WIDTH, 2))
    bias = np.zeros(2)
    checks = np.arange(n) % CALIBRATE == 0
    if y[checks].min() == y[checks].max() or y[~checks].min() == y[~checks].max():
        checks = np.ones(n, bool)  # too few texts to spare any
    learns = np.where(checks & ~checks.all(), 0.0, 1.0)
    weight = learns * np.where(y == 1, 0.5 / (learns @ y), 0.5 / (learns @ (1 - y)))
    target = np.stack([1 - y, y], 1)
    state = [(np.zeros_like(p), np.zeros_like(p)) for p in (rows, soft, bias)]
    judged = checks * np.where(y == 1, 0.5 / y[checks].sum(), 0.5 / (1 - y[checks]).sum())
    best, logit, mean_of = math.inf, np.zeros(ROWS), np.zeros(n)
    for step in range(1, PASSES + 1):
        mean = _row_sums(_row_sums(rows * scale[:, None], gram_of, word_of, len(n_grams)), word, doc, n, part)
        logits = mean @ soft + bias
        chance = np.exp(logits - logits.max(1, keepdims=True))
        chance /= chance.sum(1, keepdims=True)
        # The pass that does best on the texts that don't teach is the one that counts.
        loss = -float(judged @ np.log(np.maximum((chance * target).sum(1), 1e-12)))
        if loss < best:
            best, logit = loss, (rows * scale[:, None]) @ (soft[:, 1] - soft[:, 0])
            mean_of = mean @ (soft[:, 1] - soft[:, 0])
        error = (chance - target) * weight[:, None]
        down = _row_sums(error @ soft.T, doc, word, len(n_grams), part)
        slopes = (
            _row_sums(down, word_of, gram_of, ROWS) * scale[:, None] + DECAY * rows,
            mean.T @ error + 1e-4 * soft, error.sum(0),
        )
        for value, slope, (first, second) in zip((rows, soft, bias), slopes, state):
            first += 0.1 * (slope - first)
            second += 0.01 * (slope**2 - second)
            # One step size for all embeddings, so that rare subwords don't run ahead.
            size = (second.mean() if value is rows else second) / (1 - 0.99**step)
            rate = ROW_STEP if value is rows else SOFT_STEP
            value -= rate * first / (1 - 0.9**step) / (np.sqrt(size) + 1e-12)
    return Model(logit.astype(np.float32), *_calibrated(mean_of[checks], y[checks], share))


def _logit(p: float) -> float:
    return math.log(max(p, 1e-6) / max(1 - p, 1e-6))


def _calibrated(mean: np.ndarray, y: np.ndarray, share: float) -> tuple[float, float]:
    """Slope and offset of a logistic curve over the averages, at the true share of toxic texts."""
    weight = np.where(y == 1, share / y.sum(), (1 - share) / (len(y) - y.sum()))
    scale = max(float(mean.std()), 1e-9)
    x = np.stack([mean / scale, np.ones_like(mean)], 1)
    theta = np.array([1.0, _logit(share)])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        slope = x.T @ (weight * (p - y)) + 1e-4 * theta
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(2)
        theta = theta - np.clip(np.linalg.solve(curve, slope), -2, 2)
    return float(theta[0] / scale), float(theta[1])


def held_out(doc_id: Column) -> Column:
    """Documents whose labels are never read."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fits on the labelled documents that are not held out; labels: (doc_id, toxic).

    The ids of the sample are chosen first, so only their texts are joined. Null labels and ids are left
    out; a document labelled twice counts as toxic if one label says so.
    """
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    n, n_toxic = known.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    by_hash = [F.xxhash64("doc_id"), F.col("doc_id")]
    sample = known.filter("toxic = 1").orderBy(*by_hash).limit(SAMPLE_TOXIC).union(
        known.filter("toxic = 0").orderBy(*by_hash).limit(SAMPLE_CLEAN)
    )
    texts = id_text(docs).select("doc_id", "text")
    rows = texts.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "text").agg(F.max("toxic").alias("toxic"))
    found = [(r.text, int(r.toxic)) for r in rows.collect()]  # bounded by the sample
    found.sort(key=lambda r: zlib.crc32(r[0].encode()))
    return fit([r[0] for r in found], [r[1] for r in found], n_toxic / n if n else 0.0)


class _Sums(dict):
    """word -> (sum of its subwords' logits, their number)."""

    def __init__(self, logit: np.ndarray):
        super().__init__()
        self._logit = logit

    def __missing__(self, word: str) -> complex:
        rows = subwords(word)
        # Two sums in one number: the logits' and, as its imaginary part, the subwords'.
        found = complex(sum(self._logit[rows].tolist()), len(rows))
        if len(self) >= MEMO_WORDS:
            self.clear()
        if len(word) < 60:
            self[word] = found
        return found


def average(sums, text: str) -> float:
    """Weighted mean logit of a text's subwords; 0 without words."""
    total = sum((math.log1p(n) * sums(w) for w, n in Counter(words(text)).items()), 0j)
    return total.real / total.imag if total.imag else 0.0


@functools.lru_cache(maxsize=1)
def _sums_of(key: int, shipped) -> _Sums:
    return _Sums(shipped.value.logit)


def score_column(model: Model, docs: DataFrame):
    """A function of a text column: probability that the text is toxic."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts):
        sums = _sums_of(id(shipped), shipped).__getitem__
        mean = np.array([average(sums, t or "") for t in texts])
        return type(texts)(shipped.value.probability(mean))

    return score


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per input row, over whole texts.

    Null texts are empty; a text without words gets the score of an average of nothing. Null
    ids are never held out.
    """
    own = id_text(docs)
    scored = own.withColumn("score", score_column(model, docs)(F.col("text")))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
