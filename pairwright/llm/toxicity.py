"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A word is the bag of its hashed character n-grams and of itself; a window of
words is the average of all their embeddings; a linear softmax over the average
tells toxic from clean.  Embeddings and softmax are trained jointly in numpy by
gradient steps.  A document is as toxic as its most toxic window, in training as
in scoring, so one word in a long text is not averaged away.  A misspelled word
shares most n-grams with the right one, and with them their vectors.

The fit uses a bounded sample of labelled rows (``PER_CLASS`` of each label, at most
``MOST_WINDOWS`` windows of each) and runs in one task, which sends back the weights.
Scoring reads every text whole.  A fitted model is one number per bucket, as
the softmax of an average is linear in the embeddings.

Defined cases: a null or empty text scores as a window without any word, by the
bias alone; without labelled rows of both kinds every score is the share of
toxic rows among those seen, or 0.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairwright.llm.frames import held_out
from pairwright.llm.subwords import EDGES, ngrams
from pairwright.llm.training import fitted, sample
from pairwright.llm.words import SLICE_BYTES, Words, filled, sizes_in_bytes, white_space_words

PER_CLASS = 1000
WINDOW = 40
# Windows of one text in the fit: of a longer text so many, evenly spread over all of it.
MOST_WINDOWS = 500
# A window counts as having so many more n-grams of no weight: few words alone are weak evidence.
EMPTY_NGRAMS = 60
BUCKETS = 1 << 18
LENGTHS = range(3, 6)
DIMENSIONS = 4
STEPS = 60
# Pull of the embeddings towards 0 in each step.
DECAY = 1e-6


@dataclass(frozen=True)
class Model:
    """Logit of a bucket, of which a window's average is taken, and the bias."""

    weights: np.ndarray
    bias: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        """The toxic share of the softmax for each text's most toxic window."""
        out = np.empty(len(texts))
        part = np.cumsum(sizes_in_bytes(texts)) // SLICE_BYTES
        cuts = np.flatnonzero(np.diff(part, prepend=-1, append=-1))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            out[a:b] = self._scores(filled(texts.slice(a, b - a)))
        return out

    def _scores(self, texts: pa.Array) -> np.ndarray:
        words = text_words(texts)
        buckets, owner = subword_buckets(words.distinct)
        size = len(words.distinct)
        value = np.bincount(owner, weights=self.weights[buckets], minlength=size)
        count = np.bincount(owner, minlength=size)
        starts, first = windows(words.bounds)
        best = np.full(len(texts), self.bias)
        if len(starts):
            mean = np.add.reduceat(value[words.codes], starts) / (np.add.reduceat(count[words.codes], starts) + EMPTY_NGRAMS)
            some = np.diff(words.bounds) > 0
            best[some] = np.maximum.reduceat(mean, first[some]) + self.bias
        return 1 / (1 + np.exp(-np.clip(best, -500, 500)))


def text_words(texts: pa.Array) -> Words:
    """Lower-case words, each run of one word as one; marks at a word's edges are taken off when its n-grams are made."""
    return white_space_words(pc.utf8_lower(texts)).without_runs()


def subword_buckets(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words' n-grams, and each one's word."""
    hashes, owner = ngrams(pc.utf8_trim(words, EDGES), LENGTHS)
    return (hashes % np.uint64(BUCKETS)).astype(np.int64), owner


def windows(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each window of at most ``WINDOW`` words starts, and each text's first window."""
    per_text = -(-np.diff(bounds) // WINDOW)
    first = np.cumsum(per_text) - per_text
    nth = np.arange(int(per_text.sum())) - np.repeat(first, per_text)
    return np.repeat(bounds[:-1], per_text) + nth * WINDOW, first


def _each(sums: Callable[[np.ndarray], np.ndarray], rows: np.ndarray) -> np.ndarray:
    """``sums`` of one dimension after the other, so that only one is spread out at a time."""
    return np.stack([sums(rows[:, d]) for d in range(rows.shape[1])], axis=1)


def fit(texts: pa.Array, toxic: np.ndarray, seed: int = 7) -> Model:
    """Embeddings and softmax trained jointly by Adagrad on each text's most toxic window."""
    if not len(texts) or toxic.min() == toxic.max():
        share = min(max(float(toxic.mean()) if len(texts) else 0.0, 1e-9), 1 - 1e-9)
        return Model(np.zeros(BUCKETS), float(np.log(share / (1 - share))))
    words = text_words(filled(texts))
    buckets, owner = subword_buckets(words.distinct)
    order = np.argsort(owner, kind="stable")
    buckets, owner = buckets[order], owner[order]
    used, local = np.unique(buckets, return_inverse=True)
    word_start = np.searchsorted(owner, np.arange(len(words.distinct)))
    subwords = np.bincount(owner, minlength=len(words.distinct))
    starts, first = windows(words.bounds)
    some = np.flatnonzero(np.diff(words.bounds) > 0)
    label = toxic[some].astype(np.float64)
    ends = np.append(starts[1:], len(words.codes))
    counts = np.add.reduceat(subwords[words.codes], starts) + EMPTY_NGRAMS
    text_window_first, text_window_last = first[some], np.append(first[some][1:], len(starts))
    per_text = text_window_last - text_window_first
    text_of_window = np.repeat(np.arange(len(some)), per_text)

    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 0.1, (len(used), DIMENSIONS))
    softmax = rng.normal(0, 0.5, (DIMENSIONS, 2))
    bias = np.zeros(2)
    memory = [np.full(p.shape, 1e-8) for p in (vectors, softmax, bias)]
    weight = np.where(label == 1, 0.5 / max(label.sum(), 1), 0.5 / max((1 - label).sum(), 1))
    for step in range(STEPS):
        by_word = _each(lambda v: np.add.reduceat(v[local], word_start), vectors)
        mean = _each(lambda v: np.add.reduceat(v[words.codes], starts), by_word) / counts[:, None]
        logits = mean @ softmax + bias
        z = logits[:, 1] - logits[:, 0]
        # of a toxic text first all windows count alike, then more and more the most toxic one;
        # of a clean text all windows count, and the most toxic one as much as all
        top = np.array([a + int(np.argmax(z[a:b])) for a, b in zip(text_window_first, text_window_last, strict=True)])
        lean = np.where(label == 1, step / STEPS, 0.5)
        share = ((1 - lean) * weight / per_text)[text_of_window]
        share[top] += lean * weight
        slope = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - label[text_of_window]) * share
        both = np.stack([-slope, slope], axis=1)
        grad_mean = both @ softmax.T / counts[:, None]
        size = len(words.distinct)
        spread = lambda v: np.bincount(words.codes, weights=np.repeat(v, ends - starts), minlength=size)
        grad_word = _each(spread, grad_mean)
        grad_vectors = _each(lambda v: np.bincount(local, weights=v[owner], minlength=len(used)), grad_word)
        grads = (
            grad_vectors + DECAY * vectors,
            mean.T @ both,
            both.sum(axis=0),
        )
        rate = 1.0 * (1 - step / STEPS)
        for param, seen, grad in zip((vectors, softmax, bias), memory, grads, strict=True):
            seen += grad * grad
            param -= rate * grad / np.sqrt(seen)
    weights = np.zeros(BUCKETS)
    weights[used] = vectors @ (softmax[:, 1] - softmax[:, 0])
    return Model(weights, float(bias[1] - bias[0]))


@F.arrow_udf(T.StringType())
def thinned(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Texts for the fit: of a very long one, windows from all over it."""
    for texts in batches:
        yield pa.array([_thin(t) for t in texts.to_pylist()], pa.string())


def _thin(text: str) -> str:
    words = text.split(maxsplit=-1)
    windows_ = -(-len(words) // WINDOW)
    if windows_ <= MOST_WINDOWS:
        return text
    at = np.linspace(0, windows_ - 1, MOST_WINDOWS).astype(np.int64).tolist()
    return " ".join(" ".join(words[k * WINDOW : (k + 1) * WINDOW]) for k in at)


def fit_on(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """A model of ``labels.toxic`` on a bounded sample of labelled rows that are not held out."""

    def fit_rows(rows: pa.Table) -> dict:
        model = fit(rows.column("value").combine_chunks(), (rows.column("label").to_numpy() == 1).astype(np.int64))
        return {"weights": model.weights.tobytes(), "bias": model.bias}

    rows = sample(docs, labels, F.col("toxic").cast("int"), per_class, thinned)
    found = fitted(rows, fit_rows, "weights binary, bias double")
    if found is None:
        return fit(pa.array([], pa.string()), np.empty(0, np.int64))
    return Model(np.frombuffer(bytes(found["weights"])), found["bias"])


def score_column(model: Model, text: Column) -> Column:
    """The score of a text column, Arrow batch by Arrow batch."""

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(model.scores(filled(texts)))

    return score(text)


def toxicity(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, threshold: float = 0.5) -> DataFrame:
    """Every document with its score and whether it is taken for toxic."""
    model = fit_on(docs, labels, per_class)
    scored = docs.select("doc_id", held_out().alias("held_out"), score_column(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
