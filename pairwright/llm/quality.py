"""Quality classifier: Bradley-Terry scores of documents, thresholded by score quantile.

A document is a vector of measures of its whole text: shares of characters by
kind, word lengths, how many distinct words there are, how often a word follows
itself, how much of the text its most frequent words and lines make up.  Every
labelled bad document is paired with good ones; the logistic loss on the
differences of their vectors gives the weights (Bradley-Terry: the odds that one
document is preferred are the ratio of the exponentials of their scores).

The share of bad documents among all labelled rows is the quantile of those
rows' scores that parts good from bad.  The reported score is a logistic
function of the distance to it, at ``threshold`` exactly there.

The weights come from a bounded sample of labelled rows (``PER_CLASS`` of each
label), of which the driver gets the measures; counts of labels and the quantile
cover all labelled rows that are not held out, however long.  Defined cases: a null or empty text has all measures 0 and
scores like any other; without labelled rows of both kinds every score is 1,
or 0 if only bad rows were seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairwright.llm.frames import held_out, landed, text_of
from pairwright.llm.training import sample
from pairwright.llm.words import SLICE_BYTES, Words, filled, sizes_in_bytes, white_space_words

PER_CLASS = 2000
RIVALS = 8
# Strengths are counted in steps of one STEPS-th up to FAR either way.
STEPS = 1000
FAR = 1000
# Fixed marks whose share of a text is measured one by one.
MARKS = "!*#$%&|<>=_@/"


def _shares(flags: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Share of flagged bytes in each text."""
    out = np.zeros(len(starts))
    some = sizes > 0
    if some.any():
        out[some] = np.add.reduceat(flags, starts[some], dtype=np.int64) / sizes[some]
    return out


def _most_frequent(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Share of distinct words, and share of the most frequent one, of each text."""
    counts = np.diff(words.bounds)
    owner = np.repeat(np.arange(len(counts)), counts)
    pair, times = np.unique(owner * np.int64(len(words.distinct) + 1) + words.codes, return_counts=True)
    of = pair // np.int64(len(words.distinct) + 1)
    distinct = np.bincount(of, minlength=len(counts))
    most = np.zeros(len(counts), dtype=np.int64)
    np.maximum.at(most, of, times)
    return distinct / np.maximum(counts, 1), most / np.maximum(counts, 1)


def measures(texts: pa.Array) -> np.ndarray:
    """One row of measures per text."""
    out = []
    part = np.cumsum(sizes_in_bytes(texts)) // SLICE_BYTES
    cuts = np.flatnonzero(np.diff(part, prepend=-1, append=-1))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        out.append(_measures(filled(texts.slice(a, b - a))))
    return np.concatenate(out) if out else np.empty((0, len(NAMES)))


NAMES = [
    "log_words",
    "log_lines",
    "word_length",
    "words_per_line",
    "distinct_words",
    "top_word",
    "distinct_lines",
    "follows_itself",
    "upper",
    "digits",
    "marks",
    "other_ascii",
    "beyond_ascii",
    "marked_ends",
    *(f"mark_{ord(m)}" for m in MARKS),
]


def _measures(texts: pa.Array) -> np.ndarray:
    sizes = sizes_in_bytes(texts)
    starts = np.cumsum(sizes) - sizes
    raw = np.frombuffer(b"".join(texts.cast(pa.binary()).to_pylist()), dtype=np.uint8)
    words, lines = white_space_words(texts), Words(pc.split_pattern(texts, "\n")).without_empty()
    n_words, n_lines = np.diff(words.bounds), np.diff(lines.bounds)
    letters = sizes_in_bytes(words.distinct)
    running = np.concatenate([[0], np.cumsum(letters[words.codes])])
    length = np.diff(running[words.bounds]) / np.maximum(n_words, 1)
    distinct_words, top_word = _most_frequent(words)
    distinct_lines, _ = _most_frequent(lines)
    same = np.diff(words.codes, prepend=-1) == 0
    inner = words.bounds[:-1]
    same[inner[inner < len(same)]] = False
    follows = np.diff(np.concatenate([[0], np.cumsum(same)])[words.bounds]) / np.maximum(n_words, 1)
    ends = pc.match_substring_regex(words.distinct, r"[!*#$%&|]$").to_numpy(zero_copy_only=False)
    marked = np.diff(np.concatenate([[0], np.cumsum(ends[words.codes])])[words.bounds]) / np.maximum(n_words, 1)
    kind = np.zeros(256, dtype=np.uint8)
    kind[ord("A") : ord("Z") + 1] = 1
    kind[ord("0") : ord("9") + 1] = 2
    kind[[b for b in range(0x21, 0x7F) if not chr(b).isalnum()]] = 3
    kind[128:] = 4
    kinds = kind[raw]
    by_kind = [_shares(kinds == k, starts, sizes) for k in (1, 2, 3, 4)]
    by_mark = [_shares(raw == ord(m), starts, sizes) for m in MARKS]
    other = by_kind[2] - sum(by_mark)
    return np.stack(
        [
            np.log1p(n_words),
            np.log1p(n_lines),
            length,
            np.log1p(n_words / np.maximum(n_lines, 1)),
            distinct_words,
            top_word,
            distinct_lines,
            follows,
            by_kind[0],
            by_kind[1],
            by_kind[2],
            other,
            by_kind[3],
            marked,
            *by_mark,
        ],
        axis=1,
    )


@dataclass(frozen=True)
class Model:
    """Weights of the scaled measures, and the score at the quantile that parts good from bad."""

    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    parting: float
    threshold: float

    def strengths(self, rows: np.ndarray) -> np.ndarray:
        """Bradley-Terry scores."""
        return np.clip((rows - self.centre) / self.scale, -8, 8) @ self.weights

    def scores(self, texts: pa.Array) -> np.ndarray:
        odds = np.log(self.threshold / (1 - self.threshold))
        z = self.strengths(measures(texts)) - self.parting + odds
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fit(rows: np.ndarray, good: np.ndarray, threshold: float, ridge: float = 1.0, seed: int = 7) -> Model:
    """Weights by Newton steps on the logistic loss of good-minus-bad differences of measures; parted at 0."""
    width = len(NAMES)
    good_rows, bad_rows = np.flatnonzero(good == 1), np.flatnonzero(good == 0)
    if not len(good_rows) or not len(bad_rows):
        far = 1e6 if not len(good_rows) and len(bad_rows) else -1e6
        return Model(np.zeros(width), np.ones(width), np.zeros(width), far, threshold)
    centre, scale = rows.mean(axis=0), rows.std(axis=0) + 1e-6
    z = np.clip((rows - centre) / scale, -8, 8)
    rng = np.random.default_rng(seed)
    rivals = rng.choice(good_rows, (len(bad_rows), RIVALS))
    diff = (z[rivals] - z[bad_rows][:, None, :]).reshape(-1, width)
    weights = np.zeros(width)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(diff @ weights, -50, 50)))
        grad = diff.T @ (p - 1) + ridge * weights
        bend = (diff * (p * (1 - p))[:, None]).T @ diff + ridge * np.eye(width)
        step = np.linalg.solve(bend, grad)
        weights -= step
        if np.abs(step).max() < 1e-6:
            break
    return Model(centre, scale, weights, 0.0, threshold)


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def measured(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The measures of a text column."""
    for texts in batches:
        rows = measures(filled(texts))
        bounds = np.arange(len(rows) + 1, dtype=np.int32) * len(NAMES)
        yield pa.ListArray.from_arrays(pa.array(bounds), pa.array(rows.ravel()))


def strength_column(model: Model, text: Column) -> Column:
    """The Bradley-Terry score of a text column."""

    @F.arrow_udf("double")
    def strength(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(model.strengths(measures(filled(texts))))

    return strength(text)


def quantile(strengths: DataFrame, labels: DataFrame) -> float:
    """The strength that as large a share of the labelled rows lies below as are bad, to half a step.

    ``strengths`` are ``doc_id, strength`` of all documents.  Labelled rows that are
    not held out are counted in steps, so what reaches the driver does not grow
    with the rows.
    """
    label = F.col("quality").cast("int")
    seen = labels.where(F.col("doc_id").isNotNull() & label.isin(0, 1) & ~held_out())
    rows = strengths.select("doc_id", "strength").join(seen.select("doc_id", (1 - label).alias("bad")), "doc_id")
    step = F.floor(F.least(F.greatest("strength", F.lit(-FAR)), F.lit(FAR)) * F.lit(STEPS)).cast("int")
    counted = rows.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n"), F.sum("bad").alias("bad"))
    found = counted.orderBy("step").toPandas()
    if not len(found):
        return 0.0
    below = int(np.searchsorted(np.cumsum(found["n"]), found["bad"].sum()))
    here, after = found["step"].iloc[below], found["step"].iloc[min(below + 1, len(found) - 1)]
    return float((here + after + 1) / 2 / STEPS)


def fit_weights(docs: DataFrame, labels: DataFrame, threshold: float, per_class: int = PER_CLASS) -> Model:
    """Weights from a bounded sample of labelled rows that are not held out; parted at 0."""
    rows = sample(docs, labels, F.col("quality").cast("int"), per_class, measured).toArrow()
    values = rows.column("value").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, len(NAMES))
    return fit(values, (rows.column("label").to_numpy() == 1).astype(np.int64), threshold)


def fit_on(docs: DataFrame, labels: DataFrame, threshold: float, per_class: int = PER_CLASS) -> Model:
    """A model of ``labels.quality`` on labelled rows that are not held out."""
    model = fit_weights(docs, labels, threshold, per_class)
    if not model.weights.any():
        return model
    strengths = docs.select("doc_id", strength_column(model, text_of()).alias("strength"))
    return replace(model, parting=quantile(strengths, labels))


def score_column(model: Model, text: Column) -> Column:
    """The score of a text column, Arrow batch by Arrow batch."""

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(model.scores(filled(texts)))

    return score(text)


def quality(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, threshold: float = 0.3) -> DataFrame:
    """Every document with its score and whether it is taken for good; texts are measured once."""
    model = fit_weights(docs, labels, threshold, per_class)
    strengths = docs.select("doc_id", held_out().alias("held_out"), strength_column(model, text_of()).alias("strength"))
    strengths = landed(strengths, "strengths")
    parting = quantile(strengths, labels) if model.weights.any() else model.parting
    z = F.col("strength") - F.lit(parting) + F.lit(float(np.log(threshold / (1 - threshold))))
    score = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.least(F.greatest(z, F.lit(-500.0)), F.lit(500.0))))
    scored = strengths.select("doc_id", "held_out", score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
