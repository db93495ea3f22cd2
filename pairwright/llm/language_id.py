"""Language ID: n-grams looked up in bit-sliced Bloom filters of all languages at once.

Each position of the filter holds one bit per language, in as many words of 64
bits as the languages need.  The bit-wise and of a
few positions gives all languages that may hold an n-gram.  A document's hits
per language are counted over the n-grams of its words; a filter that is filled
to a share ``f`` answers ``f ** hashes`` of foreign n-grams by chance, and the
counts are corrected for that.  The language with the largest corrected count
wins; its share of all corrected counts is the score.

The filters are filled from a bounded sample of texts of each language
(``PER_LANGUAGE``) with the n-grams at home there.  Every language of a row that
is not held out is learned, however many there are.
Defined cases: ``und`` with score 0 for a null text or one without a letter, and
for every text if nothing could be learned; of equal counts the language first
in the alphabet wins; a text without any known n-gram gets it with score 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairwright.llm.frames import held_out
from pairwright.llm.subwords import EDGES, mixed, ngrams
from pairwright.llm.training import sample_of_every_label
from pairwright.llm.words import SLICE_BYTES, Words, filled, sizes_in_bytes, white_space_words

PER_LANGUAGE = 400
WORD_BITS = 64
POSITIONS = 1 << 21
HASHES = 2
HOME = 0.2
LENGTHS = range(3, 5)
UNKNOWN = "und"


def text_words(texts: pa.Array) -> Words:
    return white_space_words(pc.utf8_lower(texts))


def word_ngrams(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return ngrams(pc.utf8_trim(words, EDGES), LENGTHS)


def _positions(hashes: np.ndarray) -> list[np.ndarray]:
    return [
        (mixed(hashes + np.uint64((0x9E3779B97F4A7C15 * (k + 1)) % 2**64)) % np.uint64(POSITIONS)).astype(np.int64)
        for k in range(HASHES)
    ]


def _bit(words: np.ndarray, k: int) -> np.ndarray:
    """Whether the words that hold language ``k`` have its bit."""
    return (words >> np.uint64(k % WORD_BITS) & np.uint64(1)).astype(bool)


@dataclass(frozen=True)
class Model:
    """Languages and the filter: at each position a mask of languages, one bit each, in words of 64 bits."""

    languages: list[str]
    masks: np.ndarray

    @cached_property
    def false_positives(self) -> np.ndarray:
        """Chance that a language's filter holds an n-gram that was never put in."""
        fill = [np.count_nonzero(_bit(self.masks[:, k // WORD_BITS], k)) / POSITIONS for k in range(len(self.languages))]
        return np.array(fill) ** HASHES

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        """Language and score of each text."""
        names: list[str] = []
        scores = np.zeros(len(texts))
        chance = self.false_positives
        part = np.cumsum(sizes_in_bytes(texts)) // SLICE_BYTES
        cuts = np.flatnonzero(np.diff(part, prepend=-1, append=-1))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            names_, scores[a:b] = self._predict(filled(texts.slice(a, b - a)), chance)
            names += names_
        return names, scores

    def _predict(self, texts: pa.Array, chance: np.ndarray) -> tuple[list[str], np.ndarray]:
        words = text_words(texts)
        count, size = len(self.languages), len(words.distinct)
        hashes, owner = word_ngrams(words.distinct)
        positions = _positions(hashes)
        asked = np.bincount(owner, minlength=size)
        letter = pc.match_substring_regex(words.distinct, r"\pL").to_numpy(zero_copy_only=False)
        sums = lambda x: np.diff(np.concatenate([[0], np.cumsum(x[words.codes])])[words.bounds])
        n = sums(asked)
        corrected = np.zeros((len(texts), max(count, 1)))
        for k in range(count):
            if k % WORD_BITS == 0:
                found = np.bitwise_and.reduce([self.masks[at, k // WORD_BITS] for at in positions])
            hits = np.bincount(owner[_bit(found, k)], minlength=size)
            corrected[:, k] = np.maximum((sums(hits) - n * chance[k]) / (1 - min(chance[k], 0.999)), 0)
        best = corrected.argmax(axis=1)
        total = corrected.sum(axis=1)
        known = (sums(letter.astype(np.int64)) > 0) & (count > 0)
        score = np.where(known & (total > 0), corrected.max(axis=1) / np.maximum(total, 1e-12), 0.0)
        return [self.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)], np.clip(score, 0, 1)


@F.arrow_udf(T.ArrayType(T.LongType()))
def gram_sets(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The distinct n-grams of each text."""
    for texts in batches:
        sets = [np.unique(word_ngrams(text_words(filled(texts.slice(k, 1))).distinct)[0]) for k in range(len(texts))]
        bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
        flat = np.concatenate([np.empty(0, dtype=np.uint64), *sets]).view(np.int64)
        yield pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat))


def fit(rates: dict[str, tuple[np.ndarray, np.ndarray]]) -> Model:
    """Filters that hold, for each language, the n-grams that are at home in it.

    ``rates`` has the n-grams of each language that at least two of its texts hold,
    and the share of its texts that hold each.  An n-gram is at home where its rate
    is at least a share ``HOME`` of its rate in any one language.
    """
    names = sorted(rates)
    masks = np.zeros((POSITIONS, max(1, -(-len(names) // WORD_BITS))), dtype=np.uint64)
    grams = [rates[n][0] for n in names]
    known, where = np.unique(np.concatenate([*grams, np.empty(0, dtype=np.uint64)]), return_inverse=True)
    rate = np.concatenate([*(rates[n][1] for n in names), np.empty(0)])
    highest = np.zeros(len(known))
    np.maximum.at(highest, where, rate)
    at_home = rate >= HOME * highest[where]
    bounds = np.cumsum([0, *map(len, grams)])
    for k in range(len(names)):
        for at in _positions(grams[k][at_home[bounds[k] : bounds[k + 1]]]):
            masks[at, k // WORD_BITS] |= np.uint64(1) << np.uint64(k % WORD_BITS)
    return Model(names, masks)


def fit_on(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """Filters learned from a bounded sample of documents that are not held out.

    The sampled texts' n-grams are counted by Spark; the driver gets each language's once.
    """
    sampled = sample_of_every_label(docs, F.col("lang"), per_language, gram_sets)
    texts = sampled.groupBy("label").agg(F.count(F.lit(1)).alias("texts"))
    held = sampled.select("label", F.explode("value").alias("gram")).groupBy("label", "gram").agg(F.count(F.lit(1)).alias("times"))
    often = held.join(F.broadcast(texts), "label").where(F.col("times") >= F.least(F.lit(2), F.col("texts")))
    rows = often.select("label", "gram", (F.col("times") / F.col("texts")).alias("rate")).toArrow()
    rates = {name: (np.empty(0, dtype=np.uint64), np.empty(0)) for (name,) in texts.select("label").collect()}
    labels = rows.column("label").combine_chunks().dictionary_encode()
    codes = labels.indices.to_numpy(zero_copy_only=False)
    grams, shares = rows.column("gram").to_numpy().view(np.uint64), rows.column("rate").to_numpy()
    order = np.lexsort((grams, codes))
    for code, name in enumerate(labels.dictionary.to_pylist()):
        own = order[np.searchsorted(codes[order], code) : np.searchsorted(codes[order], code, side="right")]
        rates[name] = (grams[own], shares[own])
    return fit(rates)


def language_columns(model: Model, text: Column) -> Column:
    """A struct of language and score of a text column, Arrow batch by Arrow batch."""
    @F.arrow_udf("struct<lang_pred string, score double>")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            names, scores = model.predict(filled(texts))
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores)], ["lang_pred", "score"])

    return predict(text)


def language_id(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """Every document with its predicted language."""
    model = fit_on(docs, per_language)
    found = docs.select("doc_id", held_out().alias("held_out"), language_columns(model, F.col("text")).alias("found"))
    return found.select("doc_id", "held_out", "found.lang_pred", "found.score")
