"""Scoring pairs of values and filtering by score."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairwright.functions import similarity, text
from pairwright.operators.segments import core_name
from pairwright.operators.token_sets import TokenMetric


@dataclass(frozen=True)
class StringMetric:
    """How a named metric is computed and how it may be pruned."""

    compare: Callable[[Column, Column], Column]
    prepare: Callable[[Column], Column] | None = None  # per value, before comparing
    arrow: bool = False  # runs in Python workers, after all else
    bound: Callable[[Column, Column], Column] | None = None  # cheap upper bound
    letter_bound: Callable[[Column, Column, Column], Column] | None = None  # a closer one, from the common letters
    same: Callable[[Column], Column] | None = None  # score of a value with itself
    strict: bool = True  # null on a null side
    tokens: TokenMetric | None = None  # what pairs over a minimum must share
    cored: Callable[[Column, Column, Column, Column], Column] | None = None  # the same of both values and their cores


METRICS: dict[str, StringMetric] = {
    "fuzzy": StringMetric(
        text.edit_score, bound=text.edit_score_bound, same=text.edit_score_same, cored=text.edit_score_of_cores
    ),
    "soundex": StringMetric(text.edit_score, prepare=text.soundex, same=text.edit_score_same),
    "levenshtein": StringMetric(similarity.levenshtein_distance),
    "hamming": StringMetric(similarity.hamming_distance),
    "jaccard_similarity": StringMetric(similarity.jaccard_similarity, tokens=TokenMetric(similarity.characters, False)),
    "jaccard_distance": StringMetric(similarity.jaccard_distance),
    "cosine_similarity": StringMetric(similarity.cosine_similarity, tokens=TokenMetric(similarity.words, True)),
    "word_jaccard_similarity": StringMetric(similarity.word_jaccard_similarity, tokens=TokenMetric(similarity.words, False)),
    "cosine_distance": StringMetric(similarity.cosine_distance),
    "jaro_winkler_similarity": StringMetric(
        similarity.jaro_winkler_similarity, arrow=True, letter_bound=similarity.jaro_winkler_bound
    ),
    "jaro_winkler_distance": StringMetric(similarity.jaro_winkler_distance, arrow=True),
    "lcs_length": StringMetric(similarity.lcs_length, arrow=True, letter_bound=lambda left, right, common: common),
    "lcs_distance": StringMetric(similarity.lcs_distance, arrow=True),
    "fuzzy_subsequence_score": StringMetric(similarity.fuzzy_subsequence_score),
    "ratio": StringMetric(
        similarity.ratio,
        arrow=True,
        bound=similarity.ratio_bound,
        letter_bound=similarity.ratio_letter_bound,
        strict=False,
    ),
    "partial_ratio": StringMetric(
        similarity.partial_ratio, arrow=True, letter_bound=similarity.partial_ratio_bound, strict=False
    ),
    "token_sort_ratio": StringMetric(
        similarity.ratio,
        prepare=similarity.sorted_token_text,
        arrow=True,
        bound=similarity.ratio_bound,
        letter_bound=similarity.ratio_letter_bound,
        strict=False,
    ),
}


@dataclass(frozen=True)
class Comparison:
    """Compare two columns with a metric and name the result."""

    left: str
    right: str
    metric: str
    alias: str

    @property
    def definition(self) -> StringMetric:
        return METRICS[self.metric]

    def operand(self, column: str, present: Sequence[str]) -> Column:
        """A side's value, prepared for the metric unless the frame holds it already."""
        ready = prepared_name(column, self.metric)
        if ready in present:
            return F.col(ready)
        prepare = self.definition.prepare
        return prepare(F.col(column)) if prepare else F.col(column)

    def score(self, present: Sequence[str] = ()) -> Column:
        if self.left == self.right and self.definition.same:
            return self.definition.same(self.operand(self.left, present))
        cores = [core_name(c) for c in (self.left, self.right)]
        if self.definition.cored and all(c in present for c in cores):
            return self.definition.cored(F.col(self.left), F.col(self.right), *map(F.col, cores))
        return self.definition.compare(
            self.operand(self.left, present), self.operand(self.right, present)
        )

    def bound(self, present: Sequence[str] = ()) -> Column | None:
        if self.definition.bound is None:
            return None
        return self.definition.bound(
            self.operand(self.left, present), self.operand(self.right, present)
        )


    def letter_bound(self, present: Sequence[str] = ()) -> Column | None:
        """The closer bound; letter signatures are taken from the frame where it holds them."""
        if self.definition.letter_bound is None:
            return None
        sides = [self.operand(c, present) for c in (self.left, self.right)]
        names = [letters_name(c, self.metric) for c in (self.left, self.right)]
        counts = [
            F.col(n) if n in present else similarity.letter_counts(side) for n, side in zip(names, sides, strict=True)
        ]
        return self.definition.letter_bound(*sides, similarity.common_letters(*counts))


def letters_name(column: str, metric: str) -> str:
    """The column that holds the letter signature of a value prepared for a metric."""
    return f"_letters_{metric}_{column}"


def prepared_name(column: str, metric: str) -> str:
    """The column that holds a value prepared for a metric ahead of pairing."""
    return f"_{metric}_{column}"


def possible_pairs(
    pairs: DataFrame, comparisons: Sequence[Comparison], minimums: Mapping[str, float]
) -> DataFrame:
    """The pairs that the bounds do not rule out, lengths first and common letters then."""
    present = pairs.columns
    limited = [c for c in comparisons if c.alias in minimums and c.alias not in present]
    for bounds in (Comparison.bound, Comparison.letter_bound):
        for c in limited:
            bound = bounds(c, present)
            if bound is not None:
                pairs = pairs.where(bound >= F.lit(minimums[c.alias]))
    return pairs


def score_pairs(
    pairs: DataFrame,
    comparisons: Sequence[Comparison],
    minimums: Mapping[str, float] | None = None,
) -> DataFrame:
    """Add one score column per comparison; optionally keep only high scores.

    With minimums, bounds drop hopeless pairs first, then the JVM-side
    scores filter, and only what is left reaches Python, where each batch scores
    its distinct pairs of values.  Nothing is shuffled for it.  A comparison whose
    column is already there is not computed again.
    """
    minimums = dict(minimums or {})
    present = pairs.columns
    todo = [c for c in comparisons if c.alias not in present]
    scored = possible_pairs(pairs, comparisons, minimums)

    def limits(group: Sequence[Comparison]) -> dict[str, float]:
        return {c.alias: minimums[c.alias] for c in group if c.alias in minimums}

    scored = filter_scores(scored, limits([c for c in comparisons if c.alias in present]))
    native = [c for c in todo if not c.definition.arrow]
    for c in native:
        if c.alias in minimums:
            # generated, so that the score is worked out once and not for the filter and again for the result
            scored = scored.select("*", F.inline(F.array(F.struct(c.score(present).alias(c.alias)))))
            scored = filter_scores(scored, limits([c]))
    if native:
        scored = scored.withColumns({c.alias: c.score(present) for c in native if c.alias not in minimums})

    for c in todo:
        if c.definition.arrow:
            scored = filter_scores(scored.withColumn(c.alias, c.score(present)), limits([c]))
    aliases = [c.alias for c in comparisons]
    return scored.select(*(c for c in present if c not in aliases), *aliases)


def filter_scores(scores: DataFrame, minimums: Mapping[str, float]) -> DataFrame:
    """Rows whose named scores all reach their minimum; null scores drop out."""
    for alias, minimum in minimums.items():
        scores = scores.where(F.col(alias) >= F.lit(minimum))
    return scores
