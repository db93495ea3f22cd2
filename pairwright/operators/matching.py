"""A matching job: what blocks records, what is compared, what is enough."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairwright.functions.similarity import letter_counts
from pairwright.operators import pairing, segments, token_sets
from pairwright.operators.estimates import all_known
from pairwright.operators.scoring import METRICS, Comparison, filter_scores, letters_name, prepared_name, score_pairs
from pairwright.session import ensure_checkpoint_dir


@dataclass(frozen=True)
class Compare:
    """Compare a column of two records with a metric and name the score."""

    column: str
    metric: str
    alias: str


@dataclass(frozen=True)
class Matching:
    """Records block on equal keys and are compared by symmetric metrics."""

    id_column: str
    block: Sequence[str]
    compare: Sequence[Compare] = ()
    minimums: Mapping[str, float] = field(default_factory=dict)
    slot_rows: int = pairing.SLOT_ROWS
    also: Sequence[str] = ()  # carried without being compared
    tell_values: bool = True  # links tell the values of both sides, where they are not needed for a score yet

    @property
    def values(self) -> list[str]:
        """Columns outside the block that tell profiles apart: those compared, and those carried besides."""
        wanted = [*(c.column for c in self.compare), *self.also]
        return list(dict.fromkeys(c for c in wanted if c not in self.block))

    @property
    def _prepared(self) -> list[Compare]:
        return [c for c in self.compare if c.column not in self.block and self._comparison(c).definition.prepare]

    @property
    def _lettered(self) -> list[Compare]:
        """What is compared by letters before it is scored."""
        return [
            c
            for c in self.compare
            if c.column not in self.block and c.alias in self.minimums and METRICS[c.metric].letter_bound
        ]

    @property
    def _ready(self) -> list[str]:
        """Names of what is prepared once per profile."""
        names = [prepared_name(c.column, c.metric) for c in self._prepared]
        return list(dict.fromkeys([*names, *(letters_name(c.column, c.metric) for c in self._lettered)]))

    @property
    def carried(self) -> list[str]:
        """Compared columns and what was prepared from them."""
        return [*self.values, *self._ready]

    @property
    def constants(self) -> list[str]:
        """Scores of block columns: both records agree, so they follow from the block."""
        return [c.alias for c in self.compare if c.column in self.block]

    def _comparison(self, c: Compare) -> Comparison:
        if c.column in self.block:
            return Comparison(c.column, c.column, c.metric, c.alias)
        return Comparison(f"{c.column}1", f"{c.column}2", c.metric, c.alias)

    @property
    def comparisons(self) -> list[Comparison]:
        return [self._comparison(c) for c in self.compare]

    def prepare(self, frame: DataFrame) -> DataFrame:
        """Do beforehand what depends on one record: prepared values, block scores."""
        ready = {
            prepared_name(c.column, c.metric): self._comparison(c).definition.prepare(F.col(c.column))
            for c in self._prepared
        }
        fixed = {c.alias: self._comparison(c).score() for c in self.compare if c.column in self.block}
        frame = frame.withColumns({**ready, **fixed}) if ready or fixed else frame
        letters = {}
        for c in self._lettered:
            name = prepared_name(c.column, c.metric)
            letters[letters_name(c.column, c.metric)] = letter_counts(F.col(name if name in frame.columns else c.column))
        return frame.withColumns(letters) if letters else frame

    def possible(self, prepared: DataFrame) -> DataFrame:
        """What one record alone does not rule out.

        A block score may be too low already, and a null value has no score.
        Said here, before pairing, both sides of a pair filter alike and can
        share one aggregation.
        """
        wanted = {alias: self.minimums[alias] for alias in self.constants if alias in self.minimums}
        needed = [c.column for c in self.compare if c.alias in self.minimums and METRICS[c.metric].strict]
        return filter_scores(prepared, wanted).where(all_known([*self.block, *needed]))

    def profiles(self, records: DataFrame) -> DataFrame:
        """Profiles, prepared for pairing."""
        return self.prepare(pairing.profiles(records, self.id_column, self.block, self.values))

    def qualifying_profiles(self, records: DataFrame) -> DataFrame:
        return self.possible(self.profiles(records))

    def meet(self, groups: DataFrame) -> DataFrame:
        """Pairs of profiles, sides not settled."""
        return pairing.meet_profiles(groups, self.block, self.carried, self.constants, self.slot_rows)

    def meet_likely(self, groups: DataFrame) -> DataFrame:
        """Pairs of profiles, without most of those that cannot reach the minimums.

        Where an edit score has a high minimum, only values that share a segment
        meet; where a score of token sets has one, only sets that share a rare token.
        """
        limited = [(self.minimums[c.alias], c) for c in self.compare if c.column not in self.block and c.alias in self.minimums]
        edits = [(m, c.column) for m, c in limited if c.metric == "fuzzy" and m >= segments.LEAST_MINIMUM]
        if edits:
            minimum, column = max(edits)
            return segments.meet_by_segments(
                groups, self.block, self.carried, column, minimum, self.constants, self.slot_rows
            )
        sets = [(m, c.column, c.metric, c.alias) for m, c in limited if METRICS[c.metric].tokens and m > 0]
        if sets:
            minimum, column, metric, alias = max(sets)
            carried = self.carried if self.tell_values or len(self.compare) > 1 or self.also else []
            scored = (alias, METRICS[metric].compare)
            return token_sets.meet_by_tokens(
                groups, self.block, carried, column, METRICS[metric].tokens, minimum, self.constants, self.slot_rows, scored
            )
        edited = list(dict.fromkeys(c.column for _, c in limited if METRICS[c.metric].cored))
        if edited:
            cores = [segments.core_name(c) for c in edited]
            cored = segments.with_cores(groups, self.block, edited)
            return pairing.meet_profiles(cored, self.block, [*self.carried, *cores], self.constants, self.slot_rows, groups)
        return self.meet(groups)

    def score(self, pairs: DataFrame) -> DataFrame:
        """All scores, nothing filtered."""
        return self._tidy(score_pairs(pairs, self.comparisons))

    def qualify(self, pairs: DataFrame) -> DataFrame:
        """Scores of the pairs that reach every minimum."""
        return self._tidy(score_pairs(pairs, self.comparisons, self.minimums))

    def _tidy(self, scored: DataFrame) -> DataFrame:
        ready = [*self._ready, *(segments.core_name(c) for c in self.values)]
        return scored.drop(*(f"{name}{side}" for name in ready for side in (1, 2)))

    def candidates(self, records: DataFrame) -> DataFrame:
        """Candidate pairs by profile, with the number of record pairs each."""
        return pairing.candidate_pairs(records, self.id_column, self.block, self.values, self.slot_rows)

    def scores(self, records: DataFrame) -> DataFrame:
        """The score table, by profile pair."""
        return pairing.in_id_order(self.score(self.meet(self.profiles(records))), self.values)

    def links(self, records: DataFrame) -> DataFrame:
        """The profile pairs that are probable duplicates."""
        met = self.qualify(self.meet_likely(self.qualifying_profiles(records)))
        return pairing.in_id_order(met, [c for c in self.values if f"{c}1" in met.columns])

    def record_profiles(self, records: DataFrame) -> DataFrame:
        """(id, profile): which profile each record belongs to, one row per record that can pair."""
        return pairing.record_profiles(records, self.id_column, self.block, self.values)

    def record_pairs(self, links: DataFrame, records: DataFrame, max_pairs: int) -> DataFrame:
        """Every record pair behind the links; refuses past ``max_pairs``.

        The links are written to the shared folder, so counting does not score them twice.
        """
        ensure_checkpoint_dir(links.sparkSession)
        checked = pairing.within_limit(links.checkpoint(), max_pairs)
        return pairing.spell_out(checked, records, self.id_column, self.block, self.values)
