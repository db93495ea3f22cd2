"""Several block rules: records that agree in any one of them are compared, each pair once.

A pair belongs to the first rule that both its records agree in.  Every rule pairs
its own blocks and passes over the pairs that an earlier rule has: whether it has
them shows in the earlier rule's columns, which both records carry.  So nothing is
formed twice, and nothing has to be made distinct.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairwright.operators import pairing
from pairwright.operators.matching import Compare, Matching


def _agree(job: Matching, rule: Sequence[str]) -> Column:
    """Whether both sides of a pair know and share all columns of a rule."""
    same = [F.col(c).isNotNull() if c in job.block else F.col(f"{c}1") == F.col(f"{c}2") for c in rule]
    return F.coalesce(reduce(Column.__and__, same), F.lit(False))


def rule_jobs(
    id_column: str,
    rules: Sequence[Sequence[str]],
    compare: Sequence[Compare],
    minimums: Mapping[str, float] | None = None,
    slot_rows: int = pairing.SLOT_ROWS,
) -> list[Matching]:
    """A matching job for each rule, which carries what the earlier rules block on."""
    jobs = []
    for number, rule in enumerate(rules):
        earlier = list(dict.fromkeys(c for r in rules[:number] for c in r))
        jobs.append(Matching(id_column, rule, compare, dict(minimums or {}), slot_rows, earlier))
    return jobs


def rule_links(
    records: DataFrame,
    id_column: str,
    rules: Sequence[Sequence[str]],
    compare: Sequence[Compare],
    minimums: Mapping[str, float] | None = None,
    slot_rows: int = pairing.SLOT_ROWS,
) -> DataFrame:
    """The profile pairs of all rules that reach every minimum, with the number of their ``rule`` from 0 on.

    A profile is one of its rule: records that agree in the rule's block, in what
    is compared and in what earlier rules block on.
    """
    jobs = rule_jobs(id_column, rules, compare, minimums, slot_rows)
    found = []
    for number, job in enumerate(jobs):
        met = job.meet_likely(job.qualifying_profiles(records))
        for rule in rules[:number]:
            met = met.where(~_agree(job, rule))
        scored = pairing.in_id_order(job.qualify(met), job.values)
        names = [*dict.fromkeys(c.column for c in compare), *pairing.PROFILE_MARKS]
        sides = [
            F.col(c).alias(f"{c}{s}") if c in job.block else F.col(f"{c}{s}") for s in (1, 2) for c in names
        ]
        found.append(scored.select(F.lit(number).alias("rule"), *sides, "pairs", *(c.alias for c in compare)))
    return reduce(DataFrame.unionByName, found)
