"""Candidate pairs within blocks, at the level of distinct values.

Records that agree in the block and in every compared column score alike, so
they are folded into one *profile* before anything is paired.  Profiles are
paired, scored and filtered; record pairs are spelled out last and only for
the profiles that remain.  A profile is named by the least id of its records.

Blocks with many profiles are cut into slots, and pairs of slots become cells
of bounded size, so one block never lands in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairwright.operators.estimates import WIDE, all_known
from pairwright.session import shuffle_partitions

PROFILE_MARKS = ("profile", "profile_last", "profile_members")
# Profiles per slot: a cell compares at most this many squared, unless a block would have too many slots.
SLOT_ROWS = 1024
# A profile is copied to as many cells as its block has slots.  Beyond so many, slots grow first ...
MANY_SLOTS = 64
# ... up to so many profiles.
LARGE_SLOT_ROWS = 4096
# The product of two counts below this is a long.
MANY_MEMBERS = 1 << 31
# Records per slice when record pairs are spelled out.
SLICE_ROWS = 1024


def profiles(records: DataFrame, id_column: str, block: Sequence[str], carry: Sequence[str]) -> DataFrame:
    """Distinct (block, compared values) with least id, greatest id and count.

    Null block keys never pair, so they are left out.  The aggregation
    combines before the shuffle; copies of one record cost one row per task.
    """
    known = records.where(all_known(block))
    return known.groupBy(*block, *carry).agg(
        F.min(id_column).alias("profile"),
        F.max(id_column).alias("profile_last"),
        F.count(F.lit(1)).alias("profile_members"),
    )


def whole() -> Column:
    """True of every profile, by a look at all its marks.

    What is asked of profiles goes through it: with the same columns asked for in the same order, Spark
    reuses the shuffle that made the profiles instead of scanning the records again.
    """
    return (F.col("profile") <= F.col("profile_last")) & (F.col("profile_members") > 0)


def _slotted(groups: DataFrame, block: Sequence[str], slot_rows: int, sized: DataFrame | None = None) -> DataFrame:
    """Give each profile a slot; only blocks over one slot's size get several.

    What is copied grows with the square of a block over the size of its slots, so
    slots smaller than ``LARGE_SLOT_ROWS`` grow in blocks of more than ``MANY_SLOTS``.

    The size counts through every profile mark (:func:`whole`).
    """
    largest = max(slot_rows, LARGE_SLOT_ROWS)

    def slots_of(size: str) -> Column:
        fewest = F.greatest(F.lit(MANY_SLOTS).cast("long"), F.ceil(F.col(size) / largest))
        return F.least(F.ceil(F.col(size) / slot_rows), fewest)

    crowded = (
        (groups if sized is None else sized)
        .groupBy(*block)
        .agg(F.count_if(whole()).alias("_size"))
        .where(F.col("_size") > slot_rows)
        .select(*block, slots_of("_size").alias("_slots"))
    )
    slots = F.coalesce(F.col("_slots"), F.lit(1).cast("long"))
    placed = groups.join(crowded, list(block), "left").withColumn("_slots", slots)
    return placed.withColumn("_slot", F.pmod(F.xxhash64("profile"), F.col("_slots")))


def _counted(members: Sequence[str], whole: Callable[..., Column], wide: Callable[..., Column]) -> Column:
    """A count of pairs: of whole numbers where those are wide enough, as decimals take many times longer."""
    columns = [F.col(m) for m in members]
    few = reduce(Column.__and__, (c < MANY_MEMBERS for c in columns))
    return F.when(few, whole(*columns).cast(WIDE)).otherwise(wide(*(c.cast("decimal(19,0)") for c in columns)).cast(WIDE))


def pairs_between(one: str, other: str) -> Column:
    """How many record pairs two profiles with so many members make."""
    return _counted([one, other], lambda a, b: a * b, lambda a, b: a * b)


def pairs_within(members: str) -> Column:
    """How many record pairs a profile with so many members makes with itself."""
    return _counted([members], lambda n: F.shiftright(n * (n - F.lit(1)), 1), lambda n: n * (n - F.lit(1)) / F.lit(2))


def meet_profiles(
    groups: DataFrame,
    block: Sequence[str],
    carry: Sequence[str],
    constants: Sequence[str] = (),
    slot_rows: int = SLOT_ROWS,
    sized: DataFrame | None = None,
) -> DataFrame:
    """Every unordered pair of profiles of a block once, with itself if it has pairs.

    Columns end in 1 and 2 in no particular order; :func:`in_id_order` settles
    it, best after filtering.  ``constants`` follow from the block alone and
    travel on one side only.  ``pairs`` counts the record pairs of a row.  ``sized``
    are the same profiles by a shorter plan, from which blocks are counted.
    """
    placed = _slotted(groups, block, slot_rows, sized)
    zero = F.lit(0).cast("long")
    carried = [*carry, *PROFILE_MARKS]
    keys = [*block, "_low", "_high"]
    tasks = shuffle_partitions(groups.sparkSession)

    # The cell (low, high) meets slot low from one side and slot high from the
    # other.  Repartitioning by number keeps the cells spread: their input is
    # small, and adaptive coalescing would judge them by that.
    def side(mark: str, low: Column, high: Column, extra: Sequence[str] = ()) -> DataFrame:
        renamed = [F.col(c).alias(f"{c}_{mark}") for c in carried]
        cells = placed.select(*block, *extra, *renamed, low.alias("_low"), high.alias("_high"))
        return cells.repartition(tasks, *keys)

    slot, last_slot = F.col("_slot"), F.col("_slots") - 1
    left = side("a", slot, F.explode(F.sequence(slot, last_slot)), constants)
    right = side("b", F.explode(F.sequence(zero, slot)), slot)

    once = (F.col("_low") < F.col("_high")) | (F.col("profile_a") <= F.col("profile_b"))
    same = F.col("profile_a") == F.col("profile_b")
    met = left.join(right, keys).where(once).where(~same | (F.col("profile_members_a") > 1))
    pairs = F.when(same, pairs_within("profile_members_a")).otherwise(pairs_between("profile_members_a", "profile_members_b"))

    # Catalyst tests filters added later first.  A meeting that counts from
    # the other end shows them a null, so no score is computed for it.
    masked = {c: F.when(once, F.col(f"{c}_a")) for c in carry[:1]}
    first = [masked.get(c, F.col(f"{c}_a")).alias(f"{c}1") for c in carried]
    second = [F.col(f"{c}_b").alias(f"{c}2") for c in carried]
    return met.select(*block, *constants, *first, *second, pairs.alias("pairs"))


def in_id_order(pairs: DataFrame, carry: Sequence[str]) -> DataFrame:
    """Put the profile with the lesser id first."""
    swap = F.col("profile1") > F.col("profile2")
    settled = {}
    for c in (*carry, *PROFILE_MARKS):
        one, two = F.col(f"{c}1"), F.col(f"{c}2")
        settled[f"{c}1"] = F.when(swap, two).otherwise(one)
        settled[f"{c}2"] = F.when(swap, one).otherwise(two)
    return pairs.withColumns(settled)


def candidate_pairs(
    records: DataFrame,
    id_column: str,
    block: Sequence[str],
    carry: Sequence[str],
    slot_rows: int = SLOT_ROWS,
) -> DataFrame:
    """All candidate pairs of a table in folded form, lesser id first."""
    groups = profiles(records, id_column, block, carry)
    return in_id_order(meet_profiles(groups, block, carry, slot_rows=slot_rows), carry)


def record_profiles(records: DataFrame, id_column: str, block: Sequence[str], carry: Sequence[str]) -> DataFrame:
    """(id, profile) of every record with a known block.

    Profiles are named within their block, so no pair is formed.  Equal records
    meet their one profile row; a common profile's join is split by Spark.
    """
    names = [*block, *carry]
    groups = profiles(records, id_column, block, carry).select(*(F.col(c).alias(f"_{c}") for c in names), "profile")
    return records.join(groups, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in names]).select(id_column, "profile")


def within_limit(links: DataFrame, max_pairs: int) -> DataFrame:
    """Refuse a job that stands for more pairs than the caller is ready for.

    Nothing is cut off: the frame comes back whole or an error is raised.
    """
    total = links.agg(F.sum("pairs").alias("n")).first()["n"] or 0
    if total > max_pairs:
        raise ValueError(f"{total} record pairs, more than the {max_pairs} allowed")
    return links


def spell_out(
    links: DataFrame,
    records: DataFrame,
    id_column: str,
    block: Sequence[str],
    carry: Sequence[str],
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """The record pairs behind profile pairs, each once with id1 < id2.

    All columns of ``links`` other than profile marks are kept, with values
    swapped where the lesser id belongs to the second profile.  Both profiles
    are cut into slices, so a mass of equal records is spread over many tasks.
    """
    names = [*block, *carry]
    groups = profiles(records, id_column, block, carry).select(
        *(F.col(c).alias(f"_{c}") for c in names), F.col("profile").alias("_profile"), F.col("profile_members").alias("_members")
    )
    same_values = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in names]
    slices = F.ceil(F.col("_members") / slice_rows)
    tagged = records.join(groups, same_values).select(
        F.col(id_column).alias("_id"),
        F.col("_profile"),
        F.pmod(F.xxhash64(id_column), slices).alias("_slice"),
    )

    def all_slices(members: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col(members) / slice_rows) - 1))

    cells = links.withColumn("_slice1", all_slices("profile_members1")).withColumn("_slice2", all_slices("profile_members2"))
    # A profile meets itself in every pair of slices once, lower slice first.
    cells = cells.where(
        (F.col("profile1") != F.col("profile2")) | (F.col("_slice1") <= F.col("_slice2"))
    )
    # A slice travels as one list, so what is shuffled is a row per pair of slices, and pairs are
    # spelled out last.  Structs, as a list leaves nulls out.
    held = tagged.groupBy("_profile", "_slice").agg(F.collect_list(F.struct("_id")).getField("_id").alias("_ids"))
    first = held.select(
        F.col("_profile").alias("profile1"), F.col("_slice").alias("_slice1"), F.col("_ids").alias("_ids1")
    )
    second = held.select(
        F.col("_profile").alias("profile2"), F.col("_slice").alias("_slice2"), F.col("_ids").alias("_ids2")
    )
    # By number: few bytes may stand for many pairs, and adaptive coalescing goes by bytes.
    tasks = shuffle_partitions(links.sparkSession)
    met = cells.join(first, ["profile1", "_slice1"]).repartition(tasks, "profile2", "_slice2")
    met = met.join(second, ["profile2", "_slice2"])
    met = met.withColumn("_id1", F.explode("_ids1")).drop("_ids1").withColumn("_id2", F.explode("_ids2")).drop("_ids2")
    once = (
        (F.col("profile1") != F.col("profile2"))
        | (F.col("_slice1") < F.col("_slice2"))
        | (F.col("_id1") < F.col("_id2"))
    )
    met = met.where(once)
    swap = F.col("_id1") > F.col("_id2")
    oriented = []
    for name in carry:
        low, high = F.col(f"{name}1"), F.col(f"{name}2")
        oriented += [
            F.when(swap, high).otherwise(low).alias(f"{name}1"),
            F.when(swap, low).otherwise(high).alias(f"{name}2"),
        ]
    folded = {f"{c}{side}" for c in (*carry, *PROFILE_MARKS) for side in (1, 2)} | {"pairs", *block}
    others = [c for c in links.columns if c not in folded]
    return met.select(
        F.least("_id1", "_id2").alias(f"{id_column}1"),
        F.greatest("_id1", "_id2").alias(f"{id_column}2"),
        *block,
        *oriented,
        *others,
    )
