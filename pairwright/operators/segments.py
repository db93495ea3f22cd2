"""Pairs of similar values within blocks, found by the segments they share.

Two values whose edit score reaches a minimum differ by at most ``k`` edits, and
``k`` follows from the longer one's length.  Cut the shorter one into ``k + 1``
segments: an edit touches one of them at most, so one segment survives whole in
the other value, near its old place.  Joining on segment, number and lengths finds
every such pair, and the pairs that share nothing are never formed.

What all values of a block begin and end with tells no pair apart, and taking it
off changes no edit distance, so segments are cut from what is left.  A segment
that very many values share is cut into slots, as large blocks are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairwright.functions.similarity import characters
from pairwright.operators.estimates import WIDE
from pairwright.operators.pairing import PROFILE_MARKS, SLOT_ROWS, whole
from pairwright.session import shuffle_partitions

# Below this minimum segments get so short that most values share some.
LEAST_MINIMUM = 0.7
# Above the rounding of a score, below a step of one.
ROUNDING = 1e-9
KEY = ("_long", "_short", "_number", "_segment")


def _shared_start(one: Column, other: Column) -> Column:
    """How many leading characters two strings share."""
    same = F.zip_with(characters(one), characters(other), lambda a, b: F.coalesce(a == b, F.lit(False)))
    differs = F.array_position(same, False)
    return F.when(differs == 0, F.size(same)).otherwise(differs - 1).cast("int")


def trimmed(groups: DataFrame, block: Sequence[str], column: str) -> DataFrame:
    """Adds ``_core`` (without what its block's values all begin and end with), ``_off`` (how much that is), and the
    block's ``_least`` and ``_most`` lengths of a core.

    The first and the last string in order share what all share, so four extremes tell it.
    """
    value = F.col(column)
    extremes = groups.groupBy(*block).agg(
        F.min(value).alias("_first"),
        F.max(value).alias("_last"),
        F.min(F.reverse(value)).alias("_first_end"),
        F.max(F.reverse(value)).alias("_last_end"),
        F.min(F.length(value)).alias("_shortest"),
        F.max(F.length(value)).alias("_longest"),
    )
    start = _shared_start(F.col("_first"), F.col("_last"))
    end = F.least(_shared_start(F.col("_first_end"), F.col("_last_end")), F.col("_shortest") - F.col("_start"))
    offs = extremes.withColumn("_start", start).withColumn("_end", end)
    offs = offs.select(
        *block,
        "_start",
        (F.col("_start") + F.col("_end")).alias("_off"),
        (F.col("_shortest") - F.col("_start") - F.col("_end")).alias("_least"),
        (F.col("_longest") - F.col("_start") - F.col("_end")).alias("_most"),
    )
    core = F.substring(value, F.col("_start") + 1, F.length(value) - F.col("_off"))
    return groups.join(offs, list(block)).withColumn("_core", core).drop("_start")


def with_cores(groups: DataFrame, block: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Adds ``_core_<column>`` for each column: its value without what the block's values all begin and end with.

    Cores of a block are as many edits apart as the values.
    """
    ends = []
    for c in columns:
        value = F.when(whole(), F.col(c))
        bounds = {"first": value, "last": value, "first_end": F.reverse(value), "last_end": F.reverse(value)}
        ends += [(F.max(v) if n.startswith("last") else F.min(v)).alias(f"_{n}_{c}") for n, v in bounds.items()]
        ends.append(F.min(F.length(value)).alias(f"_shortest_{c}"))
    offs = groups.groupBy(*block).agg(*ends)
    offs = offs.withColumns({f"_start_{c}": _shared_start(F.col(f"_first_{c}"), F.col(f"_last_{c}")) for c in columns})
    shared_ends = {c: _shared_start(F.col(f"_first_end_{c}"), F.col(f"_last_end_{c}")) for c in columns}
    after = {c: F.least(end, F.col(f"_shortest_{c}") - F.col(f"_start_{c}")) for c, end in shared_ends.items()}
    kept = [F.col(f"_start_{c}") for c in columns] + [(F.col(f"_start_{c}") + after[c]).alias(f"_off_{c}") for c in columns]
    cores = {core_name(c): F.substring(F.col(c), F.col(f"_start_{c}") + 1, F.length(c) - F.col(f"_off_{c}")) for c in columns}
    met = groups.join(offs.select(*block, *kept), list(block)).withColumns(cores)
    return met.drop(*(f"_{n}_{c}" for n in ("start", "off") for c in columns))


def core_name(column: str) -> str:
    """The column that holds a value's core."""
    return f"_core_{column}"


def _edits(core_length: str, minimum: float) -> str:
    """SQL for the most edits that a pair may have whose longer core is so long."""
    return f"int(floor((1 - {minimum!r}D) * ({core_length} + _off) + {ROUNDING}D))"


def _cut(length: str, number: str, edits: str) -> str:
    """SQL for where a segment of a core starts."""
    return f"int(floor({length} * {number} / ({edits} + 1)))"


def segments(trimmed_groups: DataFrame, minimum: float) -> DataFrame:
    """Each core's own segments, one row for each, for every length of a longer partner."""
    most = f"least(int(floor((length(_core) + _off) / {minimum!r}D + {ROUNDING}D)) - _off, _most)"
    k = _edits("n", minimum)
    start, stop = _cut("length(_core)", "i", k), _cut("length(_core)", "(i + 1)", k)
    keys = f"""flatten(transform(
        filter(sequence(length(_core), {most}), n -> n - length(_core) <= {k}),
        n -> transform(sequence(0, {k}), i -> named_struct(
          '_long', n, '_short', length(_core), '_number', i,
          '_segment', substring(_core, {start} + 1, {stop} - {start})))))"""
    return trimmed_groups.select("*", F.inline(F.expr(keys)))


def probes(trimmed_groups: DataFrame, minimum: float) -> DataFrame:
    """The substrings of each core that a shorter partner's segment may be, one row for each.

    A segment lies as far from its old place as the edits on either side of it
    allow, and the edits on both sides make up the difference of the lengths.
    """
    k = _edits("length(_core)", minimum)
    start, stop = _cut("n", "i", k), _cut("n", "(i + 1)", k)
    behind = "(length(_core) - n)"
    low = f"greatest({start} - i, {start} + {behind} - ({k} - i), 0)"
    high = f"least({start} + i, {start} + {behind} + ({k} - i), length(_core) - ({stop} - {start}))"
    places = f"if({low} <= {high}, sequence({low}, {high}), array())"
    keys = f"""flatten(transform(sequence(greatest(length(_core) - {k}, _least), length(_core)),
        n -> flatten(transform(sequence(0, {k}), i -> transform(
          array_distinct(transform({places}, p -> substring(_core, p + 1, {stop} - {start}))),
          s -> named_struct('_long', length(_core), '_short', n, '_number', i, '_segment', s))))))"""
    return trimmed_groups.select("*", F.inline(F.expr(keys)))


def meet_by_segments(
    groups: DataFrame,
    block: Sequence[str],
    carry: Sequence[str],
    column: str,
    minimum: float,
    constants: Sequence[str] = (),
    slot_rows: int = SLOT_ROWS,
) -> DataFrame:
    """The pairs of profiles of :func:`pairing.meet_profiles` whose ``column`` has an edit score of ``minimum`` or more.

    Each pair comes once, with the same columns.  Null values pair with nothing.
    """
    known = groups.where(F.col(column).isNotNull())
    cores = trimmed(known, block, column)
    carried = [*carry, *PROFILE_MARKS]
    keys = [*block, *KEY]
    own, asked = segments(cores, minimum), probes(cores, minimum)
    # a segment with many owners: owners are dealt to slots, whoever asks meets all of them
    crowded = own.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size")).where(F.col("_size") > slot_rows)
    crowded = crowded.select(*keys, F.ceil(F.col("_size") / slot_rows).cast("int").alias("_slots"))
    slots = F.coalesce(F.col("_slots"), F.lit(1))
    tasks = shuffle_partitions(groups.sparkSession)

    def side(rows: DataFrame, mark: str, slot: Column, extra: Sequence[str] = ()) -> DataFrame:
        renamed = [F.col(c).alias(f"{c}{mark}") for c in carried]
        placed = rows.join(crowded, keys, "left").select(*keys, *extra, *renamed, slot.alias("_slot"))
        return placed.repartition(tasks, *keys, "_slot")

    shorter = side(own, "1", F.pmod(F.xxhash64("profile"), slots).cast("int"), [*constants, "_off"])
    longer = side(asked, "2", F.explode(F.sequence(F.lit(0), slots - 1)))
    once = (F.col("_short") < F.col("_long")) | (F.col("profile1") < F.col("profile2"))
    # the distance is worked out in a band of that width, and is -1 beyond it
    near = F.expr(f"levenshtein(`{column}1`, `{column}2`, {_edits('_long', minimum)}) >= 0")
    met = shorter.join(longer, [*keys, "_slot"]).where(once).where(near)
    members = [F.col(f"profile_members{s}").cast("decimal(19,0)") for s in (1, 2)]
    names = [f"{c}{s}" for s in (1, 2) for c in carried]
    # a pair may share several segments
    found = met.select(*block, *constants, *names, (members[0] * members[1]).cast(WIDE).alias("pairs"))
    found = found.dropDuplicates(["profile1", "profile2"])
    count = F.col("profile_members").cast("decimal(19,0)")
    alike = known.where((F.col("profile_members") > 1) & (F.length(column) > 0)).select(
        *block,
        *constants,
        *[F.col(c).alias(f"{c}{s}") for s in (1, 2) for c in carried],
        (count * (count - F.lit(1)) / F.lit(2)).cast(WIDE).alias("pairs"),
    )
    return found.unionByName(alike)
