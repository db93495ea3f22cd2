"""Pairs of similar token sets within blocks, found by bounds on what they share.

A block is cut into slots and a pair of slots is a cell with its own shuffle key.
In a cell each token list becomes a vector of bounded width: the tokens that weigh
most in the cell have a column each, the others share columns, whose entries are
lengths.  The product of two vectors is never less than that of the lists, so one
matrix product rules out most pairs; what the others share is added up exactly,
in whole numbers, and gives their score.  Sets whose sizes differ too much are not compared at all.

Slots travel packed, their tokens as numbers in compressed bytes, and a cell is made of
several slots from either side, which are compared slot by slot.  So a block is copied a few
times only, but for blocks of very many slots, and what a task holds at once does not grow.

That is quadratic in a block, at some ten nanoseconds for a pair: in large tables
even rare tokens are common, and lists under tokens met in every pair many times
over.  Without tokens a value pairs with nothing.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairwright.operators.pairing import PROFILE_MARKS, SLOT_ROWS, pairs_between, pairs_within, whole
from pairwright.session import shuffle_partitions

# Ship the helpers inside the task, so executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Below a computed score, above a rounding error.
ROUNDING = 1e-9
# A token's rows go to so many tasks when its rarity is looked up.
SALTS = 16
# So many slots of a job make one here, as rows are narrow; fewer cells mean fewer copies of a row.
SLOTS_TOGETHER = 4
# A block's slots are dealt to so many sides of cells at least, if it has them; a slot is copied to as many cells ...
FEW_SIDES = 4
# ... and a side has so many slots at most.
SIDE_SLOTS = 8
# Columns of tokens of their own, and of those that share one.
OWN_COLUMNS = 512
SHARED_COLUMNS = 256
# Rows of a cell that are compared at a time.
STRIP = 512


@dataclass(frozen=True)
class TokenMetric:
    """What a metric compares, and how much of it a partner may lack."""

    tokens: Callable[[Column], Column]  # of a value, with repeats
    weighted: bool  # counts of tokens matter, as in a cosine; else only which there are


def ordered_bags(groups: DataFrame, value: Column, metric: TokenMetric) -> DataFrame:
    """``profile`` and ``_bag``: its distinct tokens with their ``times`` and ``places`` in the table, the rarest first."""
    tokens = groups.select("profile", F.explode(metric.tokens(value)).alias("token"))
    counted = tokens.groupBy("profile", "token").agg(F.count(F.lit(1)).alias("times"))
    rarity = counted.groupBy("token").agg(F.count(F.lit(1)).alias("places"))
    # a token that every value has is looked up in several tasks
    salted = rarity.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    found = counted.withColumn("_salt", F.pmod(F.xxhash64("profile"), F.lit(SALTS)).cast("int")).join(salted, ["token", "_salt"])
    entry = F.struct("places", "token", "times")
    return found.groupBy("profile").agg(F.sort_array(F.collect_list(entry)).alias("_bag"))


def _weights(tokens: pa.ListArray, weighted: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Rows, token numbers and weights of the bags of some token lists, row by row, and the tokens by number."""
    rows = pc.list_parent_indices(tokens).to_numpy(zero_copy_only=False).astype(np.int64)
    names = pc.list_flatten(tokens).dictionary_encode()
    kinds = max(len(names.dictionary), 1)
    both, times = np.unique(rows * kinds + names.indices.to_numpy(zero_copy_only=False), return_counts=True)
    weights = times.astype(np.int64) if weighted else np.ones(len(both), dtype=np.int64)
    return both // kinds, both % kinds, weights, names.dictionary


@dataclass
class Slot:
    """The bags of a slot's rows, as :func:`_weights` gives them, and columns of the rows beside."""

    count: int
    rows: np.ndarray
    ids: np.ndarray
    weights: np.ndarray
    names: pa.Array
    columns: list[pa.Array]

    @classmethod
    def of(cls, tokens: pa.ListArray, weighted: bool, columns: Sequence[pa.Array] = ()) -> Slot:
        return cls(len(tokens), *_weights(tokens, weighted), list(columns))

    def packed(self) -> bytes:
        """The slot as compressed bytes; numbers are what they are more than the one before, so they are small."""
        keys = self.rows * max(len(self.names), 1) + self.ids
        parts = [pa.array([self.count]), pa.array(np.diff(keys, prepend=0)), pa.array(self.weights), self.names, *self.columns]
        lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in parts]
        batch = pa.RecordBatch.from_arrays(lists, names=[str(k) for k in range(len(lists))])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
            writer.write_batch(batch)
        return sink.getvalue().to_pybytes()

    @classmethod
    def unpacked(cls, data: bytes) -> Slot:
        count, steps, weights, names, *columns = (c.flatten() for c in pa.ipc.open_stream(data).read_next_batch().columns)
        keys, kinds = np.cumsum(steps.to_numpy()), max(len(names), 1)
        return cls(count[0].as_py(), keys // kinds, keys % kinds, weights.to_numpy(), names, columns)

    @property
    def filled(self) -> np.ndarray:
        """The rows that have tokens."""
        return np.unique(self.rows)

    def beside(self, other: Slot) -> Slot:
        """Both slots' rows in one, those of ``other`` last."""
        known = pc.index_in(other.names, value_set=self.names)
        numbers = pc.fill_null(known, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        fresh = numbers < 0
        numbers[fresh] = len(self.names) + np.arange(fresh.sum())
        return Slot(
            self.count + other.count,
            np.concatenate([self.rows, other.rows + self.count]),
            np.concatenate([self.ids, numbers[other.ids]]),
            np.concatenate([self.weights, other.weights]),
            pa.concat_arrays([self.names, other.names.filter(pa.array(fresh))]),
            [pa.concat_arrays(both) for both in zip(self.columns, other.columns, strict=True)],
        )


def _bounds_frame(rows: np.ndarray, ids: np.ndarray, weights: np.ndarray, count: int) -> np.ndarray:
    """One vector per row; the product of two is at least the product of their bags, by Cauchy and Schwarz.

    The tokens that weigh most in the cell have a column each, the others share columns.
    """
    mass = np.bincount(ids, weights * weights)
    order = np.argsort(-mass, kind="stable")
    column = np.empty(len(mass), dtype=np.int64)
    column[order] = np.arange(len(mass))
    over = column >= OWN_COLUMNS
    column[over] = OWN_COLUMNS + (column[over] - OWN_COLUMNS) % SHARED_COLUMNS
    width = min(len(mass), OWN_COLUMNS + SHARED_COLUMNS)
    summed = np.bincount(rows * width + column[ids], weights * weights, count * width)
    return np.sqrt(summed).reshape(count, width).astype(np.float32)


Scored = tuple[np.ndarray, np.ndarray, np.ndarray]


def scored_strips(slot: Slot, low: np.ndarray, high: np.ndarray, weighted: bool, minimum: float) -> Iterator[Scored]:
    """Which rows of ``low`` and of ``high`` reach the minimum (but for a rounding error), and their scores, a part at a time.

    The scores are the metric's to the last bit: sums are whole numbers, and what follows is done in its order.
    """
    rows, ids, weights = slot.rows, slot.ids, slot.weights
    squares = np.bincount(rows, weights * weights, slot.count).astype(np.int64)
    # a token that only one row has is in no pair; it counts in the squares and is left out else
    shared = np.bincount(ids, minlength=1)[ids] > 1
    rows, ids, weights = rows[shared], ids[shared], weights[shared]
    if not len(ids):
        return
    vectors = _bounds_frame(rows, ids, weights, slot.count)
    starts = np.searchsorted(rows, np.arange(slot.count + 1))
    # sets of like size together: others never match
    low, high = (side[np.argsort(squares[side], kind="stable")] for side in (low, high))
    sizes, reach = squares[high], np.zeros(int(ids.max()) + 1, dtype=np.int64)
    roots = np.sqrt(squares.astype(np.float64))
    for at in range(0, len(low), STRIP):
        strip = low[at : at + STRIP]
        first, last = 0, len(high)
        if not weighted:
            first = np.searchsorted(sizes, squares[strip[0]] * (minimum - ROUNDING))
            last = np.searchsorted(sizes, squares[strip[-1]] / max(minimum - ROUNDING, ROUNDING), "right")
        for begin in range(first, last, 8 * STRIP):
            others = high[begin : min(begin + 8 * STRIP, last)]
            if weighted:
                needed = minimum * np.outer(roots[strip], roots[others])
            else:
                needed = minimum / (1 + minimum) * (squares[strip][:, None] + squares[others])
            # single precision is a little off; sums over shared tokens are right again below
            one, other = np.nonzero(vectors[strip] @ vectors[others].T >= needed * (1 - 1e-4))
            edges = np.searchsorted(one, np.arange(len(strip) + 1))
            found: list[Scored] = []
            for k in np.unique(one):
                mine = slice(starts[strip[k]], starts[strip[k] + 1])
                asked = other[edges[k] : edges[k + 1]]
                partner = others[asked]
                counts = starts[partner + 1] - starts[partner]
                ends = np.cumsum(counts)
                places = np.arange(ends[-1]) + np.repeat(starts[partner] - ends + counts, counts)
                reach[ids[mine]] = weights[mine]
                sums = np.concatenate(([0], np.cumsum(reach[ids[places]] * weights[places])))
                reach[ids[mine]] = 0
                products = sums[ends] - sums[ends - counts]
                enough = products >= needed[k, asked] * (1 - ROUNDING) - ROUNDING
                partner, products = partner[enough], products[enough]
                most = roots[strip[k]] * roots[partner] if weighted else (squares[strip[k]] + squares[partner] - products).astype(np.float64)
                found.append((np.full(len(partner), strip[k]), partner, products / most))
            if found:
                one, other, score = (np.concatenate(parts) for parts in zip(*found, strict=True))
                yield one, other, score


def similar_in_cell(tokens: pa.ListArray, low: np.ndarray, high: np.ndarray, weighted: bool, minimum: float) -> tuple[np.ndarray, np.ndarray]:
    """The rows of :func:`scored_strips`, of token lists, in one piece."""
    none = np.zeros(0, dtype=np.int64)
    found = [(none, none), *((a, b) for a, b, _ in scored_strips(Slot.of(tokens, weighted), low, high, weighted, minimum))]
    one, other = (np.concatenate(parts) for parts in zip(*found, strict=True))
    return one, other


def candidates(
    groups: DataFrame, block: Sequence[str], value: Column, metric: TokenMetric, minimum: float, slot_rows: int = SLOT_ROWS
) -> DataFrame:
    """The block, both profiles with their marks and ``score`` of the pairs of a block that reach the minimum, but for rounding, each once."""
    marks = [m for m in PROFILE_MARKS if m in groups.columns]
    tasks = shuffle_partitions(groups.sparkSession)
    each = whole() if len(marks) == len(PROFILE_MARKS) else F.lit(True)
    sizes = groups.groupBy(*block).agg(F.count_if(each).alias("_size"))
    slots = sizes.select(*block, F.ceil(F.col("_size") / (SLOTS_TOGETHER * slot_rows)).cast("int").alias("_slots"))
    # one row for thousands of profiles at least, so it is sent to where the values are, which stay there
    crowded = F.broadcast(slots.where(F.col("_slots") > 1))
    placed = groups.select(*block, *marks, value.alias("_value")).join(crowded, list(block), "left")
    placed = placed.withColumn("_slots", F.coalesce("_slots", F.lit(1)))
    placed = placed.withColumn("_slot", F.pmod(F.xxhash64("profile"), F.col("_slots")).cast("int"))
    # values are dealt out as they are; their tokens take more room
    dealt = placed.repartition(tasks, *block, "_slots", "_slot")
    # which bags are empty is seen in the cells: a filter here would find the tokens of every record once more
    bags = dealt.select(*block, "_slots", "_slot", *marks, metric.tokens(F.col("_value")).alias("_tokens"))
    weighted, names = metric.weighted, [*block]
    kinds = {m: groups.schema[m].dataType.simpleString() for m in [*block, *marks]}

    def pack(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        slot = Slot.of(rows["_tokens"].combine_chunks(), weighted, [rows[m].combine_chunks() for m in marks])
        keys = {k: rows[k].slice(0, 1) for k in [*names, "_slots", "_slot"]}
        return pa.table({**keys, "_packed": pa.array([slot.packed()], pa.binary())})

    of_block = ", ".join(f"`{c}` {kinds[c]}" for c in block)
    packed = bags.groupBy(*block, "_slots", "_slot").applyInArrow(pack, f"{of_block}, _slots int, _slot int, _packed binary")
    sides = F.least("_slots", F.greatest(F.lit(FEW_SIDES), F.ceil(F.col("_slots") / SIDE_SLOTS).cast("int")))
    met = packed.withColumn("_mine", F.pmod("_slot", sides)).withColumn("_other", F.explode(F.sequence(F.lit(0), sides - 1)))
    met = met.withColumn("_low", F.least("_mine", "_other")).withColumn("_high", F.greatest("_mine", "_other"))
    keys = [*block, "_low", "_high"]
    cells = met.select(*keys, "_mine", "_slot", "_packed").repartition(tasks, *keys)

    def pairs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell = pa.Table.from_batches(list(batches)).sort_by("_slot")
        low, high = cell["_low"][0].as_py(), cell["_high"][0].as_py()
        own = [cell[c].slice(0, 1) for c in names]
        mine = cell["_mine"].to_pylist()
        for i in range(cell.num_rows):
            if mine[i] != low:
                continue
            one = Slot.unpacked(cell["_packed"][i].as_py())
            for j in range(i if low == high else 0, cell.num_rows):
                if mine[j] != high:
                    continue
                other = one if i == j else Slot.unpacked(cell["_packed"][j].as_py())
                met = one if i == j else one.beside(other)
                rows = [one.filled, one.filled if i == j else other.filled + one.count]
                for a, b, score in scored_strips(met, *rows, weighted, minimum):
                    once = a < b if i == j else slice(None)
                    a, b, score = pa.array(a[once]), pa.array(b[once]), pa.array(score[once])
                    blocks = [pa.concat_arrays(c.chunks).take(pa.array(np.zeros(len(a), np.int32))) for c in own]
                    both = [c.take(at) for at in (a, b) for c in met.columns]
                    yield pa.RecordBatch.from_arrays([*blocks, *both, score], names=[*names, *told, "score"])

    told = [f"{m}{s}" for s in (1, 2) for m in marks]
    of_pair = ", ".join(f"`{m}{s}` {kinds[m]}" for s in (1, 2) for m in marks)
    return cells.groupBy(*keys).applyInArrow(pairs_of, f"{of_block}, {of_pair}, score double")


def meet_by_tokens(
    groups: DataFrame,
    block: Sequence[str],
    carry: Sequence[str],
    column: str,
    metric: TokenMetric,
    minimum: float,
    constants: Sequence[str] = (),
    slot_rows: int = SLOT_ROWS,
    scored: tuple[str, Callable[[Column, Column], Column]] | None = None,
) -> DataFrame:
    """The pairs of :func:`pairing.meet_profiles` that could reach the minimum, with the same columns.

    Pairs are found by narrow rows; the values follow when few pairs are left, and not at all without
    ``carry`` and ``constants``: profiles are known where pairs are found.  ``scored`` names
    the score and works it out of two values: a pair's is known where it is found and comes along.
    """
    known = groups.where(F.col(column).isNotNull())
    found = candidates(known, block, F.col(column), metric, minimum, slot_rows)
    score = [F.col("score").alias(scored[0])] if scored else []
    if carry or constants:
        carried = [*carry, *PROFILE_MARKS]
        one = known.select(*block, *constants, *[F.col(c).alias(f"{c}1") for c in carried])
        two = known.select(*[F.col(c).alias(f"{c}2") for c in carried])
        # by number, as few pairs with long values are much work
        tasks = shuffle_partitions(groups.sparkSession)
        found = found.select(F.least("profile1", "profile2").alias("profile1"), F.greatest("profile1", "profile2").alias("profile2"), "score")
        found = found.repartition(tasks, "profile1").join(one, "profile1").repartition(tasks, "profile2").join(two, "profile2")
    names = [f"{c}{s}" for s in (1, 2) for c in [*carry, *PROFILE_MARKS]]
    pairs = found.select(*block, *constants, *names, pairs_between("profile_members1", "profile_members2").alias("pairs"), *score)
    # asked of profiles with pairs only: by themselves, these would be worked out for every record before profiles are made
    paired = (F.col("profile_members") > 1) & whole()
    text = F.col(column)
    alike = known.where(paired & (F.when(paired, F.size(metric.tokens(text))) > 0)).select(
        *block,
        *constants,
        *[F.col(n[:-1]).alias(n) for n in names],
        pairs_within("profile_members").alias("pairs"),
        *([F.when(paired, scored[1](text, text)).alias(scored[0])] if scored else []),
    )
    return pairs.unionByName(alike)
