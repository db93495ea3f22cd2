"""N-gram Jaccard join by T-occurrence search, after DivideSkip.

Two texts link when their sets of word shingles overlap by at least a share
``percent`` of the union.  Such a pair shares nearly all of either set: with
``d = n - ceil(n * percent / 100)``, each lacks at most ``d`` of its ``n``
shingles in the other.  The search uses that bound in each of its steps.

1. *Counting.*  Equal sets are one node.  In hash order, a linked node has more
   than ``d / 2`` shared shingles among its first ``3 d / 2 + 1``; most texts have
   not, and are done.  Of the rest, whole sets are counted the same way: more than
   ``d`` shingles that occur nowhere else, and there is no partner.
2. *Divide.*  A remaining node's ``d + 1`` shortest lists (shingles of its own
   alone first) hold every partner at least once; its longer lists are skipped.
   Lists are merged by shuffling on the shingle.  A list with very many members
   is cut into parts, and each pair of parts is a cell of its own.
3. *Bound.*  In a cell, a pair's difference is bounded from below by parity
   sketches: of two sketches' exclusive or only the difference is left.  What
   could still link gives a forest first, so that a group of copies gives as many
   pairs as members, and then all pairs between the components found so far, but
   for components that no pair of a forest left without a link.
4. *Probe.*  The sets of each such pair are compared exactly, the members of the
   one looked up in the other by binary search.

Shingles are 64-bit hashes and a set is known by a 64-bit hash.  No pair within a
component is needed, none between components is left out.

Defined cases: words are runs other than ASCII white space, with A-Z lowered;
with fewer words than a shingle has, their sequence is the one shingle; a text
without words, or null, has none and links with nothing; copies link; ids may
repeat or be null, and a component's id is its least id that is not null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from pairwright.llm.components import components
from pairwright.llm.frames import Scratch, landed, text_of, unwrapped, wrapped
from pairwright.llm.subwords import mixed
from pairwright.llm.words import filled, slices, white_space_words

# Bytes of text shingled at once, shingles counted by one task, nodes that a task counts
# together, members of a list's part.
SHINGLED_BYTES = 2 << 20
RANGE_SHINGLES = 500_000
TOGETHER = 2_000
PART = 1_024
# A text holds a word where this matches.
WORD = r"[^\x20\x09-\x0D]"


@dataclass(frozen=True)
class Rule:
    """Shingle length in words, and the least overlap in percent of the union."""

    words: int = 3
    percent: int = 90

    def lacks(self, n: np.ndarray | int) -> np.ndarray | int:
        """How many of ``n`` shingles a partner's set may lack."""
        return n * (100 - self.percent) // 100

    def first(self, n: int) -> int:
        """How many shingles are counted first."""
        return min(n, self.lacks(n) + self.lacks(n) // 2 + 1)

    def first_shared(self, n: np.ndarray | int) -> np.ndarray | int:
        """How many of the first must be shared: as many as for the smallest partner."""
        least = -(-n * self.percent // 100)
        return self.lacks(least) // 2 + 1

    def links(self, overlap: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return 100 * overlap >= self.percent * (a + b - overlap)

    def most_different(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The largest symmetric difference of linked sets of these sizes."""
        overlap = -(-self.percent * (a + b) // (100 + self.percent))
        return a + b - 2 * overlap


def shingle_sets(texts: pa.Array, words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    found = white_space_words(pc.ascii_lower(texts))
    each = np.array([xxhash.xxh3_64_intdigest(w) for w in found.distinct.cast(pa.binary()).to_pylist()], dtype=np.uint64)
    hashes = each[found.codes]
    # a window's hash takes in one word after the other
    rolled = mixed(hashes + np.uint64(words))
    for k in range(1, words):
        if len(hashes) > k:
            rolled = mixed(rolled[: len(hashes) - k] * np.uint64(3) + hashes[k:])
    out = []
    for start, stop in zip(found.bounds[:-1], found.bounds[1:], strict=True):
        if stop - start >= words:
            out.append(np.unique(rolled[start : stop - words + 1]))
        elif stop > start:
            out.append(np.array([xxhash.xxh3_64_intdigest(hashes[start:stop].tobytes(), seed=words)], dtype=np.uint64))
        else:
            out.append(np.empty(0, dtype=np.uint64))
    return out


def node_of(shingles: np.ndarray) -> int:
    """The signed 64-bit hash that a set is known by."""
    return int(np.array([xxhash.xxh3_64_intdigest(shingles.tobytes())], dtype=np.uint64).view(np.int64)[0])


def text_nodes(docs: DataFrame, id_column: str, text_column: str, rule: Rule) -> DataFrame:
    """``doc_id, text_key, node, n, first`` of every document, from one reading of the texts.

    ``node`` is null without words, ``n`` is the set's size, ``first`` its first
    shingles in hash order, ``text_key`` a 128-bit hash of the text.
    """
    rows = docs.select(F.col(id_column).alias("doc_id"), text_of(text_column).alias("text"))
    rows = rows.withColumn("text_key", F.unhex(F.md5("text")))
    schema = T.StructType(
        [
            rows.schema["doc_id"],
            T.StructField("text_key", T.BinaryType()),
            T.StructField("node", T.LongType()),
            T.StructField("n", T.LongType()),
            T.StructField("first", T.ArrayType(T.LongType())),
        ]
    )

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, filled(batch.column("text")), SHINGLED_BYTES):
                sets = shingle_sets(filled(texts), rule.words)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("text_key"),
                        pa.array([node_of(s) if len(s) else None for s in sets], pa.int64()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        _list_array([s[: rule.first(len(s))].view(np.int64) for s in sets], pa.int64()),
                    ],
                    names=schema.names,
                )

    return rows.mapInArrow(named, schema)


def _lists(column: pa.Array) -> list[np.ndarray]:
    """A list column's rows as numpy arrays."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(pc.list_value_length(column).to_numpy(zero_copy_only=False))
    return [flat[a:b] for a, b in zip(np.concatenate([[0], ends[:-1]]), ends, strict=True)] if len(ends) else []


def _list_array(rows: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    flat = np.concatenate(rows) if rows else np.empty(0, dtype=np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, type=kind))


class _Counter:
    """Collects sets, and tells what of them is counted elsewhere.

    Of the sets taken together, a shingle that several hold is shared, whatever
    others hold.  It is sent on once, marked as such, so a shingle that a third
    of all nodes hold reaches its range once per ``TOGETHER`` nodes.
    """

    def __init__(self, ranges_log2: int):
        self.bits = ranges_log2
        self.turn = 0
        self.partition = TaskContext.get().partitionId()
        self.clear()

    def clear(self) -> None:
        self.nodes: dict[int, tuple[int, np.ndarray]] = {}

    def add(self, node: int, n: int, shingles: np.ndarray) -> bool:
        self.nodes[node] = (n, shingles)
        return len(self.nodes) >= TOGETHER

    def rows(self) -> pa.RecordBatch:
        """One row per range with the sets' shingles there, and one of range -1 with what is known here.

        ``nodes`` and ``sizes`` say whose the ``shingles`` are, ``marked`` are those
        of several sets.  In range -1, ``sizes`` are the sets' and ``shingles``
        the numbers of shared ones.
        """
        self.turn += 1
        instance = (self.partition << 32) + self.turn
        keys, sizes = np.array(list(self.nodes)), np.array([v[0] for v in self.nodes.values()])
        flat = np.concatenate([v[1] for v in self.nodes.values()])
        owner = np.repeat(np.arange(len(keys)), [len(v[1]) for v in self.nodes.values()])
        values, inverse, times = np.unique(flat, return_inverse=True, return_counts=True)
        known = np.bincount(owner[times[inverse] > 1], minlength=len(keys))
        of = np.full(len(values), -1)
        of[inverse] = owner
        of[times > 1] = -1  # many hold it: no node to tell
        at = (values >> np.uint64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(values), dtype=np.int64)
        order = np.lexsort((of, at))
        values, of, at = values[order].view(np.int64), of[order], at[order]
        starts = np.flatnonzero(np.diff(at, prepend=-1) != 0)
        ranges, nodes, runs, shingles, marked = [-1], [keys], [sizes], [known], [values[:0]]
        for start, stop in zip(starts.tolist(), [*starts[1:].tolist(), len(at)], strict=True):
            first = start + int(np.searchsorted(of[start:stop], 0))
            own, counts = np.unique(of[first:stop], return_counts=True)
            ranges.append(int(at[start]))
            nodes.append(keys[own])
            runs.append(counts)
            shingles.append(values[first:stop])
            marked.append(values[start:first])
        batch = pa.RecordBatch.from_arrays(
            [
                pa.array(ranges, pa.int64()),
                pa.array([instance] * len(ranges), pa.int64()),
                *(_list_array(x, pa.int64()) for x in (nodes, runs, shingles, marked)),
            ],
            names=["range", "instance", "nodes", "sizes", "shingles", "marked"],
        )
        self.clear()
        return batch


COUNTED = "range long, instance long, nodes array<long>, sizes array<long>, shingles array<long>, marked array<long>"
SHARED = "instance long, nodes array<long>, sizes array<long>, shared array<long>"


def _range_counts(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    """How many of each set's shingles in a range other sets hold as well."""
    nodes, sizes, shingles, marked = (
        _lists(rows.column(c).combine_chunks()) for c in ("nodes", "sizes", "shingles", "marked")
    )
    own = np.concatenate(shingles)
    node = np.repeat(np.concatenate(nodes), np.concatenate(sizes))
    values, inverse = np.unique(np.concatenate([own, *marked]), return_inverse=True)
    shared = np.zeros(len(values), dtype=bool)
    shared[inverse[len(own) :]] = True
    # two different nodes: the least and the greatest differ
    low, high = np.full(len(values), np.iinfo(np.int64).max), np.full(len(values), np.iinfo(np.int64).min)
    np.minimum.at(low, inverse[: len(own)], node)
    np.maximum.at(high, inverse[: len(own)], node)
    shared |= low < high
    running = np.concatenate([[0], np.cumsum(shared[inverse[: len(own)]])])
    ends = np.cumsum(np.concatenate(sizes))
    counts = running[ends] - running[ends - np.concatenate(sizes)]
    bounds = np.cumsum([len(x) for x in nodes])[:-1]
    return pa.table(
        {
            "instance": rows.column("instance"),
            "nodes": _list_array(nodes, pa.int64()),
            "sizes": _list_array([x[:0] for x in nodes], pa.int64()),
            "shared": _list_array(np.split(counts, bounds), pa.int64()),
        }
    )


def _enough(counted: DataFrame, need: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """Nodes of which at least ``need`` of their sizes are shared.

    A node may be counted in several instances; each counts all of it.  Both uses
    of ``counted`` read the same files in the same parts, so instances are the same.
    """
    ranges = counted.where(F.col("range") >= 0).groupBy("range").applyInArrow(_range_counts, SHARED)
    here = counted.where(F.col("range") < 0).select("instance", "nodes", "sizes", F.col("shingles").alias("shared"))

    def reached(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        nodes, sizes, shared = (_lists(rows.column(c).combine_chunks()) for c in ("nodes", "sizes", "shared"))
        whole = next(k for k, x in enumerate(sizes) if len(x))
        order = np.argsort(nodes[whole])
        known, n = nodes[whole][order], sizes[whole][order]
        at = np.searchsorted(known, np.concatenate(nodes))
        total = np.bincount(at, weights=np.concatenate(shared), minlength=len(known))
        return pa.table({"node": pa.array(known[total >= need(n)], pa.int64())})

    return here.unionByName(ranges).groupBy("instance").applyInArrow(reached, "node long").distinct()


def _ranges_log2(shingles: int) -> int:
    """How many leading bits part the shingles into ranges of bounded size."""
    return max(0, int(np.ceil(np.log2(max(1, shingles) / RANGE_SHINGLES))))


def candidates_by_first(rows: DataFrame, rule: Rule) -> DataFrame:
    """Nodes that share enough of their first shingles to have a partner."""
    bits = _ranges_log2(rows.agg(F.sum(F.size("first"))).first()[0] or 0)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _Counter(bits)
        for batch in batches:
            columns = (batch.column("node").to_pylist(), batch.column("n").to_pylist(), _lists(batch.column("first")))
            for node, n, first in zip(*columns, strict=True):
                if counter.add(node, n, first.view(np.uint64)):
                    yield counter.rows()
        if counter.nodes:
            yield counter.rows()

    known = rows.where(F.col("node").isNotNull()).select("node", "n", "first")
    return _enough(known.mapInArrow(count, COUNTED), rule.first_shared)


def whole_sets(docs: DataFrame, text_column: str, rule: Rule, rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node`` and ``shingles`` of the given nodes, from one text of each."""
    chosen = rows.join(nodes, "node").groupBy("node").agg(F.min("text_key").alias("text_key"))
    texts = docs.select(text_of(text_column).alias("text")).select(F.unhex(F.md5("text")).alias("text_key"), "text")
    one = texts.groupBy("text_key").agg(F.first("text").alias("text")).join(chosen.hint("shuffle_hash"), "text_key")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, some in slices(batch, filled(batch.column("text")), SHINGLED_BYTES):
                sets = [s.view(np.int64) for s in shingle_sets(filled(some), rule.words)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("node"), _list_array(sets, pa.int64())], names=["node", "shingles"]
                )

    return one.select("node", "text").mapInArrow(whole, "node long, shingles array<long>")


def candidates_by_all(sets: DataFrame, rule: Rule) -> DataFrame:
    """Nodes that share enough of all their shingles to have a partner."""
    total = sets.agg(F.sum(F.size("shingles"))).first()[0] or 0
    bits = _ranges_log2(total)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _Counter(bits)
        for batch in batches:
            for node, s in zip(batch.column("node").to_pylist(), _lists(batch.column("shingles")), strict=True):
                if counter.add(node, len(s), s.view(np.uint64)):
                    yield counter.rows()
        if counter.nodes:
            yield counter.rows()

    return _enough(sets.mapInArrow(count, COUNTED), lambda n: n - rule.lacks(n))


def sketch_words(n: int) -> int:
    """64-bit words of a sketch: a power of two, about three bits per shingle."""
    return 1 << max(0, int(np.ceil(np.log2(max(1, 3 * n) / 64))))


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Parity of the number of shingles at each bit."""
    words = sketch_words(len(shingles))
    out = np.zeros(words, dtype=np.uint64)
    h = mixed(shingles.view(np.uint64) + np.uint64(0x632BE59BD9B4E019))
    np.bitwise_xor.at(out, (h >> np.uint64(6)).astype(np.int64) & (words - 1), np.uint64(1) << (h & np.uint64(63)))
    return out


def folded(sketches: np.ndarray, words: int) -> np.ndarray:
    """Sketches (rows) of fewer words, by exclusive or of their parts."""
    return np.bitwise_xor.reduce(sketches.reshape(len(sketches), -1, words), axis=1)


def short_lists(sets: DataFrame, rule: Rule, scratch: Scratch) -> DataFrame:
    """Cells: members of the lists that some node cannot skip.

    Columns ``shingle, i, j, side, node, n, short, sketch``; side 0 is the part
    ``i`` of a list, side 1 the part ``j``.
    """

    @F.arrow_udf("binary")
    def sketched(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            yield pa.array([sketch(s).tobytes() for s in _lists(column)], pa.binary())

    nodes = scratch.landed(
        sets.select("node", F.size("shingles").cast("long").alias("n"), sketched("shingles").alias("sketch")), "sketches"
    )
    postings = sets.select("node", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
    # written first, so that the join reads two plain shuffles and a common shingle can be split
    lists = postings.groupBy("shingle").agg(F.count(F.lit(1)).alias("members")).where(F.col("members") > 1)
    lists = scratch.landed(lists, "lists")
    shared = postings.join(lists.hint("shuffle_hash"), "shingle")
    order = Window.partitionBy("node").orderBy("members", "shingle")
    whole = Window.partitionBy("node")
    # of the d + 1 shortest lists, those of the node alone come first
    alone = F.col("n") - F.count(F.lit(1)).over(whole)
    lacks = F.floor(F.col("n") * (100 - rule.percent) / 100)
    ranked = shared.withColumn("short", F.row_number().over(order) <= lacks + 1 - alone)
    ranked = scratch.landed(ranked.select("shingle", "node", "members", "short"), "ranked")
    wanted = ranked.where("short").select("shingle").distinct()
    members = ranked.join(wanted.hint("shuffle_hash"), "shingle", "left_semi").join(nodes, "node")
    parts = F.ceil(F.col("members") / PART).cast("int")
    part = F.pmod(F.xxhash64("node"), parts).cast("int")
    members = members.withColumns({"parts": parts, "part": part})
    one = members.withColumn("j", F.explode(F.sequence("part", F.col("parts") - 1))).withColumns(
        {"i": F.col("part"), "side": F.lit(0)}
    )
    other = (
        members.where(F.col("part") > 0)
        .withColumn("i", F.explode(F.sequence(F.lit(0), F.col("part") - 1)))
        .withColumns({"j": F.col("part"), "side": F.lit(1)})
    )
    columns = ("shingle", "i", "j", "side", "node", "n", "short", "sketch")
    return one.select(*columns).unionByName(other.select(*columns))


class _Forest:
    """Components of numbers from 0 on."""

    def __init__(self, size: int):
        self.up = list(range(size))

    def top(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.top(a), self.top(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)
        return a != b


def _close(a: pa.Table, b: pa.Table | None, rule: Rule) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of pairs of a cell that could link; of ``a`` alone without ``b``."""
    tables = [a, b if b is not None else a]
    sides = []
    for t in tables:
        n = t.column("n").to_numpy()
        raw = t.column("sketch").to_pylist()
        sides.append((n, t.column("short").to_numpy(), raw))
    # pairs are of similar size, so sketches are compared per width, folded to the smaller
    widths = [np.array([len(r) // 8 for r in side[2]]) for side in sides]
    for wa in np.unique(widths[0]):
        for wb in np.unique(widths[1]):
            if max(wa, wb) > 2 * min(wa, wb):
                continue
            w = min(wa, wb)
            ra, rb = np.flatnonzero(widths[0] == wa), np.flatnonzero(widths[1] == wb)
            sa, sb = (
                folded(np.frombuffer(b"".join(side[2][k] for k in r), dtype=np.uint64).reshape(len(r), -1), w)
                for side, r in ((sides[0], ra), (sides[1], rb))
            )
            step = max(1, (1 << 21) // max(1, len(rb) * int(w)))
            for at in range(0, len(ra), step):
                rows = ra[at : at + step]
                na, nb = sides[0][0][rows][:, None], sides[1][0][rb][None, :]
                most = rule.most_different(na, nb)
                may = (sides[0][1][rows][:, None] | sides[1][1][rb][None, :]) & (np.abs(na - nb) <= most)
                if b is None:
                    may &= rows[:, None] < rb[None, :]
                if not may.any():
                    continue
                x, y = np.nonzero(may)
                differ = np.bitwise_count(sa[at : at + step][x] ^ sb[y]).sum(axis=1, dtype=np.int64)
                close = differ <= most[x, y]
                yield rows[x[close]], rb[y[close]]


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of one cell each from batches sorted by cell."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("shingle", "i", "j")], axis=1)
        starts = np.flatnonzero(np.any(np.diff(keys, axis=0, prepend=keys[:1] + 1) != 0, axis=1))
        for start, stop in zip(starts, [*starts[1:], batch.num_rows], strict=True):
            key = tuple(keys[start])
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, stop - start))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def close_pairs(cells: DataFrame, rule: Rule, forest: bool) -> DataFrame:
    """Distinct pairs ``a, b`` of nodes that could link.

    With ``forest``, only as many of each cell as connect them; without, all
    between different labels (column ``label``).
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = [], []
        for cell in _cells(batches):
            if cell.num_rows < 2:
                continue
            # in one order everywhere, so that lists of the same nodes give the same tree
            cell = cell.sort_by("node")
            side = cell.column("side").to_numpy()
            a = cell.filter(pa.array(side == 0)) if side.any() else cell
            b = cell.filter(pa.array(side == 1)) if side.any() else None
            if cell.column("i")[0].as_py() != cell.column("j")[0].as_py() and (b is None or not a.num_rows):
                continue
            na, nb = a.column("node").to_numpy(), (b or a).column("node").to_numpy()
            trees = _Forest(len(na) + len(nb)) if forest else None
            for x, y in _close(a, b, rule):
                if trees:
                    shift = len(na) if b is not None else 0
                    new = [k for k, (p, q) in enumerate(zip(x.tolist(), y.tolist(), strict=True)) if trees.join(p, q + shift)]
                    x, y = x[new], y[new]
                else:
                    la, lb = a.column("label").to_numpy()[x], (b or a).column("label").to_numpy()[y]
                    x, y = x[la != lb], y[la != lb]
                left.append(np.minimum(na[x], nb[y]))
                right.append(np.maximum(na[x], nb[y]))
            if sum(map(len, left)) > 100_000:
                yield _pairs(left, right)
                left, right = [], []
        yield _pairs(left, right)

    dealt = cells.repartition("shingle", "i", "j").sortWithinPartitions("shingle", "i", "j")
    return dealt.mapInArrow(search, "a long, b long").distinct()


def _pairs(left: list[np.ndarray], right: list[np.ndarray]) -> pa.RecordBatch:
    empty = [np.empty(0, dtype=np.int64)]
    both = np.unique(np.stack([np.concatenate(left or empty), np.concatenate(right or empty)], axis=1), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0], pa.int64()), pa.array(both[:, 1], pa.int64())], names=["a", "b"])


def links(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """The pairs whose sets do link."""

    @F.arrow_udf("boolean")
    def linked(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for one, other in batches:
            overlap, na, nb = [], [], []
            for x, y in zip(_lists(one), _lists(other), strict=True):
                x, y = x.view(np.uint64), y.view(np.uint64)
                few, many = (x, y) if len(x) <= len(y) else (y, x)
                at = np.minimum(np.searchsorted(many, few), len(many) - 1)
                overlap.append(int((many[at] == few).sum()))
                na.append(len(x))
                nb.append(len(y))
            yield pa.array(rule.links(np.array(overlap, np.int64), np.array(na, np.int64), np.array(nb, np.int64)))

    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a"))
    other = sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"))
    both = pairs.join(one, "a").join(other, "b")
    return both.where(linked("set_a", "set_b")).select("a", "b")


def unsettled(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """``node`` and ``label`` of the nodes that may link with another component.

    Two nodes of a cell that could link are joined by that cell's tree.  If they are in
    two components, the tree leaves the component of either by a pair that did not link.
    So all nodes of components without such a pair are settled.
    """
    tops = [labels.select(F.col("node").alias(c), F.col("label").alias(f"label_{c}")) for c in ("a", "b")]
    named = pairs.join(tops[0], "a", "left").join(tops[1], "b", "left")
    named = named.select(F.coalesce("label_a", "a").alias("one"), F.coalesce("label_b", "b").alias("other"))
    met = named.where(F.col("one") != F.col("other")).select(F.explode(F.array("one", "other")).alias("label")).distinct()
    # a node that links with none is its own label
    alone = met.select(F.col("label").alias("node"), "label")
    return labels.join(met, "label").select("node", "label").unionByName(alone).distinct()


def linked_nodes(docs: DataFrame, text_column: str, rule: Rule, rows: DataFrame) -> DataFrame:
    """``node`` and ``label`` of the nodes that are linked with another."""
    early, late = Scratch(), Scratch()
    maybe = early.landed(candidates_by_first(rows, rule), "maybe")
    all_sets = early.landed(whole_sets(docs, text_column, rule, rows, maybe), "sets")
    likely = early.landed(candidates_by_all(all_sets, rule), "likely")
    sets = late.landed(all_sets.join(likely, "node", "left_semi"), "sets")
    early.clear()
    cells = late.landed(short_lists(sets, rule, early), "cells")
    early.clear()
    pairs = late.landed(close_pairs(cells, rule, forest=True), "pairs")
    found = landed(links(pairs, sets, rule), "links")
    labels = components(found)
    # written first, so that Spark knows how few they may be before it moves the cells
    named = cells.join(late.landed(unsettled(pairs, labels), "unsettled"), "node")
    across = landed(links(close_pairs(named, rule, forest=False), sets, rule), "links")
    late.clear()
    return components(found.unionByName(across)) if not across.isEmpty() else labels


def least_ids(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``node``, ``label`` of its component and ``component_id``, the least ``doc_id`` of the component's rows."""
    nodes = rows.where(F.col("node").isNotNull()).groupBy("node").agg(F.min("doc_id").alias("low"))
    named = nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    low = named.groupBy("label").agg(F.min("low").alias("component_id"))
    return named.join(low, "label").select("node", "label", "component_id")


def jaccard_join(
    docs: DataFrame, rule: Rule | None = None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Every document with the size of its set and the least id that its links reach."""
    rule = rule or Rule()
    rows = landed(text_nodes(docs, id_column, text_column, rule), "nodes")
    low = least_ids(rows, linked_nodes(docs, text_column, rule, rows))
    return rows.join(low, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def one_of_each(docs: DataFrame, rule: Rule, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row of ``docs`` of each component, with its own columns: that of the least id, then least node and text key.

    A null id counts only where its component has no other.  Documents without words stay.
    """
    rows = landed(text_nodes(docs, id_column, text_column, rule), "nodes")
    low = least_ids(rows, linked_nodes(docs, text_column, rule, rows))
    # chosen among narrow rows, so that texts move once
    named = rows.where(F.col("node").isNotNull()).select("doc_id", "text_key", "node").join(low, "node")
    least = named.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    stays = least.groupBy("label").agg(
        F.min_by(F.struct("doc_id", "text_key"), F.struct("node", "text_key")).alias("key"),
    )
    stays = stays.join(_repeated(least), F.col("key.text_key") == F.col("again"), "left")
    stays = landed(stays.select("key.doc_id", "key.text_key", F.col("again").isNotNull().alias("repeated")), "stays")
    text = text_of(text_column)
    bare = wrapped(docs.where(~text.rlike(WORD)))
    packed = wrapped(docs, _id=F.col(f"`{id_column}`"), _key=F.unhex(F.md5(text)))
    kept = packed.join(stays, (F.col("_key") == F.col("text_key")) & F.col("_id").eqNullSafe(F.col("doc_id")))
    alone = kept.where(~F.col("repeated"))
    one = kept.where("repeated").dropDuplicates(["_key"])
    return unwrapped(bare.unionByName(alone.select("row")).unionByName(one.select("row")), docs.columns)


def _repeated(rows: DataFrame) -> DataFrame:
    """``again``: keys of the texts that several rows have under one id."""
    counted = rows.groupBy("text_key", "doc_id").agg(F.count(F.lit(1)).alias("times"))
    return counted.where(F.col("times") > 1).select(F.col("text_key").alias("again")).distinct()


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS words FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(words) >= 3 THEN list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])
    WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS shingle FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pair AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b USING (shingle) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
link AS (
  SELECT a, b FROM pair JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 90 * (x.n + y.n - shared)
), reach AS (
  SELECT doc_id, doc_id AS other FROM documents UNION SELECT doc_id, b FROM reach JOIN link ON other = a
), least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM least LEFT JOIN n USING (doc_id)
"""
