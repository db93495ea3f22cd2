"""Packing: documents cut into pieces, pieces dealt to token windows by differencing.

A document's ids end with one closing id.  Whole windows of them are cut off
first, each a sequence of its own that no group sees; what is left is cut into pieces of at most ``piece`` ids.  The pieces are
dealt at random to groups of bounded size, and each group is packed by
Karmarkar-Karp differencing into as many windows as its ids need: partial
partitions are merged, the two with the largest spread first, so that the fuller
windows of one meet the emptier ones of the other.  The windows come out nearly
equal.  If one exceeds the capacity, the number of windows rises and the group
is packed again.

Tokenizing is the one pass over the texts; what is packed is a table of lengths,
written to the shared folder in between.  No group is collected beyond its
bounded number of pieces, whatever the size of a document or source.

Defined cases: a null or empty text is its closing id alone; repeated rows are
packed as often as they occur; ids of documents may be null; an empty table
gives an empty result.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairwright.llm.byte_ids import ByteIds
from pairwright.llm.frames import landed
from pairwright.llm.words import filled, slices

CAPACITY = 2048
PIECE = 512
GROUP_PIECES = 1024
# Sequences that are one whole window are numbered from here, those of the groups below.
WHOLE_IDS = 1 << 62
CLOSING_ID = 1


def differencing(lengths: np.ndarray, windows: int) -> np.ndarray:
    """The window of each length when ``windows`` windows are made as equal as differencing makes them."""
    if windows == 1:
        return np.zeros(len(lengths), dtype=np.int64)
    # A partition is its windows' sums less the least of them, fullest first.
    sums: list[np.ndarray] = []
    for n in lengths:
        one = np.zeros(windows, dtype=np.int64)
        one[0] = n
        sums.append(one)
    heap = [(-int(n), k) for k, n in enumerate(lengths)]
    heapq.heapify(heap)
    merges: list[tuple[int, int, np.ndarray]] = []
    while len(heap) > 1:
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        both = sums[a] + sums[b][::-1]
        order = np.argsort(-both, kind="stable")
        both = both[order]
        both -= both[-1]
        sums[a] = sums[b] = order  # free the sums; an index stands for a partition from now on
        merges.append((a, b, order))
        sums.append(both)
        heapq.heappush(heap, (-int(both[0]), len(sums) - 1))
    # Windows of the last partition, followed back to the single lengths.
    place: dict[int, np.ndarray] = {len(sums) - 1: np.arange(windows)}
    for k in range(len(merges) - 1, -1, -1):
        a, b, order = merges[k]
        mine = place.pop(len(lengths) + k)
        left, right = np.empty(windows, dtype=np.int64), np.empty(windows, dtype=np.int64)
        left[order] = mine
        right[windows - 1 - order] = mine
        place[a], place[b] = left, right
    return np.array([place[k][0] for k in range(len(lengths))], dtype=np.int64)


def pack_group(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The window of each length; no window holds more than ``capacity``."""
    windows = max(1, -(-int(lengths.sum()) // capacity))
    while True:
        if windows >= len(lengths):
            return np.arange(len(lengths))
        found = differencing(lengths, windows)
        if np.bincount(found, weights=lengths).max() <= capacity:
            return found
        windows += max(1, windows // 200)


def cuts(tokens: int, capacity: int, piece: int) -> list[int]:
    """Where the pieces of a document begin, and its end."""
    whole = tokens // capacity * capacity
    starts = list(range(0, whole, capacity))
    rest = tokens - whole
    parts = -(-rest // piece)
    return starts + [whole + rest * k // parts for k in range(parts)] + [tokens]


def pieces(
    docs: DataFrame, tokenizer_path: str, id_column: str, text_column: str, capacity: int, piece: int
) -> DataFrame:
    """One row per piece with a random ``salt``."""
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    schema = T.StructType(
        [
            T.StructField("doc_id", rows.schema["doc_id"].dataType),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
            T.StructField("doc_tokens", T.LongType()),
            T.StructField("salt", T.LongType()),
        ]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = ByteIds(tokenizer_path)
        rng = np.random.default_rng(TaskContext.get().partitionId())
        close = np.array([CLOSING_ID], dtype="<u4")
        for batch in batches:
            for part, texts in slices(batch, filled(batch.column("text"))):
                row, start, length, crc, tokens = [], [], [], [], []
                for k, found in enumerate(ids.encode(texts)):
                    found = np.concatenate([found, close])
                    raw, at = memoryview(found.tobytes()), cuts(len(found), capacity, piece)
                    for a, b in zip(at[:-1], at[1:], strict=True):
                        row.append(k)
                        start.append(a)
                        length.append(b - a)
                        crc.append(zlib.crc32(raw[4 * a : 4 * b]))
                        tokens.append(len(found))
                yield pa.RecordBatch.from_arrays(
                    [
                        pc.take(part.column("doc_id"), pa.array(row, pa.int64())),
                        *(pa.array(x, pa.int64()) for x in (start, length, crc, tokens)),
                        pa.array(rng.integers(0, 1 << 62, len(row))),
                    ],
                    names=schema.names,
                )

    return rows.mapInArrow(cut, schema)


def packing(
    docs: DataFrame,
    tokenizer_path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    capacity: int = CAPACITY,
    piece: int = PIECE,
    group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """Every piece of every document with its sequence and its place there."""
    found = landed(pieces(docs, tokenizer_path, id_column, text_column, capacity, piece), "pieces")
    partial = found.where(F.col("length") < capacity)
    groups = max(1, -(-partial.count() // group_pieces))
    carried = [f for f in found.schema if f.name != "salt"]
    names = [f.name for f in carried]
    schema = T.StructType(
        carried
        + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )

    def pack(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        length = rows.column("length").to_numpy()
        window = pack_group(length, capacity)
        order = np.argsort(window, kind="stable")
        rows, window, length = rows.take(pa.array(order)), window[order], length[order]
        end = np.cumsum(length)
        first = np.diff(window, prepend=-1) != 0
        offset = end - length - np.repeat((end - length)[first], np.diff(np.append(np.flatnonzero(first), len(window))))
        sequence = (key[0].as_py() << 32) + window
        out = rows.select(names)
        return out.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    grouped = partial.withColumn("pack_group", F.pmod(F.col("salt"), F.lit(groups)))
    whole = found.where(F.col("length") >= capacity).select(
        *names,
        (F.lit(WHOLE_IDS) + F.monotonically_increasing_id()).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    return grouped.groupBy("pack_group").applyInArrow(pack, schema).unionByName(whole)
