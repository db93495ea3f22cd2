"""Arrow and numpy helpers for texts inside a task."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Texts are taken in slices of about this many bytes, so that a task's memory
# does not follow the size of the batches it is given.
SLICE_BYTES = 8 << 20


def sizes_in_bytes(texts: pa.Array) -> np.ndarray:
    return pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)


def slices(batch: pa.RecordBatch, texts: pa.Array, most_bytes: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Consecutive parts of a batch, each of few bytes of text (or of a single text)."""
    if not batch.num_rows:
        return
    part = np.cumsum(sizes_in_bytes(texts)) // most_bytes
    starts = np.flatnonzero(np.diff(part, prepend=part[0] - 1))
    for start, stop in zip(starts, [*starts[1:], batch.num_rows], strict=True):
        yield batch.slice(start, stop - start), texts.slice(start, stop - start)


def filled(texts: pa.Array) -> pa.Array:
    """Texts with nulls made empty, as a flat array without an offset of its own."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    return pa.concat_arrays([pc.fill_null(texts, "")])


def tidied(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``work`` on batches, after which freed memory goes back to the system.

    Spark keeps its Python workers for later tasks; what one has freed but not
    returned counts against the executor for as long.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)

    return run


class Words:
    """The words of some texts: ``codes`` into ``distinct``, and where each text's codes begin."""

    def __init__(self, parts: pa.Array):
        flat = parts.flatten().dictionary_encode()
        self.distinct = flat.dictionary
        self.codes = flat.indices.to_numpy(zero_copy_only=False)
        self.bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(parts).to_numpy(zero_copy_only=False))]).astype(
            np.int64
        )

    def without_empty(self) -> Words:
        """The same words, those of no character left out."""
        empty = np.flatnonzero(sizes_in_bytes(self.distinct) == 0)
        if len(empty):
            self._kept(self.codes != empty[0])
        return self

    def _kept(self, keep: np.ndarray) -> Words:
        before = np.concatenate([[0], np.cumsum(keep)])
        self.codes, self.bounds = self.codes[keep], before[self.bounds]
        return self

    def without_runs(self) -> Words:
        """The same words, of each run of one word in a text only the first."""
        keep = np.diff(self.codes, prepend=-1) != 0
        starts = self.bounds[:-1]
        keep[starts[starts < len(keep)]] = True
        return self._kept(keep)


def white_space_words(texts: pa.Array) -> Words:
    """Runs of characters other than the ASCII white space ``[\\x20\\x09-\\x0D]``."""
    return Words(pc.ascii_split_whitespace(texts)).without_empty()


def space_words(texts: pa.Array) -> Words:
    """What lies between single spaces; neighbouring spaces give empty words."""
    return Words(pc.split_pattern(texts, " "))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indexes of the elements of many runs, one run after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)
