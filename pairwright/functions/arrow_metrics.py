"""Dynamic-programming string metrics as Arrow UDFs.

Spark has no expression for these.  Each UDF takes whole Arrow batches: common
subsequences of short texts are worked out for all pairs of a batch at once, the
rest by a small helper per pair.  Spark still partitions and shuffles the work.
"""

from __future__ import annotations

import sys
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType

# Ship the helpers inside the task, so executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _subsequence_length(masks: dict[str, int], width: int, other: str) -> int:
    """Common subsequence length, one bit per character of the masked side."""
    full = (1 << width) - 1
    row = full
    for ch in other:
        hit = row & masks.get(ch, 0)
        row = ((row + hit) | (row - hit)) & full
    return width - row.bit_count()


def _positions(text: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for place, ch in enumerate(text):
        masks[ch] = masks.get(ch, 0) | (1 << place)
    return masks


def subsequence_length(left: str, right: str) -> int:
    return _subsequence_length(_positions(left), len(left), right)


# Texts of at most so many characters are worked out together, one bit for each; so many pairs at a time.
WORD = 64
TOGETHER = 4096


def _code_points(texts: list[str], padding: int) -> np.ndarray:
    """One row of code points per text, filled up with ``padding``."""
    lengths = np.array([len(t) for t in texts])
    flat = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.int32)
    rows = np.full((len(texts), max(int(lengths.max(initial=0)), 1)), padding, dtype=np.int32)
    rows[np.arange(rows.shape[1]) < lengths[:, None]] = flat
    return rows


def subsequence_lengths(left: list[str], right: list[str]) -> list[int]:
    """:func:`subsequence_length` of many pairs, all at once where one side of a pair fits a machine word."""
    sides = [(a, b) if len(a) <= len(b) else (b, a) for a, b in zip(left, right, strict=True)]
    out = np.zeros(len(sides), dtype=np.int64)
    # pairs of like lengths together, so that little is padding
    order = sorted(range(len(sides)), key=lambda k: (len(sides[k][1]), len(sides[k][0])))
    short = [k for k in order if len(sides[k][0]) <= WORD]
    for k in order:
        if len(sides[k][0]) > WORD:
            out[k] = subsequence_length(*sides[k])
    for at in range(0, len(short), TOGETHER):
        some = short[at : at + TOGETHER]
        out[some] = _word_lengths([sides[k][0] for k in some], [sides[k][1] for k in some])
    return out.tolist()


def _word_lengths(masked: list[str], other: list[str]) -> np.ndarray:
    """Common subsequence lengths; the masked side has one bit per character."""
    a, b = _code_points(masked, -1), _code_points(other, -2)
    bits = np.zeros((len(masked), WORD), dtype=bool)
    rows = np.full(len(masked), ~np.uint64(0))
    for j in range(b.shape[1]):
        bits[:, : a.shape[1]] = a == b[:, j : j + 1]
        hit = rows & np.packbits(bits, axis=1, bitorder="little").view(np.uint64)[:, 0]
        rows = (rows + hit) | (rows - hit)
    return WORD - np.bitwise_count(rows).astype(np.int64)


def window_subsequences(short: str, long: str) -> np.ndarray:
    """Common subsequence length of ``short`` with each window of ``long`` of the same length.

    All windows come from one braid: a strand enters from every character of
    either text, and where two meet they cross unless the characters agree or
    they have crossed before.  A strand that enters and leaves inside a window is
    a character of the window that is not common.  The meetings on one diagonal
    do not touch, so each diagonal is one step over arrays.
    """
    m, n = len(short), len(long)
    a = np.frombuffer(short[::-1].encode("utf-32-le"), dtype=np.int32)
    b = np.frombuffer(long.encode("utf-32-le"), dtype=np.int32)
    rows, columns = np.arange(m, dtype=np.int32), np.arange(m, m + n, dtype=np.int32)
    for diagonal in range(m + n - 1):
        last, first = min(m - 1, diagonal), max(0, diagonal - n + 1)
        h, v = rows[m - 1 - last : m - first], columns[diagonal - last : diagonal - first + 1]
        apart = (a[m - 1 - last : m - first] == b[diagonal - last : diagonal - first + 1]) | (h > v)
        turned = (h ^ v) * apart
        h ^= turned
        v ^= turned
    # the strand that leaves at place r came in at c; windows that start after r - m and not after c hold both
    left = np.flatnonzero(columns >= m)
    came = columns[left] - m
    start, stop = np.maximum(left - m + 1, 0), np.minimum(came, n - m) + 1
    inside = start < stop
    change = np.bincount(start[inside], minlength=n - m + 2) - np.bincount(stop[inside], minlength=n - m + 2)
    return m - np.cumsum(change)[: n - m + 1]


# From so many characters of the shorter text times windows on, the braid is faster than a look at each window.
BRAID_WORK = 5_000


def window_ratio(left: str, right: str) -> int:
    """Best 0-100 ratio of the shorter text over every window of the longer."""
    short, long = (left, right) if len(left) <= len(right) else (right, left)
    if short == long or (short and short in long):
        return 100
    if not short:
        return 0
    width = len(short)
    if width * (len(long) - width + 1) >= BRAID_WORK:
        return round(100 * (int(window_subsequences(short, long).max()) / width))
    return round(100 * (_best_window(short, long) / width))


def _best_window(short: str, long: str) -> int:
    """The longest common subsequence of the shorter text with a window, window by window."""
    width = len(short)
    masks = _positions(short)
    # Common characters of the window, whatever their order, bound its common
    # subsequence; they change by one character out and one in per step.
    wanted = Counter(short)
    held = Counter(long[:width])
    shared = sum(min(n, held[ch]) for ch, n in wanted.items())
    best = 0
    for start in range(len(long) - width + 1):
        if start:
            out, into = long[start - 1], long[start + width - 1]
            shared -= held[out] <= wanted[out]
            held[out] -= 1
            held[into] += 1
            shared += held[into] <= wanted[into]
        if shared > best:
            best = max(best, _subsequence_length(masks, width, long[start : start + width]))
            if best == width:
                break
    return best


def winkler(left: str, right: str) -> float:
    """Jaro-Winkler: prefix up to four, scale 0.1, boost from Jaro 0.7 up."""
    if left == right:
        return 1.0
    if not left or not right:
        return 0.0
    reach = max(max(len(left), len(right)) // 2 - 1, 0)
    used = [False] * len(right)
    matched_left = []
    # Places of each character on the right; those that fell behind are not looked at again.
    places: dict[str, list[int]] = {}
    for j, ch in enumerate(right):
        places.setdefault(ch, []).append(j)
    following = dict.fromkeys(places, 0)
    for i, ch in enumerate(left):
        at = places.get(ch)
        if at is None:
            continue
        k = following[ch]
        while k < len(at) and at[k] < i - reach:
            k += 1
        if k < len(at) and at[k] <= i + reach:
            used[at[k]] = True
            matched_left.append(ch)
            k += 1
        following[ch] = k
    matches = len(matched_left)
    if not matches:
        return 0.0
    matched_right = [ch for ch, taken in zip(right, used) if taken]
    swapped = sum(a != b for a, b in zip(matched_left, matched_right)) // 2
    jaro = (matches / len(left) + matches / len(right) + (matches - swapped) / matches) / 3
    if jaro < 0.7:
        return jaro
    prefix = 0
    for a, b in zip(left[:4], right[:4]):
        if a != b:
            break
        prefix += 1
    return jaro + 0.1 * prefix * (1 - jaro)


def one_by_one(helper):
    """A helper of two texts as one of many pairs."""

    def each(left: list[str], right: list[str]) -> list:
        return [helper(a, b) for a, b in zip(left, right, strict=True)]

    each.__name__ = helper.__name__
    return each


def _over_pairs(helper, left: pa.Array, right: pa.Array, kind: pa.DataType) -> pa.Array:
    """The helper's results, asked for the distinct pairs of the batch; null on a null side."""
    pairs = pa.table({"l": left, "r": right}).group_by(["l", "r"], use_threads=False).aggregate([])
    asked = [p for p in zip(pairs["l"].to_pylist(), pairs["r"].to_pylist(), strict=True) if None not in p]
    known = dict(zip(asked, helper([a for a, _ in asked], [b for _, b in asked]), strict=True))
    return pa.array([known.get(pair) for pair in zip(left.to_pylist(), right.to_pylist(), strict=True)], kind)


def _once(helper, spark_type, kind: pa.DataType):
    """A UDF over two texts that Spark evaluates once per row.

    It is marked as not deterministic, though it is: else a filter on its result
    is pushed below it and evaluates it a second time.
    """

    def score(left: pa.Array, right: pa.Array) -> pa.Array:
        return _over_pairs(helper, left, right, kind)

    score.__name__ = helper.__name__
    return F.arrow_udf(score, spark_type).asNondeterministic()


common_subsequence = _once(subsequence_lengths, IntegerType(), pa.int32())
best_window_ratio = _once(one_by_one(window_ratio), IntegerType(), pa.int32())
jaro_winkler = _once(one_by_one(winkler), DoubleType(), pa.float64())
