"""Hashed character n-grams of many words at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from pairwright.llm.words import sizes_in_bytes

OPEN, CLOSE = 0x3C, 0x3E
EDGES = ".,;:!?\"'()[]{}*#$%&|-"


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit values with every bit depending on every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def framed(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All words' bytes between an opening and a closing byte, and each byte's word."""
    sizes = sizes_in_bytes(words)
    raw = np.frombuffer(b"".join(words.cast(pa.binary()).to_pylist()), dtype=np.uint8)
    owner = np.repeat(np.arange(len(words)), sizes + 2)
    starts = np.cumsum(sizes + 2) - (sizes + 2)
    out = np.empty(len(owner), dtype=np.uint8)
    inside = np.ones(len(owner), dtype=bool)
    inside[starts] = inside[starts + sizes + 1] = False
    out[inside] = raw
    out[starts], out[starts + sizes + 1] = OPEN, CLOSE
    return out, owner


def ngrams(words: pa.Array, lengths: range, whole: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words' byte n-grams, and each hash's word; with ``whole``, one for each word as well."""
    raw, owner = framed(words)
    wide = raw.astype(np.uint64)
    hashes, owners = [], []
    rolling = np.zeros(len(raw), dtype=np.uint64)
    for n in range(1, lengths.stop):
        if len(raw) < n:
            break
        # rolling[i] covers the n bytes from i on
        rolling = rolling[: len(raw) - n + 1] * np.uint64(0x100000001B3) + wide[n - 1 :] + np.uint64(1)
        if n >= lengths.start:
            same = owner[: len(rolling)] == owner[n - 1 :]
            hashes.append(mixed(rolling[same] + np.uint64(n)))
            owners.append(owner[: len(rolling)][same])
    if whole and len(words):
        # a word's own hash: the sum of its bytes' mixed values, each with its place
        starts = np.searchsorted(owner, np.arange(len(words)))
        place = np.arange(len(raw)) - starts[owner]
        each = mixed(wide * np.uint64(0x9E3779B97F4A7C15) + place.astype(np.uint64))
        hashes.append(mixed(np.add.reduceat(each, starts)))
        owners.append(np.arange(len(words)))
    if not hashes:
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    return np.concatenate(hashes), np.concatenate(owners)
