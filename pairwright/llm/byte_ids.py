"""Ids of a byte-level BPE tokenizer file for many texts.

The tokenizer cuts a text into parts before it merges anything, and each place
where white space follows something else is a cut.  What lies between single
spaces can therefore be encoded by itself, and each distinct chunk once.  Texts
with other runs of spaces are cut at those places by pattern.

Chunks of plain characters are merged by ``tiktoken``, several times as fast,
over the very vocabulary of the tokenizer file: where every merge's result has a
higher id than the one before, ids are ranks and both give the same ids.  All
other chunks, and all chunks of other files, go through the tokenizer itself.
"""

from __future__ import annotations

import json
import re
from array import array

import numpy as np
import pyarrow as pa
import tiktoken
from tokenizers import Tokenizer

from pairwright.llm.words import ragged, sizes_in_bytes, space_words

# White space as the tokenizer's pattern knows it.
SPACES = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
CHUNKS = re.compile(f"[{SPACES}]*[^{SPACES}]+|[{SPACES}]+")
# Characters whose class all Unicode versions agree on; other chunks go through the whole tokenizer.
PLAIN = re.compile("[\\n\\x20-\\x7e\\u00c0-\\u017f]*")
# Fixed value: how a byte-level tokenizer of this kind cuts text.
PARTS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MEMO_ENTRIES = 1_000_000


def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte: printable Latin-1 itself, the rest from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}


def _ranks(path: str) -> dict[bytes, int] | None:
    """Bytes and id of every token, or None where ids do not follow the order of merges."""
    with open(path, encoding="utf-8") as file:
        described = json.load(file)
    model, cut = described["model"], described.get("pre_tokenizer") or {}
    if cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or described.get("normalizer"):
        return None
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    ids = [model["vocab"][a + b] for a, b in merges]
    special = {t["content"] for t in described["added_tokens"]}
    value = {letter: b for b, letter in _byte_letters().items()}
    if len(model["vocab"]) - len(special & set(model["vocab"])) != 256 + len(set(ids)) or ids != sorted(set(ids)):
        return None
    return {bytes(value[c] for c in token): i for token, i in model["vocab"].items() if token not in special}


def token_bytes(path: str) -> dict[int, bytes]:
    """The bytes of every token but the special ones, by id."""
    with open(path, encoding="utf-8") as file:
        described = json.load(file)
    special = {t["content"] for t in described["added_tokens"]}
    value = {letter: b for b, letter in _byte_letters().items()}
    return {i: bytes(value[c] for c in token) for token, i in described["model"]["vocab"].items() if token not in special}


class ByteIds:
    """Encodes texts; ids of chunks seen before come from memory of bounded size."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        ranks = _ranks(path)
        self.fast = ranks and tiktoken.Encoding("file", pat_str=PARTS, mergeable_ranks=ranks, special_tokens={})
        self.chunks: dict[str, bytes] = {}

    def chunk(self, chunk: str) -> bytes:
        """Ids of one chunk as little-endian 32-bit integers."""
        found = self.chunks.get(chunk)
        if found is None:
            if self.fast and PLAIN.fullmatch(chunk) and not any(s in chunk for s in self.special):
                ids = self.fast.encode_ordinary(chunk)
            else:
                ids = self.tokenizer.encode(chunk, add_special_tokens=False).ids
            found = array("I", ids).tobytes()
            if len(self.chunks) >= MEMO_ENTRIES:
                self.chunks.clear()
            self.chunks[chunk] = found
        return found

    def spell(self, chunks: list[str]) -> list[bytes]:
        """:meth:`chunk` of each chunk."""
        return [self.chunk(c) for c in chunks]

    def encode(self, texts: pa.Array, after_space: bool = False) -> list[np.ndarray]:
        """Ids of each text, or of each text with a space before it."""
        words = space_words(texts)
        codes, bounds = words.codes.astype(np.int64), words.bounds
        distinct = words.distinct.to_pylist()
        firsts = words.distinct.take(pa.array(codes[bounds[:-1]])).dictionary_encode()
        if not after_space:
            codes[bounds[:-1]] = len(distinct) + firsts.indices.to_numpy(zero_copy_only=False)
        spelled = self.spell([" " + w for w in distinct] + ([] if after_space else firsts.dictionary.to_pylist()))
        lengths = np.fromiter(map(len, spelled), np.int64, len(spelled)) // 4
        starts = np.cumsum(lengths) - lengths
        ids = np.frombuffer(b"".join(spelled), dtype="<u4")[ragged(starts[codes], lengths[codes])]
        ends = np.concatenate([[0], np.cumsum(lengths[codes])])[bounds]
        out = [ids[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
        # neighbouring, leading or trailing spaces: cut by pattern instead
        empty = np.array([w == "" for w in [*distinct, *firsts.dictionary.to_pylist()]])
        odd = np.add.reduceat(empty[codes], bounds[:-1]) > 0 if len(codes) else []
        for k in np.flatnonzero(odd & (sizes_in_bytes(texts) + after_space > 0)):
            chunks = CHUNKS.findall(" " * after_space + texts[int(k)].as_py())
            out[k] = np.frombuffer(b"".join(map(self.chunk, chunks)), dtype="<u4")
        return out
