"""SentencePiece encoding and decoding by a table of prefixes.

A merge-type model encodes every prefix of a text in one way, so each prefix has
one last token, and the table of last tokens holds the encoding of them all.  An
automaton of all pieces gives the pieces that end at a position.  The right one
is the only piece whose start has a last token it is compatible with: the two,
side by side, must encode to themselves.  Ids are then read backwards from the
end.  Characters that no piece holds become byte pieces and part the text.

Pieces hold the space mark only at their start, so a text falls into chunks at
its spaces and each distinct chunk is encoded once.  A model for which that is
not so is encoded text by text, through the same table.

Defined cases: a null text counts as empty, which gives the begin and end ids
alone; the space mark in a text counts as a space, as it does in the library.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from sentencepiece import SentencePieceProcessor

from pairwright.llm.words import filled, ragged, slices, space_words

MARK = "▁"
MEMO_ENTRIES = 1_000_000
RUNS = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


class PieceIds:
    """A merge-type model with byte pieces, its table of prefixes and its decoder."""

    def __init__(self, path: str):
        model = SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.begin, self.end = model.bos_id(), model.eos_id()
        self.bytes = [0] * 256
        self.score: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.text: list[str] = [model.id_to_piece(i) for i in range(size)]
        decoded: list[bytes] = []
        for i, piece in enumerate(self.text):
            if model.is_byte(i):
                value = int(piece[1:-1], 16)
                self.bytes[value] = i
                decoded.append(bytes([value]))
            elif model.is_control(i) or model.is_unknown(i):
                decoded.append(b"")
            else:
                self.score[piece], self.id[piece] = model.get_score(i), i
                decoded.append(piece.replace(MARK, " ").encode())
        self.decoded = np.frombuffer(b"".join(decoded), dtype=np.uint8)
        self.decoded_length = np.array([len(d) for d in decoded], dtype=np.int64)
        self.decoded_start = np.cumsum(self.decoded_length) - self.decoded_length
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.id.items():
            self.automaton.add_word(piece, (len(piece), i))
        self.automaton.make_automaton()
        self.parted = not any(MARK in piece.lstrip(MARK) for piece in self.id)
        self.pairs: dict[tuple[int, int], bool] = {}
        self.made: dict[int, list[tuple[float, str, str]]] = {}
        self.chunks: dict[str, bytes] = {}

    def merging(self, text: str) -> list[tuple[float, str, str]]:
        """The merges of a text in their order, the best pair first, of equals the leftmost.

        Each is the score with the first and the last part that it leaves.
        """
        parts, score, steps = list(text), self.score, []
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                value = score.get(parts[k] + parts[k + 1])
                if value is not None and (best is None or value > best):
                    best, at = value, k
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            steps.append((best, parts[0], parts[-1]))
        return steps

    def steps(self, piece: int) -> list[tuple[float, str, str]]:
        """The merges that make a piece, begun by its bare ends; the last leaves the whole piece, if it encodes to itself."""
        found = self.made.get(piece)
        if found is None:
            text = self.text[piece]
            found = self.made[piece] = [(0.0, text[0], text[-1]), *self.merging(text)]
        return found

    def encodes_itself(self, piece: int) -> bool:
        return len(self.steps(piece)) == len(self.text[piece])

    def compatible(self, left: int, right: int) -> bool:
        """Whether two pieces that encode to themselves still do side by side.

        The merges of both sides are replayed in the order in which they would
        happen together; the pieces are not compatible if at some point the two
        parts that touch would be merged first.
        """
        key = (left, right)
        found = self.pairs.get(key)
        if found is None:
            a, b, i, j = self.steps(left), self.steps(right), 0, 0
            found = self.encodes_itself(left) and self.encodes_itself(right)
            while found:
                across = self.score.get(a[i][2] + b[j][1])
                next_a = a[i + 1][0] if i + 1 < len(a) else None
                next_b = b[j + 1][0] if j + 1 < len(b) else None
                if across is not None and (next_a is None or across > next_a) and (next_b is None or across >= next_b):
                    found = False
                elif next_a is None and next_b is None:
                    break
                elif next_b is None or (next_a is not None and next_a >= next_b):
                    i += 1
                else:
                    j += 1
            if len(self.pairs) >= 2 * MEMO_ENTRIES:
                self.pairs.clear()
            self.pairs[key] = found
        return found

    def prefix_table(self, text: str) -> list[int]:
        """The last token of every prefix: a piece's id, or -1 after a character that no piece holds."""
        last, pairs = [-1] * (len(text) + 1), self.pairs
        for end, (length, piece) in self.automaton.iter(text):
            if last[end + 1] >= 0:
                continue
            before = last[end + 1 - length]
            if before < 0:
                right = self.encodes_itself(piece)
            else:
                right = pairs.get((before, piece))
                if right is None:
                    right = self.compatible(before, piece)
            if right:
                last[end + 1] = piece
        return last

    def chunk(self, text: str) -> bytes:
        """Ids of a text that stands by itself, as little-endian 32-bit integers."""
        found = self.chunks.get(text)
        if found is None:
            last, at, ids = self.prefix_table(text), len(text), []
            while at:
                piece = last[at]
                if piece >= 0:
                    ids.append(piece)
                    at -= len(self.text[piece])
                else:
                    at -= 1
                    ids.extend(self.bytes[b] for b in reversed(text[at].encode()))
            found = array("I", ids[::-1]).tobytes()
            if len(self.chunks) >= MEMO_ENTRIES:
                self.chunks.clear()
            self.chunks[text] = found
        return found

    def spell(self, words: list[str]) -> list[bytes]:
        """:meth:`chunk` of each word, with the space before it."""
        return [self.chunk(MARK + w) for w in words]

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text with the begin and end ids; texts hold no space mark."""
        words = space_words(texts)
        distinct = words.distinct.to_pylist()
        spelled = self.spell(distinct) if self.parted else []
        odd = np.full(len(texts), not self.parted)
        out: list[np.ndarray] = [np.empty(0, dtype="<u4")] * len(texts)
        if self.parted:
            lengths = np.fromiter(map(len, spelled), np.int64, len(spelled)) // 4
            starts = np.cumsum(lengths) - lengths
            ids = np.frombuffer(b"".join(spelled), dtype="<u4")[ragged(starts[words.codes], lengths[words.codes])]
            ends = np.concatenate([[0], np.cumsum(lengths[words.codes])])[words.bounds]
            out = [ids[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
            empty = np.array([w == "" for w in distinct])
            if len(words.codes):
                odd = np.add.reduceat(empty[words.codes], words.bounds[:-1]) > 0
        for k in np.flatnonzero(odd):
            text = texts[int(k)].as_py()
            whole = MARK + text.replace(" ", MARK) if text else ""
            chunks = RUNS.findall(whole) if self.parted else [whole]
            out[k] = np.frombuffer(b"".join(map(self.chunk, chunks)), dtype="<u4")
        frame = (np.array([self.begin], dtype="<u4"), np.array([self.end], dtype="<u4"))
        return [np.concatenate([frame[0], ids, frame[1]]) for ids in out]

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of some ids, in UTF-8: without the space that encoding puts first."""
        raw = self.decoded[ragged(self.decoded_start[ids], self.decoded_length[ids])].tobytes()
        return raw[1:] if raw.startswith(b" ") else raw


def piece_ids(docs: DataFrame, model_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Ids and decoded text of every document, as a count and two digests."""
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    schema = T.StructType(
        [
            T.StructField("doc_id", rows.schema["doc_id"].dataType),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_sha256", T.StringType()),
            T.StructField("decoded_sha256", T.StringType()),
        ]
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = PieceIds(model_path)
        for batch in batches:
            texts = pc.replace_substring(filled(batch.column("text")), MARK, " ")
            for part, some in slices(batch, texts):
                found = model.encode(filled(some))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([len(ids) for ids in found], pa.int64()),
                        pa.array([hashlib.sha256(ids.tobytes()).hexdigest() for ids in found], pa.string()),
                        pa.array([hashlib.sha256(model.decode(ids)).hexdigest() for ids in found], pa.string()),
                    ],
                    names=schema.names,
                )

    return rows.mapInArrow(encode, schema)
