import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from pairwright.llm import packing, piece_ids
from pairwright.llm.byte_ids import ByteIds
from pairwright.llm.piece_ids import PieceIds

BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def odd_texts():
    rng = random.Random(1)
    letters = "ab cdeéñ  \n\t.,'!<>|　 日本x1290_-ſK①Ａ\x00\x1c 🙂"
    syllables = ["th", "er", "ing", " ", "tion", "e", "an", " the", "  ", "▁", "\n", "'s", " 12"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(0, 40))) for _ in range(800)]
    texts += ["".join(rng.choice(syllables) for _ in range(rng.randrange(0, 30))) for _ in range(800)]
    return texts + ["", " ", "  ", " a", "a ", "<|endoftext|>", "x <|endoftext|> y", "a\n\n b\n  c \n d   e", "<s>", "▁▁"]


def test_byte_ids_are_the_tokenizers():
    texts = odd_texts()
    whole = Tokenizer.from_file(BYTES)
    for text, ids in zip(texts, ByteIds(BYTES).encode(pa.array(texts)), strict=True):
        assert ids.tolist() == whole.encode(text, add_special_tokens=False).ids, text


def test_piece_ids_are_the_librarys():
    texts = [t.replace("▁", " ") for t in odd_texts()]
    model, library = PieceIds(PIECES), SentencePieceProcessor(model_file=PIECES)
    for text, ids in zip(texts, model.encode(pa.array(texts)), strict=True):
        assert ids.tolist() == library.encode(text, add_bos=True, add_eos=True), text
        assert model.decode(ids) == library.decode(ids.tolist()).encode()


def test_prefix_table_agrees_with_merging():
    model = PieceIds(PIECES)
    rng = random.Random(2)
    for _ in range(500):
        text = "▁" + "".join(rng.choice("aeinorstlhéñ") for _ in range(rng.randrange(1, 25)))
        parts = []
        last, at = model.prefix_table(text), len(text)
        while at:
            parts.append(model.text[last[at]])
            at -= len(parts[-1])
        library = [model.text[i] for i in np.frombuffer(model.chunk(text), "<u4")]
        assert parts[::-1] == library


def test_piece_query_on_edge_rows(documents, edge_rows):
    library = SentencePieceProcessor(model_file=PIECES)
    got = piece_ids.piece_ids(documents(rows=edge_rows), PIECES).collect()
    want = []
    for doc_id, text, *_ in edge_rows:
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        raw = np.array(ids, dtype="<u4").tobytes()
        decoded = library.decode(ids).encode()
        want.append((doc_id, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(decoded).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert piece_ids.piece_ids(documents(), PIECES).count() == 0


@pytest.mark.parametrize("windows", [1, 2, 7, 40])
def test_differencing_fills_windows_evenly(windows):
    lengths = np.random.default_rng(4).integers(1, 500, 400)
    found = packing.differencing(lengths, windows)
    sums = np.bincount(found, weights=lengths, minlength=windows)
    assert sums.sum() == lengths.sum() and len(sums) == windows
    assert sums.max() - sums.min() <= 0.05 * sums.mean()


def test_groups_never_exceed_their_capacity():
    rng = np.random.default_rng(5)
    for _ in range(20):
        lengths = rng.integers(1, 2048, rng.integers(1, 60))
        found = packing.pack_group(lengths, 2048)
        assert np.bincount(found, weights=lengths).max() <= 2048


def test_every_id_lies_in_one_piece(documents, edge_rows):
    whole = Tokenizer.from_file(BYTES)
    got = packing.packing(documents(rows=edge_rows), BYTES, group_pieces=16).collect()
    windows, by_doc = {}, {}
    for r in got:
        windows.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        by_doc.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], r["length"], r["ids_crc32"]))
    for pieces in windows.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= packing.CAPACITY
    for doc_id, text, *_ in edge_rows:
        ids = whole.encode(text or "", add_special_tokens=False).ids + [1]
        raw = np.array(ids, dtype="<u4").tobytes()
        cut = packing.cuts(len(ids), packing.CAPACITY, packing.PIECE)
        want = [(a, b - a, zlib.crc32(raw[4 * a : 4 * b])) for a, b in zip(cut[:-1], cut[1:], strict=True)]
        for piece in want:
            by_doc[(doc_id, len(ids))].remove(piece)
    assert not any(by_doc.values())
    assert packing.packing(documents(), BYTES).count() == 0


def test_whole_windows_stay_out_of_the_groups(documents):
    long = " ".join(f"word{k % 977}" for k in range(20_000))
    got = packing.packing(documents([long, "short", None, long + " end"]), BYTES).collect()
    whole = [r for r in got if r["length"] == packing.CAPACITY]
    assert len(whole) > 20
    assert all(r["sequence_id"] >= packing.WHOLE_IDS and r["offset"] == 0 for r in whole)
    assert len({r["sequence_id"] for r in whole}) == len(whole)
    assert all(r["sequence_id"] < packing.WHOLE_IDS for r in got if r["length"] < packing.CAPACITY)
    for k in range(4):
        of_doc = sorted((r["start"], r["length"], r["doc_tokens"]) for r in got if r["doc_id"] == k)
        ends = [s + n for s, n, _ in of_doc]
        assert [s for s, *_ in of_doc] == [0, *ends[:-1]] and ends[-1] == of_doc[0][2]
