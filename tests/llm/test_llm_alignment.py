import hashlib
import random
from collections import Counter

import public_tokenizers
import pyarrow.parquet as pq
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from pairwright.llm import alignment

BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def letters_of_bytes():
    """The byte that each letter of a byte-level vocabulary stands for."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    found, more = {chr(b): b for b in printable}, 256
    for b in range(256):
        if b not in printable:
            found[chr(more)] = b
            more += 1
    return found


def expected(rows):
    """The contract, token by token, with the libraries."""
    a_library = Tokenizer.from_file(BYTES)
    a_library.encode_special_tokens = True
    b_library = SentencePieceProcessor(model_file=PIECES)
    value = letters_of_bytes()

    def piece(i):
        text = b_library.id_to_piece(i)
        return bytes([int(text[3:5], 16)]) if b_library.is_byte(i) else text.replace("▁", " ").encode()

    found, counts = [], Counter()
    for doc_id, text, *_ in rows:
        whole = (" " + (text or "")).encode()
        a = a_library.encode(" " + (text or ""), add_special_tokens=False)
        a = [(i, bytes(value[c] for c in a_library.id_to_token(i))) for i in a.ids]
        b = [(i, piece(i)) for i in b_library.encode(text or "")]
        if not text or b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
            found.append((doc_id, [], [], "", []))
            continue
        ends = []
        for tokens in (a, b):
            at, of = 0, {}
            for i, raw in tokens:
                at += len(raw)
                of[at] = i
            ends.append(of)
        common = sorted(set(ends[0]) & set(ends[1]))
        links = [(ends[0][e], ends[1][e]) for e in common]
        counts.update(links)
        sides = [[[]], [[]]]
        for side, of in zip(sides, ends, strict=True):
            for end, i in of.items():
                side[-1].append(str(i))
                if end in ends[0] and end in ends[1]:
                    side.append([])
        groups = [",".join(x) + "|" + ",".join(y) for x, y in zip(*(side[:-1] for side in sides), strict=True)]
        found.append((doc_id, a, b, hashlib.sha256(";".join(groups).encode()).hexdigest(), links))
    highest = Counter()
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    return sorted(
        (
            (d, len(a), len(b), len(links), len(links), sum(counts[x] == highest[x[1]] for x in links), sum(counts[x] for x in links), digest)
            for d, a, b, digest, links in found
        ),
        key=str,
    )


def found(docs):
    columns = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return sorted(map(tuple, alignment.alignment(docs, BYTES, PIECES).select(*columns).collect()), key=str)


def odd_texts():
    rng = random.Random(8)
    letters = "ab cdeéñ  \n\t.,'!<>|　 日本x1290_-ſK①Ａ\x00\x1c 🙂"
    syllables = ["th", "er", "ing", " ", "tion", "e", "an", " the", "  ", "\n", "'s", " 12", "<|endoftext|>", "<s>", "</s>", "<0x41>", "<unk>"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(0, 40))) for _ in range(250)]
    texts += ["".join(rng.choice(syllables) for _ in range(rng.randrange(0, 30))) for _ in range(250)]
    return texts + ["▁", "a▁b", " ", "  ", " a", "a ", "a" * 3_000, "the " * 2_000]


def test_alignment_is_that_of_the_contract(documents):
    texts = odd_texts()
    assert found(documents(texts)) == expected(list(enumerate(texts)))


def test_slices_only_part_the_work(documents, monkeypatch):
    texts = odd_texts()[::5]
    whole = found(documents(texts))
    monkeypatch.setattr(alignment, "SLICE_BYTES", 200)
    sliced = alignment.aligned_slices(documents(texts), BYTES, PIECES)
    assert sliced.count() > 10
    assert found(documents(texts)) == whole == expected(list(enumerate(texts)))


def test_edge_rows(documents, edge_rows):
    assert found(documents(rows=edge_rows)) == expected(edge_rows)
    assert found(documents()) == []
    assert found(documents(["", None])) == [(0, 0, 0, 0, 0, 0, 0, ""), (1, 0, 0, 0, 0, 0, 0, "")]


def test_counts_are_of_the_whole_corpus(documents):
    counts = alignment.pair_counts(alignment.aligned_slices(documents(["the the", "the"] * 3), BYTES, PIECES)).collect()
    assert sorted(r["count"] for r in counts) == [9] and all(r["best"] for r in counts)


def test_no_list_of_a_tasks_slices_is_held(documents):
    """Rows are sorted by slice, on disk if need be; a list per slice was kept for all slices of a task at once."""
    result = alignment.alignment(documents(["one two three", "two three four"]), BYTES, PIECES)
    plan = result._jdf.queryExecution().toString()
    assert "collect_list" not in plan and "CoGroups" in plan


def test_slices_are_read_a_few_at_a_time(documents, monkeypatch, tmp_path):
    """Spark reads a row group at once, so one with a hundred slices of megabytes fills the memory."""
    monkeypatch.setattr(alignment, "SLICE_BYTES", 20_000)
    rng = random.Random(5)
    texts = [" ".join(str(rng.random()) for _ in range(1000)) for _ in range(60)]
    sliced = alignment.aligned_slices(documents(texts).coalesce(1), BYTES, PIECES)
    sizes = {}
    for name, options in (("plain", {}), ("bounded", {**alignment.ROW_GROUPS, "parquet.block.size": str(1 << 20)})):
        sliced.write.options(**options).parquet(f"{tmp_path}/{name}")
        files = [pq.ParquetFile(p) for p in (tmp_path / name).glob("*.parquet")]
        sizes[name] = max(f.metadata.row_group(k).num_rows for f in files for k in range(f.metadata.num_row_groups))
    assert sizes["plain"] > 50 and sizes["bounded"] < 30
