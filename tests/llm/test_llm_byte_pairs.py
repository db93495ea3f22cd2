import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from pairwright.llm import byte_pairs

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def expected(rows, ranks):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = []
    for doc_id, text, *_ in rows:
        ids = library.encode_ordinary(text or "")
        joined = " ".join(map(str, ids)).encode()
        out.append((doc_id, len(ids), hashlib.sha256(joined).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=str)


def found(docs, path=RANKS):
    return sorted(map(tuple, byte_pairs.byte_pairs(docs, path, public_tokenizers.PATTERN).collect()), key=str)


def odd_texts():
    rng = random.Random(5)
    letters = "ab cdeéñ  \n\t.,'!<>|　 日本x1290_-ſK①Ａ\x00\x1c 🙂\x85​᠎ࡰ𑽐"
    syllables = ["th", "er", "ing", " ", "tion", "e", "an", " the", "  ", "\r\n", "\n", "'s", "'LL", " 12", "३"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(0, 40))) for _ in range(400)]
    texts += ["".join(rng.choice(syllables) for _ in range(rng.randrange(0, 30))) for _ in range(400)]
    # long words: of one letter, of few letters, of any letters, of syllables, of bytes beyond ASCII
    texts += ["a" * 5_000, "ab" * 3_001, " " * 4_000 + "x", "!" * 777, "\n" * 500]
    texts += ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(3_000))]
    texts += ["".join(rng.choice(["the", "of", "and", "ing", "to"]) for _ in range(400)), "日本語" * 300]
    return texts


def test_ids_are_the_librarys(documents):
    texts = odd_texts()
    rows = [(k, t) for k, t in enumerate(texts)]
    assert found(documents(texts)) == expected(rows, byte_pairs.read_ranks(RANKS))


def test_edge_rows(documents, edge_rows):
    assert found(documents(rows=edge_rows)) == expected(edge_rows, byte_pairs.read_ranks(RANKS))
    assert found(documents()) == []


def test_slices_cut_work_only(documents, edge_rows, monkeypatch):
    whole = found(documents(rows=edge_rows))
    monkeypatch.setattr(byte_pairs, "SLICE_BYTES", 64)
    assert found(documents(rows=edge_rows)) == whole


def test_a_task_encodes_a_word_once(documents, monkeypatch):
    texts = [f"blorfint {'quandle ' * k}xyzzyx{k % 3}" for k in range(40)]
    docs = documents(texts).coalesce(1)
    monkeypatch.setattr(byte_pairs, "SLICE_BYTES", 64)
    slices = byte_pairs.encoded_words(docs, RANKS, public_tokenizers.PATTERN, "doc_id", "text").collect()
    assert len(slices) > 10
    spelled = [word.bytes for s in slices for word in s.spelled]
    assert len(spelled) == len(set(spelled)) == len({b"blorfint", b" quandle", b" xyzzyx", b"0", b"1", b"2"})
    whole = found(docs)
    # a task that may keep few words begins anew with every slice
    monkeypatch.setattr(byte_pairs, "KNOWN_BYTES", 1)
    slices = byte_pairs.encoded_words(docs, RANKS, public_tokenizers.PATTERN, "doc_id", "text").collect()
    assert {s.known for s in slices} == {0} and sum(len(s.spelled) for s in slices) > 20
    assert found(docs) == whole == expected(list(enumerate(texts)), byte_pairs.read_ranks(RANKS))


def test_a_text_may_lie_in_several_rows_and_slices(documents, edge_rows, monkeypatch):
    monkeypatch.setattr(byte_pairs, "ROW_WORDS", 3)
    monkeypatch.setattr(byte_pairs, "SLICE_BYTES", 16)
    texts = ["a few words of a text", "", "one two three", " four", None, "\n", "five 5 six 6 seven 7"]
    rows = list(enumerate(texts))
    ranks = byte_pairs.read_ranks(RANKS)
    assert found(documents(texts)) == expected(rows, ranks)
    assert found(documents(rows=edge_rows).coalesce(1)) == expected(edge_rows, ranks)


def test_small_partitions_are_read_together(spark, tmp_path):
    spark.range(400).selectExpr("id doc_id", "concat('word', id) text").repartition(40).write.parquet(str(tmp_path / "docs"))
    cores = spark.sparkContext.defaultParallelism
    docs = spark.read.parquet(str(tmp_path / "docs"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
        docs = spark.read.parquet(str(tmp_path / "docs"))
        assert docs.rdd.getNumPartitions() > cores
        assert byte_pairs.read_together(docs).rdd.getNumPartitions() == cores
        assert found(docs) == expected([(k, f"word{k}") for k in range(400)], byte_pairs.read_ranks(RANKS))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.fixture
def small_ranks(tmp_path):
    """Ranks in which a token often ranks below the parts that make it, so order matters."""
    rng = random.Random(9)
    tokens = {"".join(rng.choice("abc") for _ in range(rng.randrange(2, 6))).encode() for _ in range(120)}
    ranks = {bytes([b]): b for b in range(256)}
    for token in sorted(tokens, key=lambda t: hashlib.md5(t).digest()):
        ranks[token] = len(ranks)
    path = tmp_path / "small.tiktoken"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % r for t, r in ranks.items()))
    return str(path), ranks


def test_merges_whose_order_matters(documents, small_ranks):
    path, ranks = small_ranks
    rng = random.Random(11)
    texts = ["".join(rng.choice("abc") for _ in range(rng.randrange(1, 300))) for _ in range(300)]
    texts += ["a" * 200, "ab" * 90, "abc" * 80, "aab" * 70]
    assert any(m % 2 for m in byte_pairs.merges(ranks).values())
    assert found(documents(texts), path) == expected(list(enumerate(texts)), ranks)


def test_classes_are_the_librarys(spark):
    """Each class holds the characters that it holds in the library, one by one and together."""
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF)
    texts = spark.createDataFrame([(every,), ("aé 1\xa0x",)], "t string")
    for name in (r"\p{L}", r"\p{N}", r"\s"):
        held = texts.select(byte_pairs.words_of(F.col("t"), f"{name}+")).collect()
        assert set("".join(held[0][0])) == byte_pairs._library_class(name)
        assert set("".join(held[1][0])) == byte_pairs._library_class(name) & set("aé 1\xa0x")


def test_a_file_without_every_byte_is_refused(tmp_path):
    path = tmp_path / "few.tiktoken"
    path.write_bytes(b"YQ== 0\n")
    with pytest.raises(ValueError):
        byte_pairs.read_ranks(str(path))
