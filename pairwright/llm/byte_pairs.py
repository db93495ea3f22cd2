"""Byte-level BPE encoding and decoding with Spark's higher-order functions.

A text falls into words by the tokenizer's pattern, and each word is encoded by
itself: its bytes are the first parts, and of all neighbours the pair whose
joined bytes have the lowest rank is merged, the leftmost first, until no pair
has a rank.  ``aggregate`` folds these steps over the parts; ranks come from
literal buckets, each a short string of entries that is searched for a key.  A
word that has a rank itself is one token.  Decoding joins the bytes of the ids'
pieces.

Parts are kept as a string with one character for each: a token's character is
named by its rank, so a pair of parts is a string of two.  Characters order as
ranks do, so the ranks of all pairs are a string as well, its least character
is the token to merge, and a merge overlays both strings at one place.

- *Distinct words.*  Texts are taken in slices of bounded bytes; the fold sees
  a word once in a task, which keeps what it has found up to a bound and then
  begins anew.  As large tasks meet a word again more often, small partitions are
  read together, as long as no core goes without a task.  Nothing is shuffled, and
  no task holds more than a slice or one text beside the words found.
- *Equal ranks at once.*  In a long word, all places of the lowest rank
  are merged in one step where no pair with the merged token has a lower rank than
  that token: the leftmost of them would follow each other anyway.  Other tokens
  are merged one place a step.  Which is which is part of the entries.
- *Cuts.*  Two bytes that stand side by side in no token never become one, so a
  long word is cut there first.

The pattern's classes are the library's: characters that its Unicode version
knows as letters, numbers or white space and this JVM's does not are added to
the JVM's classes.

Defined cases: a null text counts as empty and has no tokens, the digests are
those of nothing; strings of special tokens are ordinary text; ids may repeat or
be null; an empty table gives an empty result.  Work within one uncut word grows
with its length times the number of different merges in it.
"""

from __future__ import annotations

import base64
import hashlib
import json
import zlib
from collections.abc import Callable, Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairwright.llm.frames import text_of
from pairwright.llm.words import Words, sizes_in_bytes, tidied

LATIN = "ISO-8859-1"
# Buckets of pairs and of tokens, a power of two: a few entries each for the vocabularies in use.
BUCKETS = 1 << 16
# The first token's character: no number beyond it is a surrogate's.
FIRST = 0x10000
# The rank of a pair that is none, beyond all others; the part beside the first and the last.
NONE = chr(0x10FFFD)
EDGE = " "
# Words of a text that are a row, so that what Spark hands over at once stays small; bytes of text that are a slice.
ROW_WORDS = 200
SLICE_BYTES = 8 << 20
# Bytes of distinct words that a task keeps: the more, the fewer are encoded again.
KNOWN_BYTES = 32 << 20
# Bytes of input that partitions are read together for.
TASK_BYTES = 32 << 20
CODEC = "zstd"
# Words of more bytes are cut first, and merged at several places a step; and a character that is no byte's and no token's.
LONG = 64
CUT = chr(0x100)


def read_ranks(path: str) -> dict[bytes, int]:
    """Bytes and rank of every token of a rank file; every single byte has to be one."""
    with open(path, "rb") as file:
        found = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    if any(bytes([b]) not in found for b in range(256)):
        raise ValueError(f"{path}: not every byte is a token")
    return found


def token_character(rank: int) -> str:
    """The character that stands for a token."""
    if rank >= ord(NONE) - FIRST:
        raise ValueError(f"rank {rank}: no character is left for it")
    return chr(FIRST + rank)


def merges(ranks: dict[bytes, int]) -> dict[tuple[bytes, bytes], int]:
    """Twice the rank of what each pair of tokens gives, and one more where its merges have to be made one by one.

    That is so where some pair with the merged token on a side has a lower rank than that token.
    """
    found = {}
    least: dict[bytes, int] = {}
    for token, rank in ranks.items():
        for k in range(1, len(token)):
            left, right = token[:k], token[k:]
            if left in ranks and right in ranks:
                found[left, right] = rank
                least[left] = min(rank, least.get(left, rank))
                least[right] = min(rank, least.get(right, rank))
    return {pair: 2 * r + (least.get(pair[0] + pair[1], r + 1) <= r) for pair, r in found.items()}


def bucketed(entries: dict[str, str], start: str = "") -> list[str]:
    """Strings of ``start`` and the entries, each a key and what it gives; Spark finds a key's by the same checksum."""
    buckets = [[start] for _ in range(BUCKETS)]
    for key, value in entries.items():
        buckets[zlib.crc32(key.encode()) % BUCKETS].append(key + value)
    return list(map("".join, buckets))


def cut_pattern(ranks: dict[bytes, int]) -> str:
    """A Java pattern for the places between two bytes that no token holds side by side."""
    after: dict[int, set[int]] = {b: set() for b in range(256)}
    for token in ranks:
        for a, b in zip(token, token[1:]):
            after[a].add(b)

    def one_of(values: set[int]) -> str:
        return f"[{_spelled_ranges(map(chr, values))}]"

    # bytes that the same ones may follow share an alternative
    by_next: dict[frozenset[int], set[int]] = {}
    for a, following in after.items():
        by_next.setdefault(frozenset(following), set()).add(a)
    every = set(range(256))
    parts = [f"(?<={one_of(firsts)})(?={one_of(every - n)})" for n, firsts in by_next.items() if len(n) < 256]
    return "|".join(parts) or "(?!)"


def _spelled_ranges(characters: Iterable[str]) -> str:
    """Characters as ranges of a Java character class."""
    numbers = sorted(map(ord, characters))
    starts = [n for k, n in enumerate(numbers) if not k or numbers[k - 1] != n - 1]
    ends = [n for k, n in enumerate(numbers) if k + 1 == len(numbers) or numbers[k + 1] != n + 1]
    return "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in zip(starts, ends, strict=True))


@cache
def _library_class(pattern: str) -> frozenset[str]:
    """The characters that the library's pattern class holds."""
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF)
    single = {bytes([b]): b for b in range(256)}
    held = tiktoken.Encoding("class", pat_str=f"{pattern}+", mergeable_ranks=single, special_tokens={})
    return frozenset(bytes(held.encode_ordinary(every)).decode())


@cache
def _java_classes() -> dict[str, tuple[str, frozenset[str]]]:
    """This JVM's name of each class, and the characters that only the library's has."""
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF)
    compiled = SparkSession.active()._jvm.java.util.regex.Pattern.compile
    found = {}
    for name, java in ((r"\p{L}", r"\p{L}"), (r"\p{N}", r"\p{N}"), (r"\s", r"\p{IsWhite_Space}")):
        known = set(compiled(f"[^{java}]+").matcher(every).replaceAll(""))
        if not known <= _library_class(name):
            raise ValueError(f"{name} holds characters here that it does not hold in the library")
        found[name] = (java, _library_class(name) - known)
    return found


def _translated(pattern: str, classes: dict[str, str]) -> str:
    """A pattern with its classes under other names; a name may be several ranges."""
    names = {**classes, r"\S": f"^{classes[r'\s']}"}
    out, at, inside = [], 0, False
    while at < len(pattern):
        name = next((n for n in names if pattern.startswith(n, at)), None)
        if name:
            out.append(names[name] if inside else f"[{names[name]}]")
            at += len(name)
        else:
            step = 2 if pattern[at] == "\\" else 1
            inside = pattern[at] == "[" or (inside and pattern[at] != "]")
            out.append(pattern[at : at + step])
            at += step
    return "".join(out)


def words_of(text: Column, pattern: str) -> Column:
    """The words of a text by the tokenizer's pattern, with the library's idea of each class.

    Only texts with a character that this JVM does not class as the library does
    pay for classes with many ranges.
    """
    classes = _java_classes()
    found = F.regexp_extract_all(text, F.lit(_translated(pattern, {n: java for n, (java, _) in classes.items()})), F.lit(0))
    unknown = frozenset().union(*(more for _, more in classes.values()))
    if not unknown:
        return found
    longer = {n: java + _spelled_ranges(more) for n, (java, more) in classes.items()}
    high = text.rlike(f"[\\x{{{ord(min(unknown)):x}}}-\\x{{10ffff}}]")
    odd = high & text.rlike(f"[{_spelled_ranges(unknown)}]")
    return F.when(odd, F.regexp_extract_all(text, F.lit(_translated(pattern, longer)), F.lit(0))).otherwise(found)


def _named(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), use), 1)


class BytePairs:
    """Column expressions that encode words.

    ``pairs`` and ``tokens`` are literal buckets: of two tokens' characters that of the token they
    make and its mark, as :func:`pair_buckets` has them, and of a token's bytes its character.
    """

    def __init__(self, pairs: Column, tokens: Column, ranks: dict[bytes, int]):
        self.pairs = pairs
        self.tokens = tokens
        self.cuts = cut_pattern(ranks)
        self.bytes = "".join(map(chr, range(256)))
        self.byte_tokens = "".join(token_character(ranks[bytes([b])]) for b in range(256))

    def _whole(self, letters: Column) -> Column:
        """The character of the token that some bytes are, or null."""

        def found(key: Column) -> Column:
            def after(bucket: Column) -> Column:
                at = F.instr(bucket, key)
                return F.when(at > 0, F.substring(bucket, at + F.length(key), F.lit(1)))

            return _named(_bucket(self.tokens, key), after)

        return _named(F.concat(F.lit(CUT), letters, F.lit(CUT)), found)

    def _made(self, left: Column, right: Column, characters: int = 1) -> Column:
        """The character of the token that two parts make, and its mark where two are asked for; or ``NONE``."""
        key = F.concat(F.lit(CUT), left, right)
        # a key that is not there is at 0, so what follows the start of a bucket is taken
        return _named(
            _bucket(self.pairs, key), lambda b: F.substring(b, F.instr(b, key) + 3, F.lit(characters))
        )

    def _pairs(self, parts: Column) -> Column:
        """The token that each pair of neighbours makes, and its mark."""
        more = F.size(parts) - 1
        return F.zip_with(F.slice(parts, 1, more), F.slice(parts, 2, more), lambda a, b: self._made(a, b, 2))

    def _one_merge(self, at: Column, least: Column) -> Column:
        """``at`` (``parts`` between edges, ``ranks`` of the pairs) after its next merge."""
        parts, ranks = at["parts"], at["ranks"]

        def merged(place: Column) -> Column:
            """``place`` is the left part's, from 1 on, and its pair's."""
            before = self._made(F.substring(parts, place - 1, F.lit(1)), least)
            after = self._made(least, F.substring(parts, place + 2, F.lit(1)))
            return F.struct(
                F.overlay(parts, least, place, F.lit(2)).alias("parts"),
                F.overlay(ranks, F.concat(before, after), place - 1, F.lit(3)).alias("ranks"),
            )

        return _named(F.instr(ranks, least), merged)

    def _all_merges(self, at: Column, least: Column) -> Column:
        """``at`` (``parts``, ``ranks`` of the pairs) after the merges of the lowest rank, all of them where their
        order cannot matter."""
        flags = F.array_join(F.transform(at["ranks"], lambda r: F.when(r == least, "1").otherwise("0")), "")
        # of neighbouring places the left one is merged
        apart = F.replace(flags, F.lit("11"), F.lit("10"))
        single = F.concat(F.repeat(F.lit("0"), F.instr(flags, "1") - 1), F.lit("1"))
        chosen = F.split(F.when(F.substring(least, 2, 1) == "1", single).otherwise(apart), "")

        def joined(places: Column) -> Column:
            def part(character: Column, k: Column) -> Column:
                here, before = F.get(places, k) == "1", F.get(places, k - 1) == "1"
                return F.when(here, F.substring(least, 1, 1)).when(~F.coalesce(before, F.lit(False)), character)

            return F.array_compact(F.transform(each(at["parts"]), part))

        return _named(
            _named(chosen, joined),
            lambda new: F.struct(F.array_join(new, "").alias("parts"), self._pairs(new).alias("ranks")),
        )

    def _folded(self, letters: Column) -> Column:
        """The parts of some bytes that no merge is left for."""
        tokens = F.translate(letters, self.bytes, self.byte_tokens)

        def between_edges(parts: Column) -> Column:
            """No merge reaches the first and the last part, so every place has two neighbours."""
            ranks = F.transform(each(parts), lambda c, k: self._made(c, F.substring(parts, k + 2, F.lit(1))))
            return F.struct(parts.alias("parts"), F.array_join(ranks, "").alias("ranks"))

        def in_array(parts: Column) -> Column:
            return F.struct(parts.alias("parts"), self._pairs(each(parts)).alias("ranks"))

        def fold(start: Column, least: Callable[[Column], Column], merge: Callable[[Column, Column], Column]) -> Column:
            def step(at: Column, _: Column) -> Column:
                return _named(least(at["ranks"]), lambda r: F.when(r < NONE, merge(at, r)).otherwise(at))

            return F.aggregate(F.sequence(F.lit(1), F.length(letters)), start, step, lambda at: at["parts"])

        edged = _named(F.concat(F.lit(EDGE), tokens, F.lit(EDGE)), between_edges)
        short = F.trim(fold(edged, lambda ranks: F.array_min(each(ranks)), self._one_merge))
        long = fold(_named(tokens, in_array), F.array_min, self._all_merges)
        return F.when(F.length(letters) > LONG, long).otherwise(short)

    def encode(self, word: Column) -> Column:
        """Ids of a word, an array of integers; a word is not empty."""

        def ids(letters: Column) -> Column:
            # replaced, then split: a pattern to replace is compiled once, one to split by for every word
            cut = F.split(F.regexp_replace(letters, self.cuts, CUT), CUT)
            long = F.array_join(F.transform(cut, self._folded), "")
            parts = F.when(F.length(letters) > LONG, long).otherwise(self._folded(letters))
            return F.transform(each(F.coalesce(self._whole(letters), parts)), lambda c: F.ascii(c) - FIRST)

        return _named(F.decode(word.cast("binary"), LATIN), ids)


def _bucket(buckets: Column, key: Column) -> Column:
    return F.get(buckets, F.crc32(key.cast("binary")).bitwiseAND(F.lit(BUCKETS - 1)))


def each(parts: Column) -> Column:
    """The characters of a string that is not empty."""
    return F.split(parts, "")


def pair_buckets(ranks: dict[bytes, int]) -> list[str]:
    """Of two tokens' characters that of the token they make, and 1 where its merges are made one by one, else 0."""
    characters = {token: token_character(rank) for token, rank in ranks.items()}
    made = {CUT + characters[a] + characters[b]: f"{token_character(m // 2)}{m % 2}" for (a, b), m in merges(ranks).items()}
    return bucketed(made, f"{EDGE * 2}{NONE}0")


def token_buckets(ranks: dict[bytes, int]) -> list[str]:
    """Of each token's bytes its character."""
    return bucketed({CUT + token.decode(LATIN) + CUT: token_character(rank) for token, rank in ranks.items()})


def spelled(words: Column, ranks: dict[bytes, int]) -> Column:
    """``(n, ids, bytes)`` of each of some words: how many ids, the ids as text, and the bytes that they stand for.

    The literals stand in the plan once; all lambdas take them from there.
    """
    by_rank = {rank: token for token, rank in ranks.items()}
    tokens = [by_rank[k].decode(LATIN) if k in by_rank else None for k in range(max(by_rank) + 1)]
    literals = [_literal(values, "array<string>") for values in (pair_buckets(ranks), token_buckets(ranks), tokens)]

    def of_all(made: Column, whole: Column, pieces: Column) -> Column:
        pairs = BytePairs(made, whole, ranks)

        def of_ids(ids: Column) -> Column:
            joined = F.array_join(F.transform(ids, lambda i: F.get(pieces, i)), "")
            text = F.array_join(ids.cast("array<string>"), " ")
            return F.struct(F.size(ids).alias("n"), text.alias("ids"), F.encode(joined, LATIN).alias("bytes"))

        return F.transform(words, lambda word: _named(pairs.encode(word), of_ids))

    return _named(literals[0], lambda m: _named(literals[1], lambda w: _named(literals[2], lambda p: of_all(m, w, p))))


def _literal(value: list, kind: str) -> Column:
    return F.from_json(F.lit(json.dumps(value, ensure_ascii=False)), kind)


def read_together(docs: DataFrame) -> DataFrame:
    """The rows of a table in tasks of up to ``TASK_BYTES``, but in one for each core at least."""
    spark = docs.sparkSession
    partition = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    partitions = docs.rdd.getNumPartitions()
    tasks = max(-(-partitions // max(1, TASK_BYTES // max(1, partition))), spark.sparkContext.defaultParallelism)
    return docs.coalesce(tasks) if tasks < partitions else docs


def encoded_words(docs: DataFrame, ranks_path: str, pattern: str, id_column: str, text_column: str) -> DataFrame:
    """One row per slice of texts, those of a task in order: ids of its documents, one for every ``ROW_WORDS`` words of
    theirs or fewer, whether these are the ``last`` ones, ``counts`` of them, compressed ``codes`` of the words, and ``spelled``, an array of ``(n, ids, bytes)`` of each word that no slice
    before had.  It is put behind the ``known`` first of those before; if that is 0, what came before is over."""
    ranks = read_ranks(ranks_path)
    text = text_of(text_column)

    def runs(words: Column) -> Column:
        final = F.greatest(F.floor((F.size(words) - 1) / ROW_WORDS), F.lit(0)).cast("int")
        return F.transform(
            F.sequence(F.lit(0), final),
            lambda k: F.struct((k == final).alias("last"), F.slice(words, k * ROW_WORDS + 1, ROW_WORDS).alias("words")),
        )

    rows = read_together(docs).select(
        F.col(id_column).alias("doc_id"), F.inline(_named(words_of(text, pattern), runs))
    )
    schema = T.StructType(
        [
            T.StructField("doc_ids", T.ArrayType(rows.schema["doc_id"].dataType)),
            T.StructField("last", T.ArrayType(T.BooleanType())),
            T.StructField("counts", T.ArrayType(T.LongType())),
            T.StructField("codes", T.BinaryType()),
            T.StructField("known", T.IntegerType()),
            T.StructField("words", T.ArrayType(T.StringType())),
        ]
    )

    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None
        for batch in batches:
            if not batch.num_rows:
                continue
            ends = np.cumsum(pc.list_value_length(batch.column("words")).to_numpy(zero_copy_only=False))
            sizes = sizes_in_bytes(batch.column("words").flatten())
            part = np.concatenate([[0], np.cumsum(sizes)])[ends] // SLICE_BYTES
            starts = np.flatnonzero(np.diff(part, prepend=part[0] - 1))
            for start, stop in zip(starts, [*starts[1:], batch.num_rows], strict=True):
                some = batch.slice(start, stop - start)
                words = Words(some.column("words"))
                if known is None or known.nbytes > KNOWN_BYTES:
                    known = words.distinct.slice(0, 0)
                places = pc.index_in(words.distinct, value_set=known)
                new = places.is_null()
                later = len(known) - 1 + np.cumsum(new.to_numpy(zero_copy_only=False))
                places = np.where(new, later, places.fill_null(0)).astype(np.int32)
                words.distinct = words.distinct.filter(new)
                codes = pa.compress(places[words.codes], CODEC, asbytes=True)
                columns = (some.column("doc_id"), some.column("last"), pa.array(np.diff(words.bounds)), words.distinct)
                *lists, distinct = (pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in columns)
                yield pa.RecordBatch.from_arrays(
                    [*lists, pa.array([codes], pa.binary()), pa.array([len(known)], pa.int32()), distinct],
                    names=schema.names,
                )
                known = pa.concat_arrays([known, words.distinct])

    found = rows.mapInArrow(tidied(sliced), schema)
    return found.select("doc_ids", "last", "counts", "codes", "known", spelled(F.col("words"), ranks).alias("spelled"))


def _runs(values: pa.Array, codes: np.ndarray, bounds: np.ndarray) -> list[memoryview]:
    """The bytes of each run of codes, one after the other."""
    taken = values.cast(pa.large_binary()).take(codes)
    ends = np.frombuffer(taken.buffers()[1], np.int64)[taken.offset : taken.offset + len(taken) + 1] if len(taken) else np.zeros(1, np.int64)
    data = memoryview(taken.buffers()[2] or b"") if len(taken) else memoryview(b"")
    cuts = ends[bounds].tolist()
    return [data[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def byte_pairs(
    docs: DataFrame, ranks_path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Ids and decoded bytes of every document, as a count and two digests."""
    slices = encoded_words(docs, ranks_path, pattern, id_column, text_column)
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema[id_column].dataType),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_sha256", T.StringType()),
            T.StructField("decoded_sha256", T.StringType()),
        ]
    )

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, n_tokens, of_ids, of_bytes = [], 0, hashlib.sha256(), hashlib.sha256()
        for batch in batches:
            for row in range(batch.num_rows):
                lists = (batch.column(c).slice(row, 1).flatten() for c in ("doc_ids", "last", "counts", "spelled"))
                doc_ids, last, counts, words = lists
                n, ids, raw = (words.field(k) for k in ("n", "ids", "bytes"))
                # every word's ids end in a space, the last one's is left out
                found = [n, pa.array([f"{i} " for i in ids.to_pylist()], pa.string()), raw]
                before = batch.column("known")[row].as_py()
                kept = [pa.concat_arrays([k.slice(0, before), f]) for k, f in zip(kept or found, found, strict=True)]
                n, spaced, raw = kept
                bounds = np.concatenate([[0], np.cumsum(counts.to_numpy(zero_copy_only=False))]).astype(np.int64)
                packed = batch.column("codes")[row].as_buffer()
                codes = np.frombuffer(pa.decompress(packed, int(bounds[-1]) * 4, CODEC), np.int32)
                tokens = n.to_numpy(zero_copy_only=False).astype(np.int64)[codes]
                tokens = np.diff(np.concatenate([[0], np.cumsum(tokens)])[bounds]).tolist()
                out = []
                runs = (tokens, _runs(spaced, codes, bounds), _runs(raw, codes, bounds), last.to_pylist())
                # a document's rows follow each other, maybe in several slices
                for count, some_ids, some_bytes, ended in zip(*runs, strict=True):
                    n_tokens += count
                    of_ids.update(some_ids[:-1] if ended else some_ids)
                    of_bytes.update(some_bytes)
                    if ended:
                        out.append((n_tokens, of_ids.hexdigest(), of_bytes.hexdigest()))
                        n_tokens, of_ids, of_bytes = 0, hashlib.sha256(), hashlib.sha256()
                if out:
                    columns = [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.string(), pa.string()), strict=True)]
                    yield pa.RecordBatch.from_arrays([doc_ids.filter(last), *columns], names=schema.names)

    return slices.mapInArrow(tidied(digested), schema)
