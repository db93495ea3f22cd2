"""Cross-tokenizer alignment: which tokens of two vocabularies end together.

Both tokenizers cut the same bytes, so a token's end is a byte offset, and the
offsets where tokens of both end part a text into groups.  The two tokens that end
there are linked.  How often a pair of ids is linked in the whole corpus says how
good a link is.

- *In a task* all work is on Arrow arrays.  Token ids of a slice of texts are
  flattened, with their parents' indices; byte lengths are summed up per text (a
  running sum less what it was at the text's start); an Acero hash join on
  text and end gives the links; ``Table.group_by`` counts each pair of ids once
  per slice.
- *Between tasks* Spark adds up the slices' counts and finds each second id's
  highest one.  Counts go back to their slice, one row per pair and slice, so that
  a link that every text has is one row per slice, and no slice has more pairs than
  links.

Nothing but whole slices of bounded bytes (or one long text) is ever together.

Defined cases: texts that are null, empty, or that the tokens' bytes do not spell
again have no tokens: zeros and an empty ``groups_sha256``; strings of special
tokens are ordinary text; ids may repeat or be null; an empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from sentencepiece import SentencePieceProcessor

from pairwright.llm.byte_ids import PLAIN, ByteIds, token_bytes
from pairwright.llm.frames import landed
from pairwright.llm.piece_ids import MARK, PieceIds
from pairwright.llm.words import filled, slices, tidied

# Arrow's arrays of a slice are some hundred times its bytes, and workers keep what they once held.
SLICE_BYTES = 1 << 20
# A slice is a row of some megabytes, and Spark reads a row group at once.
ROW_GROUPS = {"parquet.block.size": str(8 << 20), "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1"}


class PlainByteIds(ByteIds):
    """Byte-level ids in which the strings of special tokens are ordinary text, and each id's bytes.

    A slice's distinct words are encoded together and not remembered, so memory does not grow with the vocabulary.
    """

    def __init__(self, path: str):
        super().__init__(path)
        self.tokenizer.encode_special_tokens = True
        self.special = []
        spelled = token_bytes(path)
        self.spelled = pa.array([spelled.get(k, b"") for k in range(max(spelled) + 1)], pa.binary())

    def chunk(self, chunk: str) -> bytes:
        if self.fast and PLAIN.fullmatch(chunk):
            return array("I", self.fast.encode_ordinary(chunk)).tobytes()
        return array("I", self.tokenizer.encode(chunk, add_special_tokens=False).ids).tobytes()

    def spell(self, chunks: list[str]) -> list[bytes]:
        # mostly all are plain, which one search tells
        if self.fast and PLAIN.fullmatch("".join(chunks)):
            encode = self.fast.encode_ordinary
            return [array("I", encode(c)).tobytes() for c in chunks]
        return super().spell(chunks)


class SpelledPieceIds(PieceIds):
    """Piece ids with each id's bytes; a slice's distinct words go through the library together."""

    def __init__(self, path: str):
        super().__init__(path)
        self.library = SentencePieceProcessor(model_file=path)
        ends = np.concatenate([self.decoded_start, [len(self.decoded)]])
        raw = self.decoded.tobytes()
        self.spelled = pa.array([raw[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary())

    def spell(self, words: list[str]) -> list[bytes]:
        ids = self.library.encode(words, num_threads=1)
        # of an empty word the library makes nothing; its texts are encoded by runs of spaces anyway
        return [array("I", i).tobytes() for i in ids]

    def chunk(self, text: str) -> bytes:
        found = super().chunk(text)
        self.chunks.clear()
        return found


def _tokens(lists: list[np.ndarray], spelled: pa.Array) -> tuple[pa.Table, pa.Array]:
    """``doc, id, end`` of every token, ends in bytes from its text's start; and the bytes of each text."""
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
    flat = pa.array(np.concatenate([np.empty(0, np.uint32), *lists]).astype(np.int32))
    ids = pa.ListArray.from_arrays(pa.array(bounds), flat)
    doc = pc.list_parent_indices(ids)
    flat = pc.list_flatten(ids)
    size = pc.cast(pc.binary_length(spelled.take(flat)), pa.int64())
    running = pc.cumulative_sum(size)
    # what the sum is where each text starts
    sums = pa.concat_arrays([pa.array([0], pa.int64()), running])
    starts = sums.take(pa.array(bounds[:-1]))
    ends = sums.take(pa.array(bounds[1:]))
    end = pc.subtract(running, starts.take(doc))
    return pa.table({"doc": doc, "id": flat, "end": end}), pc.subtract(ends, starts)


def _joined_bytes(lists: list[np.ndarray], spelled: pa.Array) -> list[memoryview]:
    """The bytes that each list of ids spells."""
    flat = pa.array(np.concatenate([np.empty(0, np.uint32), *lists]).astype(np.int32))
    taken = spelled.take(flat).cast(pa.large_binary())
    ends = np.frombuffer(taken.buffers()[1], np.int64)[: len(taken) + 1] if len(taken) else np.zeros(1, np.int64)
    data = memoryview(taken.buffers()[2] or b"").cast("B")
    cuts = ends[np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)].tolist()
    return [data[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


class Aligner:
    """Aligns the tokens of slices of texts."""

    def __init__(self, byte_path: str, piece_path: str):
        self.a, self.b = PlainByteIds(byte_path), SpelledPieceIds(piece_path)

    def encoded(self, texts: pa.Array) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Both tokenizers' ids of each text, none where they do not spell the text."""
        spaced = pc.binary_join_element_wise(" ", texts, "")
        a = self.a.encode(texts, after_space=True)
        b = [ids[1:-1] for ids in self.b.encode(filled(pc.replace_substring(texts, MARK, " ")))]
        none = np.empty(0, np.uint32)
        wanted = spaced.cast(pa.binary()).to_pylist()
        spelled = zip(wanted, _joined_bytes(a, self.a.spelled), _joined_bytes(b, self.b.spelled), strict=True)
        right = [len(w) > 1 and w == x and w == y for w, x, y in spelled]
        return [x if ok else none for x, ok in zip(a, right, strict=True)], [x if ok else none for x, ok in zip(b, right, strict=True)]

    def align(self, texts: pa.Array) -> tuple[dict[str, pa.Array], pa.Table, pa.Array]:
        """Counts and digests per text; ``a, b, n`` of each linked pair of ids; and each text's links as places in that table."""
        lists_a, lists_b = self.encoded(texts)
        a, size = _tokens(lists_a, self.a.spelled)
        b, _ = _tokens(lists_b, self.b.spelled)
        links = a.join(b, keys=["doc", "end"], join_type="inner", right_suffix="_b", use_threads=False)
        # in the order of texts and ends, which the join mostly leaves
        reach = int(pc.max(size).as_py() or 0) + 1
        links = links.take(pa.array(np.argsort(links["doc"].to_numpy().astype(np.int64) * reach + links["end"].to_numpy(), kind="stable")))
        pairs = links.group_by(["id", "id_b"], use_threads=False).aggregate([([], "count_all")])
        pairs = pairs.select(["id", "id_b", "count_all"]).rename_columns(["a", "b", "n"]).sort_by([("a", "ascending"), ("b", "ascending")])
        # places by a key of both ids, since a join would lose the order
        key = _pair_key(links["id"], links["id_b"])
        codes = np.searchsorted(_pair_key(pairs["a"], pairs["b"]), key).astype(np.int32)
        n_links = np.bincount(links["doc"].to_numpy(), minlength=len(texts))
        bounds = np.concatenate([[0], np.cumsum(n_links)]).astype(np.int32)
        columns = {
            "n_a": pa.array([len(x) for x in lists_a], pa.int64()),
            "n_b": pa.array([len(x) for x in lists_b], pa.int64()),
            "n_groups": pa.array(n_links, pa.int64()),
            "groups_sha256": pa.array(self._digests(a, b, links, size), pa.string()),
        }
        return columns, pairs, pa.ListArray.from_arrays(pa.array(bounds), pa.array(codes))

    def _digests(self, a: pa.Table, b: pa.Table, links: pa.Table, size: pa.Array) -> list[str]:
        """The digest of each text's groups, spelled out.

        Ends are made ends in the slice, so that one order holds for all texts.
        """
        sizes = size.to_numpy(zero_copy_only=False)
        starts = np.cumsum(sizes) - sizes
        ends = [t["end"].to_numpy() + starts[t["doc"].to_numpy()] for t in (a, b, links)]
        order, texts, docs = [], [], []
        for side, (tokens, end) in enumerate(zip((a, b), ends[:2], strict=True)):
            group = np.searchsorted(ends[2], end)
            last = ends[2][group] == end
            mark = pa.array([",", "|" if side == 0 else ";"]).take(pa.array(last.astype(np.int8)))
            order.append(2 * group + side)
            texts.append(pc.binary_join_element_wise(tokens["id"].combine_chunks().cast(pa.string()), mark, ""))
            docs.append(tokens["doc"].to_numpy())
        by = np.argsort(np.concatenate(order), kind="stable")
        spelled = pa.concat_arrays(texts).take(pa.array(by)).cast(pa.large_string())
        counts = np.bincount(np.concatenate(docs), minlength=len(sizes))
        if not len(spelled):
            return [""] * len(sizes)
        data = memoryview(spelled.buffers()[2])
        at = np.frombuffer(spelled.buffers()[1], np.int64)[np.concatenate([[0], np.cumsum(counts)])].tolist()
        # the last group's mark is left out
        return [hashlib.sha256(data[p : q - 1]).hexdigest() if p < q else "" for p, q in zip(at[:-1], at[1:], strict=True)]


def _pair_key(a: pa.ChunkedArray, b: pa.ChunkedArray) -> np.ndarray:
    return (a.to_numpy().astype(np.int64) << 32) | b.to_numpy().astype(np.int64)


def aligned_slices(
    docs: DataFrame, byte_path: str, piece_path: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per slice of texts: its number, its documents (with each one's links as places in ``pairs``), and ``pairs``."""
    rows = docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text_column}`").alias("text"))
    of_doc = T.StructType(
        [
            rows.schema["doc_id"],
            *(T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups")),
            T.StructField("groups_sha256", T.StringType()),
            T.StructField("links", T.ArrayType(T.IntegerType())),
        ]
    )
    of_pair = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType()), T.StructField("n", T.LongType())])
    schema = T.StructType(
        [T.StructField("slice", T.LongType()), T.StructField("docs", T.ArrayType(of_doc)), T.StructField("pairs", T.ArrayType(of_pair))]
    )

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, turn = Aligner(byte_path, piece_path), 0
        for batch in batches:
            for part, texts in slices(batch, filled(batch.column("text")), SLICE_BYTES):
                turn += 1
                columns, pairs, links = aligner.align(filled(texts))
                each = pa.StructArray.from_arrays([part.column("doc_id"), *columns.values(), links], names=of_doc.names)
                pair = pa.StructArray.from_arrays([pairs[c].combine_chunks() for c in of_pair.names], names=of_pair.names)
                number = (TaskContext.get().partitionId() << 32) + turn
                lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (each, pair)]
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *lists], names=schema.names)

    return rows.mapInArrow(tidied(align), schema)


def pair_counts(sliced: DataFrame) -> DataFrame:
    """``a, b, count, best``: links of each pair of ids in the corpus, and whether no other ``a`` has more with this ``b``."""
    counts = (
        sliced.select(F.inline("pairs")).groupBy("a", "b").agg(F.sum("n").alias("count"))
    )
    highest = counts.groupBy("b").agg(F.max("count").alias("highest"))
    return counts.join(highest, "b").select("a", "b", "count", (F.col("count") == F.col("highest")).alias("best"))


def alignment(
    docs: DataFrame, byte_path: str, piece_path: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Every document's tokens, groups and links, and how good its links are in the whole corpus."""
    sliced = landed(aligned_slices(docs, byte_path, piece_path, id_column, text_column), "aligned", ROW_GROUPS)
    counts = landed(pair_counts(sliced), "counts")
    asked = sliced.select("slice", F.posexplode("pairs").alias("place", "pair")).select("slice", "place", "pair.a", "pair.b")
    told = asked.join(counts, ["a", "b"]).select(F.col("slice").alias("of"), "place", "count", "best")
    doc_id = docs.schema[id_column].dataType
    schema = T.StructType(
        [
            T.StructField("doc_id", doc_id),
            *(T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")),
            T.StructField("groups_sha256", T.StringType()),
        ]
    )

    def judge(each: pa.Table, told: pa.Table) -> pa.Table:
        links = each["links"].combine_chunks()
        codes = links.flatten().to_numpy(zero_copy_only=False)
        bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(links).to_numpy(zero_copy_only=False))]).astype(np.int64)
        place, sums = told["place"].to_numpy(), {}
        for field in ("best", "count"):
            value = np.zeros(len(place), np.int64)
            value[place] = told[field].cast(pa.int64()).to_numpy()
            running = np.concatenate([[0], np.cumsum(value[codes])])
            sums[field] = pa.array(np.diff(running[bounds]), pa.int64())
        own = [each[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_groups")]
        return pa.table([*own, sums["best"], sums["count"], each["groups_sha256"]], names=schema.names)

    # a slice is put together in Python; Spark sorts rows by slice, which it can do on disk, and holds no list of them
    each = sliced.select("slice", F.inline("docs"))
    return each.groupBy("slice").cogroup(told.groupBy("of")).applyInArrow(judge, schema)
