"""Suffix-array dedup by prefix-free parsing.

Every string of ``length`` bytes that occurs more than once in a corpus is
removed wherever it occurs.

*Parse.*  A rolling hash of ``gram`` bytes triggers phrases: each window of
``length`` bytes has one trigger, the least hash within it (the leftmost of
equals), and a phrase is a run of windows with one trigger.  Phrases overlap by
``length - 1`` bytes, so every window lies in exactly one of them.  Equal windows
have equal triggers at equal places.

*Dictionary.*  Of a phrase that occurs twice, all windows are repeated.  Of a
phrase whose trigger no other phrase has, none is.  Only different phrases with
one trigger are left, the edges of what is repeated.  A repetitive corpus has few
of them: what occurs a thousand times is one phrase.

*Order.*  The windows of those phrases are sorted by a suffix array of the
dictionary, built by doubling from ranks of 8 bytes up to ``length``; windows of
one rank are equal to the byte.  As no window leaves its phrase, the order of the
parse adds nothing below ``length`` bytes; it tells where each phrase occurs.

Texts meet their ranges by a 128-bit hash of the text, so copies of a text are
handled once.  A trigger with very many phrases is split by where in the window
the trigger stands, and beyond that by the window itself.

Defined cases: a null text counts as empty; texts shorter than ``length`` lose
nothing; overlapping occurrences within a text count; ids may repeat or be null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairwright.llm.frames import landed, text_of
from pairwright.llm.words import filled, sizes_in_bytes, slices

LENGTH = 400
GRAM = 48
# Bytes parsed at once, bytes ordered at once, phrases of one trigger ordered together.
STRETCH = 1 << 20
ORDERED = 1 << 20
TOGETHER = 256
FACTOR = 0x9E3779B97F4A7C15 | 5
INVERSE = pow(FACTOR, -1, 1 << 64)


def _powers(base: int, count: int) -> np.ndarray:
    """``base ** 0, 1, …`` modulo 2**64."""
    out = np.ones(count, dtype=np.uint64)
    if count > 1:
        out[1:] = base
        np.multiply.accumulate(out, out=out)
    return out


class Parser:
    """Cuts bytes into phrases."""

    def __init__(self, length: int = LENGTH, gram: int = GRAM):
        self.length, self.gram = length, gram
        self.up = _powers(FACTOR, STRETCH + length)
        self.down = _powers(INVERSE, STRETCH + length)

    def grams(self, raw: np.ndarray) -> np.ndarray:
        """Rolling hash of the bytes from each position on."""
        sums = np.zeros(len(raw) + 1, dtype=np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * self.up[: len(raw)], out=sums[1:])
        h = (sums[self.gram :] - sums[: -self.gram]) * self.down[: len(raw) - self.gram + 1]
        h ^= h >> np.uint64(32)
        return h * np.uint64(0xD6E8FEB86659FD93)

    def phrases(self, raw: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """Start, last window, trigger's position and hash of each phrase; ``ends`` has the end of each byte's text."""
        width = self.length - self.gram + 1
        for base in range(0, len(raw), STRETCH):
            part = raw[base : base + STRETCH + self.length - 1]
            windows = len(part) - self.length + 1
            if windows < 1:
                return
            h = self.grams(part)
            # the least hash, then the leftmost: 40 bits of hash above 24 of position
            key = (h & ~np.uint64(0xFFFFFF)) | np.arange(len(h), dtype=np.uint64)
            padded = np.full(-(-len(key) // width) * width, ~np.uint64(0))
            padded[: len(key)] = key
            blocks = padded.reshape(-1, width)
            left = np.minimum.accumulate(blocks, axis=1).reshape(-1)
            right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
            least = np.minimum(right[:windows], left[width - 1 : width - 1 + windows])
            at = (least & np.uint64(0xFFFFFF)).astype(np.int64)
            own = np.arange(base, base + windows)
            inside = own + self.length <= ends[base : base + windows]
            cut = np.diff(at, prepend=-1) != 0
            cut |= np.diff(inside, prepend=False)
            cut |= np.diff(ends[base : base + windows], prepend=-1) != 0
            first = np.flatnonzero(cut)
            last = np.append(first[1:], windows) - 1
            keep = inside[first]
            first, last = first[keep], last[keep]
            yield first + base, last + base, at[first] + base, h[at[first]]


def parse(docs: DataFrame, text_column: str, length: int, gram: int) -> DataFrame:
    """Phrases of every text: ``text_key, start, size, at, trigger, phrase``.

    ``at`` is the trigger's place in the phrase, ``phrase`` a hash of its bytes.
    """
    rows = docs.select(text_of(text_column).alias("text")).where(F.octet_length("text") >= length)
    rows = rows.select(F.unhex(F.md5("text")).alias("text_key"), "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = Parser(length, gram)
        for batch in batches:
            for part, texts in slices(batch, filled(batch.column("text")), STRETCH):
                sizes = sizes_in_bytes(texts)
                ends = np.cumsum(sizes)
                data = b"".join(texts.cast(pa.binary()).to_pylist())
                view, raw = memoryview(data), np.frombuffer(data, dtype=np.uint8)
                for first, last, at, trigger in parser.phrases(raw, np.repeat(ends, sizes)):
                    text = np.searchsorted(ends, first, side="right")
                    hashes = [
                        xxhash.xxh3_64_intdigest(view[a:b])
                        for a, b in zip(first.tolist(), (last + length).tolist(), strict=True)
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pc.take(part.column("text_key"), pa.array(text)),
                            pa.array(first - (ends - sizes)[text]),
                            pa.array((last - first + length).astype(np.int32)),
                            pa.array((at - first).astype(np.int32)),
                            pa.array(trigger.view(np.int64)),
                            pa.array(np.array(hashes, dtype=np.uint64).view(np.int64)),
                        ],
                        names=["text_key", "start", "size", "at", "trigger", "phrase"],
                    )

    return rows.mapInArrow(cut, "text_key binary, start long, size int, at int, trigger long, phrase long")


def ranks(raw: np.ndarray, length: int) -> np.ndarray:
    """Rank of the ``length`` bytes from each position on; equal ranks are equal bytes.

    Doubling: the rank of 2 k bytes comes from the pair of ranks of k bytes.
    """
    count = len(raw) - length + 1
    known = min(8, length)
    eight = np.zeros(len(raw) - known + 1, dtype=np.uint64)
    for k in range(known):
        eight = (eight << np.uint64(8)) | raw[k : k + len(eight)]
    rank = np.unique(eight, return_inverse=True)[1].astype(np.uint64)
    while known < length:
        step = min(known, length - known)
        pairs = (rank[: len(rank) - step] << np.uint64(32)) | rank[step:]
        rank = np.unique(pairs, return_inverse=True)[1].astype(np.uint64)
        known += step
    return rank[:count].astype(np.int64)


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and one past the last index of each run of true flags."""
    edge = np.diff(flags.astype(np.int8), prepend=0, append=0)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


class _Ordering:
    """Phrases of complete triggers, ordered together."""

    def __init__(self, length: int):
        self.length = length
        self.rows: list[tuple[int, bytes | None, bytes]] = []
        self.size = 0

    def add(self, start: int, text_key: bytes | None, data: bytes) -> None:
        self.rows.append((start, text_key, data))
        self.size += len(data)

    def ranges(self) -> pa.RecordBatch:
        """Repeated stretches of the phrases that are to be told (those with a text)."""
        keys, starts, stops = [], [], []
        if self.rows:
            raw = np.frombuffer(b"".join(r[2] for r in self.rows), dtype=np.uint8)
            rank = ranks(raw, self.length)
            # windows of one phrase each; those across two phrases are no windows
            sizes = np.array([len(r[2]) for r in self.rows])
            place = np.repeat(np.cumsum(sizes), sizes)[: len(rank)] - np.arange(len(rank)) >= self.length
            times = np.bincount(rank[place])
            position = 0
            for start, text_key, data in self.rows:
                windows = len(data) - self.length + 1
                if text_key is not None:
                    a, b = runs(times[rank[position : position + windows]] > 1)
                    keys += [text_key] * len(a)
                    starts += (start + a).tolist()
                    stops += (start + b - 1 + self.length).tolist()
                position += len(data)
        self.rows, self.size = [], 0
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.binary()), pa.array(starts, pa.int64()), pa.array(stops, pa.int64())],
            names=["text_key", "start", "stop"],
        )


def edges(dictionary: DataFrame, docs: DataFrame, text_column: str, length: int, gram: int) -> DataFrame:
    """Repeated ranges ``text_key, start, stop`` in phrases that occur once but share their trigger.

    ``dictionary`` has the different phrases of such triggers, each with one
    place where it occurs.
    """
    width = length - gram + 1
    members = dictionary.groupBy("trigger").agg(F.count(F.lit(1)).alias("members"))
    wanted = (
        dictionary.join(members, "trigger")
        .groupBy(F.col("home.text_key").alias("text_key"))
        .agg(F.collect_list(F.struct("trigger", "members", "times", "home.start", "home.size", "home.at")).alias("phrases"))
    )
    texts = docs.select(text_of(text_column).alias("text")).where(F.octet_length("text") >= length)
    texts = texts.select(F.unhex(F.md5("text")).alias("text_key"), "text").groupBy("text_key").agg(F.first("text").alias("text"))
    both = texts.join(wanted.hint("shuffle_hash"), "text_key").select("text_key", "text", "phrases")

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _ in (x for batch in batches for x in slices(batch, batch.column("text"), STRETCH)):
            rows: list[tuple] = []
            for key, text, phrases in zip(*(part.column(c).to_pylist() for c in ("text_key", "text", "phrases")), strict=True):
                raw = text.encode()
                for p in phrases:
                    rows += spelled(key, raw, p)
                    if len(rows) >= 10_000:
                        yield table(rows)
                        rows = []
            yield table(rows)

    def spelled(key: bytes, raw: bytes, p: dict) -> Iterator[tuple]:
        """The phrase's windows by the trigger's place in them, as many parts as its trigger needs."""
        told = key if p["times"] == 1 else None
        parts = min(width, -(-p["members"] // TOGETHER))
        splits = -(-p["members"] // (TOGETHER * width))
        step = -(-width // parts)
        windows = p["size"] - length + 1
        # window k has its trigger at place at - k
        for part in range((p["at"] - windows + 1) // step, p["at"] // step + 1):
            a, b = max(0, p["at"] - (part + 1) * step + 1), min(windows, p["at"] - part * step + 1)
            if a < b:
                data = raw[p["start"] + a : p["start"] + b - 1 + length]
                split = xxhash.xxh3_64_intdigest(data) % splits if splits > 1 and b - a == 1 else 0
                yield (p["trigger"], part, split, p["start"] + a, told, data)

    def table(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
        columns = zip(*rows, strict=True) if rows else [[]] * 6
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)],
            names=["trigger", "part", "split", "start", "text_key", "data"],
        )

    pieces = both.mapInArrow(spell, "trigger long, part int, split int, start long, text_key binary, data binary")

    def order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ordering = _Ordering(length)
        last = None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:3] != last and ordering.size >= ORDERED:
                    yield ordering.ranges()
                last = row[:3]
                ordering.add(row[3], row[4], row[5])
        yield ordering.ranges()

    dealt = pieces.repartition("trigger", "part", "split").sortWithinPartitions("trigger", "part", "split")
    return dealt.mapInArrow(order, "text_key binary, start long, stop long")


def repeated_ranges(docs: DataFrame, text_column: str, length: int, gram: int) -> DataFrame:
    """``text_key`` and ``ranges``, an array of ``(start, stop)`` of repeated bytes; ranges may overlap."""
    phrases = landed(parse(docs, text_column, length, gram), "parse")
    triggers = phrases.groupBy("trigger").agg(
        F.count(F.lit(1)).alias("places"), F.min("phrase").alias("low"), F.max("phrase").alias("high")
    )
    # written first, so that the join reads two plain shuffles and a common trigger can be split
    twice = triggers.where(F.col("places") > 1).select("trigger", (F.col("low") < F.col("high")).alias("several"))
    twice = landed(twice, "twice")
    again = landed(phrases.join(twice.hint("shuffle_hash"), "trigger"), "again")
    home = F.min(F.struct("text_key", "start", "size", "at")).alias("home")
    dictionary = landed(
        again.groupBy("trigger", "phrase", "several").agg(F.count(F.lit(1)).alias("times"), home), "dictionary"
    )
    whole = again.join(dictionary.where(F.col("times") > 1).select("trigger", "phrase"), ["trigger", "phrase"])
    whole = whole.select("text_key", "start", (F.col("start") + F.col("size")).alias("stop"))
    parts = edges(dictionary.where("several"), docs, text_column, length, gram)
    return (
        whole.unionByName(parts)
        .distinct()
        .groupBy("text_key")
        .agg(F.collect_list(F.struct("start", "stop")).alias("ranges"))
    )


def _kept(raw: bytes, ranges: list[dict]) -> tuple[list[bytes], int, int]:
    """What stays of some bytes, how many go, and in how many runs."""
    kept, gone, spans, at = [], 0, 0, 0
    for r in sorted(ranges, key=lambda r: r["start"]):
        if r["start"] > at or not spans:
            kept.append(raw[at : r["start"]])
            spans += 1
            at = r["start"]
        if r["stop"] > at:
            gone += r["stop"] - at
            at = r["stop"]
    kept.append(raw[at:])
    return kept, gone, spans


def without_repeats(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", length: int = LENGTH, gram: int = GRAM
) -> DataFrame:
    """What every document loses, and a digest of what stays."""
    ranges = landed(repeated_ranges(docs, text_column, length, gram), "ranges")
    texts = docs.select(text_of(text_column).alias("text")).where(F.octet_length("text") >= length)
    texts = texts.select(F.unhex(F.md5("text")).alias("text_key"), "text").groupBy("text_key").agg(F.first("text").alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _ in (x for batch in batches for x in slices(batch, batch.column("text"), STRETCH)):
            keys, gone, spans, digests = [], [], [], []
            for key, text, found in zip(*(part.column(c).to_pylist() for c in ("text_key", "text", "ranges")), strict=True):
                kept, n, runs_ = _kept(text.encode(), found)
                digest = hashlib.sha256()
                for piece in kept:
                    digest.update(piece)
                keys.append(key)
                gone.append(n)
                spans.append(runs_)
                digests.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array(gone, pa.int64()), pa.array(spans, pa.int64()), pa.array(digests, pa.string())],
                names=["text_key", "n_removed", "n_spans", "digest"],
            )

    lost = texts.join(ranges.hint("shuffle_hash"), "text_key").select("text_key", "text", "ranges")
    lost = landed(lost.mapInArrow(cut, "text_key binary, n_removed long, n_spans long, digest string"), "lost")
    text = text_of(text_column)
    rows = docs.select(
        F.col(id_column).alias("doc_id"),
        F.unhex(F.md5(text)).alias("text_key"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.sha2(text, 256).alias("whole"),
    )
    return rows.join(lost, "text_key", "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("digest", "whole").alias("kept_sha256"),
    )


ORACLE = r"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, encode(coalesce(text, '')) AS h,
    octet_length(encode(coalesce(text, ''))) AS n FROM documents),
w AS (SELECT rid, h, unnest(range(0, n - 399)) AS p FROM t WHERE n >= 400),
k AS (SELECT rid, p, md5_number(h[p + 1:p + 400]) AS m FROM w),
r AS (SELECT rid, p FROM k WHERE m IN (SELECT m FROM k GROUP BY m HAVING count(*) > 1)),
f AS (SELECT rid, p, CASE WHEN p > lag(p) OVER (PARTITION BY rid ORDER BY p) + 400 THEN 1 ELSE 0 END AS fresh FROM r),
g AS (SELECT rid, p, sum(fresh) OVER (PARTITION BY rid ORDER BY p) AS run FROM f),
span AS (SELECT rid, min(p) AS a, max(p) + 400 AS b FROM g GROUP BY rid, run),
gap AS (SELECT rid, a, b, coalesce(lag(b) OVER (PARTITION BY rid ORDER BY a), 0) AS since FROM span),
cut AS (
  SELECT rid, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans, max(b) AS last,
    string_agg(hex(h[since + 1:a]), '' ORDER BY a) AS kept
  FROM gap JOIN t USING (rid) GROUP BY rid
)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(CASE WHEN n_spans > 0 THEN unhex(kept || hex(h[last + 1:])) ELSE h END) AS kept_sha256
FROM t LEFT JOIN cut USING (rid)
"""
