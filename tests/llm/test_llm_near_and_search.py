import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pairwright.llm import jaccard_join, repeats, top_k
from pairwright.llm.components import components

WORDS = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingle_set(text, k):
    words = WORDS.findall((text or "").translate(LOWER))
    if len(words) >= k:
        return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}
    return {tuple(words)} if words else set()


def expected_components(rows, rule):
    sets = [shingle_set(text, rule.words) for _, text, *_ in rows]
    top = list(range(len(rows)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            union = len(sets[a] | sets[b])
            if union and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= rule.percent * union:
                top[find(a)] = find(b)
    least = {}
    for k, (doc_id, *_) in enumerate(rows):
        least.setdefault(find(k), []).append(doc_id)
    out = []
    for k, (doc_id, *_) in enumerate(rows):
        known = [i for i in least[find(k)] if i is not None]
        out.append((doc_id, len(sets[k]), min(known) if known else None))
    return sorted(out, key=str)


def near_rows():
    """Texts in families: edited copies above and below the limit, and a shared passage."""
    rng = random.Random(8)
    vocabulary = [f"w{k}" for k in range(4000)]
    passage = [rng.choice(vocabulary) for _ in range(40)]
    texts = []
    for size in (12, 30, 60, 150, 400):
        for _ in range(4):
            base = [rng.choice(vocabulary) for _ in range(size)]
            for _ in range(10):
                copy = list(base)
                for _ in range(rng.choice([0, 0, 1, 1, 2, size // 60, size // 40, size // 25])):
                    copy[rng.randrange(size)] = rng.choice(vocabulary)
                if rng.random() < 0.3:
                    copy = copy[: size - rng.randrange(0, 3)]
                texts.append(" ".join(copy + (passage if rng.random() < 0.3 else [])))
    rng.shuffle(texts)
    return [(k, t, "en", "s", 0) for k, t in enumerate(texts)]


@pytest.mark.parametrize(("words", "percent", "part"), [(3, 90, 1024), (3, 90, 4), (5, 80, 8)])
def test_components_match_all_pairs(documents, monkeypatch, words, percent, part):
    monkeypatch.setattr(jaccard_join, "PART", part)
    rows, rule = near_rows(), jaccard_join.Rule(words, percent)
    got = jaccard_join.jaccard_join(documents(rows=rows), rule).select("doc_id", "n_shingles", "component_id").collect()
    want = expected_components(rows, rule)
    assert sorted(map(tuple, got), key=str) == want
    assert 20 < len({c for *_, c in want}) < len(rows)


def test_edge_rows_of_the_join(documents, edge_rows):
    rule = jaccard_join.Rule()
    got = jaccard_join.jaccard_join(documents(rows=edge_rows), rule).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == expected_components(edge_rows, rule)
    assert jaccard_join.jaccard_join(documents()).count() == 0


def test_one_of_each_component_stays(documents, edge_rows):
    rule = jaccard_join.Rule()
    rows = [r for r in edge_rows if r[0] is not None]
    docs = documents(rows=rows)
    kept = jaccard_join.one_of_each(docs, rule)
    assert kept.columns == docs.columns
    found = expected_components(rows, rule)
    bare = [i for i, n, _ in found if n == 0]
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, n, c in found if n} | set(bare))


@pytest.mark.parametrize("rule", [jaccard_join.Rule(), corpus_pipeline.NEAR])
def test_one_row_of_each_group_stays_when_ids_are_null_or_repeat(documents, edge_rows, rule):
    rng = random.Random(9)
    rows = edge_rows + [(1000 + k, *r) for k, *r in near_rows()]
    for ids in ([None] * 4, [50] * 4, [None, 61, 60, None, 60], [70]):
        words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(120)]
        texts = [" ".join(words[: 120 - k]) for k in range(len(ids))]
        rows += [(i, t, "en", "s", len(t)) for i, t in zip(ids, texts, strict=True)]
    # Brute force by place in the list, so that null and repeated ids stay apart.
    numbered = [(k, *r[1:]) for k, r in enumerate(rows)]
    groups = {}
    for k, n, component in expected_components(numbered, rule):
        groups.setdefault(component if n else ("bare", k), []).append(k)
    want = [min((rows[k][0] for k in g if rows[k][0] is not None), default=None) for g in groups.values()]
    kept = jaccard_join.one_of_each(documents(rows=rows), rule).select("doc_id", "text").collect()
    assert sorted(map(str, want)) == sorted(str(r["doc_id"]) for r in kept)
    place = {(r[0], r[1]): k for k, r in enumerate(rows)}
    group_of = {k: c for c, g in groups.items() for k in g if not isinstance(c, tuple)}
    found = [group_of[place[r["doc_id"], r["text"]]] for r in kept if place[r["doc_id"], r["text"]] in group_of]
    assert len(found) == len(set(found)) == len(set(group_of.values()))


def test_sketches_never_overrate_a_difference():
    rng = np.random.default_rng(1)
    for n in (5, 60, 300, 2000):
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        for changed in (0, 1, n // 10, n // 3):
            b = np.unique(np.concatenate([a[changed:], rng.integers(0, 1 << 63, changed).astype(np.uint64)]))
            x, y = jaccard_join.sketch(a), jaccard_join.sketch(b)
            w = min(len(x), len(y))
            differ = np.bitwise_count(jaccard_join.folded(x[None], w) ^ jaccard_join.folded(y[None], w)).sum()
            assert differ <= len(np.setxor1d(a, b))


def test_components_of_a_long_chain(spark):
    edges = spark.range(40).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = components(edges.where("a <> 20"))
    assert sorted(map(tuple, got.collect())) == [(k, 0 if k <= 20 else 21) for k in range(41)]

def test_only_nodes_beside_a_pair_without_link_are_unsettled(spark):
    """Forests of groups that link throughout, and of some in which pairs do not: every pair of nodes between two
    components of a tree is kept for the second search, whole groups are not."""
    rng = random.Random(5)
    pairs, linked = [], []
    for group in range(40):
        tree = [(100 * group + rng.randrange(k), 100 * group + k) for k in range(1, 8)]
        pairs += tree
        linked += tree if group % 4 else [p for p in tree if rng.random() < 0.6]
    labels = components(spark.createDataFrame(linked, "a long, b long"))
    top = {r["node"]: r["label"] for r in labels.collect()}
    found = jaccard_join.unsettled(spark.createDataFrame(pairs, "a long, b long"), labels).collect()
    kept = {r["node"]: r["label"] for r in found}
    assert len(kept) == len(found)
    want = {}
    for group in range(40):
        nodes = {100 * group + k: top.get(100 * group + k, 100 * group + k) for k in range(8)}
        if len(set(nodes.values())) > 1:
            want |= nodes
    assert want and kept == want and len(kept) <= 80


def brute_top(rows, k, scale=256):
    whole = [(i, n, [int(np.floor(scale * float(x))) for x in v]) for n, (i, v) in enumerate(rows)
             if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for i, n, v in whole:
        if i is None or i % 5:
            continue
        scores = [(-sum(a * b for a, b in zip(v, w, strict=True)), j is None, j or 0, m, j)
                  for j, m, w in whole if m != n and len(w) == len(v)]
        out += [(i, rank, s[4], -s[0]) for rank, s in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def vector_rows():
    rng = np.random.default_rng(6)
    rows = [(int(i), rng.normal(0, 0.3, 8).astype(np.float32).tolist()) for i in range(300)]
    rows += [(300 + i, [0.5] * 8) for i in range(7)] + [(None, [0.5] * 8), (310, [0.0] * 8)]
    rows += [(320, None), (325, [None] * 8), (330, [float("nan")] * 8), (335, [float("inf")] * 8)]
    rows += [(340, []), (345, []), (350, [1e6, -1e6]), (355, [1e6, 3.0]), (360, [1.0, 2.0, 3.0])]
    return rows


@pytest.mark.parametrize(("block", "query_block"), [(8192, 2048), (32, 16)])
def test_top_k_matches_all_scores(spark, block, query_block):
    rows = vector_rows()
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("v", F.lit(1)).repartition(3)
    got = top_k.top_k(vectors, F.col("vec_id") % 5 == 0, block=block, query_block=query_block).collect()
    assert sorted(((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got), key=str) == brute_top(rows, 5)


def test_top_k_of_nothing(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert top_k.top_k(none, F.col("vec_id") % 5 == 0).count() == 0


def test_search_stops_before_the_end_of_the_lists():
    rng = np.random.default_rng(7)
    vectors = np.floor(256 * rng.normal(0, 0.1, (4000, 3))).astype(np.int64)
    vectors[:5] *= 10
    block = top_k.Block(vectors)
    rows, scores = block.search(np.array([3, -2, 1]), 5, np.empty(0, np.int64), np.arange(4000))
    want = np.sort(vectors @ np.array([3, -2, 1]))[::-1][:5]
    assert scores.tolist() == want.tolist() and block.read < 2000


def brute_repeats(rows, length):
    raw = [(i, (t or "").encode()) for i, t, *_ in rows]
    times = collections.Counter(b[k : k + length] for _, b in raw for k in range(len(b) - length + 1))
    out = []
    for i, b in raw:
        gone = np.zeros(len(b) + 1, dtype=bool)
        for k in range(len(b) - length + 1):
            if times[b[k : k + length]] > 1:
                gone[k : k + length] = True
        kept = bytes(x for x, g in zip(b, gone[:-1], strict=True) if not g)
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("together", [256, 2])
def test_repeats_match_a_count_of_all_strings(documents, edge_rows, monkeypatch, together):
    monkeypatch.setattr(repeats, "TOGETHER", together)
    rng = random.Random(9)
    passages = ["".join(rng.choice("ab é") for _ in range(rng.randrange(20, 120))) for _ in range(8)]
    texts = []
    for _ in range(60):
        parts = [rng.choice(passages) if rng.random() < 0.6 else "".join(rng.choice("abcdé") for _ in range(30)) for _ in range(5)]
        texts.append("".join(parts))
    texts += ["a" * 200, "ab" * 100, "ab" * 90, texts[0], texts[0], "", None]
    rows = [(k, t, "en", "s", 0) for k, t in enumerate(texts)] + [r for r in edge_rows if len(r[1] or "") < 1000]
    got = repeats.without_repeats(documents(rows=rows), length=40, gram=8).collect()
    assert sorted(map(tuple, got), key=str) == brute_repeats(rows, 40)


def test_repeats_of_production_length(documents, edge_rows):
    rows = [(r[0], (r[1] or "")[:3000] if r[1] else r[1], *r[2:]) for r in edge_rows]
    got = repeats.without_repeats(documents(rows=rows)).collect()
    assert sorted(map(tuple, got), key=str) == brute_repeats(rows, 400)
    assert repeats.without_repeats(documents()).count() == 0


def test_ranks_follow_the_bytes():
    raw = np.frombuffer(b"abracadabra abracadabra", dtype=np.uint8)
    for length in (1, 3, 8, 11):
        rank = repeats.ranks(raw, length)
        strings = [raw[k : k + length].tobytes() for k in range(len(rank))]
        assert [sorted(set(strings)).index(s) for s in strings] == rank.tolist()
