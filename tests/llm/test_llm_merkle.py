import zlib
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairwright.llm import merkle


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[0], row[3], row[2], row[4], row[1])))


def levels_of(digests):
    out = [digests]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][k : k + 3]) for k in range(0, len(out[-1]), 3)])
    return out


def steps(levels, at):
    for level in levels[:-1]:
        first = at - at % 3
        yield level[first:at], level[at + 1 : first + 3]
        at //= 3


def expected(rows):
    """The contract row by row; rows are (doc_id, text, lang, source, n_chars)."""
    trees = {}
    for row in rows:
        trees.setdefault(row[3], []).append((row[0] is not None, row[0] or 0, leaf_of(row), row))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    built = {s: levels_of([t[2] for t in sorted(trees[s], key=lambda t: t[:3])]) for s in names}
    top = levels_of([built[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for at, (*_, leaf, row) in enumerate(sorted(trees[s], key=lambda t: t[:3])):
            path = [*steps(built[s], at), *steps(top, k)]
            start = leaf
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0:
                text = None if row[1] is None else row[1].replace("\n", "")
                start = leaf_of((row[0], text, *row[2:]))
            for before, after in path:
                start = h(*before, start, *after)
            proof = h(*(d for before, after in path for d in (*before, *after)))
            out.append((row[0], leaf, built[s][-1][0], top[-1][0], proof, start, start == top[-1][0]))
    return sorted(out, key=str)


def found(docs, **settings):
    return sorted(map(tuple, merkle.checked_copy(docs, **settings).collect()), key=str)


def many_rows():
    """Sources of 1 to 60 rows, some null or empty, ids that repeat."""
    sizes = {None: 4, "": 1, "a": 60, "b": 27, "ż": 3, "z": 10, "B": 28, "é": 2}
    rows, key = [], 0
    for source, size in sizes.items():
        for k in range(size):
            key += 1
            rows.append((key - key % 7, f"line {k}\nline\n" * (k % 3) if k % 5 else None, "en" if k % 2 else None, source, k))
    return rows


@pytest.mark.parametrize("height", [1, 2, 7])
def test_proofs_are_those_of_the_contract(documents, height):
    rows = many_rows()
    got = found(documents(rows=rows), height=height)
    assert got == expected(rows)
    assert {g[-1] for g in got} == {True, False}


def test_edge_rows(documents, edge_rows):
    assert found(documents(rows=edge_rows)) == expected(edge_rows)
    assert found(documents()) == []
    alone = [(5, "only\none", "en", "s", 8)]
    assert found(documents(rows=alone)) == expected(alone)
    assert found(documents(rows=alone))[0][4] == sha256(b"").hexdigest()


def test_a_mass_of_equal_rows(documents):
    rows = [(1, "same\n", "en", "s", 5)] * 200 + [(2, "other", "en", "s", 5)]
    assert found(documents(rows=rows), height=2) == expected(rows)


def test_places_are_those_of_the_order(spark):
    rows = spark.createDataFrame([("t", (k * 37) % 101) for k in range(101)] + [("u", k) for k in range(5)], "tree string, v int")
    got = merkle.placed(rows.repartition(7), ["v"]).collect()
    assert all(r["pos"] == r["v"] and r["size"] == (101 if r["tree"] == "t" else 5) for r in got)


@pytest.mark.parametrize("levels", range(1, 9))
def test_addresses_are_a_layout(levels):
    at = merkle.addresses(levels)
    assert [len(a) for a in at] == [3**k for k in range(levels)]
    assert np.array_equal(np.sort(np.concatenate(at)), np.arange(merkle.nodes_of(levels)))
    # a lower tree lies in one piece, and is laid out as it would be alone
    upper = levels // 2
    if upper:
        size = merkle.nodes_of(levels - upper)
        for k in range(3**upper):
            own = [a[k * 3**d : (k + 1) * 3**d] for d, a in enumerate(at[upper:])]
            start = min(int(o.min()) for o in own)
            assert all(np.array_equal(o - start, a) for o, a in zip(own, merkle.addresses(levels - upper), strict=True))
            assert start == merkle.nodes_of(upper) + k * size


def test_a_changed_block_shows(documents):
    """The manifest's own blocks: one byte changed, and no proof through it holds."""
    rows = many_rows()
    made = merkle.manifest(documents(rows=rows), height=2)
    assert made.leaves.count() == len(rows)
    assert made.sources.rounds[0].agg(F.sum("leaves")).first()[0] == len(rows)
    block = made.sources.rounds[0].where("tree = '=a' AND block = 0").first()
    paths = merkle.block_paths(block["nodes"], block["levels"], block["leaves"])
    leaves = [r["leaf"] for r in made.leaves.where("tree = '=a' AND pos < 9").orderBy("pos").collect()]
    assert all(merkle.folded(d, p) == block["root"] for d, p in zip(leaves, paths, strict=True))
    broken = bytearray(block["nodes"])
    broken[32 * int(merkle.addresses(3)[2][4])] ^= 1
    paths = merkle.block_paths(bytes(broken), block["levels"], block["leaves"])
    held = [merkle.folded(d, p) == block["root"] for d, p in zip(leaves, paths, strict=True)]
    # the changed leaf's own path has only its siblings
    assert held == [True] * 3 + [False, True, False] + [True] * 3
