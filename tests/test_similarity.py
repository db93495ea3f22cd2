"""String metrics against stated values and against brute force."""

import math
from collections import Counter
from functools import lru_cache

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pairwright.functions import similarity

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
TEXT = st.text("abcż _", max_size=9)
PAIRS = st.lists(st.tuples(TEXT, TEXT), min_size=1, max_size=40)

STATED = [
    ("levenshtein_distance", "hyperspace", "cyberscape", 4),
    ("hamming_distance", "hyperspace", "cyberscape", 4),
    ("hamming_distance", "abc", "ab", None),
    ("jaccard_similarity", "hyperspace", "cyberscape", 7 / 9),
    ("jaccard_distance", "hyperspace", "cyberscape", 2 / 9),
    ("jaccard_similarity", "", "", 1.0),
    ("jaccard_similarity", "", "a", 0.0),
    ("jaro_winkler_similarity", "hyperspace", "cyberscape", 0.825),
    ("jaro_winkler_distance", "hyperspace", "cyberscape", 0.175),
    ("lcs_length", "hyperspace", "cyberscape", 6),
    ("lcs_distance", "hyperspace", "cyberscape", 8),
    ("fuzzy_subsequence_score", "hyperspace", "cyberscape", 1),
    ("fuzzy_subsequence_score", "Workshop", "wo", 4),
    ("cosine_similarity", "string similarity", "string distance", 0.5),
    ("cosine_distance", "string similarity", "string distance", 0.5),
    ("cosine_distance", "string distance", "string", 1 - 1 / math.sqrt(2)),
    ("token_sort_ratio", "b  a", "a b", 100),
    ("ratio", "Łucja Zielińska S.", "Łucja Zielińska", 91),
    ("ratio", "Łucja Zielińska S.", "Zielińska Łucja", 61),
    ("partial_ratio", "Łucja Zielińska S.", "Łucja Zielińska", 100),
    ("partial_ratio", "Łucja Zielińska", "Łucja Zielińska S.", 100),
    ("partial_ratio", "Łucja Zielińska S.", "Zielińska Łucja", 67),
    ("token_sort_ratio", "Łucja Zielińska S.", "Zielińska Łucja", 93),
    ("token_sort_ratio", "Łucja Zielińska S.", "Zielińska S. Łucja", 100),
    ("ratio", "", "", 100),
    ("ratio", "", "a", 0),
]
NULL_GIVES = {"ratio": 0, "partial_ratio": 0, "token_sort_ratio": 0}
ALL = sorted({name for name, *_ in STATED})


def scores(spark, name, pairs):
    df = spark.createDataFrame(pairs, "a string, b string").coalesce(1)
    return [r[0] for r in df.select(getattr(similarity, name)(F.col("a"), F.col("b"))).collect()]


@pytest.mark.parametrize("name", ALL)
def test_stated_values(spark, name):
    cases = [c for c in STATED if c[0] == name]
    got = scores(spark, name, [(a, b) for _, a, b, _ in cases])
    assert got == [pytest.approx(x) if x is not None else None for *_, x in cases]


@pytest.mark.parametrize("name", ALL)
def test_null_sides(spark, name):
    expected = NULL_GIVES.get(name)
    assert scores(spark, name, [(None, "a"), ("a", None), (None, None)]) == [expected] * 3


def lcs(a, b):
    @lru_cache(None)
    def go(i, j):
        if i == len(a) or j == len(b):
            return 0
        if a[i] == b[j]:
            return 1 + go(i + 1, j + 1)
        return max(go(i + 1, j), go(i, j + 1))

    return go(0, 0)


def plain_ratio(a, b):
    return round(100 * (2 * lcs(a, b) / (len(a) + len(b)))) if a or b else 100


def plain_partial(a, b):
    short, long = sorted((a, b), key=len)
    if not short:
        return 100 if not long else 0
    windows = [long[i : i + len(short)] for i in range(len(long) - len(short) + 1)]
    return max(plain_ratio(short, w) for w in windows)


def plain_jaro_winkler(a, b):
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    pairs, free = [], set(range(len(b)))
    for i in range(len(a)):
        near = [j for j in sorted(free) if abs(i - j) <= reach and a[i] == b[j]]
        if near:
            pairs.append((i, near[0]))
            free.discard(near[0])
    m = len(pairs)
    if m == 0:
        return 0.0
    mine, theirs = [a[i] for i, _ in pairs], [b[j] for j in sorted(j for _, j in pairs)]
    moved = sum(x != y for x, y in zip(mine, theirs)) // 2
    jaro = (m / len(a) + m / len(b) + (m - moved) / m) / 3
    shared = 0
    while shared < min(4, len(a), len(b)) and a[shared] == b[shared]:
        shared += 1
    return jaro if jaro < 0.7 else jaro + 0.1 * shared * (1 - jaro)


def plain_cosine(a, b):
    def words(s):
        runs = "".join(ch if ch in "abc_" else " " for ch in s).split()
        return Counter(runs)

    x, y = words(a), words(b)
    if not x or not y:
        return None
    norm = math.sqrt(sum(v * v for v in x.values())) * math.sqrt(sum(v * v for v in y.values()))
    return sum(v * y[w] for w, v in x.items()) / norm


def plain_subsequence(term, query):
    points, at, last = 0, 0, None
    for ch in query.lower():
        found = term.lower().find(ch, at)
        if found < 0:
            break
        points += 3 if last is not None and found == last + 1 else 1
        last, at = found, found + 1
    return points


BRUTE_FORCE = {
    "lcs_length": lcs,
    "ratio": plain_ratio,
    "partial_ratio": plain_partial,
    "jaro_winkler_similarity": plain_jaro_winkler,
    "cosine_similarity": plain_cosine,
    "fuzzy_subsequence_score": plain_subsequence,
}


@pytest.mark.parametrize("name", sorted(BRUTE_FORCE))
@SETTINGS
@given(PAIRS)
def test_against_brute_force(spark, name, pairs):
    expected = [BRUTE_FORCE[name](a, b) for a, b in pairs]
    got = scores(spark, name, pairs)
    assert got == [pytest.approx(x) if x is not None else None for x in expected]


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(PAIRS)
def test_symmetry(spark, pairs):
    df = spark.createDataFrame(pairs, "a string, b string").coalesce(1)
    a, b = F.col("a"), F.col("b")
    for name in ALL:
        if name != "fuzzy_subsequence_score":
            metric = getattr(similarity, name)
            for there, back in df.select(metric(a, b).alias("there"), metric(b, a).alias("back")).collect():
                assert there == (pytest.approx(back) if back is not None else None)


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(TEXT, TEXT, TEXT), min_size=1, max_size=40))
def test_triangle_inequality(spark, triples):
    df = spark.createDataFrame(triples, "a string, b string, c string")
    direct = similarity.levenshtein_distance(F.col("a"), F.col("c"))
    detour = F.levenshtein("a", "b") + F.levenshtein("b", "c")
    assert df.where(direct > detour).count() == 0


@SETTINGS
@given(PAIRS)
def test_ratio_never_exceeds_its_bound(spark, pairs):
    df = spark.createDataFrame(pairs, "a string, b string")
    a, b = F.col("a"), F.col("b")
    both = df.select(similarity.ratio(a, b).alias("r"), similarity.ratio_bound(a, b).alias("top"))
    assert both.where("r > top").count() == 0


def test_long_texts_are_scored_whole(spark):
    left = " ".join(f"w{i % 50}" for i in range(5000))
    right = left + " tail"
    assert scores(spark, "lcs_length", [(left, right)]) == [len(left)]
    assert scores(spark, "cosine_similarity", [(left, right)])[0] == pytest.approx(1.0, abs=1e-4)
