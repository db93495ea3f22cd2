"""Bounds that spare Python a pair, and metrics over whole batches."""

import random

import pytest
from pyspark.sql import functions as F

from pairwright.functions import arrow_metrics, similarity
from pairwright.operators import pairing
from pairwright.operators.matching import Compare, Matching
from pairwright.operators.scoring import METRICS, Comparison, possible_pairs, score_pairs
from pairwright.plans import catalog

FOLDER = "/root/testdata/sf0.001"

BOUNDED = ["jaro_winkler_similarity", "lcs_length", "ratio", "partial_ratio", "token_sort_ratio"]


def texts(rng, count):
    alphabets = ["ab", "abc xyz", "ąćżó lk", "abcdefghijklmnopqrstuvwxyz ", "日本🙂a"]
    return ["".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.randrange(0, 30))) for _ in range(count)]


@pytest.fixture(scope="module")
def pairs(spark):
    rng = random.Random(6)
    left, right = texts(rng, 600), texts(rng, 600)
    right = [r if k % 3 else a[: rng.randrange(0, len(a) + 1)] + rng.choice(["", "x", "ab"]) for k, (a, r) in enumerate(zip(left, right))]
    rows = [(k, a, b) for k, (a, b) in enumerate(zip(left, right))] + [(900, None, "a"), (901, "a", None), (902, "", ""), (903, "a", "a")]
    return spark.createDataFrame(rows, "id long, l string, r string").cache()


@pytest.mark.parametrize("metric", BOUNDED)
def test_no_score_exceeds_its_bounds(pairs, metric):
    c = Comparison("l", "r", metric, "score")
    found = pairs.select(c.score().alias("score"), c.letter_bound().alias("letters"), (c.bound() if c.bound() is not None else F.lit(None)).alias("lengths"))
    rows = [r for r in found.collect() if r["score"] is not None]
    assert len(rows) > 600
    assert all(r["letters"] >= r["score"] and (r["lengths"] is None or r["lengths"] >= r["score"]) for r in rows)


@pytest.mark.parametrize("metric, minimum", [("jaro_winkler_similarity", 0.9), ("lcs_length", 9), ("ratio", 70), ("partial_ratio", 80), ("token_sort_ratio", 70)])
def test_bounds_change_no_result_and_spare_python_most_pairs(pairs, metric, minimum):
    c = Comparison("l", "r", metric, "score")
    kept = score_pairs(pairs, [c], {"score": minimum})
    every = score_pairs(pairs, [c]).where(F.col("score") >= minimum)
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, every.collect()))
    reaching = possible_pairs(pairs, [c], {"score": minimum}).count()
    assert every.count() <= reaching < 0.6 * pairs.count()


def test_signatures_are_made_once_per_value(spark):
    records = spark.createDataFrame([(k, "b", t) for k, t in enumerate(texts(random.Random(2), 60))], "id long, block string, name string")
    job = Matching("id", ["block"], [Compare("name", "token_sort_ratio", "score")], {"score": 60})
    assert "_letters_token_sort_ratio_name" in job.carried
    links = job.links(records)
    assert not [c for c in links.columns if c.startswith("_")]
    one, two = records.select("id", "name").alias("a"), records.select("id", "name").alias("b")
    every = one.join(two, F.expr("a.id < b.id")).where(similarity.token_sort_ratio(F.col("a.name"), F.col("b.name")) >= 60)
    assert links.agg(F.sum("pairs")).first()[0] == every.count()


def test_batches_and_single_pairs_agree():
    rng = random.Random(3)
    left, right = texts(rng, 500), texts(rng, 500)
    left += ["a" * 64, "ab" * 40, "", "ab" * 100]
    right += ["a" * 70, "ba" * 33, "", "ba" * 90]
    want = [arrow_metrics.subsequence_length(a, b) for a, b in zip(left, right)]
    assert arrow_metrics.subsequence_lengths(left, right) == want
    assert arrow_metrics.subsequence_lengths([], []) == []


@pytest.mark.parametrize("letters", ["ab", "abcd", "abcdefghijklmnopqrstuvwxyz ", "aż🙂"])
def test_all_windows_of_a_braid(letters):
    rng = random.Random(len(letters))
    for _ in range(120):
        short = "".join(rng.choice(letters) for _ in range(rng.randrange(1, 25)))
        long = "".join(rng.choice(letters) for _ in range(rng.randrange(len(short), 70)))
        windows = [arrow_metrics.subsequence_length(short, long[k : k + len(short)]) for k in range(len(long) - len(short) + 1)]
        assert arrow_metrics.window_subsequences(short, long).tolist() == windows


def test_partial_ratio_of_long_texts(spark):
    rng = random.Random(12)
    short, long = ("".join(rng.choice("abcdefgh ") for _ in range(n)) for n in (300, 900))
    best = max(arrow_metrics.subsequence_length(short, long[k : k + 300]) for k in range(601))
    frame = spark.createDataFrame([(short, long), (long, short)], "l string, r string")
    got = {r[0] for r in frame.select(similarity.partial_ratio(F.col("l"), F.col("r"))).collect()}
    assert got == {round(100 * best / 300)}
    # not one window at a time: 2,001 windows of 2,000 characters
    short, long = ("".join(rng.choice("abcdefgh ") for _ in range(n)) for n in (2_000, 4_000))
    assert arrow_metrics.window_ratio(short, long) >= 45


def test_every_python_metric_with_a_minimum_is_bounded():
    # distances have no minimum that would be worth one
    assert {n for n, m in METRICS.items() if m.arrow and not n.endswith("distance")} == set(BOUNDED)


def test_letters_are_counted_from_a_value_worked_out_once(spark):
    """Within a lambda a Python function is refused, and anything else would be worked out for each of the counts."""
    calls = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def noted(value):
        calls.add(1)
        return value

    frame = spark.createDataFrame([("abca",), ("",), (None,)], "t string")
    got = [r[0] for r in frame.select(similarity.letter_counts(noted("t"))).collect()]
    assert [got[0][k] for k in (1, 2, 3)] == [2, 1, 1] and sum(got[0]) == 4 and sum(got[1]) == 0
    assert got[2] == frame.select(similarity.letter_counts(F.col("t"))).collect()[2][0] and calls.value == 3


def test_pair_counts_are_whole_numbers_where_they_are_wide_enough(spark):
    """Counts beyond a long are exact, and those below it take no wide decimals; sums over pairs neither."""
    counts = [(1, 1), (3, 5), (2**31 - 1, 2**31 - 1), (2**31, 2**33), (10**15, 7 * 10**15)]
    rows = spark.createDataFrame(counts, "a long, b long")
    found = rows.select("a", "b", pairing.pairs_between("a", "b").alias("between"), pairing.pairs_within("a").alias("within"))
    assert dict(found.dtypes)["between"] == dict(found.dtypes)["within"] == "decimal(38,0)"
    assert sorted((r["a"], r["b"], int(r["between"]), int(r["within"])) for r in found.collect()) == sorted(
        (a, b, a * b, a * (a - 1) // 2) for a, b in counts
    )
    plan = catalog.large_block_candidates(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum(cast(pairs" in plan
