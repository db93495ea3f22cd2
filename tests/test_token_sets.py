"""Pairs of similar token sets, against all pairs of a block."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pairwright.operators import pairing
from pairwright.operators.matching import Compare, Matching
from pairwright.operators.scoring import METRICS
from pairwright.operators.token_sets import candidates, ordered_bags


def word_jaccard(a, b):
    x, y = set(re.findall(r"\w+", a, re.A)), set(re.findall(r"\w+", b, re.A))
    return len(x & y) / len(x | y) if x | y else None


def character_jaccard(a, b):
    return len(set(a) & set(b)) / len(set(a) | set(b)) if a or b else 1.0


def cosine(a, b):
    x, y = Counter(re.findall(r"\w+", a, re.A)), Counter(re.findall(r"\w+", b, re.A))
    if not x or not y:
        return None
    dot = sum(n * y[w] for w, n in x.items())
    return dot / (math.sqrt(sum(n * n for n in x.values())) * math.sqrt(sum(n * n for n in y.values())))


PLAIN = {"word_jaccard_similarity": word_jaccard, "jaccard_similarity": character_jaccard, "cosine_similarity": cosine}


def texts(rng):
    words = [f"w{k}" for k in range(30)] + ["the", "of"] * 4
    out = []
    for _ in range(25):
        base = [rng.choice(words) for _ in range(rng.randrange(1, 14))]
        for _ in range(4):
            copy = list(base)
            for _ in range(rng.randrange(0, 4)):
                at = rng.randrange(0, len(copy) + 1)
                copy[at : at + rng.randrange(0, 2)] = [rng.choice(words)] * rng.randrange(0, 2)
            rng.shuffle(copy)
            out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("metric", sorted(PLAIN))
@pytest.mark.parametrize("minimum", [0.3, 0.6, 0.8, 0.9, 1.0])
def test_all_similar_pairs_are_found_once(spark, metric, minimum):
    rng = random.Random(int(100 * minimum))
    rows = [(k, rng.choice(["x", "y", None]), t) for k, t in enumerate(texts(rng))]
    rows += [(500, "x", "!?"), (501, "x", None), (502, "x", "w1 w2"), (503, "x", "w1 w2"), (504, "x", "w2 w1")]
    records = spark.createDataFrame(rows, "id long, block string, text string").repartition(3)
    job = Matching("id", ["block"], [Compare("text", metric, "score")], {"score": minimum}, slot_rows=4)
    links = job.links(records)
    assert links.groupBy("profile1", "profile2").count().where("count > 1").isEmpty()
    got = {tuple(r) for r in pairing.spell_out(links, records, "id", job.block, job.values).select("id1", "id2").collect()}
    want = set()
    for a in rows:
        for b in rows:
            if a[0] < b[0] and a[1] and a[1] == b[1] and a[2] is not None and b[2] is not None and (score := PLAIN[metric](a[2], b[2])) is not None:
                # both sides round alike: Spark divides the same whole numbers
                if score >= minimum or (metric == "cosine_similarity" and abs(score - minimum) < 1e-12):
                    want.add((a[0], b[0]))
    close = {p for p in want ^ got if metric == "cosine_similarity" and abs(cosine(*(rows[k if k < 500 else 100 + k - 500][2] for k in p)) - minimum) < 1e-12}
    assert got - close == want - close and int(links.agg(F.sum("pairs")).first()[0] or 0) == len(got)


def test_rare_tokens_come_first(spark):
    groups = spark.createDataFrame([(1, "a b c"), (2, "a b"), (3, "a a")], "profile long, t string")
    bags = {r["profile"]: [(e["token"], e["times"]) for e in r["_bag"]] for r in ordered_bags(groups, F.col("t"), METRICS["cosine_similarity"].tokens).collect()}
    assert bags == {1: [("c", 1), ("b", 1), ("a", 1)], 2: [("b", 1), ("a", 1)], 3: [("a", 2)]}


def test_few_pairs_are_compared(spark):
    """1,000 values that all share common words: half a million pairs, of which next to none share a rare one."""
    rows = spark.range(1_000).selectExpr(
        "id AS profile", "'b' AS block", "concat_ws(' ', 'the', 'of', 'and', 'a' || id, 'b' || id % 500, 'c' || id, 'd' || id, 'e' || id) AS t"
    )
    assert candidates(rows, ["block"], F.col("t"), METRICS["word_jaccard_similarity"].tokens, 0.8).count() < 1_000


def test_common_words_cost_no_pairs():
    """1,500 lists that share all their frequent words: only copies reach the minimum, in little time."""
    import time

    import numpy as np
    import pyarrow as pa

    from pairwright.operators.token_sets import similar_in_cell

    common = [f"c{k}" for k in range(60)]
    lists = [common[: 40 + k % 20] + [f"r{k // 2}_{j}" for j in range(40)] for k in range(1_500)]
    every = np.arange(len(lists))
    begun = time.time()
    for weighted, minimum in ((False, 0.8), (True, 0.9)):
        one, other = similar_in_cell(pa.array(lists, pa.list_(pa.string())), every, every, weighted, minimum)
        assert {(a, b) for a, b in zip(one.tolist(), other.tolist()) if a < b} == {(k, k + 1) for k in range(0, 1_500, 2)}
    assert time.time() - begun < 30


@pytest.mark.parametrize("metric", sorted(PLAIN))
def test_scores_come_from_where_pairs_are_found(spark, metric):
    """The scores that the cells add up are the metric's to the last bit, and no pair of texts is scored again."""
    from pairwright.operators.scoring import Comparison, score_pairs

    rng = random.Random(7)
    rows = [(k, "x", t) for k, t in enumerate(texts(rng))] + [(200, "x", "w1 w1 w2"), (201, "x", "w1 w1 w2")]
    job = Matching("id", ["block"], [Compare("text", metric, "score")], {"score": 0.5}, slot_rows=8)
    records = spark.createDataFrame(rows, "id long, block string, text string")
    met = job.meet_likely(job.qualifying_profiles(records))
    assert "score" in met.columns
    again = score_pairs(met.withColumnRenamed("score", "found"), [Comparison("text1", "text2", metric, "score")])
    pairs = again.select("found", "score").collect()
    assert len(pairs) > 50 and all(r["found"] == r["score"] for r in pairs)


def test_profiles_come_from_one_shuffle_and_pairs_are_not_shuffled(spark):
    """Where only profiles are told, pairs come whole from the cells, and texts are shuffled twice: to their profiles and to their slots."""
    records = spark.createDataFrame([(1, "x", "a b c"), (2, "x", "a b c d")], "id long, block string, text string")
    job = Matching("id", ["block"], [Compare("text", "cosine_similarity", "score")], {"score": 0.5}, tell_values=False)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        links = job.links(records)
        plan = links._jdf.queryExecution().executedPlan().toString()
        assert [tuple(r) for r in links.select("profile1", "profile2", "pairs").collect()] == [(1, 2, 1)]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert "text1" not in links.columns and "profile1#" not in "".join(x for x in plan.splitlines() if "Exchange" in x)
    assert "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning(block#") - plan.count("ReusedExchange") <= 4


def test_a_slot_is_the_same_when_unpacked_and_small():
    import numpy as np
    import pyarrow as pa

    from pairwright.operators.token_sets import Slot

    rng = random.Random(11)
    lists = [[f"word{int(rng.paretovariate(0.6))}" for _ in range(rng.randrange(0, 300))] for _ in range(400)] + [[], ["x"]]
    for weighted in (False, True):
        slot = Slot.of(pa.array(lists, pa.list_(pa.string())), weighted, [pa.array([None, *range(401)], pa.int64())])
        data = slot.packed()
        again = Slot.unpacked(data)
        assert again.count == 402 and again.names == slot.names and again.columns == slot.columns
        assert all(np.array_equal(getattr(again, n), getattr(slot, n)) for n in ("rows", "ids", "weights"))
        assert len(data) < sum(len(w) + 1 for words in lists for w in words) / 2
    empty = Slot.unpacked(Slot.of(pa.array([[], []], pa.list_(pa.string())), True, [pa.array([7, 8], pa.int64())]).packed())
    assert empty.count == 2 and not len(empty.rows) and empty.beside(slot).count == 404


def test_slots_of_several_sides_meet_once(spark):
    """2,000 values in ten slots, which are dealt to four sides: every pair of slots is in one cell."""
    rows = spark.range(2_000).selectExpr("id AS profile", "'b' AS block", "concat_ws(' ', 'a' || id % 1000, 'b' || id % 1000) AS t")
    found = candidates(rows, ["block"], F.col("t"), METRICS["word_jaccard_similarity"].tokens, 0.8, slot_rows=50)
    assert found.count() == 1_000
