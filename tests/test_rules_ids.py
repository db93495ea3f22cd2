"""Several block rules, and ids at scale."""

import random

import pytest
from pyspark.sql import functions as F

from pairwright.operators import ids, pairing, rules
from pairwright.operators.matching import Compare


def records(spark):
    rng = random.Random(5)
    rows = [
        (k, rng.choice(["ann", "bob", "cid", None]), rng.choice(["x", "y", "z", None]), rng.choice(["u", "v", None]), rng.choice(["mill road", "mill rd", "high street", None]))
        for k in range(90)
    ]
    return rows, spark.createDataFrame(rows, "id long, name string, segment string, town string, street string").repartition(3)


@pytest.mark.parametrize("minimum", [None, 0.5, 0.8])
def test_every_pair_comes_by_its_first_rule_only(spark, minimum):
    rows, frame = records(spark)
    blocks = [["name"], ["segment"], ["name", "town"], ["town"]]
    compare = [Compare("street", "fuzzy", "street_fuzzy")]
    minimums = {} if minimum is None else {"street_fuzzy": minimum}
    jobs = rules.rule_jobs("id", blocks, compare, minimums, slot_rows=4)
    place = {"name": 1, "segment": 2, "town": 3}
    want = {}
    for a in rows:
        for b in rows:
            if a[0] < b[0]:
                first = next((k for k, r in enumerate(blocks) if all(a[place[c]] is not None and a[place[c]] == b[place[c]] for c in r)), None)
                if first is not None:
                    want[a[0], b[0]] = first
    links = rules.rule_links(frame, "id", blocks, compare, minimums, slot_rows=4)
    if minimum is None:
        counts = {r["rule"]: int(r["n"]) for r in links.groupBy("rule").agg(F.sum("pairs").alias("n")).collect()}
        assert counts == {k: sum(v == k for v in want.values()) for k in set(want.values())}
        # whoever agrees in name and town has met by the name
        assert 2 not in counts and {0, 1, 3} == set(counts)
        return
    same = {a: {b for b in ("mill road", "mill rd", "high street") if score(a, b) >= minimum} for a in ("mill road", "mill rd", "high street")}
    kept = {p: k for p, k in want.items() if rows[p[0]][4] and rows[p[1]][4] in same.get(rows[p[0]][4], ())}
    counts = {r["rule"]: int(r["n"]) for r in links.groupBy("rule").agg(F.sum("pairs").alias("n")).collect()}
    assert counts == {k: sum(v == k for v in kept.values()) for k in set(kept.values())}
    assert len(jobs) == 4 and list(jobs[3].also) == ["name", "segment", "town"]


def score(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return 1 - row[-1] / max(len(a), len(b))


def test_one_rule_is_a_matching_job(spark):
    _, frame = records(spark)
    compare = [Compare("street", "fuzzy", "street_fuzzy")]
    job = rules.rule_jobs("id", [["name"]], compare, {"street_fuzzy": 0.5})[0]
    one = rules.rule_links(frame, "id", [["name"]], compare, {"street_fuzzy": 0.5})
    pairs = pairing.spell_out(job.links(frame), frame, "id", job.block, job.values)
    assert one.agg(F.sum("pairs")).first()[0] == pairs.count() > 0


def numbered(frame, **settings):
    return sorted(map(tuple, ids.with_stable_id(frame, "n", **settings).collect()), key=str)


def test_ids_depend_on_neither_partitions_nor_buckets(spark):
    rng = random.Random(2)
    # equal hashes of different rows: a null is passed over by the hash
    rows = [(rng.randrange(50), rng.choice("abc")) for _ in range(700)] + [(None, "q"), (None, None)] * 3
    frame = spark.createDataFrame(rows, "a long, b string").withColumn("c", F.lit(None).cast("string"))
    swapped = frame.limit(40).select("a", F.col("c").alias("b"), F.col("b").alias("c"))
    frame = frame.unionByName(swapped)
    want = numbered(frame.coalesce(1))
    assert sorted(r[0] for r in want) == list(range(1, len(want) + 1))
    for partitions in (3, 7, 50):
        assert numbered(frame.repartition(partitions)) == want
    for buckets in (1, 100, 1 << 24):
        assert numbered(frame.repartition(5), buckets=buckets) == want


def test_rows_of_one_hash_follow_each_other(spark):
    frame = spark.createDataFrame([("x", None), (None, "x"), ("x", None)], "a string, b string")
    assert frame.select(F.xxhash64("a", "b")).distinct().count() == 1
    got = sorted((r["a"], r["n"]) for r in ids.with_stable_id(frame, "n").where("a = 'x'").collect())
    assert [n for _, n in got] in ([1, 2], [2, 3])


def test_copies_are_cut_into_parts(spark, monkeypatch):
    monkeypatch.setattr(ids, "COPIES_PER_PART", 7)
    frame = spark.range(100).select(F.when(F.col("id") < 60, F.lit("common")).otherwise(F.col("id").cast("string")).alias("v"))
    got = ids.with_stable_id(frame, "n").collect()
    assert sorted(r["n"] for r in got) == list(range(1, 101))
    common = sorted(r["n"] for r in got if r["v"] == "common")
    assert common == list(range(common[0], common[0] + 60))


def test_only_hashes_and_counts_are_sorted(spark):
    frame = spark.createDataFrame([(1, "wide")], "a long, b string")
    plan = ids.with_stable_id(frame, "n")._jdf.queryExecution().executedPlan().toString()
    sorts = [line for line in plan.splitlines() if " Sort [" in line or "Window [" in line]
    # columns of the row are in the order only where hashes tie
    assert sorts and all("b#" not in line or "_hash" in line for line in sorts)


def test_an_empty_table_gets_no_ids(spark):
    assert ids.with_stable_id(spark.createDataFrame([], "a long"), "n").count() == 0
