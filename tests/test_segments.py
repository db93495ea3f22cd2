"""Edit-distance pairs by shared segments, against all pairs of a block."""

import random

import pytest
from pyspark.sql import functions as F

from pairwright.functions.text import edit_score
from pairwright.operators import pairing, segments
from pairwright.operators.matching import Compare, Matching

SCHEMA = "id long, block string, name string, town string"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def expected(rows, minimum):
    """Record pairs of a block whose names score the minimum."""
    out = set()
    for a in rows:
        for b in rows:
            if a[0] < b[0] and a[1] is not None and a[1] == b[1] and a[2] is not None and b[2] is not None:
                longest = max(len(a[2]), len(b[2]))
                if longest and 1.0 - distance(a[2], b[2]) / longest >= minimum:
                    out.add((a[0], b[0]))
    return out


def found(spark, rows, minimum, slot_rows):
    job = Matching("id", ["block"], [Compare("name", "fuzzy", "score"), Compare("town", "fuzzy", "town_score")], {"score": minimum}, slot_rows)
    records = spark.createDataFrame(rows, SCHEMA).repartition(3)
    links = job.links(records)
    assert links.groupBy("profile1", "profile2").count().where("count > 1").isEmpty()
    pairs = pairing.spell_out(links, records, "id", job.block, job.values).select("id1", "id2").collect()
    assert len(pairs) == len(set(pairs)) == int(links.agg(F.sum("pairs")).first()[0] or 0)
    return {(r["id1"], r["id2"]) for r in pairs}


def varied(rng, letters, base, count):
    """Copies of a few words with edits, some of them many."""
    out = []
    for _ in range(count):
        word = list(rng.choice(base))
        for _ in range(rng.randrange(0, 6)):
            at = rng.randrange(0, len(word) + 1)
            kind = rng.randrange(3)
            if kind == 0:
                word.insert(at, rng.choice(letters))
            elif word and at < len(word):
                word[at : at + 1] = [] if kind == 1 else [rng.choice(letters)]
        out.append("".join(word))
    return out


@pytest.mark.parametrize("minimum", [0.7, 0.75, 0.8, 0.9, 0.95, 1.0])
@pytest.mark.parametrize("slot_rows", [2, 1024])
def test_all_similar_pairs_are_found_once(spark, minimum, slot_rows):
    rng = random.Random(int(minimum * 100))
    names = varied(rng, "ab", ["abba" * 4, "aaaaaaaa", "abababababab"], 60)
    names += varied(rng, "abcdefgh", ["prefix-abcdefgh-end", "prefix-hgfedcba-end"], 60)
    rows = [(k, rng.choice(["x", "y"]), n, rng.choice("pq")) for k, n in enumerate(names)]
    # a block in which all names begin and end alike, one of empty names, nulls, copies
    rows += [(1000 + k, "z", f"Customer#{k * 7:06d}zł", "p") for k in range(40)]
    rows += [(2000 + k, "e", "", "p") for k in range(3)] + [(2100, "e", "a", "p"), (2101, "e", "a", "q"), (2102, "e", "a", "q")]
    rows += [(3000, None, "a", "p"), (3001, None, "a", "p"), (3002, "n", None, "p"), (3003, "n", "abc", None), (3004, "n", "abc", None)]
    assert found(spark, rows, minimum, slot_rows) == expected(rows, minimum)


def test_a_loose_minimum_takes_the_other_way(spark):
    rows = [(k, "x", n, "p") for k, n in enumerate(varied(random.Random(4), "abc", ["abcabc", "ccbbaa"], 40))]
    assert found(spark, rows, 0.4, 1024) == expected(rows, 0.4)
    job = Matching("id", ["block"], [Compare("name", "fuzzy", "score")], {"score": 0.4})
    assert "_segment" not in job.links(spark.createDataFrame(rows, SCHEMA)).columns


def test_far_fewer_pairs_meet_than_a_block_has(spark):
    """2,000 numbered names of one block: two million pairs, of which few share a segment."""
    rows = spark.range(2_000).selectExpr("id", "'b' AS block", "format_string('Customer#%09d', id * 37) AS name", "'t' AS town")
    cores = segments.trimmed(rows, ["block"], "name")
    own, asked = segments.segments(cores, 0.9), segments.probes(cores, 0.9)
    keys = ["block", *segments.KEY]
    met = own.groupBy(*keys).count().join(asked.groupBy(*keys).agg(F.count(F.lit(1)).alias("asked")), keys)
    assert met.agg(F.sum(F.col("count") * F.col("asked"))).first()[0] < 200_000


def test_an_empty_table_gives_no_pairs(spark):
    assert found(spark, [], 0.9, 1024) == set()


def test_low_minimums_score_cores_and_each_score_once(spark):
    """Values that share what they begin and end with, too loosely compared for segments: edit scores as of whole values."""
    rng = random.Random(3)
    names = ["", "a", "aa", "aaa", "xyz", "xyyz", "xz"] + ["x" + "".join(rng.choice("abxz") for _ in range(rng.randrange(0, 9))) + "z" for _ in range(60)]
    rows = [(k, rng.choice(["p", "q", "r"]), n, rng.choice(["TOWN OF ABBA", "TOWN OF OBA", "TOWN"])) for k, n in enumerate(names)]
    rows += [(100, "one", "alone", "TOWN"), (101, "none", "", None), (102, "p", None, "TOWN")]
    records = spark.createDataFrame(rows, "id long, block string, name string, town string")
    compare = [Compare("name", "fuzzy", "n"), Compare("town", "fuzzy", "t"), Compare("name", "soundex", "s")]
    job = Matching("id", ["block"], compare, {"n": 0.4, "t": 0.4}, slot_rows=8)
    links = job.links(records)
    plan = links.select("block", "pairs", "n", "t")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("levenshtein(") == 2 and "_core_name" in plan
    assert not [c for c in links.columns if c.startswith("_")]
    got = pairing.spell_out(links, records, "id", job.block, job.values)
    one, two = (records.select("block", *(F.col(c).alias(f"{c}{s}") for c in ("id", "name", "town"))) for s in (1, 2))
    want = one.join(two, "block").where("id1 < id2").withColumns({"n": edit_score(F.col("name1"), F.col("name2")), "t": edit_score(F.col("town1"), F.col("town2"))})
    want = want.where("n >= 0.4 AND t >= 0.4").select("id1", "id2", "block", "n", "t")
    assert sorted(map(tuple, got.select("id1", "id2", "block", "n", "t").collect())) == sorted(map(tuple, want.collect()))


def test_records_are_landed_before_they_are_matched(spark, monkeypatch):
    """The plan of both files' links holds no trace of how records and ids are made, which took Spark minutes to plan."""
    from pairwright.plans import catalog, customers

    made = spark.createDataFrame([(1, "A", "KOWAL", "ŁÓDŹ"), (2, "A", "KOWALA", "ŁÓDŹ")], "CUST_ID long, IMIE string, NAZWISKO string, MIASTO_ZAMELDOWANIA string")
    monkeypatch.setattr(catalog, "_loaded_files", lambda *_: (None, None))
    monkeypatch.setattr(customers, "records_for_matching", lambda *_: made)
    links = catalog.customer_file_links(spark, "")
    plan = links._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" not in plan and "LocalRelation" not in plan and "parquet" in plan
    assert [tuple(r) for r in links.collect()] == [("A", 1, 0.833, 1.0)]
