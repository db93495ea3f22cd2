"""Pair planning, candidate pairs, scores, listings: against brute force."""

from itertools import combinations

import pytest
from pyspark.sql import functions as F

from pairwright.operators import estimates, listing, pairing
from pairwright.operators.matching import Compare, Matching
from pairwright.operators.scoring import Comparison, score_pairs
from pairwright.plans import customers
from pairwright.sources.schemas import CUSTOMERS, WEB_CUSTOMERS

LASTS = ["KOWAL", "KOWALSKA", "NOWAK", "NOWACKI", None, "", "ZZZ"]
CITIES = ["ŁÓDŹ", "LODZ", "KRAKÓW", None, "Q"]


def make_records():
    """One block with a third of all rows, many equal records, null blocks."""
    data = []
    for i in range(1, 241):
        first = "HOT" if i % 3 == 0 else (None if i % 17 == 0 else f"N{i % 20}")
        data.append((i * 7 % 997, first, LASTS[i % 7], CITIES[i * i % 5]))
    data += [(2000 + i, "HOT", "SAME", "SAME") for i in range(60)]
    return data


DATA = make_records()


@pytest.fixture(scope="module")
def records(spark):
    return spark.createDataFrame(DATA, "id long, first string, last string, city string").repartition(5)


def job(**changes):
    base = dict(
        id_column="id",
        block=["first"],
        compare=[
            Compare("first", "fuzzy", "fname_fuzzy"),
            Compare("first", "soundex", "fname_soundex"),
            Compare("last", "fuzzy", "lname_fuzzy"),
            Compare("last", "soundex", "lname_soundex"),
            Compare("city", "fuzzy", "address_fuzzy"),
        ],
        minimums=customers.MINIMUM_SCORES,
    )
    return Matching(**{**base, **changes})


def edit(a, b):
    row = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        diagonal, row[0] = row[0], i
        for j, cb in enumerate(b, 1):
            diagonal, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, diagonal + (ca != cb))
    return row[-1]


def fuzzy(a, b):
    if a is None or b is None or not (a or b):
        return None
    return 1.0 - edit(a, b) / max(len(a), len(b))


def block_pairs():
    ordered = sorted(DATA)
    return [(a, b) for a, b in combinations(ordered, 2) if a[1] is not None and a[1] == b[1]]


def good(a, b):
    scores = [fuzzy(a[2], b[2]), fuzzy(a[3], b[3])]
    return all(s is not None and s >= 0.4 for s in scores)


def test_estimate_counts_what_the_join_yields(records):
    row = estimates.estimate_pairs(records, ["first"]).first()
    sizes = {}
    for r in DATA:
        sizes[r[1]] = sizes.get(r[1], 0) + 1
    assert row.records == len(DATA) and row.blocks == len(sizes)
    assert row.ordered_pairs == sum(n * n for n in sizes.values())
    assert row.candidate_pairs == len(block_pairs())
    assert row.largest_block == max(sizes.values())
    plain = estimates.estimate_pairs(records).first()
    assert (plain.ordered_pairs, plain.candidate_pairs) == (len(DATA) ** 2, len(DATA) * (len(DATA) - 1) // 2)
    assert estimates.pair_report(records, ["first"]).count() == 2
    assert estimates.largest_blocks_first(records, ["first"]).first()["first"] == "HOT"
    counted = estimates.pair_count(records, "first", "HOT").first()
    assert counted.all_pairs == sizes["HOT"] ** 2 and counted.ordered_once == sizes["HOT"] * (sizes["HOT"] - 1) // 2


def test_estimate_does_not_overflow(spark):
    n = 4_000_000_000
    df = spark.range(0, n, 1, 8)
    row = estimates.estimate_pairs(df).first()
    assert row.ordered_pairs == n * n and row.candidate_pairs == n * (n - 1) // 2


@pytest.mark.parametrize("slot_rows", [4096, 3])
@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_candidates_cover_every_pair_once(spark, records, slot_rows, broadcast):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        folded = job(slot_rows=slot_rows).candidates(records)
        assert folded.agg(F.sum("pairs")).first()[0] == len(block_pairs())
        keys = folded.select("profile1", "profile2").collect()
        assert len(keys) == len(set(map(tuple, keys))) and all(a <= b for a, b in keys)
        spelled = pairing.spell_out(folded, records, "id", ["first"], ["last", "city"], slice_rows=7)
        got = {(r.id1, r.id2): (r.last1, r.last2, r.city1, r.city2) for r in spelled.collect()}
        assert spelled.count() == len(got)
        assert got == {(a[0], b[0]): (a[2], b[2], a[3], b[3]) for a, b in block_pairs()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_links_are_the_pairs_over_the_thresholds(records):
    links = job(slot_rows=5).links(records)
    spelled = job().record_pairs(links, records, max_pairs=10**6)
    got = {(r.id1, r.id2): round(r.lname_fuzzy + 10 * r.address_fuzzy, 9) for r in spelled.collect()}
    likely = [(a, b) for a, b in block_pairs() if good(a, b)]
    assert got == {(a[0], b[0]): round(fuzzy(a[2], b[2]) + 10 * fuzzy(a[3], b[3]), 9) for a, b in likely}
    assert "_soundex_last1" not in links.columns


def test_scores_keep_every_pair(records):
    scored = job().scores(records)
    assert scored.agg(F.sum("pairs")).first()[0] == len(block_pairs())
    row = scored.where("last1 = 'KOWAL' and last2 = 'NOWAK' or last2 = 'KOWAL' and last1 = 'NOWAK'").first()
    assert row.lname_fuzzy == pytest.approx(fuzzy("KOWAL", "NOWAK")) and row.fname_fuzzy == 1.0


def test_too_many_pairs_are_refused_not_cut(records):
    links = job().links(records)
    with pytest.raises(ValueError):
        job().record_pairs(links, records, max_pairs=10)


@pytest.mark.parametrize("probes", [(1, 2), (2, 60), (50, 60), None])
def test_first_pairs_are_exact(records, probes):
    key = lambda p: f"{p[0][0]}-{p[1][0]}"
    expected = sorted((p for p in block_pairs() if good(*p)), key=key)
    for count in (1, 13):
        got = listing.first_pairs(records, job(), count, probes=probes).collect()
        assert sorted((r.id1, r.id2) for r in got) == sorted((a[0], b[0]) for a, b in expected[:count])
    unfiltered = listing.first_pairs(records, Matching("id", ["first"]), 9, probes=probes).collect()
    everything = sorted(block_pairs(), key=key)[:9]
    assert sorted((r.id1, r.id2) for r in unfiltered) == sorted((a[0], b[0]) for a, b in everything)


def test_listing_shorter_than_asked(spark):
    df = spark.createDataFrame([(1, "A", "x", "y"), (2, "A", "x", "y"), (3, "B", "x", "y")], "id long, first string, last string, city string")
    out = listing.duplicate_listing(df, job(), 100).collect()
    assert [(r.pair_key, r.id) for r in out] == [("1-2", 1), ("1-2", 2)]


def test_listing_matches_brute_force(records):
    likely = [(f"{a[0]}-{b[0]}", r) for a, b in block_pairs() if good(a, b) for r in (a, b)]
    expected = sorted(set(likely), key=lambda t: (t[0], t[1][0]))[:31]
    got = listing.duplicate_listing(records, job(), 31).collect()
    assert [(r.pair_key, (r.id, r.first, r.last, r.city)) for r in got] == expected


def test_block_key_need_not_be_compared(records):
    other = Matching("id", ["city"], [Compare("last", "jaccard_similarity", "j")], {"j": 0.5})
    total = other.candidates(records).agg(F.sum("pairs")).first()[0]
    ordered = [(a, b) for a, b in combinations(DATA, 2) if a[3] is not None and a[3] == b[3]]
    assert total == len(ordered)


ARROW = ["jaro_winkler_similarity", "ratio", "partial_ratio", "token_sort_ratio", "lcs_length"]


def test_scores_with_minimums_are_the_high_ones(spark, rows):
    data = [(i, LASTS[i % 7], CITIES[i % 5]) for i in range(70)]
    pairs = spark.createDataFrame(data, "k int, a string, b string")
    comparisons = [Comparison("a", "b", m, m) for m in [*ARROW, "fuzzy", "soundex"]]
    scored = score_pairs(pairs, comparisons)
    assert scored.columns == ["k", "a", "b", *(c.alias for c in comparisons)]
    assert scored.count() == 70
    minimums = {"ratio": 30, "fuzzy": 0.2}
    assert rows(score_pairs(pairs, comparisons, minimums)) == rows(scored.where("ratio >= 30 and fuzzy >= 0.2"))


def test_python_metrics_run_once_per_pair(spark):
    """One build of the pairs and one Python step, whatever the minimum."""
    records = spark.createDataFrame([(i, f"n{i % 3}", f"name {i}") for i in range(30)], "id int, block string, name string")
    job = Matching("id", ["block"], [Compare("name", "jaro_winkler_similarity", "s")], {"s": 0.8})
    text = job.links(records)._jdf.queryExecution().executedPlan().toString()
    assert text.count("ArrowEvalPython") == 1 and text.count("SortMergeJoin [block") == 3


def test_record_profiles_name_every_record(spark, rows):
    data = [(1, "a", "x"), (2, "a", "x"), (3, "a", None), (4, "a", None), (5, None, "x"), (6, "b", "x")]
    records = spark.createDataFrame(data, "id int, block string, name string")
    job = Matching("id", ["block"], [Compare("name", "fuzzy", "s")])
    assert rows(job.record_profiles(records)) == [(1, 1), (2, 1), (3, 3), (4, 3), (6, 6)]


def test_customer_workflow(spark, rows):
    def row(schema, **values):
        return tuple(values.get(n) for n in schema.names)

    main = spark.createDataFrame(
        [row(CUSTOMERS, PESEL="1", IMIE="Hilaria", NAZWISKO="Kowal-ska", MIASTO_ZAMELDOWANIA="Łódź"),
         row(CUSTOMERS, PESEL="3", IMIE="Jan", NAZWISKO="X", MIASTO_ZAMELDOWANIA="Łódź")], CUSTOMERS)
    web = spark.createDataFrame(
        [row(WEB_CUSTOMERS, PESEL="2", IMIE="HILARIA", NAZWISKO="Kowalska", MIEJSCE_ZAMIESZKANIA="łódź")], WEB_CUSTOMERS)
    records = customers.records_for_matching(main, web)
    assert records.columns == ["CUST_ID", *customers.MATCHING_COLUMNS]
    out = customers.probable_duplicates(records)
    assert {r.PESEL for r in out.collect()} == {"1", "2"} and out.columns[0] == "pair_key"


def test_listing_refuses_ids_that_are_no_whole_numbers(spark):
    records = spark.createDataFrame([("A", "x", "y"), ("A 1", "x", "y")], "id string, block string, name string")
    job = Matching("id", ["block"], [Compare("name", "fuzzy", "s")], {"s": 0.5})
    with pytest.raises(TypeError, match="whole numbers"):
        listing.first_pairs(records, job, 10)


def test_pairs_are_spelled_out_from_lists_after_the_last_shuffle(spark):
    """Slices travel as lists; repeated and null ids stay as they are."""
    rows = [(k, "b", "x" if k % 2 else "y") for k in range(12)] + [(3, "b", "x"), (None, "b", "y")]
    records = spark.createDataFrame(rows, "id long, block string, name string")
    links = pairing.candidate_pairs(records, "id", ["block"], ["name"])
    told = pairing.spell_out(links, records, "id", ["block"], ["name"], slice_rows=4)
    plan = told._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("explode(_ids2") < plan.index("Join") and plan.index("explode(_ids1") < plan.index("Join")
    across = told.where("name1 <> name2")
    assert across.count() == 7 * 7 and across.where("id1 = 3 OR id2 = 3").count() == 2 * 7 + 0


def test_a_large_block_has_a_bounded_number_of_slots(spark):
    """A profile is copied once for each slot, so small slots grow in large blocks."""
    groups = spark.range(1_000).selectExpr("'b' AS block", "id AS profile", "id AS profile_last", "1L AS profile_members")
    slots = pairing._slotted(groups, ["block"], 2).agg(F.max("_slots"), F.count("*")).first()
    assert tuple(slots) == (pairing.MANY_SLOTS, 1_000)
