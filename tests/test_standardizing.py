"""Dictionary standardization, filters, replies."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark import TaskContext
from pyspark.sql import functions as F

from pairwright.operators import filters, replies, standardizing
from pairwright.plans import customers
from pairwright.sources.dictionaries import dictionary_df


def people(spark, names):
    return spark.createDataFrame(list(enumerate(names)), "cust_key int, fname string")


def test_standardize_table_passes_other_columns(spark, rows):
    df = spark.createDataFrame([(1, "a-b", " c. ")], "id int, x string, y string")
    assert rows(standardizing.standardize_table(df, ["x", "y"], trim=["y"])) == [(1, "AB", "C")]


def test_whole_values(spark, rows):
    df = people(spark, ["MAXINE", "ANNA", "STREET", None, "MAXINE X"])
    out = standardizing.standardize_value(df, "fname", dictionary_df(spark), "NAME", "fname_std")
    assert rows(out, "cust_key", "fname_std") == [(0, "MAX"), (1, None), (2, None), (3, None), (4, None)]
    assert rows(standardizing.changed_rows(out, "fname", "fname_std"), "cust_key") == [(0,)]
    filled = standardizing.standardize_value(df, "fname", dictionary_df(spark), "NAME", "s", fill_unchanged=True)
    assert rows(filled, "s") == [(None,), ("ANNA",), ("MAX",), ("MAXINE X",), ("STREET",)]


def test_duplicate_token_does_not_multiply_rows(spark, rows):
    dictionary = dictionary_df(spark, [("A", "z", "NAME"), ("A", "y", "NAME")])
    out = standardizing.apply_dictionary(people(spark, ["A"]), "fname", dictionary, "NAME", "s")
    assert rows(out, "s") == [("y",)]


ADDRESSES = [
    (1, "12  NINTH AVENUE"),
    (2, "MAXINE STREET STREET"),
    (3, "ŁÓDZKA 5"),
    (4, ""),
    (5, None),
    (6, "   "),
    (7, "PLAIN 1"),
    (8, "A/B LANE"),
]
EXPECTED = {1: "12 9TH AVE", 2: "MAXINE ST ST", 3: "DZKA 5", 7: "PLAIN 1", 8: "A B LN"}


def test_tokens_by_join(spark):
    df = spark.createDataFrame(ADDRESSES, "cust_key int, address string")
    out = standardizing.token_standards(df, "address", dictionary_df(spark), "ADDRESS")
    assert {r.text: r.standard for r in out.collect()} == {dict(ADDRESSES)[k]: v for k, v in EXPECTED.items()}


def address_terms(spark):
    return {r._token: r._term for r in standardizing.context_terms(dictionary_df(spark), "ADDRESS").collect()}


@pytest.mark.parametrize("embedded", [True, False])
def test_tokens_written_back(spark, embedded):
    df = spark.createDataFrame(ADDRESSES, "cust_key int, address string")
    dictionary = address_terms(spark) if embedded else dictionary_df(spark)
    out = standardizing.standardize_tokens(df, "address", dictionary, "ADDRESS", "address_std")
    expected = {k: EXPECTED.get(k) if EXPECTED.get(k) != a else None for k, a in ADDRESSES}
    assert {r.cust_key: r.address_std for r in out.collect()} == expected
    far = standardizing.large_changes(out, "address", "address_std", 5)
    assert {r.cust_key for r in far.collect()} == {1, 2}


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text("AB LNE/Ł", max_size=14), min_size=1, max_size=25))
def test_both_token_forms_agree(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "k int, a string")
    dictionary = dictionary_df(spark, [("LANE", "LN", "ADDRESS"), ("A", "B", "ADDRESS"), ("B", "X", "NAME")])
    joined = standardizing.standardize_tokens(df, "a", dictionary, "ADDRESS", "s")
    mapped = standardizing.standardize_tokens(df, "a", {"LANE": "LN", "A": "B"}, "ADDRESS", "s")
    assert sorted(map(str, joined.collect())) == sorted(map(str, mapped.collect()))


@pytest.mark.parametrize("embedded", [True, False])
def test_token_replacement_needs_no_unique_key(spark, embedded):
    rows = [(1, "12 OAK STREET"), (1, "7 ELM AVENUE"), (None, "3 PINE LANE"), (None, "3 PINE LANE"), (2, "12 OAK STREET")]
    df = spark.createDataFrame(rows, "k int, a string")
    dictionary = address_terms(spark) if embedded else dictionary_df(spark)
    out = standardizing.standardize_tokens(df, "a", dictionary, "ADDRESS", "s")
    short = {"12 OAK STREET": "12 OAK ST", "7 ELM AVENUE": "7 ELM AVE", "3 PINE LANE": "3 PINE LN"}
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(str((k, a, short[a])) for k, a in rows)


def test_samples(spark, rows):
    person = spark.createDataFrame(
        [(1, 10, "Max", "O'Hara"), (2, 10, None, "X"), (3, 11, "A", "B"), (4, 12, "C", "D")],
        "c_customer_sk int, c_current_addr_sk int, c_first_name string, c_last_name string",
    )
    address = spark.createDataFrame(
        [(10, "5", "Oak", "Avenue", None, "TX", "1"), (11, "6", None, "Ct", "Y", "TX", "1"), (12, "7", "Elm", "Ln", "Z", "TX", None)],
        "ca_address_sk int, ca_street_number string, ca_street_name string, ca_street_type string, "
        "ca_city string, ca_state string, ca_zip string",
    )
    samples = standardizing.build_samples(person, address)
    assert rows(samples) == [("1", "10", "MAX", "OHARA", "5 OAK AVENUE", None, "TX", "1")]
    done = customers.standardize_samples(samples.withColumn("fname", F.lit("MAXINE")), dictionary_df(spark))
    assert rows(done, "fname_std", "address_std") == [("MAX", "5 OAK AVE")]
    assert standardizing.capped(samples, 0, ["cust_key"]).count() == 0


def test_candidate_terms(spark, rows):
    df = people(spark, ["MAX", "MAXINE", "MAX", "ANNA", None])
    assert rows(standardizing.short_values(df, "fname", 4)) == [("MAX",)]
    assert rows(standardizing.values_with_prefix(df, "fname", "MAX")) == [("MAX",), ("MAXINE",)]


def test_lookup(spark, rows):
    codes = spark.createDataFrame([("Łódź", "LDZ"), (None, "?")], "NAZWA string, NAZWA_MATCHCODE string")
    df = spark.createDataFrame([("Łódź",), ("X",), (None,)], "city string")
    out = standardizing.lookup(df, "city", codes, "NAZWA", "NAZWA_MATCHCODE", "code")
    assert rows(out) == [(None, None), ("X", None), ("Łódź", "LDZ")]


def test_filters(spark, rows):
    df = spark.createDataFrame([("37/36",), ("110A",), ("12",), ("",), (None,)], "n string")
    assert rows(filters.non_simple_house_number(df, "n")) == [("110A",), ("37/36",)]
    streets = spark.createDataFrame([("  polna",), ("Opolska",), ("P",)], "n string")
    assert rows(filters.street_starts_with(streets, "n", "P")) == [("  polna",), ("P",)]


def test_replies_are_asked_once_per_address(spark, tmp_path, rows):
    log = str(tmp_path)

    def complete(prompts):
        import os
        import uuid

        open(os.path.join(log, f"{len(prompts)}-{uuid.uuid4().hex}"), "w").close()
        return [p.replace("Data - ", "").split("short. ")[1].replace(" street:", ", street:") for p in prompts]

    df = spark.createDataFrame(
        [("Lodz", "Polna")] * 5 + [("Krakow", "Długa"), (None, "x")], "city string, road string"
    )
    out = replies.correct_addresses(df, "city", "road", complete)
    assert rows(out, "miasto", "street") == sorted(
        [("Lodz", "Polna")] * 5 + [("Krakow", "Długa"), (None, None)], key=lambda t: tuple((v is not None, str(v)) for v in t)
    )
    import os

    assert sum(int(name.split("-")[0]) for name in os.listdir(log)) == 2


def test_prompt_text(spark):
    df = spark.createDataFrame([("A", "B")], "c string, s string")
    prompt = df.select(replies.address_prompt(F.col("c"), F.col("s"))).first()[0]
    assert prompt.endswith("keep the answer short. Data - city: A street: B")


def test_as_many_tasks_ask_as_the_caller_wants(spark):
    df = spark.range(40).selectExpr("concat('city ', id) AS city", "'mill road' AS road")

    def complete(prompts):
        return [f"City: task {TaskContext.get().partitionId()}, street: x" for _ in prompts]

    for parallel in (1, 3):
        out = replies.correct_addresses(df, "city", "road", complete, parallel=parallel)
        assert out.select("miasto").distinct().count() == parallel
        assert out.count() == 40


def test_fewer_replies_than_prompts_are_refused(spark):
    df = spark.createDataFrame([("a", "b"), ("c", "d")], "city string, road string")
    with pytest.raises(Exception, match="1 replies to 2 prompts"):
        replies.correct_addresses(df, "city", "road", lambda prompts: prompts[:1], parallel=1).collect()


def test_large_changes_equal_whole_distances(spark):
    words = ["mill road", "mill rd", "m", "", None, "high street", "mill roads"]
    df = spark.createDataFrame([(a, b) for a in words for b in words], "raw string, standard string")
    for distance in (0, 1, 3, 20):
        banded = standardizing.large_changes(df, "raw", "standard", distance).collect()
        plain = df.where(F.levenshtein("raw", "standard") > distance).collect()
        assert sorted(map(str, banded)) == sorted(map(str, plain))
