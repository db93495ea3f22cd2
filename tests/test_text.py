"""Column helpers: standardizing, regular expressions, soundex, edit score."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pairwright.functions import text

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
WORDS = st.lists(st.text("aAbBżŁó9 /-", max_size=8), min_size=1, max_size=20)


def column(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v string")


def results(spark, values, expression):
    return [r[0] for r in column(spark, values).coalesce(1).select(expression(F.col("v"))).collect()]


def test_standardize_deletes_without_spaces(spark):
    values = ["37/36", " al. łódzka-1 ", None, "", "Ünï"]
    assert results(spark, values, text.standardize) == ["3736", " AL ŁÓDZKA1 ", None, "", "N"]


def test_standardize_reads_numbers_as_text(spark):
    assert spark.range(12, 13).select(text.standardize(F.col("id"))).first()[0] == "12"


@SETTINGS
@given(WORDS)
def test_standardize_twice_changes_nothing(spark, values):
    once = results(spark, values, text.standardize)
    assert results(spark, once, text.standardize) == once


def test_clean_tokens_drops_polish_letters_unless_kept(spark):
    assert results(spark, ["ŁÓDZKA 5"], text.clean_tokens) == ["DZKA 5"]
    assert results(spark, ["ŁÓDZKA 5"], lambda c: text.clean_tokens(c, True)) == ["ŁÓDZKA 5"]


def test_split_tokens_skips_empty_ones(spark):
    assert results(spark, ["A  B ", "", None], text.split_tokens) == [["A", "B"], [], None]


def test_regex_full_covers_the_whole_value(spark):
    def starts(c):
        return text.regex_full(c, " *P.*", ignore_case=True)

    assert results(spark, ["  prosta", "Opolska P", None, "P"], starts) == [True, False, None, True]
    assert results(spark, ["12\n"], lambda c: text.regex_full(c, "[0-9]+")) == [False]


def test_regex_group_is_trimmed_and_null_without_match(spark):
    def city(c):
        return text.regex_group(c, r"city:\s*([^,]+),?\s*street")

    assert results(spark, ["City: Krakow street: x", "none"], city) == ["Krakow", None]


def test_soundex_folding(spark):
    values = ["ROBERT", "ŁUKASZ", "526"]
    assert results(spark, values, text.soundex) == ["R163", "ŁUKASZ", "526"]
    assert results(spark, values, lambda c: text.soundex(c, fold=True)) == ["R163", "L220", "526"]


PAIRS = [
    ("526 12TH CIR", "390 13TH DR", 0.5),
    ("ŁUKASZ", "LUKASZ", 1 - 1 / 6),
    ("", "", None),
    ("", "a", 0.0),
    (None, "a", None),
    ("a", None, None),
]


def test_edit_score(spark):
    df = spark.createDataFrame(PAIRS, "a string, b string, expected double").coalesce(1)
    got = [r[0] for r in df.select(text.edit_score(F.col("a"), F.col("b"))).collect()]
    assert got == [pytest.approx(p[2]) if p[2] is not None else None for p in PAIRS]


@SETTINGS
@given(st.lists(st.tuples(st.text("abż", max_size=6), st.text("abż", max_size=6)), min_size=1, max_size=30))
def test_edit_score_bound_and_identity(spark, pairs):
    df = spark.createDataFrame(pairs, "a string, b string")
    a, b = F.col("a"), F.col("b")
    checked = df.select(
        (text.edit_score_bound(a, b) >= text.edit_score(a, b)).alias("bounded"),
        text.edit_score(a, a).eqNullSafe(text.edit_score_same(a)).alias("identical"),
    )
    assert checked.where("not bounded or not identical").count() == 0


def test_long_texts_are_searched_fast_and_mean_the_same(spark):
    """Classes that are negated are searched slowly; long runs of other characters must not recurse."""
    from pairwright.functions.similarity import cosine_similarity

    odd = ["a\nb—c", "🙂Ą É", "", "x" * 300_000, "é?" * 100_000, "ŁÓDZKA 37/36", "\x85\r\n z"]
    frame = spark.createDataFrame([(t,) for t in odd], "t string")
    upper, plain = F.upper("t"), "A-Z0-9ĄĆĘŁŃÓŚŹŻ"
    told = frame.select(
        text.standardize(F.col("t")).alias("a"), F.regexp_replace(upper, f"[^{plain} ]", "").alias("b"),
        text.clean_tokens(upper, True).alias("c"), F.trim(F.regexp_replace(upper, f"[^{plain}]+", " ")).alias("d"),
        text.clean_tokens(upper).alias("e"), F.trim(F.regexp_replace(upper, "[^A-Z0-9]+", " ")).alias("f"),
    )
    assert all(r["a"] == r["b"] and r["c"] == r["d"] and r["e"] == r["f"] for r in told.collect())
    plan = told.select("a", "c")._jdf.queryExecution().analyzed().toString()
    assert "[^A-Z0-9" not in plan.replace(f"[^{plain} ]", "", 1).replace(f"[^{plain}]+", "", 1).replace("[^A-Z0-9]+", "", 1)
    score = frame.select(cosine_similarity(F.col("t"), upper))._jdf.queryExecution().analyzed().toString()
    assert "sort_array" in score and "array_sort" not in score
