"""The SQL names, the worked examples in SQL, and the SQL features they use."""

import pytest
from pyspark.sql import functions as F

from pairwright.functions import identifiers, similarity, text
from pairwright.functions.sql import register_functions

COLUMN_FORMS = {
    "fuzzy_score": text.edit_score,
    "LevenshteinDistance": similarity.levenshtein_distance,
    "HammingDistance": similarity.hamming_distance,
    "JaccardSimilarity": similarity.jaccard_similarity,
    "JaccardDistance": similarity.jaccard_distance,
    "CosineSimilarity": similarity.cosine_similarity,
    "CosineDistance": similarity.cosine_distance,
    "JaroWinklerSimilarity": similarity.jaro_winkler_similarity,
    "JaroWinklerDistance": similarity.jaro_winkler_distance,
    "LongestCommonSubsequence": similarity.lcs_length,
    "LongestCommonSubsequenceDistance": similarity.lcs_distance,
    "fuzzy_ratio": similarity.ratio,
    "fuzzy_partial_ratio": similarity.partial_ratio,
    "fuzzy_token_sort_ratio": similarity.token_sort_ratio,
}
PAIRS = [
    ("hyperspace", "cyberscape"),
    ("string similarity", "string distance"),
    ("string string a", "string"),
    ("Łucja Zielińska S.", "Zielińska  Łucja"),
    ("", ""),
    ("", "a"),
    (None, "a"),
    ("a", None),
]


@pytest.fixture(scope="module", autouse=True)
def registered(spark):
    register_functions(spark)
    spark.createDataFrame(PAIRS, "a string, b string").coalesce(1).createOrReplaceTempView("string_pairs")


@pytest.mark.parametrize("name", sorted(COLUMN_FORMS))
def test_sql_and_column_forms_agree(spark, name):
    by_sql = [r[0] for r in spark.sql(f"select {name}(a, b) from string_pairs").collect()]
    by_column = [r[0] for r in spark.table("string_pairs").select(COLUMN_FORMS[name](F.col("a"), F.col("b"))).collect()]
    assert [None if v is None else round(v, 9) for v in by_sql] == [None if v is None else round(v, 9) for v in by_column]


def test_subsequence_score(spark):
    by_sql = [r[0] for r in spark.sql("select FuzzyScore(a, b, 'ENGLISH') from string_pairs").collect()]
    expected = spark.table("string_pairs").select(similarity.fuzzy_subsequence_score(F.col("a"), F.col("b")))
    assert by_sql == [r[0] for r in expected.collect()]


def test_one_argument_functions(spark):
    row = spark.sql("select standardize('al. Łódzka 37/36'), validate_pesel('44051401359'), validate_pesel(null)").first()
    assert tuple(row) == ("AL ŁÓDZKA 3736", True, False)
    both = spark.sql("select '44051401359' pesel, validate_pesel('44051401359') ok union all select '44051401350', validate_pesel('44051401350')")
    assert sorted(r.ok for r in both.collect()) == [False, True]
    assert spark.range(1).select(identifiers.is_valid_pesel(F.lit("44051401350"))).first()[0] is False


def test_session_variables_as_arguments(spark):
    spark.sql("declare or replace variable s1 string default 'hyperspace'")
    spark.sql("declare or replace variable s2 string default 'cyberscape'")
    row = spark.sql("select JaccardSimilarity(s1, s2), LongestCommonSubsequence(s1, s2), HammingDistance(s1, s2)").first()
    assert tuple(row) == (pytest.approx(7 / 9), 6, 4)


def test_chained_statements_and_alias_reuse(spark):
    piped = spark.sql("from string_pairs |> where a is not null |> select fuzzy_score(a, b) as s |> where s > 0.5")
    assert piped.count() == 2
    reused = spark.sql("select concat('city: ', a) as llm, upper(llm) as loud from string_pairs where a = ''").first()
    assert reused.loud == "CITY: "


def test_native_bodies_stay_in_the_jvm(spark):
    frame = spark.sql("select standardize(a), fuzzy_score(a, b), CosineSimilarity(a, b) from string_pairs")
    assert "Python" not in frame._jdf.queryExecution().executedPlan().toString()
