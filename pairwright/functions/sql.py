"""The functions under their SQL names, for queries written as SQL text."""

from __future__ import annotations

from pyspark.sql import SparkSession

from pairwright.functions import arrow_metrics
from pairwright.functions.identifiers import PESEL_WEIGHTS
from pairwright.functions.text import KEPT_CHARACTERS

# Registered as they are; the SQL bodies below may call them.
ARROW_FUNCTIONS = {
    "JaroWinklerSimilarity": arrow_metrics.jaro_winkler,
    "LongestCommonSubsequence": arrow_metrics.common_subsequence,
    "best_window_ratio": arrow_metrics.best_window_ratio,
}

_WEIGHTED = " + ".join(
    f"(ascii(substring(value, {place}, 1)) - 48) * {weight}"
    for place, weight in enumerate(PESEL_WEIGHTS, start=1)
)
_CHARACTERS = "filter(split({0}, ''), ch -> ch <> '')"
_LEFT, _RIGHT = _CHARACTERS.format("a"), _CHARACTERS.format("b")
_JACCARD = (
    "if(a is null or b is null, null, coalesce(try_divide("
    f"double(size(array_intersect({_LEFT}, {_RIGHT}))), double(size(array_union({_LEFT}, {_RIGHT})))), 1.0D))"
)
_WORDS = "regexp_extract_all({0}, '\\\\w+', 0)"


# One pass over both word lists, merged and sorted; see cosine_similarity().
_COSINE = f"""aggregate(
    array_sort(concat(
      transform({_WORDS.format('a')}, w -> named_struct('word', w, 'side', 0L)),
      transform({_WORDS.format('b')}, w -> named_struct('word', w, 'side', 1L)))),
    named_struct('word', string(null), 'l', 0L, 'r', 0L, 'dot', 0L, 'll', 0L, 'rr', 0L),
    (s, i) -> if(s.word = i.word,
      named_struct('word', s.word, 'l', s.l + 1L - i.side, 'r', s.r + i.side,
        'dot', s.dot, 'll', s.ll, 'rr', s.rr),
      named_struct('word', i.word, 'l', 1L - i.side, 'r', i.side,
        'dot', s.dot + s.l * s.r, 'll', s.ll + s.l * s.l, 'rr', s.rr + s.r * s.r)),
    s -> try_divide(double(s.dot + s.l * s.r),
      sqrt(double(s.ll + s.l * s.l)) * sqrt(double(s.rr + s.r * s.r))))"""
_RATIO = (
    "if({0} is null or {1} is null, 0, int(bround(100D * coalesce(try_divide("
    "2D * LongestCommonSubsequence({0}, {1}), double(length({0}) + length({1}))), 1D))))"
)
_SORTED = (
    "array_join(array_sort(filter(split(lower(regexp_replace(regexp_replace({0}, "
    "'[^\\\\x00-\\\\x7F]', ''), '[^\\\\p{{L}}\\\\p{{N}}_]', ' ')), ' '), w -> w > '')), ' ')"
)
_SUBSEQUENCE = """if(term is null, null, aggregate(
    filter(split(lower(query), ''), ch -> ch <> ''),
    named_struct('score', 0, 'free', 1, 'last', -1),
    (acc, ch) -> if(acc.free > 0 and position(ch, lower(term), acc.free) > 0,
      named_struct(
        'score', acc.score + if(position(ch, lower(term), acc.free) = acc.last + 1, 3, 1),
        'free', position(ch, lower(term), acc.free) + 1,
        'last', position(ch, lower(term), acc.free)),
      named_struct('score', acc.score, 'free', 0, 'last', acc.last)),
    acc -> acc.score))"""

# name -> (parameters, result type, body)
SQL_FUNCTIONS = {
    "standardize": ("value STRING", "STRING", f"regexp_replace(upper(value), '[^{KEPT_CHARACTERS}]', '')"),
    "fuzzy_score": (
        "a STRING, b STRING",
        "DOUBLE",
        "1D - try_divide(double(levenshtein(a, b)), double(greatest(length(a), length(b))))",
    ),
    "validate_pesel": (
        "value STRING",
        "BOOLEAN",
        "coalesce(value rlike '\\\\A[0-9]{11}\\\\z', false) and coalesce("
        f"(10 - ({_WEIGHTED}) % 10) % 10 = ascii(substring(value, 11, 1)) - 48, false)",
    ),
    "LevenshteinDistance": ("a STRING, b STRING", "INT", "levenshtein(a, b)"),
    "HammingDistance": (
        "a STRING, b STRING",
        "INT",
        f"if(length(a) = length(b), size(filter(zip_with({_LEFT}, {_RIGHT}, (x, y) -> x <> y), d -> d)), null)",
    ),
    "JaccardSimilarity": ("a STRING, b STRING", "DOUBLE", _JACCARD),
    "JaccardDistance": ("a STRING, b STRING", "DOUBLE", f"1D - {_JACCARD}"),
    "CosineSimilarity": ("a STRING, b STRING", "DOUBLE", _COSINE),
    "CosineDistance": ("a STRING, b STRING", "DOUBLE", f"1D - {_COSINE}"),
    "JaroWinklerDistance": ("a STRING, b STRING", "DOUBLE", "1D - JaroWinklerSimilarity(a, b)"),
    "LongestCommonSubsequenceDistance": (
        "a STRING, b STRING",
        "INT",
        "length(a) + length(b) - 2 * LongestCommonSubsequence(a, b)",
    ),
    "FuzzyScore": ("term STRING, query STRING, locale STRING", "INT", _SUBSEQUENCE),
    "fuzzy_ratio": ("a STRING, b STRING", "INT", _RATIO.format("a", "b")),
    "fuzzy_partial_ratio": ("a STRING, b STRING", "INT", "coalesce(best_window_ratio(a, b), 0)"),
    "fuzzy_token_sort_ratio": (
        "a STRING, b STRING",
        "INT",
        _RATIO.format(_SORTED.format("a"), _SORTED.format("b")),
    ),
}


def register_functions(spark: SparkSession) -> None:
    """Make every function callable by name from SQL in this session.

    The bodies are expanded into the calling query, so Catalyst sees plain
    expressions; only the three dynamic-programming metrics run as Arrow UDFs.
    """
    for name, function in ARROW_FUNCTIONS.items():
        spark.udf.register(name, function)
    for name, (parameters, result, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {body}")
