"""String metrics as Column expressions over two text columns.

Metrics that Spark's own expressions can state are written with them.  The
dynamic-programming ones (Jaro-Winkler, common subsequence, best window) run
as Arrow UDFs and live in :mod:`pairwright.functions.arrow_metrics`.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pairwright.functions import arrow_metrics


def characters(value: Column) -> Column:
    """The characters of a string; the empty string has none."""
    return F.filter(F.split(value, ""), lambda ch: ch != "")


def levenshtein_distance(left: Column, right: Column) -> Column:
    return F.levenshtein(left, right)


def hamming_distance(left: Column, right: Column) -> Column:
    """Number of differing positions; null when the lengths differ."""
    differing = F.filter(
        F.zip_with(characters(left), characters(right), lambda a, b: a != b), lambda differs: differs
    )
    return F.when(F.length(left) == F.length(right), F.size(differing))


def jaccard_similarity(left: Column, right: Column) -> Column:
    """Shared over all characters, as sets.  Two empty strings are alike."""
    shared = F.size(F.array_intersect(characters(left), characters(right))).cast("double")
    either = F.size(F.array_union(characters(left), characters(right))).cast("double")
    both_known = left.isNotNull() & right.isNotNull()
    return F.when(both_known, F.coalesce(F.try_divide(shared, either), F.lit(1.0)))


def jaccard_distance(left: Column, right: Column) -> Column:
    return F.lit(1.0) - jaccard_similarity(left, right)


def words(value: Column) -> Column:
    """Runs of ASCII word characters, the tokens of the cosine metrics."""
    return F.regexp_extract_all(value, F.lit(r"\w+"), F.lit(0))


def word_jaccard_similarity(left: Column, right: Column) -> Column:
    """Shared over all words, as sets; null when neither side has words."""
    shared = F.size(F.array_intersect(words(left), words(right))).cast("double")
    return F.try_divide(shared, F.size(F.array_union(words(left), words(right))).cast("double"))


def cosine_similarity(left: Column, right: Column) -> Column:
    """Cosine of the two word-count vectors.

    Both word lists are tagged, merged and sorted; one pass over the sorted
    list then sees each word's occurrences side by side.  That is linear after
    the sort, so whole documents are as safe as short names.  No item is null,
    so the natural order of ``sort_array`` does, without a comparison by lambda.
    Null when either side has no words.
    """
    tagged = F.sort_array(
        F.concat(
            F.transform(words(left), lambda w: F.struct(w.alias("word"), F.lit(0).alias("side"))),
            F.transform(words(right), lambda w: F.struct(w.alias("word"), F.lit(1).alias("side"))),
        )
    )

    def state(word, in_left, in_right, dot, left_square, right_square):
        return F.struct(
            word.alias("word"),
            in_left.alias("in_left"),
            in_right.alias("in_right"),
            dot.alias("dot"),
            left_square.alias("left_square"),
            right_square.alias("right_square"),
        )

    zero = F.lit(0).cast("long")
    start = state(F.lit(None).cast("string"), zero, zero, zero, zero, zero)

    def close(acc):
        return (
            acc["dot"] + acc["in_left"] * acc["in_right"],
            acc["left_square"] + acc["in_left"] * acc["in_left"],
            acc["right_square"] + acc["in_right"] * acc["in_right"],
        )

    def step(acc, item):
        from_left = (F.lit(1) - item["side"]).cast("long")
        from_right = item["side"].cast("long")
        return F.when(
            acc["word"] == item["word"],
            state(
                acc["word"],
                acc["in_left"] + from_left,
                acc["in_right"] + from_right,
                acc["dot"],
                acc["left_square"],
                acc["right_square"],
            ),
        ).otherwise(state(item["word"], from_left, from_right, *close(acc)))

    def finish(acc):
        dot, left_square, right_square = close(acc)
        return F.try_divide(
            dot.cast("double"), F.sqrt(left_square.cast("double")) * F.sqrt(right_square.cast("double"))
        )

    return F.aggregate(tagged, start, step, finish)


def cosine_distance(left: Column, right: Column) -> Column:
    return F.lit(1.0) - cosine_similarity(left, right)


def jaro_winkler_similarity(left: Column, right: Column) -> Column:
    return arrow_metrics.jaro_winkler(left, right)


def jaro_winkler_distance(left: Column, right: Column) -> Column:
    return F.lit(1.0) - jaro_winkler_similarity(left, right)


def lcs_length(left: Column, right: Column) -> Column:
    """Length of the longest common subsequence."""
    return arrow_metrics.common_subsequence(left, right)


def lcs_distance(left: Column, right: Column) -> Column:
    return F.length(left) + F.length(right) - F.lit(2) * lcs_length(left, right)


def fuzzy_subsequence_score(term: Column, query: Column) -> Column:
    """Points for query characters found in order in the term.

    Each found character earns one point, and two more when it directly
    follows the previous find.  The search never goes back, so once a
    character is missing nothing after it can match.  Case does not count.
    """
    text = F.lower(term)
    # ``free`` is the first position still open to a match; 0 means exhausted.
    start = F.struct(F.lit(0).alias("score"), F.lit(1).alias("free"), F.lit(-1).alias("last"))

    def step(acc, ch):
        at = F.when(acc["free"] > 0, F.position(ch, text, acc["free"])).otherwise(F.lit(0))
        bonus = F.when(at == acc["last"] + 1, F.lit(3)).otherwise(F.lit(1))
        return F.when(
            at > 0,
            F.struct(
                (acc["score"] + bonus).alias("score"), (at + 1).alias("free"), at.alias("last")
            ),
        ).otherwise(
            F.struct(acc["score"].alias("score"), F.lit(0).alias("free"), acc["last"].alias("last"))
        )

    points = F.aggregate(characters(F.lower(query)), start, step, lambda acc: acc["score"])
    return F.when(term.isNotNull(), points)


def ratio_from_lcs(left: Column, right: Column, common: Column) -> Column:
    """0-100 ratio of twice the common subsequence to the summed lengths.

    Halves round to the even neighbour.  Two empty strings are equal (100); a
    missing side scores 0.
    """
    total = (F.length(left) + F.length(right)).cast("double")
    share = F.coalesce(F.try_divide(F.lit(2.0) * common, total), F.lit(1.0))
    known = left.isNotNull() & right.isNotNull()
    return F.when(known, F.bround(F.lit(100.0) * share).cast("int")).otherwise(F.lit(0))


def ratio(left: Column, right: Column) -> Column:
    return ratio_from_lcs(left, right, lcs_length(left, right))


def ratio_bound(left: Column, right: Column) -> Column:
    """An upper bound of :func:`ratio` that needs only the two lengths."""
    return ratio_from_lcs(left, right, F.least(F.length(left), F.length(right)))


# Counts in a letter signature; characters that share one only loosen its bounds.
LETTERS = 32


def letter_counts(value: Column) -> Column:
    """How many characters of a string fall to each of ``LETTERS`` counts.

    The places stand in an array of one, so that they are worked out once and not for every count.
    """
    places = F.transform(characters(value), lambda ch: F.pmod(F.ascii(ch), F.lit(LETTERS)))
    counted = F.transform(
        F.array(places),
        lambda all_places: F.transform(
            F.sequence(F.lit(0), F.lit(LETTERS - 1)), lambda k: F.size(F.filter(all_places, lambda place: place == k))
        ),
    )
    return F.element_at(counted, 1)


def common_letters(left: Column, right: Column) -> Column:
    """The most characters that two strings can have in common, whatever their order, from their signatures."""
    least = F.zip_with(left, right, lambda a, b: F.least(a, b))
    return F.aggregate(least, F.lit(0), lambda total, n: total + n)


def jaro_winkler_bound(left: Column, right: Column, common: Column) -> Column:
    """An upper bound of Jaro-Winkler: all common letters match and none is out of order."""
    shared = common.cast("double")
    jaro = (shared / F.length(left) + shared / F.length(right) + F.lit(1.0)) / F.lit(3.0)
    starts = [F.substring(left, 1, k) == F.substring(right, 1, k) for k in (1, 2, 3, 4)]
    longest = [F.least(F.length(left), F.length(right)) >= k for k in (1, 2, 3, 4)]
    prefix = sum((F.when(same & long, 1).otherwise(0) for same, long in zip(starts, longest, strict=True)), F.lit(0))
    boosted = jaro + F.lit(0.1) * prefix * (F.lit(1.0) - jaro) + F.lit(1e-12)
    bound = F.when(common == 0, F.lit(0.0)).when(jaro < 0.7, jaro + F.lit(1e-12)).otherwise(boosted)
    return F.when(left == right, F.lit(1.0)).when(F.least(F.length(left), F.length(right)) == 0, F.lit(0.0)).otherwise(bound)


def ratio_letter_bound(left: Column, right: Column, common: Column) -> Column:
    """An upper bound of :func:`ratio` from the common letters."""
    return ratio_from_lcs(left, right, common)


def partial_ratio_bound(left: Column, right: Column, common: Column) -> Column:
    """An upper bound of :func:`partial_ratio`: a window has no more of the shorter text's letters than the longer text."""
    short = F.least(F.length(left), F.length(right))
    share = F.try_divide(common.cast("double"), short.cast("double"))
    known = left.isNotNull() & right.isNotNull()
    return F.when(known & (left == right), F.lit(100)).when(known, F.bround(F.lit(100.0) * F.coalesce(share, F.lit(1.0))).cast("int")).otherwise(F.lit(0))


def partial_ratio(left: Column, right: Column) -> Column:
    """Best ratio of the shorter text with equally long windows of the longer."""
    return F.coalesce(arrow_metrics.best_window_ratio(left, right), F.lit(0))


def sorted_token_text(value: Column, ascii_only: bool = True) -> Column:
    """Lower-case words in alphabetical order, joined by single spaces."""
    text = F.regexp_replace(value, r"[^\x00-\x7F]", "") if ascii_only else value
    text = F.lower(F.regexp_replace(text, r"[^\p{L}\p{N}_]", " "))
    return F.array_join(F.array_sort(F.filter(F.split(text, " "), lambda t: t > "")), " ")


def token_sort_ratio(left: Column, right: Column, ascii_only: bool = True) -> Column:
    return ratio(sorted_token_text(left, ascii_only), sorted_token_text(right, ascii_only))
