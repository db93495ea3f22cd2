"""Secret scans: patterns of known secrets, and windows of high entropy.

Everything is a column expression over one text.  Three patterns give the base
spans.  Beyond them, candidate strings (long runs of one character class) are
read through a sliding window; the window's character counts change by one
character out and one in per step, and its Shannon entropy follows from the
sum of ``c * log2(c)`` over the counts.  A candidate with a window above its
class's threshold gives one span, from the first such window's start to the
last one's end, unless the allow list names it.

Candidates are looked for in what the base spans leave of a text, so a key that
touches one is not lost with it.  An allowed word that stands by itself, as in a
path, is left out the same way; one within a string speaks for the whole string.

Matches of a text are worked on in blocks, so work grows with their number, not
with its square.

Positions count code points, ends are exclusive.  Defined cases: a null text
counts as empty; a text without spans gives zeros, an empty ``spans`` and the
digest of the empty string; repeated rows give repeated results.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairwright.llm.frames import text_of, unwrapped, wrapped

# The base patterns.  Letters of the first are there in either case.
ASSIGN = (
    "([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
    "|[aA][pP][iI]_?[kK][eE][yY])[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ASSIGN_VALUE = 6
# What every match of ASSIGN holds, and quicker to rule out.
ASSIGN_HINT = "[dDtTnNyY][\"']?\\x20*[:=]"
# A run is matched from its first character to its last, so a minimum length in
# the pattern gives the same matches as dropping the shorter ones afterwards.
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "entropy")


@dataclass(frozen=True)
class CharacterClass:
    """Candidate strings of one character class.

    ``run`` matches a candidate, ``needs`` are patterns that it must contain,
    ``window`` is the window's length and ``bits`` its least entropy.
    """

    run: str
    needs: tuple[str, ...]
    window: int
    bits: float


# A run starts where its class starts; the look-ahead asks for a digit before any position is worked out.
CLASSES = (
    CharacterClass(
        "(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])[A-Za-z0-9+/_=-]{20,}", ("[a-z]", "[A-Z]", "[0-9]"), 20, 3.65
    ),
    CharacterClass("[0-9A-F]{24,}", ("[A-F]", "[0-9]"), 24, 3.05),
)
# Strings that look random and are none: sample keys, alphabets, placeholders.
ALLOWED = "(?i)example|sample|placeholder|changeme|x{8}|0{8}|abcdefgh|01234567|12345678"
# Those of them that are words.
ALLOWED_WORDS = ("example", "sample", "placeholder", "changeme")
BLOCK = 256
NO_SPANS = "array<struct<start:int,kind:int,stop:int>>"


def _named(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _held(values: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of an array that is worked out once, in a form whose parts can be had without reading all of it."""
    return _named(F.transform(values, lambda x: x), use)


def _blocks(values: Column, use: Callable[[Column, Column], Column]) -> Column:
    """``use`` of each block of an array (held, and not empty), and of its number."""
    last = F.floor((F.size(values) - 1) / F.lit(BLOCK)).cast("int")
    return F.transform(
        F.sequence(F.lit(0), last),
        lambda b: _named(F.slice(values, b * BLOCK + 1, F.lit(BLOCK)), lambda part: use(part, b)),
    )


def running_sums(values: Column) -> Column:
    """The sums of an array's values up to each, for an array that is not empty."""

    def sums(part: Column) -> Column:
        start = F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("all"))

        def step(state: Column, value: Column) -> Column:
            more = state["sum"] + value
            return F.struct(more.alias("sum"), F.concat(state["all"], F.array(more)).alias("all"))

        return F.aggregate(part, start, step, lambda state: state["all"])

    def shifted(parts: Column) -> Column:
        # each block starts where those before it end
        def by(ends: Column) -> Column:
            before = lambda b: F.when(b > 0, F.get(ends, b - 1)).otherwise(0)
            return F.flatten(
                F.transform(parts, lambda p, b: _named(before(b), lambda shift: F.transform(p, lambda x: x + shift)))
            )

        return _named(sums(F.transform(parts, lambda p: F.element_at(p, -1))), by)

    return _held(values, lambda held: _named(_blocks(held, lambda part, _: sums(part)), shifted))


def _found(text: Column, pattern: str, value_group: int = 0) -> Column:
    """Array of ``(start, stop, value)`` of a pattern's matches; null where there is none.

    ``split`` and ``regexp_extract_all`` meet the same matches: the end of the
    k-th is the length of all pieces and matches up to it.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group)) if value_group else whole

    def placed(whole: Column) -> Column:
        pieces = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(whole))
        ends = running_sums(F.zip_with(pieces, whole, lambda p, w: F.char_length(p) + F.char_length(w)))
        zipped = F.arrays_zip(ends.alias("stop"), whole.alias("whole"), value.alias("value"))
        return F.transform(
            zipped,
            lambda m: F.struct(
                (m["stop"] - F.char_length(m["whole"])).alias("start"), m["stop"].alias("stop"), m["value"].alias("value")
            ),
        )

    return F.when(text.rlike(pattern), _named(whole, placed))


def _spans(text: Column, pattern: str, kind: int, value_group: int = 0, least: int = 0) -> Column:
    """Array of ``(start, kind, stop)`` of a pattern's matches, in order and apart."""
    found = _found(text, pattern, value_group)
    if least:
        found = F.filter(found, lambda m: F.char_length(m["value"]) >= least)
    spans = F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["stop"].alias("stop")))
    return F.coalesce(spans, F.array().cast(NO_SPANS))


def covered(text: Column, spans: Column, mask: str) -> Column:
    """The text with every character of some spans, in order and apart, replaced; lengths stay as they were."""

    def of_text(whole: Column, held: Column) -> Column:
        def of_block(part: Column, b: Column) -> Column:
            first = F.when(b == 0, F.lit(0)).otherwise(F.element_at(part, 1)["start"])
            following = F.get(held, (b + 1) * BLOCK)["start"]

            def region(here: Column) -> Column:
                begin = F.struct(first.alias("at"), F.array().cast("array<string>").alias("done"))

                def step(state: Column, span: Column) -> Column:
                    between = F.substring(here, state["at"] - first + 1, span["start"] - state["at"])
                    hidden = F.repeat(F.lit(mask), span["stop"] - span["start"])
                    return F.struct(span["stop"].alias("at"), F.concat(state["done"], F.array(between, hidden)).alias("done"))

                rest = lambda s: F.substring(here, s["at"] - first + 1, F.char_length(here))
                return F.aggregate(part, begin, step, lambda s: F.concat(F.array_join(s["done"], ""), rest(s)))

            return _named(F.substring(whole, first + 1, F.coalesce(following, F.char_length(whole)) - first), region)

        return F.array_join(_blocks(held, of_block), "")

    return F.when(F.size(spans) > 0, _named(text, lambda t: _held(spans, lambda held: of_text(t, held)))).otherwise(text)


def _weight(count: Column) -> Column:
    """``c * log2(c)``, 0 for 0."""
    return F.when(count > 1, count * F.log2(count.cast("double"))).otherwise(F.lit(0.0))


def hot_windows(candidate: Column, window: int, bits: float) -> Column:
    """First start and last end of the windows with at least ``bits`` of entropy, as an array of at most one struct."""
    letters = F.split(candidate, "")
    alphabet = F.array_distinct(letters)
    first = F.slice(letters, 1, window)
    counts = F.transform(alphabet, lambda x: F.size(F.filter(first, lambda y: y == x)))
    total = F.aggregate(counts, F.lit(0.0), lambda sum_, c: sum_ + _weight(c))
    # entropy = log2(window) - sum / window; a small margin keeps equal sums on one side of the threshold
    most = F.lit(window * (math.log2(window) - bits) + 1e-9)

    def step(state: Column, i: Column) -> Column:
        out, into = letters[i - 1], letters[i + window - 1]
        gone = F.array_position(alphabet, out).cast("int") - 1
        come = F.array_position(alphabet, into).cast("int") - 1
        changed = F.transform(
            state["counts"],
            lambda c, k: c + F.when(k == come, 1).otherwise(0) - F.when(k == gone, 1).otherwise(0),
        )
        before_out, before_in = state["counts"][gone], state["counts"][come]
        delta = _weight(before_out - 1) - _weight(before_out) + _weight(before_in + 1) - _weight(before_in)
        sum_ = F.when(out == into, state["sum"]).otherwise(state["sum"] + delta)
        hot = sum_ <= most
        return F.struct(
            F.when(out == into, state["counts"]).otherwise(changed).alias("counts"),
            sum_.alias("sum"),
            F.when(hot & (state["first"] < 0), i).otherwise(state["first"]).alias("first"),
            F.when(hot, i).otherwise(state["last"]).alias("last"),
        )

    begin = F.when(total <= most, 0).otherwise(-1)
    start = F.struct(counts.alias("counts"), total.alias("sum"), begin.alias("first"), begin.alias("last"))
    steps = F.when(F.size(letters) > window, F.sequence(F.lit(1), F.size(letters) - window)).otherwise(
        F.array().cast("array<int>")
    )
    end = F.aggregate(
        steps, start, step, lambda s: F.struct(s["first"].alias("first"), (s["last"] + window).alias("stop"))
    )
    return F.when(F.size(letters) >= window, F.filter(F.array(end), lambda e: e["first"] >= 0)).otherwise(
        F.array().cast("array<struct<first:int,stop:int>>")
    )


def _entropy_spans(text: Column, kind: CharacterClass) -> Column:
    """Spans of one class, in order and apart."""

    def spans(run: Column) -> Column:
        candidate = run["value"]
        plausible = ~candidate.rlike(ALLOWED)
        for need in kind.needs:
            plausible = plausible & candidate.rlike(need)
        found = F.when(plausible, hot_windows(candidate, kind.window, kind.bits)).otherwise(
            F.array().cast("array<struct<first:int,stop:int>>")
        )
        return F.transform(
            found,
            lambda w: F.struct(
                (run["start"] + w["first"]).alias("start"), F.lit(3).alias("kind"), (run["start"] + w["stop"]).alias("stop")
            ),
        )

    return F.coalesce(F.flatten(F.transform(_found(text, kind.run), spans)), F.array().cast(NO_SPANS))


def without_words(text: Column) -> Column:
    """The text with spaces for allowed words that stand by themselves."""
    alone = "(?i)(?<![A-Za-z0-9])(?:{})(?![A-Za-z0-9])"
    left = text
    for word in ALLOWED_WORDS:
        left = F.regexp_replace(left, alone.format(word), " " * len(word))
    return F.when(text.rlike(alone.format("|".join(ALLOWED_WORDS))), left).otherwise(text)


def _spelled(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["stop"].cast("string"))),
        ",",
    )


BASE = ("_assign", "_access", "_hex")
MORE = tuple(f"_entropy{k}" for k in range(len(CLASSES)))


def with_spans(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``docs`` with ``_base`` and ``_spans``, sorted arrays of ``(start, kind, stop)``, and the spans of each pattern by itself."""
    text = text_of(text_column)
    base = {
        "_assign": F.when(text.rlike(ASSIGN_HINT), _spans(text, ASSIGN, 0, value_group=2, least=ASSIGN_VALUE)).otherwise(
            F.array().cast(NO_SPANS)
        ),
        "_access": F.when(F.contains(text, F.lit("AKIA")), _spans(text, ACCESS, 1)).otherwise(F.array().cast(NO_SPANS)),
        "_hex": _spans(text, HEX, 2),
    }
    found = docs.withColumns(base)
    left = text
    for name in BASE:
        left = covered(left, F.col(name), " ")
    found = found.withColumn("_left", without_words(left))
    found = found.withColumns({n: _entropy_spans(F.col("_left"), k) for n, k in zip(MORE, CLASSES, strict=True)}).drop("_left")
    more = F.array_distinct(F.concat(*MORE))
    return found.withColumn("_base", F.array_sort(F.concat(*BASE))).withColumn("_spans", F.array_sort(F.concat("_base", more)))


def secret_scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Counts, digest and spans of the secrets in every text."""
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    count = lambda kind: F.size(F.filter("_base", lambda s: s["kind"] == kind)).cast("long")
    return with_spans(rows).select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(_spelled(F.col("_base")), 256).alias("base_sha256"),
        _spelled(F.col("_spans")).alias("spans"),
    )


def masked(docs: DataFrame, text_column: str = "text", mask: str = "*") -> DataFrame:
    """``docs`` with every character of every span replaced, so that lengths stay as they were."""
    rows = with_spans(wrapped(docs, text=F.col(f"`{text_column}`")))
    # the spans of one pattern are apart; those of different patterns may overlap
    for name in (*BASE, *MORE):
        rows = rows.withColumn("text", covered(F.col("text"), F.col(name), mask))
    return unwrapped(rows, docs.columns, **{text_column: F.col("text")})


def _matches(kind: int, pattern: str, group: int, table: str) -> str:
    """SQL for one pattern's matches in the texts of a table, one row each, with the piece of text before it."""
    return f"""SELECT rid, part, {kind} AS k, unnest(range(1, len(whole) + 1)) AS i, unnest(whole) AS whole, unnest(value) AS value,
    unnest(piece[1:len(whole)]) AS piece
  FROM (SELECT rid, part, regexp_extract_all(text, '{pattern}') AS whole, regexp_extract_all(text, '{pattern}', {group}) AS value,
    string_split_regex(text, '{pattern}') AS piece FROM {table} WHERE regexp_matches(text, '{pattern}'))"""


def _placed(matches: str) -> str:
    """SQL for where matches start in their text."""
    return f"""SELECT *, (sum(length(piece)) OVER before + coalesce(sum(length(whole)) OVER earlier, 0))::BIGINT AS a
  FROM ({matches}) WINDOW before AS (PARTITION BY rid, part, k ORDER BY i),
    earlier AS (PARTITION BY rid, part, k ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""


def _without_words(text: str) -> str:
    """SQL for a text with spaces for allowed words by themselves; twice, as neighbours share what parts them."""
    for _ in range(2):
        for word in ALLOWED_WORDS:
            either = "".join(f"[{c}{c.upper()}]" for c in word)
            text = f"regexp_replace({text}, '(^|[^A-Za-z0-9]){either}($|[^A-Za-z0-9])', '\\1{' ' * len(word)}\\2', 'g')"
    return text


_ASSIGN_SQL = ASSIGN.replace("'", "''")
_BASE = " UNION ALL ".join(_matches(k, p, g, "t") for k, p, g in ((0, _ASSIGN_SQL, 2), (1, ACCESS, 0), (2, HEX, 0)))
_RUNS = " UNION ALL ".join(_matches(k, p, 0, "rest") for k, p in ((3, "[A-Za-z0-9+/_=-]{20,}"), (4, "[0-9A-F]{24,}")))
_HOT = """SELECT rid, shift + a + min(w) AS a, shift + a + max(w) + {window} AS b FROM (
    SELECT rid, part, i, a, whole, unnest(range(0, length(whole) - {window} + 1)) AS w FROM runs
    WHERE k = {kind} AND length(whole) >= {window} AND NOT regexp_matches(whole, '{allowed}') AND {needs}) JOIN rest USING (rid, part)
  WHERE list_aggregate(string_split(substr(whole, w::INTEGER + 1, {window}), ''), 'entropy') >= {bits} - 1e-9
  GROUP BY rid, part, shift, i, a"""
_ENTROPY = " UNION ".join(
    _HOT.format(
        window=c.window,
        kind=3 + n,
        bits=c.bits,
        allowed=ALLOWED,
        needs=" AND ".join(f"regexp_matches(whole, '{need}')" for need in c.needs),
    )
    for n, c in enumerate(CLASSES)
)
# The twin cuts a text where base spans are and looks at each part that is left by itself.
ORACLE = f"""
WITH t AS (SELECT row_number() OVER () AS rid, 0 AS part, doc_id, coalesce(text, '') AS text FROM documents),
base AS (SELECT rid, k, a, a + length(whole) AS b FROM ({_placed(_BASE)}) WHERE k IN (1, 2) OR k = 0 AND length(value) >= {ASSIGN_VALUE}),
reached AS (SELECT *, max(b) OVER (PARTITION BY rid ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS far FROM base),
gap AS (
  SELECT rid, coalesce(far, 0) AS x, a AS y FROM reached WHERE a > coalesce(far, 0)
  UNION ALL SELECT rid, coalesce(max(b), 0), any_value(length(text)) FROM t LEFT JOIN base USING (rid) GROUP BY rid
),
rest AS (
  SELECT rid, row_number() OVER (PARTITION BY rid ORDER BY x) AS part, x AS shift, {_without_words('substr(text, (x + 1)::BIGINT, (y - x)::BIGINT)')} AS text
  FROM gap JOIN t USING (rid) WHERE y > x
),
runs AS ({_placed(_RUNS)}),
more AS ({_ENTROPY}),
named AS (SELECT *, ['assign', 'access', 'hex', 'entropy'][k + 1] || ':' || a || ':' || b AS name
  FROM (SELECT rid, k, a, b FROM base UNION ALL SELECT DISTINCT rid, 3, a, b FROM more)),
told AS (
  SELECT rid, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
    string_agg(name, ',' ORDER BY a, k, b) FILTER (k < 3) AS base, string_agg(name, ',' ORDER BY a, k, b) AS spans
  FROM named GROUP BY rid
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM t LEFT JOIN told USING (rid)
"""
