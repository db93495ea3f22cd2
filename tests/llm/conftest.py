import random

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside; as columns of the input they must not matter.
CLASHES = (
    "node n hash content label score start stop text_key shingle shingles range _set _node _low _base _more _spans"
    " best found row v sketch trigger phrase at held_out predicted group_size _dedup_hash"
).split()


def rows_of(texts, first=0):
    return [(first + k, t, "en", "s", len(t or "")) for k, t in enumerate(texts)]


@pytest.fixture
def documents(spark):
    """Makes a table of documents, with columns whose names clash."""

    def make(texts=(), rows=None):
        data = rows_of(texts) if rows is None else rows
        plain = spark.createDataFrame(data, SCHEMA).repartition(3)
        return plain.withColumns({c: F.lit(None).cast("string") for c in CLASHES})

    return make


@pytest.fixture
def edge_rows():
    """Nulls, empty and long texts, copies and repeated rows, repeated and null ids."""
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 8))) for _ in range(300)]
    long = " ".join(rng.choice(words) for _ in range(30_000))
    near = " ".join(words[:60])
    return [
        (1, None, None, None, None),
        (2, "", "en", "s", 0),
        (3, "   \n\t ", "en", "s", 6),
        (4, "one", "en", "s", 3),
        (5, "One", "en", "s", 3),
        (6, "one two", "en", "s", 7),
        (7, long, "en", "s", len(long)),
        (8, long, "en", "s", len(long)),
        (8, long, "en", "s", len(long)),
        (9, long + " end", "en", "s", len(long) + 4),
        (10, near, "en", "s", len(near)),
        (11, near + " tail", "en", "s", len(near) + 5),
        (11, near + " tail", "en", "s", len(near) + 5),
        (None, near, "en", "s", len(near)),
        (None, None, None, None, None),
        (12, "żółw ▁ 日本語 🙂 <|endoftext|> <s>", "de", "s", 31),
    ]
