"""Address correction through a completion function the caller supplies."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairwright.functions.text import regex_group
from pairwright.session import shuffle_partitions

# The prompt around the two address parts, and the reply patterns.
PROMPT_BEFORE_CITY = (
    "If this is not the correct address in Poland, offer the correct address in the format "
    "city: correct city name and street: correct street name. Dont add any additional "
    "description - keep the answer short. Data - city: "
)
PROMPT_BEFORE_STREET = " street: "
CITY_PATTERN = r"city:\s*([^,]+),?\s*street"
STREET_PATTERN = r"street:\s*([^,]+)"


def address_prompt(city: Column, street: Column) -> Column:
    """The question for one address; null when either part is null."""
    return F.concat(F.lit(PROMPT_BEFORE_CITY), city, F.lit(PROMPT_BEFORE_STREET), street)


def reply_city(reply: Column) -> Column:
    return regex_group(reply, CITY_PATTERN)


def reply_street(reply: Column) -> Column:
    return regex_group(reply, STREET_PATTERN)


def parse_replies(df: DataFrame, reply: str, city: str = "miasto", street: str = "street") -> DataFrame:
    """Add the city and street a reply names; null where it names none."""
    return df.withColumns({city: reply_city(F.col(reply)), street: reply_street(F.col(reply))})


def correct_addresses(
    df: DataFrame,
    city: str,
    street: str,
    complete: Callable[[list[str]], list[str]],
    reply: str = "llm",
    parallel: int | None = None,
) -> DataFrame:
    """Ask once per distinct address, then parse the replies.

    ``complete`` answers a batch of prompts, one reply for each; it runs on the
    executors, in at most ``parallel`` tasks at once (as many as the session has
    partitions by default), however small the addresses are.  The answers join
    back to every row of the address.
    """
    asked = (
        df.select(F.col(city).alias("_city"), F.col(street).alias("_street"))
        .dropna()
        .distinct()
        .withColumn("_prompt", address_prompt(F.col("_city"), F.col("_street")))
    )

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prompts = batch.column("_prompt").to_pylist()
            replies = complete(prompts)
            if len(replies) != len(prompts):
                raise ValueError(f"{len(replies)} replies to {len(prompts)} prompts")
            yield pa.RecordBatch.from_arrays(
                [batch.column("_city"), batch.column("_street"), pa.array(replies, pa.string())],
                names=["_city", "_street", reply],
            )

    tasks = parallel or shuffle_partitions(df.sparkSession)
    answered = asked.repartition(tasks).mapInArrow(answer, f"_city string, _street string, `{reply}` string")
    on = [F.col(city) == F.col("_city"), F.col(street) == F.col("_street")]
    joined = df.join(answered, on, "left").drop("_city", "_street")
    return parse_replies(joined, reply)
