"""The shared test tables, reshaped into the inputs the operators expect."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairwright.functions import identifiers, text
from pairwright.operators.matching import Compare, Matching
from pairwright.plans.customers import matching_job
from pairwright.session import shuffle_partitions
from pairwright.sources.dictionaries import dictionary_df
from pairwright.sources.schemas import CUSTOMERS, WEB_CUSTOMERS

DICTIONARY_ROWS = [
    ("BLUE", "BLU", "NAME"),
    ("SMALL", "SML", "NAME"),
    ("LARGE", "LRG", "NAME"),
    ("WIDGET", "WDG", "ADDRESS"),
    ("PLATE", "PLT", "ADDRESS"),
    ("SMALL", "SM", "ADDRESS"),
    ("ECONOMY", "ECO", "ADDRESS"),
    ("STANDARD", "STD", "ADDRESS"),
]


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def part_records(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as people: name blocks, brand and type are compared."""
    return read(spark, folder, "part").select(
        F.col("p_partkey").alias("cust_id"),
        text.standardize(F.col("p_name")).alias("fname"),
        text.standardize(F.col("p_brand")).alias("lname"),
        text.standardize(F.col("p_type")).alias("address"),
    )


def part_job():
    return matching_job("cust_id", "fname", "lname", "address")


def neighbour_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Each part's label next to the label of the part after it.

    The rows are small and what is done with them is not, so they are dealt out by number: by their
    bytes, adaptive coalescing would put them into one task.
    """
    label = F.concat_ws(" ", "p_name", "p_brand")
    part = read(spark, folder, "part").repartition(shuffle_partitions(spark), "p_partkey")
    this = part.select("p_partkey", label.alias("left_text"))
    following = part.select((F.col("p_partkey") - 1).alias("p_partkey"), label.alias("right_text"))
    return this.join(following, "p_partkey")


def _identifier(key: Column) -> Column:
    ten = F.lpad((key * 7919 + 12345).cast("string"), 10, "0")
    digit = identifiers.pesel_check_digit(ten)
    kind = key % 10
    return (
        F.when(kind == 0, F.lit(None).cast("string"))
        .when(kind == 1, F.lit("00000000000"))
        .when(kind == 2, F.concat(ten, ((digit + 1) % 10).cast("string")))
        .when(kind == 3, ten)
        .when(kind == 4, F.concat(F.lit("A"), F.substring(ten, 2, 9), digit.cast("string")))
        .otherwise(F.concat(ten, digit.cast("string")))
    )


def customer_identifiers(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with an identifier, valid or broken by the last digit of the key."""
    return read(spark, folder, "customer").select(
        "c_custkey", _identifier(F.col("c_custkey")).alias("pesel")
    )


def daily_measurements(spark: SparkSession, folder: str) -> DataFrame:
    """Event counts per day as the results of one metric per event type."""
    events = read(spark, folder, "events")
    day = F.date_trunc("day", F.col("ts").cast("timestamp")).alias("measurement_time")
    name = F.concat("event_type", F.lit("_count")).alias("metric_name")
    return (
        events.groupBy(day, name)
        .agg(F.count(F.lit(1)).cast("double").alias("value"))
        .withColumns({"table_name": F.lit("events"), "column_name": F.lit("event_type")})
    )


def address_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as short address lines with a first name."""
    return read(spark, folder, "part").select(
        F.col("p_partkey").alias("cust_key"),
        F.upper(F.substring_index("p_name", " ", 1)).alias("fname"),
        F.concat_ws("  ", F.upper("p_name"), F.col("p_type")).alias("address"),
    )


def small_dictionary(spark: SparkSession) -> DataFrame:
    return dictionary_df(spark, DICTIONARY_ROWS)


ADDRESS_TERMS = {token: term for token, term, context in DICTIONARY_ROWS if context == "ADDRESS"}


def loose_addresses(spark: SparkSession, folder: str) -> DataFrame:
    """Address lines under keys that repeat or are missing; names recur, so texts do as well."""
    part = read(spark, folder, "part")
    return part.select(
        F.when(F.col("p_partkey") % 7 > 0, (F.col("p_partkey") % 5).cast("string")).alias("cust_key"),
        F.concat_ws("  ", F.upper("p_name"), F.upper("p_type")).alias("address"),
    )


def customer_records(spark: SparkSession, folder: str) -> DataFrame:
    """Customers in a few large blocks, each with a name of its own."""
    return read(spark, folder, "customer").select(
        F.col("c_custkey").alias("cust_id"),
        text.standardize(F.col("c_mktsegment")).alias("segment"),
        F.col("c_name").alias("name"),
    )


def customer_job() -> Matching:
    """Compare names within a segment; slots are small, so that small tables have several."""
    return Matching("cust_id", ["segment"], [Compare("name", "fuzzy", "name_fuzzy")], {"name_fuzzy": 0.9}, slot_rows=64)


def two_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Two tables with an identifier or a missing value each."""
    people = customer_identifiers(spark, folder)
    events = read(spark, folder, "events").select(
        "event_id", F.when(F.col("event_type") != "error", F.col("value")).alias("value"), "event_type"
    )
    return {"customer": people, "events": events}


def document_records(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of a language and source."""
    return read(spark, folder, "documents").select("doc_id", "lang", "source", "text")


def document_job(metric: str, minimum: float) -> Matching:
    """Compare the words of documents of the same language and source."""
    return Matching("doc_id", ["lang", "source"], [Compare("text", metric, "score")], {"score": minimum}, tell_values=False)


def part_name_job(metric: str, minimum: float) -> Matching:
    """Compare the names of parts of one brand."""
    return Matching("p_partkey", ["p_brand"], [Compare("p_name", metric, "score")], {"score": minimum})


def customer_files(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Customers and suppliers in the columns of the two customer files, as text; people of a nation share first names."""
    nation = read(spark, folder, "nation").select("n_nationkey", "n_name")
    people = read(spark, folder, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    shops = read(spark, folder, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    born = lambda key: F.date_add(F.lit("1970-01-01").cast("date"), (key % 9000).cast("int"))
    main = {
        "PESEL": _identifier(F.col("c_custkey")),
        "IMIE": F.concat_ws("-", "n_name", (F.col("c_custkey") % 4).cast("string")),
        "NAZWISKO": F.col("c_name"),
        "DATA_URODZENIA": born(F.col("c_custkey")),
        "MIASTO_ZAMELDOWANIA": F.concat_ws(" ", "n_name", "c_mktsegment"),
        "ULICA_ZAMIESZKANIA": F.concat(F.lit(" ul. "), F.col("n_name"), F.lit(", 5")),
        "GRUPA": F.col("c_mktsegment"),
        "ID_TARYFY": F.col("c_nationkey"),
        "CZAS_DZISIAJ": F.col("c_acctbal").cast("decimal(10,2)"),
    }
    web = {
        "PESEL": _identifier(F.col("s_suppkey") + 7),
        "IMIE": F.concat_ws("-", "n_name", (F.col("s_suppkey") % 4).cast("string")),
        "NAZWISKO": F.replace(F.col("s_name"), F.lit("Supplier"), F.lit("Customer")),
        "DATA_URODZENIA": born(F.col("s_suppkey")),
        "MIEJSCE_ZAMIESZKANIA": F.concat_ws(" ", "n_name", F.lit("BUILDING")),
        "E_MAIL": F.concat(F.lit("shop"), F.col("s_suppkey").cast("string"), F.lit("@example.org")),
    }
    absent = F.lit(None).cast("string")
    return (
        people.select(*[main.get(c, absent).cast("string").alias(c) for c in CUSTOMERS.names]),
        shops.select(*[web.get(c, absent).cast("string").alias(c) for c in WEB_CUSTOMERS.names]),
    )


def foreign_words(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct words of the documents with letters beyond ASCII, next to what standardizing makes of them."""
    words = read(spark, folder, "documents").select(F.explode(F.split("text", "[ \\n]")).alias("word")).distinct()
    words = words.where(F.col("word").rlike(r"^[a-zà-ÿ]{2,16}$") & F.col("word").rlike("[à-ÿ]"))
    return words.select("word", text.standardize(F.col("word")).alias("standard"))
