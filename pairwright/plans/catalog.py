"""Every operator as a query over the shared test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructType

from pairwright.functions.similarity import cosine_similarity
from pairwright.functions.sql import register_functions
from pairwright.functions.text import POLISH_FOLDED, POLISH_UPPER, clean_tokens, edit_score, soundex, standardize
from pairwright.operators import (
    combining,
    estimates,
    filters,
    ids,
    listing,
    pairing,
    periods,
    quality,
    replies,
    rules,
    standardizing,
)
from pairwright.operators.combining import Source
from pairwright.operators.matching import Compare, Matching
from pairwright.operators.scoring import Comparison, score_pairs
from pairwright.plans import customers, stand_ins
from pairwright.plans.stand_ins import read
from pairwright.session import shared_folder
from pairwright.sources import dictionaries, files
from pairwright.sources.schemas import CUSTOMERS, WEB_CUSTOMERS, text, typed
from pairwright.streaming.changes import measure_changes
from pairwright.streaming.monitor import monitor
from pairwright.streaming.windows import monitor_windowed as windowed

Query = Callable[[SparkSession, str], DataFrame]


# --- sources and set operations ------------------------------------------------


def row_counts(spark: SparkSession, folder: str) -> DataFrame:
    return files.row_counts({name: read(spark, folder, name) for name in ("customer", "supplier")})


SUPPLIER_ALIGNED = {
    "s_suppkey": "c_custkey",
    "s_name": "c_name",
    "s_nationkey": "c_nationkey",
    "s_acctbal": "c_acctbal",
}


def union_sources(spark: SparkSession, folder: str) -> DataFrame:
    return combining.union_sources(
        {
            "customer": Source(read(spark, folder, "customer")),
            "supplier": Source(read(spark, folder, "supplier"), SUPPLIER_ALIGNED),
        }
    )


def union_fillers(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment", "supplier_code"]
    supplier = read(spark, folder, "supplier").withColumn("supplier_code", F.col("s_suppkey").cast("string"))
    return combining.union_sources(
        {
            "customer": Source(
                read(spark, folder, "customer").drop("c_acctbal"), fillers={"supplier_code": F.lit("")}
            ),
            "supplier": Source(supplier, SUPPLIER_ALIGNED, {"c_mktsegment": F.lit(" ")}),
        },
        columns,
        provenance=None,
    )


LOADED_CUSTOMER = StructType(
    [typed("c_custkey", LongType()), text("c_name", 30), typed("c_acctbal", DoubleType()), text("c_mktsegment", 10)]
)


LOADED_CUSTOMER_NAMES = StructType(
    [typed("c_custkey", LongType()), text("c_name", 60), typed("c_acctbal", DoubleType()), text("c_mktsegment", 10)]
)


def _customer_lines(spark: SparkSession, folder: str) -> str:
    """Write customers as comma-separated lines, some of them broken.

    By the key's remainder: 1 a word for a number, 2 a missing field, 3 a
    text over its length, 4 to 6 the null tokens, 7 a quoted comma and quote,
    8 the same with a padded word for a number, 9 a quote that stays open.
    """
    kind = F.col("c_custkey") % 10
    quoted = F.concat(F.lit('"a, ""b"" '), F.col("c_name"), F.lit('"'))
    open_quote = F.concat(F.lit('"'), F.col("c_name"))
    name = F.when(kind.isin(7, 8), quoted).when(kind == 9, open_quote).otherwise(F.col("c_name"))
    balance = (
        F.when(kind == 1, F.lit("none"))
        .when(kind == 8, F.lit(" none "))
        .when(kind == 4, F.lit(""))
        .when(kind == 5, F.lit("NULL"))
        .when(kind == 6, F.lit("null"))
        .otherwise(F.col("c_acctbal").cast("string"))
    )
    segment = F.when(kind == 3, F.repeat("c_mktsegment", 2)).otherwise(F.col("c_mktsegment"))
    key = F.col("c_custkey").cast("string")
    line = F.when(kind == 2, F.concat_ws(",", key, name)).otherwise(F.concat_ws(",", key, name, balance, segment))
    target = shared_folder(spark, "customer-lines")
    lines = read(spark, folder, "customer").select(line.alias("value"))
    # The CSV writer gives each file a header; it must leave the lines alone.
    lines.write.options(header="true", quote="", sep="\u0001").csv(target)
    return target


def csv_load(spark: SparkSession, folder: str) -> DataFrame:
    path = _customer_lines(spark, folder)
    good, _ = files.load(spark, path, LOADED_CUSTOMER, files.COMMA)
    return good


def csv_rejects(spark: SparkSession, folder: str) -> DataFrame:
    path = _customer_lines(spark, folder)
    annotated = files.read_annotated(spark, path, LOADED_CUSTOMER, files.COMMA)
    _, rejects = files.land(annotated, shared_folder(spark, "landed"))
    return rejects.select("raw", F.array_join("reason", "; ").alias("reason"))


def csv_line_breaks(spark: SparkSession, folder: str) -> DataFrame:
    """Customers whose names hold quoted line breaks, commas and quotes, from files that are read in splits."""
    quoted = F.concat(F.lit('"'), F.col("c_name"), F.lit('\n""'), F.col("c_mktsegment"), F.lit('"",\n"'))
    name = F.when(F.col("c_custkey") % 3 == 0, F.col("c_name")).otherwise(quoted)
    key = F.when(F.col("c_custkey") % 7 == 0, F.lit("none")).otherwise(F.col("c_custkey").cast("string"))
    target = shared_folder(spark, "broken-lines")
    fields = F.concat_ws(",", key, name, F.col("c_acctbal").cast("string"), F.col("c_mktsegment"))
    # line by line, as the writer would put quotes of its own around a line break
    lines = read(spark, folder, "customer").select(F.explode(F.split(fields, "\n")).alias("value"))
    lines.write.options(header="true", quote="", sep="\u0001", emptyValue="").csv(target)
    return files.read_csv(spark, target, LOADED_CUSTOMER_NAMES, files.COMMA_MULTILINE)


def csv_semicolon(spark: SparkSession, folder: str) -> DataFrame:
    """A file with semicolons, read by name: commas are text there."""
    target = shared_folder(spark, "nation-lines")
    name = F.concat(F.col("n_name"), F.lit(", "), F.col("n_regionkey").cast("string"))
    lines = read(spark, folder, "nation").select(F.concat_ws(";", F.col("n_nationkey").cast("string"), name).alias("value"))
    lines.write.options(header="true", quote="", sep="\u0001").csv(target)
    return files.read_csv(spark, target, StructType([typed("n_nationkey", LongType()), text("n_name", 100)]), files.SEMICOLON)


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """The folders of a partitioned table, listed without reading it, and whether they hold anything."""
    target = shared_folder(spark, "segments")
    read(spark, folder, "customer").write.partitionBy("c_mktsegment").parquet(target)
    listed = files.list_files(spark, target).select(F.regexp_extract("path", "c_mktsegment=([^/]+)/", 1).alias("segment"), "length")
    return listed.where("segment > ''").groupBy("segment").agg((F.sum("length") > 0).alias("filled"))


def _loaded_files(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Both customer files, written as text and loaded by their declared schemas."""
    loaded = []
    for name, frame, schema in zip(("main", "web"), stand_ins.customer_files(spark, folder), (CUSTOMERS, WEB_CUSTOMERS), strict=True):
        place = shared_folder(spark, f"{name}-customers")
        frame.write.options(header="true", nullValue="NULL", ignoreLeadingWhiteSpace="false").csv(place)
        loaded.append(files.load(spark, place, schema)[0])
    return loaded[0], loaded[1]


def customer_files(spark: SparkSession, folder: str) -> DataFrame:
    """Both customer files in one table, made from a query and read back, with where each row came from."""
    main, web = _loaded_files(spark, folder)
    both = customers.combine_with_provenance(main, web, "BAZA", "WWW")
    place = shared_folder(spark, "union-table")
    return files.save_table(both, f"customers_{place.rsplit('-', 1)[-1]}".replace("/", "_"), place)


def customer_file_links(spark: SparkSession, folder: str) -> DataFrame:
    """Probable duplicates in both customer files, per first name: how many record pairs, and their scores added up."""
    records = customers.landed(customers.records_for_matching(*_loaded_files(spark, folder)))
    links = customers.matching_job().links(records)
    pairs = F.col("pairs").cast("long")
    added = [F.round(F.sum(pairs * F.col(c)).cast("double"), 3).alias(c) for c in ("lname_fuzzy", "address_fuzzy")]
    return links.groupBy("IMIE").agg(F.sum(pairs).alias("pairs"), *added)


def customer_file_listing(spark: SparkSession, folder: str) -> DataFrame:
    """The first rows of the listing of probable duplicates in both customer files."""
    return customers.probable_duplicates(customers.records_for_matching(*_loaded_files(spark, folder)))


def _view(spark: SparkSession, folder: str, name: str) -> str:
    """A table under a name for SQL."""
    register_functions(spark)
    read(spark, folder, name).createOrReplaceTempView(f"sql_{name}")
    return f"sql_{name}"


def sql_alias_reuse(spark: SparkSession, folder: str) -> DataFrame:
    """A column's alias used further on in the same select."""
    return spark.sql(
        f"SELECT p_partkey, standardize(concat(p_name, '; ', p_brand)) AS label, length(label) AS size, "
        f"concat(label, ' ', size) AS both FROM {_view(spark, folder, 'part')}"
    )


def sql_pipes(spark: SparkSession, folder: str) -> DataFrame:
    """A query as a chain of steps."""
    return spark.sql(
        f"FROM {_view(spark, folder, 'part')} |> WHERE p_size > 10 |> EXTEND standardize(p_brand) AS brand "
        "|> AGGREGATE count(*) AS parts, max(p_size) AS largest GROUP BY brand |> WHERE parts > 1"
    )


def sql_variables(spark: SparkSession, folder: str) -> DataFrame:
    """Every part's name against a session variable."""
    view = _view(spark, folder, "part")
    spark.sql("DECLARE OR REPLACE VARIABLE wanted STRING DEFAULT 'small ring'")
    return spark.sql(
        f"SELECT p_partkey, round(JaccardSimilarity(p_name, wanted), 6) AS jaccard, LevenshteinDistance(p_name, wanted) AS edits, "
        f"LongestCommonSubsequence(p_name, wanted) AS common FROM {view}"
    )


# --- standardization -----------------------------------------------------------


def standardize_table(spark: SparkSession, folder: str) -> DataFrame:
    part = read(spark, folder, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    return standardizing.standardize_table(part, ["p_name", "p_brand", "p_type"], trim=["p_type"])


def stable_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Rows with many copies get every id from 1 to n exactly once."""
    orders = read(spark, folder, "orders").select("o_orderstatus", "o_orderpriority")
    numbered = ids.with_stable_id(orders, "cust_id")
    per_value = numbered.groupBy("o_orderstatus", "o_orderpriority").agg(
        F.count_distinct("cust_id").alias("n"),
        F.min("cust_id").alias("first"),
        F.max("cust_id").alias("last"),
    )
    return per_value.agg(
        F.sum("n").alias("ids"), F.min("first").alias("first_id"), F.max("last").alias("last_id")
    )


def stable_ids_ordered(spark: SparkSession, folder: str) -> DataFrame:
    customer = read(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    return ids.with_stable_id(customer, "cust_id", mode="dense", order=["c_mktsegment", "c_custkey"])


def regex_street(spark: SparkSession, folder: str) -> DataFrame:
    part = read(spark, folder, "part").select("p_partkey", "p_name")
    return filters.street_starts_with(part, "p_name", "R")


def regex_house(spark: SparkSession, folder: str) -> DataFrame:
    size = F.col("p_size").cast("string")
    number = (
        F.when(F.col("p_partkey") % 4 == 0, F.concat(size, F.lit("/2")))
        .when(F.col("p_partkey") % 4 == 1, F.concat(size, F.lit("A")))
        .when(F.col("p_partkey") % 4 == 2, size)
    )
    part = read(spark, folder, "part").select("p_partkey", number.alias("house_number"))
    return filters.non_simple_house_number(part, "house_number")


def build_samples(spark: SparkSession, folder: str) -> DataFrame:
    person = read(spark, folder, "customer").select(
        F.col("c_custkey").alias("c_customer_sk"),
        F.col("c_nationkey").alias("c_current_addr_sk"),
        F.concat(F.lit("no. "), F.substring_index("c_name", "#", -1)).alias("c_first_name"),
        F.when(F.col("c_custkey") % 5 > 0, F.col("c_mktsegment")).alias("c_last_name"),
    )
    nation = read(spark, folder, "nation")
    address = nation.join(read(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("ca_address_sk"),
        F.col("n_nationkey").alias("ca_street_number"),
        F.col("n_name").alias("ca_street_name"),
        F.when(F.col("n_nationkey") != 3, F.lit("street")).alias("ca_street_type"),
        F.when(F.col("n_nationkey") > 5, F.col("r_name")).alias("ca_city"),
        F.col("r_name").alias("ca_state"),
        F.col("n_regionkey").alias("ca_zip"),
    )
    return standardizing.build_samples(person, address)


def capped_samples(spark: SparkSession, folder: str) -> DataFrame:
    """The first samples in the order of their keys."""
    samples = build_samples(spark, folder).withColumn("number", F.col("cust_key").cast("long"))
    return standardizing.capped(samples, 50, ["number"]).drop("number")


def short_values(spark: SparkSession, folder: str) -> DataFrame:
    return standardizing.short_values(stand_ins.address_parts(spark, folder), "fname", 5)


def prefix_values(spark: SparkSession, folder: str) -> DataFrame:
    return standardizing.values_with_prefix(stand_ins.part_records(spark, folder), "fname", "SMALL")


def dictionary_values(spark: SparkSession, folder: str) -> DataFrame:
    parts = stand_ins.address_parts(spark, folder).select("cust_key", "fname")
    dictionary = stand_ins.small_dictionary(spark)
    return standardizing.standardize_value(parts, "fname", dictionary, "NAME", "fname_std")


def changed_rows(spark: SparkSession, folder: str) -> DataFrame:
    return standardizing.changed_rows(dictionary_values(spark, folder), "fname", "fname_std")


def dictionary_tokens(spark: SparkSession, folder: str) -> DataFrame:
    parts = stand_ins.address_parts(spark, folder).select("cust_key", "address")
    dictionary = stand_ins.small_dictionary(spark)
    return standardizing.standardize_tokens(parts, "address", dictionary, "ADDRESS", "address_std")


def dictionary_tokens_joined(spark: SparkSession, folder: str) -> DataFrame:
    """Keys that repeat or are null, and texts that recur: rows stay as they are."""
    parts = stand_ins.loose_addresses(spark, folder)
    dictionary = stand_ins.small_dictionary(spark)
    return standardizing.standardize_tokens(parts, "address", dictionary, "ADDRESS", "address_std")


def dictionary_tokens_embedded(spark: SparkSession, folder: str) -> DataFrame:
    """The same rows with the terms as part of the expression."""
    parts = stand_ins.loose_addresses(spark, folder)
    return standardizing.standardize_tokens(parts, "address", stand_ins.ADDRESS_TERMS, "ADDRESS", "address_std")


def text_standards(spark: SparkSession, folder: str) -> DataFrame:
    """Long texts in several languages: upper case, kept letters, clean tokens, cosine."""
    documents = read(spark, folder, "documents").select("doc_id", "text", "lang")
    standard = standardize(F.col("text"))
    return documents.select(
        "doc_id",
        standard.alias("standard"),
        clean_tokens(F.upper("text"), True).alias("tokens"),
        F.round(cosine_similarity(F.upper("text"), standard), 6).alias("cosine"),
    )


def large_changes(spark: SparkSession, folder: str) -> DataFrame:
    return standardizing.large_changes(dictionary_tokens(spark, folder), "address", "address_std", 3)


def dictionary_checks(spark: SparkSession, folder: str) -> DataFrame:
    """The rules applied to a dictionary drawn from the parts, which breaks them."""
    drawn = read(spark, folder, "part").select(
        F.col("p_brand").alias("token"),
        F.when(F.col("p_size") > 3, F.col("p_type")).alias("term"),
        F.col("p_type").alias("context"),
    )
    return dictionaries.validate_dictionary(drawn)


def city_lookup(spark: SparkSession, folder: str) -> DataFrame:
    customer = read(spark, folder, "customer").select("c_custkey", "c_nationkey")
    # some customers get a nation that is in no list
    moved = F.when(F.col("c_custkey") % 6 == 0, F.col("c_nationkey") + 100).otherwise(F.col("c_nationkey"))
    codes = read(spark, folder, "nation")
    asked = customer.withColumn("c_nationkey", moved)
    return standardizing.lookup(asked, "c_nationkey", codes, "n_nationkey", "n_name", "match_code")


def correct_addresses(spark: SparkSession, folder: str) -> DataFrame:
    nation = read(spark, folder, "nation").join(
        read(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    customer = read(spark, folder, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    addressed = customer.select("c_custkey", "r_name", "n_name")

    def answer(prompts: list[str]) -> list[str]:
        """A stand-in for a model: repeats the address, or fails to."""
        answers = []
        for prompt in prompts:
            city, _, street = prompt.partition("Data - city: ")[2].partition(" street: ")
            answers.append("no idea" if city == "ASIA" else f"City: {city}, Street: {street}, Poland")
        return answers

    return replies.correct_addresses(addressed, "r_name", "n_name", answer)


def parse_replies(spark: SparkSession, folder: str) -> DataFrame:
    part = read(spark, folder, "part")
    reply = F.concat(
        F.when(F.col("p_partkey") % 3 == 0, F.lit("City: ")).otherwise(F.lit("CITY:")),
        F.col("p_name"),
        F.when(F.col("p_partkey") % 2 == 0, F.lit(", ")).otherwise(F.lit(" ")),
        F.when(F.col("p_partkey") % 5 > 0, F.lit("street: ")).otherwise(F.lit("road: ")),
        F.col("p_brand"),
    )
    return replies.parse_replies(part.select("p_partkey", reply.alias("llm")), "llm")


# --- identifiers and quality ---------------------------------------------------


def pesel_audit(spark: SparkSession, folder: str) -> DataFrame:
    return quality.audit_pesel(stand_ins.customer_identifiers(spark, folder), "pesel")


def pesel_metric(spark: SparkSession, folder: str) -> DataFrame:
    return quality.audit_summary(stand_ins.customer_identifiers(spark, folder), "pesel")


def metric_evaluate(spark: SparkSession, folder: str) -> DataFrame:
    metrics = [
        (quality.INVALID_PESEL_COUNT, "pesel"),
        (quality.NULL_COUNT, "pesel"),
        (quality.ROW_COUNT, "c_custkey"),
    ]
    return quality.evaluate(stand_ins.customer_identifiers(spark, folder), metrics)


def metric_history(spark: SparkSession, folder: str) -> DataFrame:
    results = quality.results_for(stand_ins.daily_measurements(spark, folder), "events")
    return quality.history(results, "error_count", newest_first=True)


def metric_latest(spark: SparkSession, folder: str) -> DataFrame:
    return quality.latest_metric(stand_ins.daily_measurements(spark, folder))


KNOWN_METRICS = [quality.INVALID_PESEL_COUNT, quality.NULL_COUNT, quality.ROW_COUNT]


def _bindings(spark: SparkSession) -> DataFrame:
    """What is measured of the two tables, one metric detached again."""
    bound = quality.bindings_df(spark)
    for table, column, metric in (
        ("customer", "pesel", "INVALID_PESEL_COUNT"),
        ("customer", "pesel", "NULL_COUNT"),
        ("customer", "c_custkey", "NULL_COUNT"),
        ("events", "value", "NULL_COUNT"),
        ("events", "event_type", "NULL_COUNT"),
        ("events", "event_id", "ROW_COUNT"),
        ("events", "event_id", "NULL_COUNT"),
    ):
        bound = quality.attach(bound, table, column, metric)
    return quality.set_schedule(quality.detach(bound, "events", "event_id", "NULL_COUNT"), "customer", "1440 minutes")


def metric_bindings(spark: SparkSession, folder: str) -> DataFrame:
    """Everything that is bound, measured, with the period it is bound for."""
    bound = _bindings(spark)
    measured = quality.measure(stand_ins.two_tables(spark, folder), bound, KNOWN_METRICS)
    return measured.join(bound, list(quality.SERIES)).select(*quality.SERIES, "schedule", "value")


def metric_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Two tables and several columns under one metric, recorded in one folder and read back."""
    results = shared_folder(spark, "measured")
    bound = _bindings(spark)
    for name, table in stand_ins.two_tables(spark, folder).items():
        for run in ("first", "second"):
            stamped = quality.measure({name: table}, bound, KNOWN_METRICS)
            quality.record_metrics(stamped, results, name, run, 0)
    recorded = quality.read_results(spark, results)
    counted = recorded.groupBy(*quality.SERIES).agg(F.count(F.lit(1)).alias("measured"))
    return quality.latest_metric(recorded).drop("measurement_time").join(counted, list(quality.SERIES))


def metric_listing(spark: SparkSession, folder: str) -> DataFrame:
    """The metrics outside the core schema that are bound, with the rows they measure."""
    known = quality.outside_core(quality.metrics_df(spark, KNOWN_METRICS))
    measured = quality.measure(stand_ins.two_tables(spark, folder), _bindings(spark), KNOWN_METRICS)
    return known.join(measured, "metric_name").select("schema_name", "metric_name", "table_name", "value")


def monitor_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Measure the events as a stream and read the newest values back; an error's value is missing."""
    schema = read(spark, folder, "events").schema
    stream = spark.readStream.schema(schema).parquet(f"{folder}/events*.parquet")
    stream = stream.withColumn("value", F.when(F.col("event_type") != "error", F.col("value")))
    results, marks = shared_folder(spark, "results"), shared_folder(spark, "marks")
    metrics = [(quality.ROW_COUNT, "event_id"), (quality.NULL_COUNT, "value")]
    monitor(stream, metrics, "events", results, marks, every=None).awaitTermination()
    return quality.latest_metric(quality.read_results(spark, results)).select("metric_name", "value")


def monitor_windowed(spark: SparkSession, folder: str) -> DataFrame:
    """Events per five minutes, each window recorded when nothing on time can fall into it any more."""
    schema = read(spark, folder, "events").schema
    stream = spark.readStream.schema(schema).parquet(f"{folder}/events*.parquet")
    value = F.when(F.col("event_type") != "error", F.col("value"))
    stream = stream.select("event_id", F.col("ts").cast("timestamp").alias("ts"), value.alias("value"))
    results, marks = shared_folder(spark, "results"), shared_folder(spark, "marks")
    metrics = [(quality.ROW_COUNT, "event_id"), (quality.NULL_COUNT, "value")]
    windowed(stream, metrics, "ts", "events", results, marks, every=None).awaitTermination()
    recorded = quality.read_results(spark, results)
    return recorded.select(F.col("measurement_time").cast("string").alias("window_end"), "metric_name", "value")


# Minutes after the first measurement at which a caller comes round.
ROUNDS = (0, 4, 5, 11, 31)


def metric_periods(spark: SparkSession, folder: str) -> DataFrame:
    """Two tables of different periods, measured at some moments as far as they are due, and what was missed."""
    bound = quality.set_schedule(_bindings(spark), "customer", "10 minutes")
    tables = stand_ins.two_tables(spark, folder)
    results, told = quality.no_results(spark), []
    for number, minutes in enumerate(ROUNDS):
        now = datetime(2025, 1, 1) + timedelta(minutes=minutes)
        missed = periods.due(bound, results, now).select(*quality.SERIES, "missed")
        measured = periods.measure_due(tables, bound, results, KNOWN_METRICS, now, number)
        told.append(measured.join(missed, list(quality.SERIES)))
        results = results.unionByName(measured)
    rounds = told[0]
    for more in told[1:]:
        rounds = rounds.unionByName(more)
    return rounds.select(F.col("batch_id").alias("round"), *quality.SERIES, "value", "missed")


def monitor_changes(spark: SparkSession, folder: str) -> DataFrame:
    """A table that gets rows, loses some, has some written anew, and is left alone; measured after each change."""
    people = stand_ins.customer_identifiers(spark, folder)
    table, results, state = (shared_folder(spark, n) for n in ("changing", "results", "state"))
    metrics = [(quality.ROW_COUNT, "c_custkey"), (quality.INVALID_PESEL_COUNT, "pesel")]
    # which third of the customers a part holds after each step
    steps = ({"a": 0, "b": 1}, {"c": 2}, {"b": 0}, {}, {"a": None})
    for step in steps:
        for part, third in step.items():
            rows = people.where("false" if third is None else f"c_custkey % 3 = {third}")
            rows.write.mode("overwrite").parquet(f"{table}/part={part}")
        measure_changes(spark, table, people.schema, metrics, "customer", results, state)
    return quality.read_results(spark, results).select(F.col("batch_id").alias("step"), "metric_name", "value")


# --- matching ------------------------------------------------------------------


def pair_estimate(spark: SparkSession, folder: str) -> DataFrame:
    report = estimates.pair_report(stand_ins.part_records(spark, folder), ["fname"])
    return report.withColumns({c: F.col(c).cast("long") for c in ("ordered_pairs", "candidate_pairs")})


def block_sizes(spark: SparkSession, folder: str) -> DataFrame:
    return estimates.largest_blocks_first(stand_ins.part_records(spark, folder), ["fname"])


def block_pair_count(spark: SparkSession, folder: str) -> DataFrame:
    counted = estimates.pair_count(stand_ins.part_records(spark, folder), "fname", "SMALL RING")
    return counted.withColumns({c: F.col(c).cast("long") for c in ("all_pairs", "ordered_once")})


def _rounded(scores: DataFrame) -> DataFrame:
    """Scores to six places and counts as plain integers."""
    doubles = [f.name for f in scores.schema if isinstance(f.dataType, DoubleType)]
    result = scores.withColumns({c: F.round(c, 6) for c in doubles})
    return result.withColumn("pairs", F.col("pairs").cast("long")) if "pairs" in result.columns else result


def candidate_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(stand_ins.part_job().candidates(stand_ins.part_records(spark, folder)))


def pair_scores(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(stand_ins.part_job().scores(stand_ins.part_records(spark, folder)))


def duplicate_links(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(stand_ins.part_job().links(stand_ins.part_records(spark, folder)))


def large_block_candidates(spark: SparkSession, folder: str) -> DataFrame:
    """Candidates of a few large blocks in which every record differs, counted per record."""
    pairs = stand_ins.customer_job().candidates(stand_ins.customer_records(spark, folder))
    counted = pairs.groupBy("segment", F.col("profile1").alias("cust_id"))
    # a pair's count is made a long before the sum: Spark adds wide decimals many times more slowly
    return counted.agg(F.sum(F.col("pairs").cast("long")).alias("pairs"), F.max("profile2").alias("last_partner"))


def large_block_links(spark: SparkSession, folder: str) -> DataFrame:
    """Customers of a segment whose names are nearly the same."""
    links = stand_ins.customer_job().links(stand_ins.customer_records(spark, folder))
    return _rounded(links).select("segment", "profile1", "profile2", "pairs", "name_fuzzy")


def several_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Parts that agree in their name, their brand or the start of their type, and are similar; each pair by its first rule."""
    parts = stand_ins.part_records(spark, folder).withColumn("kind", F.substring_index("address", " ", 1))
    compare = [Compare("address", "fuzzy", "address_fuzzy"), Compare("lname", "fuzzy", "lname_fuzzy")]
    minimums = {"address_fuzzy": 0.5, "lname_fuzzy": 0.5}
    links = rules.rule_links(parts, "cust_id", [["fname"], ["lname"], ["kind"]], compare, minimums)
    total = F.sum(F.col("pairs") * F.col("address_fuzzy")).alias("address")
    brands = F.least("lname1", "lname2").alias("one"), F.greatest("lname1", "lname2").alias("other")
    told = links.groupBy("rule", *brands).agg(F.sum("pairs").cast("long").alias("pairs"), total)
    return told.withColumn("address", F.round(F.col("address").cast("double"), 3))


def similar_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of one language and source that share most of their words, as a folded list of pairs."""
    links = stand_ins.document_job("word_jaccard_similarity", 0.8).links(stand_ins.document_records(spark, folder))
    return _rounded(links).select("lang", "source", "profile1", "profile2", "pairs", "score")


def similar_word_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The same by the cosine of their word counts."""
    links = stand_ins.document_job("cosine_similarity", 0.9).links(stand_ins.document_records(spark, folder))
    return _rounded(links).select("lang", "source", "profile1", "profile2", "pairs", "score")


def similar_part_names(spark: SparkSession, folder: str) -> DataFrame:
    """Names of one brand's parts that consist of nearly the same characters."""
    part = read(spark, folder, "part").select("p_partkey", "p_brand", "p_name")
    links = stand_ins.part_name_job("jaccard_similarity", 0.8).links(part)
    return _rounded(links).select("p_brand", "profile1", "profile2", "pairs", "score")


def record_profiles(spark: SparkSession, folder: str) -> DataFrame:
    """Which profile each record belongs to."""
    return stand_ins.part_job().record_profiles(stand_ins.part_records(spark, folder))


def duplicate_records(spark: SparkSession, folder: str) -> DataFrame:
    """Every record pair behind the probable duplicates of parts."""
    job, records = stand_ins.part_job(), stand_ins.part_records(spark, folder)
    # rounded once a link, which may stand for very many record pairs
    return pairing.spell_out(_rounded(job.links(records)), records, job.id_column, job.block, job.values)


def candidate_preview(spark: SparkSession, folder: str) -> DataFrame:
    """The first ten record pairs with the values that will be compared."""
    records = stand_ins.part_records(spark, folder)
    pairs = listing.first_pairs(records, Matching("cust_id", ["fname"]), 10)
    return listing.with_records(pairs, records, "cust_id", ["fname", "lname", "address"])


def score_preview(spark: SparkSession, folder: str) -> DataFrame:
    """The first hundred rows of the score table, one per record pair."""
    records = stand_ins.part_records(spark, folder)
    pairs = listing.first_pairs(records, Matching("cust_id", ["fname"]), 100)
    valued = listing.with_records(pairs, records, "cust_id", ["fname", "lname", "address"])
    comparisons = [
        Comparison(f"{c.column}1", f"{c.column}2", c.metric, c.alias) for c in stand_ins.part_job().compare
    ]
    scored = score_pairs(valued, comparisons).withColumn("pair_key", listing.pair_key("cust_id1", "cust_id2"))
    aliases = [c.alias for c in comparisons]
    return _rounded(scored.select("pair_key", "cust_id1", "cust_id2", *aliases))


def duplicate_listing(spark: SparkSession, folder: str) -> DataFrame:
    return listing.duplicate_listing(stand_ins.part_records(spark, folder), stand_ins.part_job(), 100)


# --- string metrics as scoring jobs --------------------------------------------


def _scored(*metrics: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        pairs = stand_ins.neighbour_pairs(spark, folder)
        comparisons = [Comparison("left_text", "right_text", m, m) for m in metrics]
        return _rounded(score_pairs(pairs, comparisons).select("p_partkey", *metrics))

    return query


def soundex_folded(spark: SparkSession, folder: str) -> DataFrame:
    """Names spelled with Polish letters: their codes with and without folding, and the score of both."""
    polish = F.translate(F.upper("p_name"), "ACELNOSZ", "ĄĆĘŁŃÓŚŻ")
    part = read(spark, folder, "part").select("p_partkey", polish.alias("polish"))
    folded, plain = soundex(F.col("polish"), fold=True), soundex(F.upper(F.translate("polish", POLISH_UPPER, POLISH_FOLDED)))
    return part.select(
        "p_partkey", folded.alias("folded"), (soundex(F.col("polish")) == folded).alias("same"), F.round(edit_score(folded, plain), 6).alias("score")
    )


def score_foreign_words(spark: SparkSession, folder: str) -> DataFrame:
    """Words with letters beyond ASCII against their standard form, whole against whole."""
    words = stand_ins.foreign_words(spark, folder)
    comparisons = [Comparison("word", "standard", m, m) for m in ("lcs_length", "lcs_distance", "ratio", "partial_ratio")]
    return score_pairs(words, comparisons)


def score_minimum(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs whose token-sort ratio reaches 80, pruned by length beforehand."""
    pairs = stand_ins.neighbour_pairs(spark, folder)
    comparison = Comparison("left_text", "right_text", "token_sort_ratio", "token_sort_ratio")
    kept = score_pairs(pairs, [comparison], {"token_sort_ratio": 80})
    return kept.select("p_partkey", "token_sort_ratio")


def score_minimums(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs that reach a minimum in three metrics of which each is bounded by lengths or common letters first."""
    pairs = stand_ins.neighbour_pairs(spark, folder)
    minimums = {"ratio": 60, "jaro_winkler_similarity": 0.7, "lcs_length": 12}
    comparisons = [Comparison("left_text", "right_text", m, m) for m in minimums]
    return _rounded(score_pairs(pairs, comparisons, minimums).select("p_partkey", *minimums))


QUERIES: dict[str, Query] = {
    "row_counts": row_counts,
    "union_sources": union_sources,
    "union_fillers": union_fillers,
    "csv_load": csv_load,
    "csv_rejects": csv_rejects,
    "csv_line_breaks": csv_line_breaks,
    "csv_semicolon": csv_semicolon,
    "customer_files": customer_files,
    "customer_file_links": customer_file_links,
    "customer_file_listing": customer_file_listing,
    "sql_alias_reuse": sql_alias_reuse,
    "sql_pipes": sql_pipes,
    "sql_variables": sql_variables,
    "capped_samples": capped_samples,
    "soundex_folded": soundex_folded,
    "score_foreign_words": score_foreign_words,
    "list_files": list_files,
    "standardize_table": standardize_table,
    "stable_ids": stable_ids,
    "stable_ids_ordered": stable_ids_ordered,
    "regex_street": regex_street,
    "regex_house": regex_house,
    "build_samples": build_samples,
    "short_values": short_values,
    "prefix_values": prefix_values,
    "dictionary_values": dictionary_values,
    "changed_rows": changed_rows,
    "dictionary_tokens": dictionary_tokens,
    "dictionary_tokens_joined": dictionary_tokens_joined,
    "dictionary_tokens_embedded": dictionary_tokens_embedded,
    "text_standards": text_standards,
    "large_changes": large_changes,
    "dictionary_checks": dictionary_checks,
    "city_lookup": city_lookup,
    "correct_addresses": correct_addresses,
    "parse_replies": parse_replies,
    "pesel_audit": pesel_audit,
    "pesel_metric": pesel_metric,
    "metric_evaluate": metric_evaluate,
    "metric_history": metric_history,
    "metric_latest": metric_latest,
    "metric_bindings": metric_bindings,
    "metric_tables": metric_tables,
    "metric_listing": metric_listing,
    "monitor_stream": monitor_stream,
    "monitor_windowed": monitor_windowed,
    "monitor_changes": monitor_changes,
    "metric_periods": metric_periods,
    "pair_estimate": pair_estimate,
    "block_sizes": block_sizes,
    "block_pair_count": block_pair_count,
    "candidate_pairs": candidate_pairs,
    "candidate_preview": candidate_preview,
    "large_block_candidates": large_block_candidates,
    "large_block_links": large_block_links,
    "several_rules": several_rules,
    "similar_documents": similar_documents,
    "similar_word_counts": similar_word_counts,
    "similar_part_names": similar_part_names,
    "record_profiles": record_profiles,
    "duplicate_records": duplicate_records,
    "pair_scores": pair_scores,
    "score_preview": score_preview,
    "duplicate_links": duplicate_links,
    "duplicate_listing": duplicate_listing,
    "score_levenshtein": _scored("levenshtein", "fuzzy"),
    "score_soundex": _scored("soundex"),
    "score_hamming": _scored("hamming"),
    "score_jaccard": _scored("jaccard_similarity", "jaccard_distance"),
    "score_cosine": _scored("cosine_similarity", "cosine_distance"),
    "score_jaro_winkler": _scored("jaro_winkler_similarity", "jaro_winkler_distance"),
    "score_lcs": _scored("lcs_length", "lcs_distance"),
    "score_fuzzy": _scored("fuzzy_subsequence_score"),
    "score_ratio": _scored("ratio"),
    "score_partial": _scored("partial_ratio"),
    "score_token_sort": _scored("token_sort_ratio"),
    "score_minimum": score_minimum,
    "score_minimums": score_minimums,
}
