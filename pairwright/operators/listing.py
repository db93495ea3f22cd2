"""The first record pairs in key order, and the records behind them.

A listing of the first k pairs does not need the other pairs.  The pair key is
the text ``id1-id2`` of whole-number ids; the dash sorts before every digit, so
keys sort by the text of id1 and then of id2.  That lets the listing start from the records
that come first as id1 and look up only their partners.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from pairwright.operators import pairing
from pairwright.operators.estimates import all_known
from pairwright.operators.matching import Matching
from pairwright.session import ensure_checkpoint_dir


def pair_key(first: str, second: str) -> Column:
    return F.concat(F.col(first).cast("string"), F.lit("-"), F.col(second).cast("string"))


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def _against_leads(
    leads: DataFrame, others: DataFrame, job: Matching, reach: str, extra: Sequence[str]
) -> DataFrame:
    """Qualifying (lead, other) rows where the other reaches an id above the lead's.

    The leads are few; Spark sends them to where the others are if their size says so.
    The lead has the lesser id, so it stands on the first side.
    """
    first = job.prepare(leads).select(
        "lead", *job.block, *(F.col(c).alias(f"{c}1") for c in job.carried)
    )
    second = job.possible(job.prepare(others)).select(
        *job.block, *job.constants, *(F.col(c).alias(f"{c}2") for c in job.carried), reach, *extra
    )
    met = second.join(first, list(job.block))
    return job.qualify(met.where(F.col(reach) > F.col("lead")))


def _first_of(leads: DataFrame, known: DataFrame, job: Matching, count: int) -> DataFrame:
    """The first pairs that have one of the leads as id1; no record is shuffled."""
    met = _against_leads(leads, known, job, job.id_column, [])
    first, second = f"{job.id_column}1", f"{job.id_column}2"
    ids = met.select(F.col("lead").alias(first), F.col(job.id_column).alias(second))
    return ids.orderBy(_text(first), _text(second)).limit(count).checkpoint()


def _sure_counts(leads: DataFrame, known: DataFrame, job: Matching) -> DataFrame:
    """Per lead, a number of pairs it is certain to have (at least one).

    Only records of the leads' blocks are folded into profiles.
    """
    blocks = leads.select(*job.block).distinct()
    nearby = known.join(blocks, list(job.block), "left_semi")
    groups = pairing.profiles(nearby, job.id_column, job.block, job.values)
    extra = ["profile", "profile_members"]
    partners = _against_leads(leads, groups, job, "profile_last", extra)
    all_above = F.when(F.col("profile") > F.col("lead"), F.col("profile_members")).otherwise(F.lit(1))
    return partners.groupBy("lead").agg(F.sum(all_above).alias("sure"))


def first_pairs(
    records: DataFrame, job: Matching, count: int, probes: tuple[int, int] | None = None
) -> DataFrame:
    """The first ``count`` qualifying record pairs (id1 < id2) in pair-key order.

    A few first records are tried as id1, record by record.  If they do not
    yield enough pairs, many more are tried against profiles.  If that is not
    enough, one pass over all profile pairs finds out which records have a
    partner at all.  Every way is exact; only the effort differs.
    """
    if not isinstance(records.schema[job.id_column].dataType, IntegralType):
        raise TypeError(f"{job.id_column} must hold whole numbers: the order of the pair key rests on it")
    ensure_checkpoint_dir(records.sparkSession)
    few, many = probes or (max(5, count // 10), max(1000, 10 * count))
    known = records.where(all_known(job.block))
    names = [*job.block, *job.values]
    ordered = known.select(F.col(job.id_column).alias("lead"), *names).orderBy(_text("lead"))

    found = _first_of(ordered.limit(few), known, job, count)
    if found.count() == count:
        return found

    leads = ordered.limit(many).checkpoint()
    sure = _sure_counts(leads, known, job).checkpoint()
    if (sure.agg(F.sum("sure").alias("n")).first()["n"] or 0) < count:
        leads = _leads_with_partners(known, job, count).checkpoint()
        sure = _sure_counts(leads, known, job)

    # Leads before which fewer than ``count`` pairs are sure: at most ``count``
    # of them.  The window runs over one row per lead.
    before = Window.orderBy(_text("lead")).rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.coalesce(F.sum("sure").over(before), F.lit(0))
    needed = sure.withColumn("_earlier", earlier).where(F.col("_earlier") < count).select("lead")
    chosen = leads.join(needed, "lead", "left_semi")
    return _first_of(chosen, known, job, count)


def _leads_with_partners(known: DataFrame, job: Matching, count: int) -> DataFrame:
    """The first records, in text order, that have any partner above them.

    A record has one when some qualifying partner profile reaches a greater
    id, so per profile only the greatest partner id matters.
    """
    ends = F.explode(
        F.array(
            F.struct(F.col("profile1").alias("profile"), F.col("profile_last2").alias("reach")),
            F.struct(F.col("profile2").alias("profile"), F.col("profile_last1").alias("reach")),
        )
    )
    groups = job.qualifying_profiles(known)
    links = job.qualify(job.meet_likely(groups)).select(ends.alias("end"))
    reach = links.groupBy("end.profile").agg(F.max("end.reach").alias("reach"))
    names = [*job.block, *job.values]
    reaching = groups.join(reach, "profile").select(*(F.col(c).alias(f"_{c}") for c in names), "reach")
    on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in names]
    leads = known.join(reaching, on).where(F.col(job.id_column) < F.col("reach"))
    return leads.select(F.col(job.id_column).alias("lead"), *names).orderBy(_text("lead")).limit(count)


def with_records(
    pairs: DataFrame, records: DataFrame, id_column: str, carry: Sequence[str]
) -> DataFrame:
    """Attach columns of both records to a short list of pairs."""
    result = pairs
    for side in ("1", "2"):
        values = records.select(
            F.col(id_column).alias(f"{id_column}{side}"), *(F.col(c).alias(f"{c}{side}") for c in carry)
        )
        result = values.join(result, f"{id_column}{side}")
    return result


def expand_pairs(pairs: DataFrame, records: DataFrame, id_column: str) -> DataFrame:
    """Both records of every pair, under the pair's key.

    One join on both ids at once; ids are unique and id1 < id2, so no row can
    come out twice.
    """
    first, second = f"{id_column}1", f"{id_column}2"
    members = pairs.select(
        pair_key(first, second).alias("pair_key"), F.explode(F.array(first, second)).alias(id_column)
    )
    return members.join(records, id_column).select("pair_key", *records.columns)


def duplicate_listing(records: DataFrame, job: Matching, rows: int = 100) -> DataFrame:
    """Both records of each probable duplicate, by pair key and id, first rows."""
    count = (rows + 1) // 2
    pairs = first_pairs(records, job, count)
    listed = expand_pairs(pairs, records, job.id_column)
    return listed.orderBy("pair_key", job.id_column).limit(rows)
