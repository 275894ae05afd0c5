"""From raw filing entries to the long silver facts table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knownby.functions import cleaning as C
from knownby.schemas import FACTS
from knownby.sources.taxonomy import taxonomy


def map_to_taxonomy(entries: DataFrame) -> DataFrame:
    """Keep entries whose filing tag is known and whose unit is the one that tag requires."""
    tags = F.broadcast(taxonomy(entries.sparkSession))  # fixed size, see taxonomy()
    return (
        entries.join(tags, "sec_tag")
        .where(F.col("unit") == F.col("want_unit"))
        .drop("sec_tag", "unit", "want_unit")
    )


def classify_periods(facts: DataFrame) -> DataFrame:
    """Reject incomplete entries, flag quarters and fiscal years, drop flows of any other length."""
    days = C.period_days(F.col("start_date"), F.col("end_date"))
    complete = (F.col("end_date").isNotNull() & F.col("filed_date").isNotNull()
                & F.col("val").isNotNull())
    return (
        facts.where(complete)
        .withColumn("is_quarter", C.is_quarter(F.col("is_instant"), days))
        .withColumn("is_fy", C.is_fiscal_year(F.col("is_instant"), days))
        .where(F.col("is_instant") | F.col("is_quarter") | F.col("is_fy"))
        .withColumn("fp", F.coalesce(F.nullif(F.col("fp"), F.lit("")), F.lit("Unknown")))
    )


def dedupe_facts(facts: DataFrame) -> DataFrame:
    """One value per (cik, tag, period, filing date, fiscal period, flags): best alias, then first.

    The scope is the whole table, so companies listed under several symbols count once. ``pos`` orders
    entries of one alias and stays below 2^56, so one long ranks an entry and the aggregate keeps
    fixed-width buffers (hash aggregation on both sides of the shuffle).
    """
    keys = ["cik", "tag", "end_date", "filed_date", "fp", "is_fy", "is_quarter"]
    rank = F.shiftleft(F.col("priority").cast("bigint"), 56) + F.col("pos")
    first = F.min_by("val", rank)
    return (
        facts.groupBy(*keys).agg(first.alias("val"))
        .withColumn("raw_val", F.col("val"))
        .select(*FACTS.names)
    )


def clean_facts(entries: DataFrame) -> DataFrame:
    """entries(cik, sec_tag, unit, start_date, end_date, filed_date, fp, val, pos) -> silver facts."""
    return dedupe_facts(classify_periods(map_to_taxonomy(entries)))
