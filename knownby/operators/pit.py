"""Point-in-time fundamentals: what was publicly known on each filing date.

Everything is keyed by company and filing date. ``e_date`` is the period end a value describes,
``f_date`` the day it became known.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from knownby.operators.timeseries import axis, so_far
from knownby.options import DEFAULT, EngineOptions
from knownby.sources.taxonomy import FY_TAGS, MATRIX_TAGS, TTM_TAGS


def _dated(facts: DataFrame) -> DataFrame:
    return (
        facts.withColumnRenamed("end_date", "e_date").withColumnRenamed("filed_date", "f_date")
        .where(F.col("f_date").isNotNull())
    )


def pivot_reports(facts: DataFrame) -> DataFrame:
    """One row per report (cik, e_date, f_date), four columns per tag.

    ``<tag>_any`` is the value that counts, ``<tag>_fy`` and ``<tag>_quarter`` the annual and the
    quarterly ones, ``<tag>_top`` the largest. When several rows share (report, tag) (a quarter and a
    year ending together, several fiscal-period labels) the last in the order (is_fy, is_quarter, fp)
    counts. Silver facts repeat that key only by those labels, so a report is a few dozen rows at
    most: hashing by report loses no map-side combine, and both levels of the pivot and every branch
    of the point-in-time plan run off this one exchange. Tags outside the daily table still make a
    report exist. The tag list is fixed, so the schema never depends on the data.
    """
    order = F.struct("is_fy", "is_quarter", "fp")
    return (
        _dated(facts).repartition("cik", "e_date", "f_date")
        .groupBy("cik", "e_date", "f_date").pivot("tag", MATRIX_TAGS)
        .agg(F.max_by("val", order).alias("any"),
             F.max_by("val", F.when(F.col("is_fy"), order)).alias("fy"),
             F.max_by("val", F.when(F.col("is_quarter"), order)).alias("quarter"),
             F.max("val").alias("top"))
    )


def filing_snapshot(facts: DataFrame) -> DataFrame:
    """Per (cik, f_date) the row of its newest period, taken whole: its nulls are not patched.

    ``shares_sec`` is the largest share count over all periods of that filing date.
    """
    filing = W.partitionBy("cik", "f_date")
    return (
        pivot_reports(facts)
        .withColumns({"_rank": F.row_number().over(filing.orderBy(F.desc("e_date"))),
                      "shares_sec": F.max("shares_outstanding_top").over(filing)})
        .where(F.col("_rank") == 1)
        .select("cik", "e_date", "f_date",
                *[F.col(f"{t}_any").alias(t) for t in MATRIX_TAGS],
                *[f"{t}_fy" for t in dict.fromkeys([*FY_TAGS, *TTM_TAGS])],
                "shares_sec")
    )


def share_counts(facts: DataFrame) -> DataFrame:
    """Largest share count reported on each filing date."""
    return (
        _dated(facts).where(F.col("tag") == "shares_outstanding")
        .groupBy("cik", "f_date").agg(F.max("val").alias("shares_sec"))
    )


def quarter_versions(facts: DataFrame) -> DataFrame:
    """Quarterly rows per (cik, e_date, f_date) with the TTM tags.

    Every filing date of a period that has any quarterly fact is a version, even when it carries none
    of the TTM tags: a later version replaces the earlier one whole.
    """
    return (
        pivot_reports(facts.where("is_quarter"))
        .select("cik", "e_date", "f_date", *[F.col(f"{t}_quarter").alias(t) for t in TTM_TAGS])
    )


def pit_ttm(facts: DataFrame, options: EngineOptions = DEFAULT) -> DataFrame:
    """Trailing-twelve-month sums per (cik, f_date), restatements applied from their filing date on.

    On a filing date the newest ``ttm_periods`` periods known by then count, each in its latest
    version. The sum is valid when all of them exist and their ends span an accepted number of days.
    A tag the company has reported by then sums its nulls as zero; a tag never seen stays null.

    Only periods ending within ``ttm_max_days`` of the newest known one can belong to a valid sum, so
    versions meet filing dates through an equi-join on (cik, bucket of the newest period) plus the
    version's validity interval. Work grows with reports, not with its square, and a company with a
    long history is spread over its buckets.
    """
    versions = quarter_versions(facts)
    span = options.ttm_max_days
    width = span + 1

    def bucket(day: Column) -> Column:
        return F.floor(F.unix_date(day) / width).cast("int")

    seen = so_far(axis(["cik"], ["f_date"]))
    filings = (
        versions.groupBy("cik", "f_date")
        .agg(F.max("e_date").alias("newest"),
             *[F.max(F.col(t).isNotNull()).alias(f"{t}_seen") for t in TTM_TAGS])
        .withColumns({"newest": F.max("newest").over(seen),
                      **{f"{t}_seen": F.max(f"{t}_seen").over(seen) for t in TTM_TAGS}})
        .withColumn("bucket", bucket(F.col("newest")))
    )
    reach = F.sequence(bucket(F.col("e_date")), bucket(F.date_add("e_date", span)))
    known = versions.withColumn(
        "replaced_on", F.lead("f_date").over(axis(["cik", "e_date"], ["f_date"]))
    ).withColumnRenamed("f_date", "known_on").withColumn("bucket", F.explode(reach))
    state = (
        filings.join(known, ["cik", "bucket"])
        .where((F.col("known_on") <= F.col("f_date"))
               & (F.col("replaced_on").isNull() | (F.col("f_date") < F.col("replaced_on")))
               & F.col("e_date").between(F.date_sub("newest", span), F.col("newest")))
    )
    newest_first = W.partitionBy("cik", "f_date").orderBy(F.desc("e_date"))
    window = (
        state.withColumn("_rank", F.row_number().over(newest_first))
        .where(F.col("_rank") <= options.ttm_periods)
        .groupBy("cik", "f_date")
        .agg(F.count(F.lit(1)).alias("periods"),
             F.date_diff(F.max("e_date"), F.min("e_date")).alias("span_days"),
             *[F.coalesce(F.sum(t), F.lit(0.0)).alias(f"{t}_sum") for t in TTM_TAGS],
             *[F.first(f"{t}_seen").alias(f"{t}_seen") for t in TTM_TAGS])
    )
    valid = ((F.col("periods") == options.ttm_periods)
             & F.col("span_days").between(options.ttm_min_days, options.ttm_max_days))
    return window.select("cik", "f_date", *[
        F.when(valid & F.col(f"{t}_seen"), F.col(f"{t}_sum")).alias(f"{t}_ttm") for t in TTM_TAGS
    ])


def ttm_with_annual(snapshot: DataFrame, ttm: DataFrame) -> DataFrame:
    """Snapshot with TTM columns; a fiscal-year value on the filing's row replaces the sum."""
    joined = snapshot.join(ttm, ["cik", "f_date"], "left")
    return joined.withColumns({
        f"{t}_ttm": F.coalesce(F.col(f"{t}_fy"), F.col(f"{t}_ttm")) for t in TTM_TAGS
    })


def filing_state(facts: DataFrame, options: EngineOptions = DEFAULT) -> DataFrame:
    """All a filing date brings: newest-period values, annual and TTM forms, and the share count."""
    return ttm_with_annual(filing_snapshot(facts), pit_ttm(facts, options))


def period_gaps(facts: DataFrame, lags: tuple[int, ...] = (3, 4)) -> DataFrame:
    """Distinct quarter ends per company with the days since the k-th earlier one."""
    ends = _dated(facts).where("is_quarter").select("cik", "e_date").distinct()
    window = axis(["cik"], ["e_date"])
    return ends.select("cik", "e_date", *[
        F.date_diff(F.col("e_date"), F.lag("e_date", k).over(window)).alias(f"days_{k}")
        for k in lags
    ])
