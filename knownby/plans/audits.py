"""Data-quality audits over the silver tables and the daily table, all securities at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knownby.functions.cleaning import non_zero
from knownby.operators.timeseries import axis


def survivorship(matrix: DataFrame) -> DataFrame:
    """Securities whose rows end before the table does, with the last day seen."""
    ends = matrix.groupBy("permaTicker").agg(F.max(F.struct("p_date", "ticker")).alias("end"))
    last = ends.agg(F.max("end.p_date")).scalar()  # over the same grouped rows, so one scan serves both
    return ends.where(F.col("end.p_date") < last).select(
        "permaTicker", F.col("end.ticker").alias("ticker"), F.col("end.p_date").alias("last_seen"))


def lost_securities(prices: DataFrame, matrix: DataFrame) -> DataFrame:
    """Securities that have bars but no row in the daily table, with the last day they traded."""
    ends = prices.groupBy("permaTicker").agg(F.max("p_date").alias("last_seen"))
    return ends.join(matrix.select("permaTicker").distinct(), "permaTicker", "left_anti")


def trailing_gaps(prices: DataFrame) -> DataFrame:
    """Market sessions since each security's last bar, for those that missed any."""
    ends = prices.groupBy("permaTicker").agg(F.max("p_date").alias("last_seen"))
    numbered = _sessions(prices)
    last = numbered.agg(F.max("session")).scalar()
    return ends.join(F.broadcast(numbered.withColumnRenamed("p_date", "last_seen")), "last_seen").select(
        "permaTicker", "last_seen", (last - F.col("session")).cast("bigint").alias("missing")).where("missing > 0")


def _sessions(prices: DataFrame) -> DataFrame:
    """The market calendar, numbered: all days any security traded.

    One group holds it and joins broadcast it: its size is bounded by the days of recorded history (tens
    of thousands of rows for a century), however large the price table grows.
    """
    days = prices.where(F.col("p_date").isNotNull()).select("p_date").distinct()
    return days.withColumn("session", F.row_number().over(axis([], ["p_date"])))


def cap_bounds(matrix: DataFrame, ceilings: DataFrame) -> DataFrame:
    """Yearly mean market cap against ceilings(permaTicker, ceiling): look-ahead inflates old caps.

    Without a cap there is nothing to pass: ``passed`` is null.
    """
    yearly = matrix.groupBy("permaTicker", F.year("p_date").alias("year")).agg(
        F.avg("mkt_cap").alias("mean_cap"))
    return yearly.join(ceilings, "permaTicker").select(
        "permaTicker", "year", "mean_cap", "ceiling",
        (F.col("mean_cap") <= F.col("ceiling")).alias("passed"))


def split_continuity(matrix: DataFrame, actions: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """Cap on every split session against the session before it."""
    before = axis(["permaTicker"], ["p_date"])
    caps = matrix.select("permaTicker", "p_date", "mkt_cap",
                         F.lag("mkt_cap").over(before).alias("cap_before"))
    splits = actions.where(F.col("splitFactor") != 1).select("permaTicker", "p_date", "splitFactor")
    deviation = F.abs(F.col("mkt_cap") / non_zero(F.col("cap_before")) - 1)
    return caps.join(splits, ["permaTicker", "p_date"]).withColumns({
        "deviation": deviation, "passed": deviation < tolerance})


def session_gaps(prices: DataFrame) -> DataFrame:
    """Runs of market sessions missing inside a security's life."""
    numbered = _sessions(prices)
    life = axis(["permaTicker"], ["p_date"])
    return (
        prices.select("permaTicker", "p_date").join(F.broadcast(numbered), "p_date")
        .withColumns({"after_day": F.lag("p_date").over(life),
                      "missing": F.col("session") - F.lag("session").over(life) - 1})
        .where(F.col("missing") > 0)
        .select("permaTicker", "after_day", F.col("p_date").alias("before_day"),
                F.col("missing").cast("bigint").alias("missing"))
    )


def filed_order(entries: DataFrame) -> DataFrame:
    """Per filing tag: entries without a filing date, and those filed on or before the period end."""
    delay = F.date_diff("filed_date", "end_date")
    return entries.groupBy("sec_tag").agg(
        F.count(F.lit(1)).alias("entries"),
        F.count_if(F.col("filed_date").isNull()).alias("no_filed_date"),
        F.count_if(delay <= 0).alias("not_after_end"),
        F.min(delay).cast("bigint").alias("min_delay"),
        F.max(delay).cast("bigint").alias("max_delay"))


def coverage(matrix: DataFrame, facts: DataFrame) -> DataFrame:
    """Companies on either side: how many the table lacks, and how many have no facts."""
    sides = (
        facts.select("cik", F.lit(1).alias("f"), F.lit(0).alias("m"))
        .unionByName(matrix.select("cik", F.lit(0).alias("f"), F.lit(1).alias("m")))
        .groupBy("cik").agg(F.max("f").alias("f"), F.max("m").alias("m"))
    )
    return sides.agg(
        F.count_if(F.col("f") == 1).alias("in_facts"),
        F.count_if(F.col("m") == 1).alias("in_matrix"),
        F.count_if((F.col("f") == 1) & (F.col("m") == 0)).alias("only_facts"),
        F.count_if((F.col("f") == 0) & (F.col("m") == 1)).alias("only_matrix"))


def ghosts(prices: DataFrame, idle_days: int = 30) -> DataFrame:
    """Last bar of every security and whether it has been silent for longer than ``idle_days``."""
    last = prices.groupBy("permaTicker").agg(F.max("p_date").alias("last_seen"))
    idle = F.date_diff(last.agg(F.max("last_seen")).scalar(), F.col("last_seen"))
    return last.select("permaTicker", "last_seen", idle.cast("bigint").alias("idle_days"),
                       (idle > idle_days).alias("inactive"))


def two_sources(first: DataFrame, second: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Agreement of the adjustment ratio of two price sources on the days both have."""
    def ratio(side: str):
        return F.col(f"{side}.adjClose") / non_zero(F.col(f"{side}.close"))

    drift = F.abs(ratio("a") / non_zero(ratio("b")) - 1)
    shared = first.alias("a").join(
        second.alias("b"),
        (F.col("a.permaTicker") == F.col("b.permaTicker")) & (F.col("a.p_date") == F.col("b.p_date")))
    return (
        shared.select(F.col("a.permaTicker").alias("permaTicker"), drift.alias("drift"))
        .groupBy("permaTicker")
        .agg(F.count(F.lit(1)).alias("shared_days"),
             F.count_if(F.col("drift") > tolerance).alias("drifting_days"),
             F.max("drift").alias("max_drift"))
    )


def symbol_changes(prices: DataFrame) -> DataFrame:
    """Days a permanent id changed its symbol, with the days since its previous bar."""
    life = axis(["permaTicker"], ["p_date"])
    return (
        prices.select("permaTicker", "p_date", "ticker",
                      F.lag("ticker").over(life).alias("old_ticker"),
                      F.lag("p_date").over(life).alias("_before"))
        .where(F.col("old_ticker") != F.col("ticker"))
        .select("permaTicker", "p_date", "old_ticker", F.col("ticker").alias("new_ticker"),
                F.date_diff("p_date", "_before").cast("bigint").alias("gap_days"))
    )
