"""Registry bookkeeping: status updates, worklists, completeness and missing-data lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knownby.functions import cleaning as C
from knownby.sources.taxonomy import SUCCESS_STATUS, TERMINAL_STATUSES


#: Statuses that end the work on a column; missing filings say nothing about prices.
TERMINAL = {
    "status_prices": [s for s in TERMINAL_STATUSES if s != "failed_no_xbrl"],
    "status_fundamentals": list(TERMINAL_STATUSES),
}


def status_upsert(registry: DataFrame, updates: DataFrame, *, key: str, column: str,
                  order: Sequence[str]) -> DataFrame:
    """Overwrite ``column`` with the last non-null ``status`` per key; others keep what they had.

    Updates fold to one row per key map-side, so a key updated very often costs no more to shuffle.
    """
    latest = (
        updates.where(F.col("status").isNotNull())
        .groupBy(key).agg(F.max_by("status", F.struct(*order)).alias("_new"))
    )
    return (
        registry.join(latest, key, "left")
        .withColumn(column, F.coalesce("_new", column))
        .select(*registry.columns)
    )


def worklist(registry: DataFrame, kind: str) -> DataFrame:
    """Registry rows still to be fetched: ``metadata``, ``prices`` or ``fundamentals``."""
    has_company = F.col("cik").isNotNull()
    if kind == "metadata":
        return registry.where(has_company & C.lacks_sector(F.col("sector")))
    if kind == "prices":
        status = F.coalesce("status_prices", F.lit(""))
        return registry.where(~status.isin(*TERMINAL["status_prices"]))
    if kind == "fundamentals":
        done = F.coalesce(F.col("status_fundamentals") == SUCCESS_STATUS, F.lit(False))
        return registry.where(has_company & ~done)
    raise ValueError(f"unknown worklist {kind!r}")


def completeness(registry: DataFrame) -> DataFrame:
    """One row: how many securities still lack prices, and how many with a company lack filings."""
    def open_status(column: str):
        return ~F.coalesce(F.col(column), F.lit("")).isin(*TERMINAL[column])

    return registry.agg(
        F.count_if(open_status("status_prices")).alias("missing_prices"),
        F.count_if(F.col("cik").isNotNull() & open_status("status_fundamentals"))
        .alias("missing_fundamentals"),
    )


def hit_list(registry: DataFrame, prices: DataFrame, facts: DataFrame) -> DataFrame:
    """Securities without any bar and companies without any fact: (type, ticker, id).

    The big sides fold to their distinct ids map-side before they are shuffled for the joins.
    """
    priced = prices.select("permaTicker").distinct()
    reporting = facts.select("cik").distinct()
    no_prices = registry.join(priced, "permaTicker", "left_anti").select(
        F.lit("price").alias("type"), "ticker",
        C.security_id(F.col("permaTicker"), F.col("ticker")).alias("id"))
    keyed = registry.where(F.col("cik").isNotNull()).select(
        "ticker", C.normalize_cik(F.col("cik")).alias("cik"))
    no_facts = keyed.join(reporting, "cik", "left_anti").select(
        F.lit("fundamentals").alias("type"), "ticker", F.col("cik").alias("id"))
    return no_prices.unionByName(no_facts)
