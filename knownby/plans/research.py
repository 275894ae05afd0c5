"""Research reports over the stored daily table. Every report works for all securities at once."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from knownby.functions.cleaning import all_of, matches_pattern, non_zero
from knownby.operators.dedupe import last_row_per_key
from knownby.operators.timeseries import asof_join, axis

PERFORMANCE_TAGS = ["revenue", "net_income", "operating_income", "shares_outstanding"]


def _of(matrix: DataFrame, ticker: str | None) -> DataFrame:
    return matrix if ticker is None else matrix.where(F.col("ticker") == ticker)


def _last_year(matrix: DataFrame) -> DataFrame:
    """The newest year that holds rows, of a table stored by year; years come from its file names."""
    years = {int(m[1]) for f in matrix.inputFiles() if (m := re.search(r"/p_year=(\d+)/", f))}
    for year in sorted(years, reverse=True):
        rows = matrix.where(F.col("p_year") == year)
        if not rows.isEmpty():  # false for the first one, unless the table was filtered before
            return rows
    return matrix


def on_latest_date(matrix: DataFrame) -> DataFrame:
    """Rows of the last session in the table; a table stored by year is read in its last year only."""
    rows = _last_year(matrix) if "p_year" in matrix.columns else matrix
    return rows.where(F.col("p_date") == rows.agg(F.max("p_date")).scalar()).drop("p_year")


def status(matrix: DataFrame) -> DataFrame:
    """Coverage: rows, distinct tickers and sectors (null counts as a value), first and last day."""
    groups = matrix.groupBy("ticker", "sector").agg(
        F.count(F.lit(1)).alias("n"), F.min("p_date").alias("lo"), F.max("p_date").alias("hi"))

    def distinct_values(column: str) -> Column:
        return F.count_distinct(column) + F.coalesce(
            F.max(F.col(column).isNull().cast("bigint")), F.lit(0))

    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        distinct_values("ticker").alias("tickers"),
        F.min("lo").alias("start"),
        F.max("hi").alias("end"),
        distinct_values("sector").alias("sectors"),
    )


def profile_header(matrix: DataFrame, ticker: str | None = None) -> DataFrame:
    """Latest figures per security; absent numbers show as zero."""
    figures = ["close", "mkt_cap", "pe_ratio", "pb_ratio", "roe"]
    latest = last_row_per_key(
        _of(matrix, ticker).select("permaTicker", "ticker", "p_date", "sector", "industry", *figures),
        ["permaTicker"], ["p_date"])
    return latest.withColumns({c: F.coalesce(F.col(c), F.lit(0.0)) for c in figures})


def _newest(rows: DataFrame, order: WindowSpec, n: int | None) -> DataFrame:
    if n is None:
        return rows
    return rows.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= n).drop("_rank")


def performance_history(matrix: DataFrame, facts: DataFrame, annual: bool,
                        ticker: str | None = None, newest_rows: int | None = None) -> DataFrame:
    """Fiscal years, or other period ends, with the valuation on the day each one ended.

    ``newest_rows`` keeps each security's newest ones only. The latest filed value counts. ``growth_prev`` compares with the next older row shown and
    ``growth_4`` with the fourth older one; both are taken after the row limit. The non-annual side
    also holds point-in-time values.
    """
    own = _of(matrix, ticker)
    securities = own.groupBy("permaTicker", "cik").agg(F.max_by("ticker", "p_date").alias("ticker"))
    last_filed = F.max_by("val", F.struct("filed_date", "is_quarter", "fp"))
    periods = (
        facts.where((F.col("is_fy") == annual) & F.col("tag").isin(*PERFORMANCE_TAGS))
        .groupBy("cik", "end_date").pivot("tag", PERFORMANCE_TAGS).agg(last_filed)
        .join(securities, "cik")
    )
    newest = axis(["permaTicker"], [F.desc("end_date")])
    shown = _newest(periods, newest, newest_rows)
    valued = asof_join(shown, own, by=["permaTicker"], left_on="end_date", right_on="p_date",
                       values=["pe_ratio", "pb_ratio", "mkt_cap", "close"])
    revenue, income = F.col("revenue"), F.col("net_income")

    def growth(rows: int) -> Column:
        older = F.lead("revenue", rows).over(newest)
        return F.coalesce(non_zero(revenue) / non_zero(older) - 1, F.lit(0.0))

    return valued.withColumns({
        "margin": F.coalesce(non_zero(income) / non_zero(revenue), F.lit(0.0)),
        "growth_prev": growth(1),
        "growth_4": growth(4),
    }).select("permaTicker", "ticker", "end_date", *PERFORMANCE_TAGS, "margin", "growth_prev",
              "growth_4", "pe_ratio", "pb_ratio", "mkt_cap", "close")


def valuation_history(matrix: DataFrame, ticker: str | None = None,
                      newest_months: int | None = None) -> DataFrame:
    """Month by month: closing price and cap, mean multiples and growth.

    ``newest_months`` keeps each security's newest ones only.
    """
    months = (
        _of(matrix, ticker)
        .groupBy("permaTicker", F.trunc("p_date", "month").alias("month"))
        .agg(F.max_by("ticker", "p_date").alias("ticker"),
             F.max_by("close", "p_date").alias("close"),
             F.avg("pe_ratio").alias("pe_ratio"),
             F.avg("pb_ratio").alias("pb_ratio"),
             F.max_by("mkt_cap", "p_date").alias("mkt_cap"),
             F.avg("rev_growth_yoy").alias("rev_growth_yoy"))
    )
    return _newest(months, axis(["permaTicker"], [F.desc("month")]), newest_months)


def screen(matrix: DataFrame, *, date: dt.date | None = None, pe_max: float | None = None,
           roe_min: float | None = None, mom_min: float | None = None, sector: str | None = None,
           sql: str | None = None, limit: int | None = None) -> DataFrame:
    """Securities meeting strict thresholds on one session, the table's last one by default.

    ``sql`` is a predicate over the table's columns. Every match is returned unless ``limit`` asks
    for the first ones by ticker.
    """
    if date is None:
        rows = on_latest_date(matrix)
    else:
        rows = matrix.where(F.col("p_date") == F.lit(date))
        if "p_year" in matrix.columns:
            rows = rows.where(F.col("p_year") == date.year)
    conditions: list[Column] = []
    if pe_max is not None:
        conditions.append(F.col("pe_ratio") < pe_max)
    if roe_min is not None:
        conditions.append(F.col("roe") > roe_min)
    if mom_min is not None:
        conditions.append(F.col("mom_12m") > mom_min)
    if sector is not None:
        conditions.append(matches_pattern(F.col("sector"), sector))
    if conditions:
        rows = rows.where(all_of(conditions))
    if sql is not None:
        rows = rows.where(sql)
    rows = rows.drop("p_year")
    return rows if limit is None else rows.orderBy("ticker", "permaTicker").limit(limit)


def universe_report(matrix: DataFrame) -> DataFrame:
    """Securities on the last session, by ticker."""
    return (
        on_latest_date(matrix).select("ticker", "cik", "sector", "mkt_cap")
        .dropna(subset=["ticker"]).orderBy("ticker", "cik")
    )


def sector_compare(matrix: DataFrame) -> DataFrame:
    """Mean month-over-month return of each sector's securities."""
    months = matrix.groupBy("permaTicker", F.trunc("p_date", "month").alias("month")).agg(
        F.max_by("sector", "p_date").alias("sector"),
        F.max_by("adjClose", "p_date").alias("adj"))
    earlier = F.lag("adj").over(axis(["permaTicker"], ["month"]))
    return (
        months.withColumn("ret", F.col("adj") / non_zero(earlier) - 1)
        .where(F.col("ret").isNotNull())
        .groupBy("sector", "month")
        .agg(F.count(F.lit(1)).alias("securities"), F.avg("ret").alias("mean_return"))
    )
