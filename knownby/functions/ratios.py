"""Valuation, quality and leverage measures as column expressions over a daily row.

Each takes its inputs from the columns of the daily table; divisors are zero-guarded.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from knownby.functions.cleaning import non_zero, or_zero


def split_invariant_shares(close: Column, adj_close: Column, shares: Column) -> Column:
    """Share count in units of the adjusted price, fixed on the day it is priced."""
    return close * shares / non_zero(adj_close)


def market_cap() -> Column:
    return non_zero(F.col("adjClose") * F.col("n_shares"))


def total_debt() -> Column:
    return or_zero(F.col("long_term_debt")) + or_zero(F.col("short_term_debt"))


def free_cash_flow() -> Column:
    return or_zero(F.col("operating_cash_flow_ttm")) - F.abs(or_zero(F.col("capex_ttm")))


def gross_margin() -> Column:
    revenue = F.col("revenue")
    return (or_zero(revenue) - or_zero(F.col("cogs"))) / non_zero(revenue)


def valuation_columns(roe_denominator: str) -> dict[str, Column]:
    """Ratios that need ``mkt_cap`` and the fundamentals already on the row."""
    cap, income = F.col("mkt_cap"), F.col("net_income_ttm")
    enterprise_value = cap + total_debt() - or_zero(F.col("cash"))
    return {
        "pe_ratio": cap / non_zero(income),
        "pb_ratio": cap / non_zero(F.col("equity")),
        "roe": income / non_zero(F.col(roe_denominator)),
        "roa": income / non_zero(F.col("total_assets")),
        "gross_margin": gross_margin(),
        "debt_to_equity": total_debt() / non_zero(F.col("equity")),
        "fcf_yield": free_cash_flow() / cap,
        "ev": enterprise_value,
        "ev_to_ebit": enterprise_value / non_zero(F.col("operating_income_ttm")),
    }


def quality_extras() -> dict[str, Column]:
    """Documented measures beyond the fixed table contract."""
    return {
        "rd_intensity": F.col("rd_expense") / non_zero(F.col("revenue")),
        "accruals": (F.col("net_income_ttm") - F.col("operating_cash_flow_ttm"))
        / non_zero(F.col("total_assets")),
    }
