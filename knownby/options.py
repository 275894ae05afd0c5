"""Tunable semantics of the engine, passed explicitly to the plans that need them."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class EngineOptions:
    """Defaults reproduce the shipped behaviour; documented variants are opt-in.

    share_match
        ``exact``: a share count is priced only when it was filed on a trading session.
        ``asof``: otherwise it is priced at the last session before the filing.
    roe_denominator
        ``total_assets`` or ``equity``.
    unique_bars
        True when the price input is known to hold one row per (permaTicker, p_date). When False
        the plan collapses it to that grain first, so that every per-security window is bounded by
        the trading calendar however often a bar was landed.
    """

    ttm_periods: int = 4
    ttm_min_days: int = 265
    ttm_max_days: int = 285
    share_match: str = "exact"
    roe_denominator: str = "total_assets"
    unique_bars: bool = False
    year_rows: int = 252
    adv_rows: int = 20

    def __post_init__(self) -> None:
        if self.share_match not in ("exact", "asof"):
            raise ValueError(f"share_match must be 'exact' or 'asof', not {self.share_match!r}")
        if self.roe_denominator not in ("total_assets", "equity"):
            raise ValueError(
                f"roe_denominator must be 'total_assets' or 'equity', not {self.roe_denominator!r}")
        if not 0 < self.ttm_min_days <= self.ttm_max_days:
            raise ValueError("ttm_min_days must be positive and not above ttm_max_days")


DEFAULT = EngineOptions()
