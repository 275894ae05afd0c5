"""The daily factor table: one plan over all securities.

Shuffles: facts by report and by filing, filings and prices by security. All per-security windows
share that last partitioning and its sort order, and so does the join with the registry.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knownby.functions import cleaning as C
from knownby.functions import ratios as R
from knownby.operators.dedupe import daily_axis, last_row_per_key
from knownby.operators.pit import filing_state
from knownby.operators.timeseries import axis, lag_return, last_known, rolling_stddev, strict_rolling
from knownby.options import DEFAULT, EngineOptions
from knownby.schemas import MATRIX
from knownby.sources.taxonomy import FY_TAGS, MATRIX_TAGS, TTM_TAGS

FILLED = [*MATRIX_TAGS, *[f"{t}_fy" for t in FY_TAGS], *[f"{t}_ttm" for t in TTM_TAGS]]
_BAR = ["close", "adjClose", "volume", "adjVolume"]


def latest_listing(meta: DataFrame) -> DataFrame:
    """One row per permaTicker: the last by ``last_update`` if there is one, then by its values."""
    rest = [c for c in meta.columns if c != "permaTicker"]
    order = [c for c in ("last_update",) if c in rest]
    return last_row_per_key(meta, ["permaTicker"], [*order, *[c for c in rest if c not in order]])


def universe(meta: DataFrame, facts: DataFrame | None = None) -> DataFrame:
    """Common-stock securities with a normalised company id and labelled sector and industry.

    ``facts`` restricts it to companies that have any. A registry may list an id again: the last
    listing counts, also if it is no common stock.
    """
    kept = latest_listing(meta).where(C.is_common_stock(F.col("ticker"))).select(
        "permaTicker", "ticker",
        C.normalize_cik(F.col("cik")).alias("cik"),
        F.coalesce(F.col("sector"), F.lit("Unknown")).alias("sector"),
        F.coalesce(F.col("industry"), F.lit("Unknown")).alias("industry"),
    )
    if facts is None:
        return kept
    return kept.join(facts.select("cik").distinct(), "cik", "left_semi")  # one row per company moves


def price_axis(prices: DataFrame, securities: DataFrame, options: EngineOptions) -> DataFrame:
    """Daily bars of the universe. A symbol on the bar itself wins over the registry's."""
    return _listed(_daily_bars(prices, options), securities)


def _daily_bars(prices: DataFrame, options: EngineOptions) -> DataFrame:
    symbol = ["ticker"] if "ticker" in prices.columns else []
    bars = prices.select("permaTicker", "p_date", *_BAR, *symbol)
    return bars if options.unique_bars else daily_axis(bars)


def _listed(bars: DataFrame, securities: DataFrame) -> DataFrame:
    """Bars of the securities, with what the registry says of them; a bar keeps its own symbol."""
    return bars.join(securities.drop(*[c for c in ("ticker",) if c in bars.columns]), "permaTicker")


def bars_with_filings(bars: DataFrame, filings: DataFrame, values: list[str],
                      options: EngineOptions = DEFAULT) -> DataFrame:
    """Bars with ``n_shares`` and one struct ``known`` of the fundamentals in force that session.

    ``filings`` holds one row per (permaTicker, f_date) with ``shares_sec`` and ``values``. A bar sees
    the latest filing not after it, so a filing followed by another before the next session is never
    seen; each value is the latest non-null one among the filings seen. Tagged union, one shuffle and
    one sort by (security, day): a filing is seen when a bar comes right behind it, and unseen ones
    contribute nothing to the forward fill. Fundamentals stay one column until the caller expands
    them, which keeps the rows of later windows narrow.
    """
    bar_columns = bars.columns
    filed = filings.select("permaTicker", F.col("f_date").alias("p_date"), F.lit(0).alias("_side"),
                           "shares_sec", F.struct(*values).alias("_filing"))
    merged = bars.withColumn("_side", F.lit(1)).unionByName(filed, allowMissingColumns=True)
    order = axis(["permaTicker"], ["p_date", "_side"])
    is_bar = F.col("_side") == 1
    filing_shares = F.when(~is_bar, F.struct("p_date", "shares_sec"))
    merged = merged.withColumns({
        "_seen": ~is_bar & (F.lead("_side").over(order) == 1),
        "_same_day": F.lead("p_date").over(order) == F.col("p_date"),
        "_filed": last_known(filing_shares, order),
        **({"_bar": last_known(F.when(is_bar, F.struct("close", "adjClose")), order)}
           if options.share_match == "asof" else {}),
    })
    fixed = F.when(
        is_bar & (F.col("_filed.p_date") == F.col("p_date")),
        R.split_invariant_shares(F.col("close"), F.col("adjClose"), F.col("_filed.shares_sec")))
    if options.share_match == "asof":
        # A filing made off-session is priced at the session before it.
        off_session = ~is_bar & ~(F.col("_seen") & F.coalesce(F.col("_same_day"), F.lit(False)))
        fixed = fixed.when(off_session, R.split_invariant_shares(
            F.col("_bar.close"), F.col("_bar.adjClose"), F.col("shares_sec")))
    merged = merged.withColumn("n_at_filing", fixed)
    merged = merged.withColumns({
        "n_shares": last_known(F.col("n_at_filing"), order),
        **{f"_k_{v}": last_known(F.when(F.col("_seen"), F.col(f"_filing.{v}")), order)
           for v in values},
    })
    return merged.where(is_bar).select(
        *bar_columns, "n_at_filing", "n_shares",
        F.struct(*[F.col(f"_k_{v}").alias(v) for v in values]).alias("known"))


def fan_out(filings: DataFrame, securities: DataFrame) -> DataFrame:
    """Company filings repeated for each of its securities."""
    return filings.join(securities.select("permaTicker", "cik"), "cik").drop("cik")


def build_frame(prices: DataFrame, facts: DataFrame, meta: DataFrame,
                options: EngineOptions = DEFAULT) -> DataFrame:
    """Every working column per (permaTicker, p_date), TTM forms and dollar volume included.

    The registry's columns are joined behind the windows: the bars move once, without them.
    """
    securities = universe(meta, facts)
    bars = _daily_bars(prices, options).where(F.col("permaTicker").isNotNull())
    filings = fan_out(filing_state(facts, options), securities)
    daily = axis(["permaTicker"], ["p_date"])
    known = bars_with_filings(bars, filings, FILLED, options)
    signals = known.withColumn("dollar_volume", F.col("adjClose") * F.col("adjVolume")).withColumns({
        "mom_12m": lag_return(F.col("adjClose"), options.year_rows, daily),
        "adv_20d": strict_rolling(F.col("dollar_volume"), options.adv_rows, daily),
        "rev_growth_yoy": lag_return(F.col("known.revenue_ttm"), options.year_rows, daily),
        "ni_growth_yoy": lag_return(F.col("known.net_income_ttm"), options.year_rows, daily),
    })
    expanded = _listed(signals, securities).select("*", "known.*").withColumn("mkt_cap", R.market_cap()).drop("known")
    return expanded.withColumns(R.valuation_columns(options.roe_denominator))


def build_matrix(prices: DataFrame, facts: DataFrame, meta: DataFrame,
                 options: EngineOptions = DEFAULT) -> DataFrame:
    """The contract table: prices(permaTicker, p_date, close, adjClose, volume, adjVolume[, ticker]),
    silver facts and registry rows in, one row per security and session out."""
    frame = build_frame(prices, facts, meta, options)
    return frame.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in MATRIX.fields])


def build_extended(prices: DataFrame, facts: DataFrame, meta: DataFrame,
                   options: EngineOptions = DEFAULT) -> DataFrame:
    """The documented measures beyond the contract, keyed by (permaTicker, p_date)."""
    frame = build_frame(prices, facts, meta, options)
    return price_signals(frame).withColumns(R.quality_extras()).select(
        "permaTicker", "p_date", *PRICE_SIGNALS, "ni_growth_yoy", "rd_intensity", "accruals")


MOMENTUM_ROWS = {"mom_1m": 21, "mom_3m": 63, "mom_6m": 126}
VOLATILITY_ROWS = {"vol_30d": 30, "vol_90d": 90}
PRICE_SIGNALS = [*MOMENTUM_ROWS, *VOLATILITY_ROWS, "amihud_20d"]


def price_signals(prices: DataFrame, by: tuple[str, ...] = ("permaTicker",)) -> DataFrame:
    """Shorter momentum, volatility of daily returns and price impact per traded dollar."""
    daily = axis(by, ["p_date"])
    adjusted = F.col("adjClose")
    impact = F.abs(F.col("ret_1d")) / C.non_zero(adjusted * F.col("adjVolume"))
    signals = (
        prices.withColumn("ret_1d", lag_return(adjusted, 1, daily))
        .withColumns({
            **{name: lag_return(adjusted, rows, daily) for name, rows in MOMENTUM_ROWS.items()},
            "amihud_20d": strict_rolling(impact, 20, daily),
        })
    )
    return rolling_stddev(signals, "ret_1d", VOLATILITY_ROWS, daily)
