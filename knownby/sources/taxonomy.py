"""Filing-tag taxonomy and industry-code rules: the fixed values every plan relies on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Canonical tag -> accepted filing tags, most preferred first.
CANONICAL_TAGS: dict[str, list[str]] = {
    "revenue": [
        "Revenues",
        "SalesRevenueNet",
        "SalesRevenueGoodsNet",
        "RevenueFromContractWithCustomerExcludingSalesTax",
        "RevenueFromContractWithCustomerExcludingAssessedTax",
        "TotalRevenuesAndOtherIncome",
        "RevenuesNetOfInterestExpense",
    ],
    "net_income": ["NetIncomeLoss", "NetIncomeLossAvailableToCommonStockholdersBasic", "ProfitLoss"],
    "cogs": ["CostOfGoodsAndServicesSold", "CostOfRevenue", "CostOfGoodsSold"],
    "rd_expense": ["ResearchAndDevelopmentExpense"],
    "sga_expense": ["SellingGeneralAndAdministrativeExpense"],
    "opex": ["OperatingExpenses"],
    "operating_income": ["OperatingIncomeLoss"],
    "total_assets": ["Assets"],
    "total_liabilities": ["Liabilities"],
    "equity": [
        "StockholdersEquity",
        "StockholdersEquityIncludingPortionAttributableToNoncontrollingInterest",
    ],
    "equity_and_liab": ["LiabilitiesAndStockholdersEquity"],
    "cash": ["CashAndCashEquivalentsAtCarryingValue"],
    "long_term_debt": ["LongTermDebt", "LongTermDebtNoncurrent"],
    "short_term_debt": ["ShortTermBorrowings"],
    "inventory": ["InventoryNet"],
    "operating_cash_flow": ["NetCashProvidedByUsedInOperatingActivities"],
    "capex": ["PaymentsToAcquirePropertyPlantAndEquipment"],
    "shares_outstanding": [
        "CommonStockSharesOutstanding",
        "EntityCommonStockSharesOutstanding",
        "WeightedAverageNumberOfSharesOutstandingBasic",
    ],
    "shares_outstanding_diluted": ["WeightedAverageNumberOfDilutedSharesOutstanding"],
}

# Tags measured at a point in time; every other tag covers a period.
INSTANT_TAGS = [
    "total_assets", "total_liabilities", "equity", "equity_and_liab", "cash", "long_term_debt",
    "short_term_debt", "inventory", "shares_outstanding", "shares_outstanding_diluted",
]

# Tags counted in shares; every other tag must be in USD.
SHARE_TAGS = ["shares_outstanding", "shares_outstanding_diluted"]

# Tags the daily table carries, and the subsets with TTM and fiscal-year forms.
MATRIX_TAGS = [
    "revenue", "net_income", "cogs", "operating_income", "rd_expense", "sga_expense",
    "operating_cash_flow", "capex", "shares_outstanding", "equity", "total_assets", "cash",
    "long_term_debt", "short_term_debt",
]
TTM_TAGS = ["net_income", "revenue", "operating_income", "operating_cash_flow", "capex"]
FY_TAGS = ["revenue", "net_income", "cogs", "operating_income", "rd_expense", "sga_expense"]

# Period lengths in days accepted as a quarter and as a fiscal year.
QUARTER_DAYS = (80, 105)
FISCAL_YEAR_DAYS = (350, 380)

# Industry-code ranges in order of precedence; a None label keeps the description.
SIC_RULES: list[tuple[int, int, str, str | None]] = [
    (2830, 2836, "Healthcare", None),
    (8000, 8099, "Healthcare", None),
    (3570, 3579, "Technology", None),
    (3660, 3679, "Technology", None),
    (7370, 7379, "Technology", None),
    (6798, 6798, "Real Estate", "REIT"),
    (100, 999, "Consumer Defensive", None),
    (1000, 1499, "Basic Materials", None),
    (1500, 1799, "Industrials", "Construction"),
    (2000, 3999, "Industrials", "Manufacturing"),
    (4000, 4899, "Industrials", "Transportation & Comm"),
    (4900, 4999, "Utilities", None),
    (5000, 5199, "Consumer Cyclical", "Wholesale"),
    (5200, 5999, "Consumer Cyclical", "Retail"),
    (6000, 6799, "Financial Services", None),
    (7000, 8999, "Consumer Cyclical", "Services"),
]

# Ticker fragments that mark preferreds, warrants and units.
NON_COMMON_FRAGMENTS = ["-P", "_P", "PR", "WS", "-W", ".U", " WRT"]
MAX_COMMON_TICKER_LENGTH = 5

# Vendor text standing for an absent sector, and the download statuses.
SECTOR_PLACEHOLDERS = ["Field not available for free/evaluation", "Unknown"]
PENDING_STATUS = "pending"
SUCCESS_STATUS = "success"
TERMINAL_STATUSES = ["success", "success_empty", "failed_404", "failed_no_xbrl"]


def sec_tags() -> list[str]:
    return [sec_tag for aliases in CANONICAL_TAGS.values() for sec_tag in aliases]


def taxonomy(spark: SparkSession) -> DataFrame:
    """One row per accepted filing tag: sec_tag, tag, priority, is_instant, want_unit.

    Its row count is fixed by this module, which is what makes broadcasting it safe.
    """
    rows = [
        F.struct(
            F.lit(sec_tag).alias("sec_tag"),
            F.lit(tag).alias("tag"),
            F.lit(priority).alias("priority"),
            F.lit(tag in INSTANT_TAGS).alias("is_instant"),
            F.lit("shares" if tag in SHARE_TAGS else "USD").alias("want_unit"),
        )
        for tag, aliases in CANONICAL_TAGS.items()
        for priority, sec_tag in enumerate(aliases)
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))
