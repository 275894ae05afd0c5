"""Explicit schemas of the layers; no plan infers one from data."""

from __future__ import annotations

from pyspark.sql import types as T

from knownby.sources.taxonomy import FY_TAGS, MATRIX_TAGS

PRICE_VALUES = [
    "close", "high", "low", "open", "volume", "adjClose", "adjHigh", "adjLow", "adjOpen",
    "adjVolume", "divCash", "splitFactor",
]

PRICES = T.StructType(
    [T.StructField("date", T.StringType())]
    + [T.StructField(c, T.DoubleType()) for c in PRICE_VALUES]
    + [T.StructField("permaTicker", T.StringType()), T.StructField("ticker", T.StringType())]
)

FACTS = T.StructType([
    T.StructField("cik", T.StringType()),
    T.StructField("tag", T.StringType()),
    T.StructField("val", T.DoubleType()),
    T.StructField("raw_val", T.DoubleType()),
    T.StructField("end_date", T.DateType()),
    T.StructField("filed_date", T.DateType()),
    T.StructField("fp", T.StringType()),
    T.StructField("is_fy", T.BooleanType()),
    T.StructField("is_quarter", T.BooleanType()),
])

REGISTRY_TEXT = [
    "permaTicker", "ticker", "cik", "sector", "industry", "sicCode", "sicIndustry",
    "status_metadata", "status_prices", "status_fundamentals", "last_update", "bootstrap_date",
]
REGISTRY = T.StructType([T.StructField(c, T.StringType()) for c in REGISTRY_TEXT])

FACT_ENTRY = T.StructType([
    T.StructField("start", T.StringType()),
    T.StructField("end", T.StringType()),
    T.StructField("val", T.DoubleType()),
    T.StructField("filed", T.StringType()),
    T.StructField("fp", T.StringType()),
    T.StructField("accn", T.StringType()),
])
_UNITS = T.StructType([
    T.StructField("units", T.MapType(T.StringType(), T.ArrayType(FACT_ENTRY))),
])
COMPANY_FACTS = T.StructType([
    T.StructField("cik", T.StringType()),
    T.StructField("facts", T.StructType([
        T.StructField("us-gaap", T.MapType(T.StringType(), _UNITS)),
    ])),
    T.StructField("_corrupt", T.StringType()),
])

COMPANY_PROFILE = T.StructType([
    T.StructField("cik", T.StringType()),
    T.StructField("sic", T.StringType()),
    T.StructField("sicDescription", T.StringType()),
    T.StructField("_corrupt", T.StringType()),
])

MATRIX_COLUMNS = (
    ["ticker", "cik", "p_date", "close", "adjClose", "volume", "sector", "industry", "mkt_cap",
     "pe_ratio", "pb_ratio", "roe", "roa", "gross_margin", "rev_growth_yoy", "mom_12m", "adv_20d",
     "debt_to_equity", "fcf_yield", "ev", "ev_to_ebit"]
    + MATRIX_TAGS[:8]
    + [f"{t}_fy" for t in FY_TAGS]
    + MATRIX_TAGS[8:]
)
_MATRIX_TEXT = {"permaTicker", "ticker", "cik", "sector", "industry"}


def _matrix_type(column: str) -> T.DataType:
    if column in _MATRIX_TEXT:
        return T.StringType()
    return T.DateType() if column == "p_date" else T.DoubleType()


MATRIX = T.StructType(
    [T.StructField(c, _matrix_type(c)) for c in ["permaTicker", *MATRIX_COLUMNS]]
)
