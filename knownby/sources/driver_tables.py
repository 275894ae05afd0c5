"""Finance inputs derived from the star-schema test tables.

The definitions run unchanged on Spark SQL and on other ANSI engines, so both sides of a comparison
start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FX_PRICES = """
SELECT 'P' || lpad(CAST(l_suppkey AS STRING), 6, '0')            AS permaTicker,
       CAST(l_shipdate AS DATE)                                  AS p_date,
       max(l_extendedprice / l_quantity)                         AS close,
       max(l_extendedprice / l_quantity)                         AS high,
       min(l_extendedprice / l_quantity)                         AS low,
       min(l_extendedprice / l_quantity)                         AS open,
       sum(l_quantity)                                           AS volume,
       max(l_extendedprice / l_quantity) * (1 - max(l_discount)) AS adjClose,
       sum(l_quantity)                                           AS adjVolume
FROM lineitem GROUP BY l_suppkey, CAST(l_shipdate AS DATE)
"""

# A second vendor over the same sessions: prices from the cheapest line of the day.
FX_PRICES_ALT = """
SELECT 'P' || lpad(CAST(l_suppkey AS STRING), 6, '0')            AS permaTicker,
       CAST(l_shipdate AS DATE)                                  AS p_date,
       min(l_extendedprice / l_quantity)                         AS close,
       min(l_extendedprice / l_quantity) * (1 - min(l_discount)) AS adjClose
FROM lineitem GROUP BY l_suppkey, CAST(l_shipdate AS DATE)
"""

# Corporate actions: a split factor on some sessions, and a symbol that changes over time.
FX_ACTIONS = """
SELECT 'P' || lpad(CAST(l_suppkey AS STRING), 6, '0')            AS permaTicker,
       CAST(l_shipdate AS DATE)                                  AS p_date,
       CASE WHEN max(l_tax) >= 0.08 THEN 2.0E0 ELSE 1.0E0 END    AS splitFactor,
       'T' || CAST(l_suppkey AS STRING) || max(l_returnflag)     AS symbol
FROM lineitem GROUP BY l_suppkey, CAST(l_shipdate AS DATE)
"""

_FX_BASE_FACTS = """
SELECT lpad(CAST(o_custkey % (SELECT count(*) FROM supplier) AS STRING), 10, '0') AS cik,
       CASE o_orderkey % 8 WHEN 0 THEN 'Revenues' WHEN 1 THEN 'NetIncomeLoss'
            WHEN 2 THEN 'OperatingIncomeLoss' WHEN 3 THEN 'NetCashProvidedByUsedInOperatingActivities'
            WHEN 4 THEN 'PaymentsToAcquirePropertyPlantAndEquipment' WHEN 5 THEN 'StockholdersEquity'
            WHEN 6 THEN 'Assets' ELSE 'CommonStockSharesOutstanding' END          AS sec_tag,
       CASE WHEN o_orderkey % 8 = 7 THEN 'shares'
            WHEN o_orderstatus = 'P' THEN 'CAD' ELSE 'USD' END                    AS unit,
       CASE WHEN o_orderkey % 8 >= 5 THEN NULL
            WHEN CAST(floor(o_orderkey / 8) AS BIGINT) % 10 = 0
                 THEN CAST(date_trunc('quarter', o_orderdate) AS DATE) - 365
            WHEN CAST(floor(o_orderkey / 8) AS BIGINT) % 10 = 1
                 THEN CAST(date_trunc('quarter', o_orderdate) AS DATE) - 181
            ELSE CAST(date_trunc('quarter', o_orderdate) AS DATE) - 91 END        AS start_date,
       CAST(date_trunc('quarter', o_orderdate) AS DATE) - 1                       AS end_date,
       CAST(o_orderdate AS DATE)                                                  AS filed_date,
       o_totalprice                                                               AS val,
       o_orderkey                                                                 AS pos
FROM orders
"""

# A second entry of each filing: the remaining tags of the daily table, some values missing.
_FX_MORE_FACTS = """
SELECT lpad(CAST(o_custkey % (SELECT count(*) FROM supplier) AS STRING), 10, '0') AS cik,
       CASE o_custkey % 8 WHEN 0 THEN 'CostOfRevenue' WHEN 1 THEN 'CostOfGoodsAndServicesSold'
            WHEN 2 THEN 'ResearchAndDevelopmentExpense'
            WHEN 3 THEN 'SellingGeneralAndAdministrativeExpense'
            WHEN 4 THEN 'CashAndCashEquivalentsAtCarryingValue' WHEN 5 THEN 'LongTermDebt'
            WHEN 6 THEN 'LongTermDebtNoncurrent' ELSE 'ShortTermBorrowings' END   AS sec_tag,
       'USD'                                                                      AS unit,
       CASE WHEN o_custkey % 8 >= 4 THEN NULL
            WHEN o_orderkey % 8 = 3 THEN CAST(date_trunc('quarter', o_orderdate) AS DATE) - 365
            ELSE CAST(date_trunc('quarter', o_orderdate) AS DATE) - 91 END        AS start_date,
       CAST(date_trunc('quarter', o_orderdate) AS DATE) - 1                       AS end_date,
       CAST(o_orderdate AS DATE)                                                  AS filed_date,
       CASE WHEN o_orderkey % 13 = 5 THEN NULL ELSE o_totalprice / 4 END          AS val,
       o_orderkey                                                                 AS pos
FROM orders
"""

# The same figures under a less preferred tag, listed before the preferred one.
_FX_ALIASES = """
SELECT cik, CASE sec_tag WHEN 'Revenues' THEN 'SalesRevenueNet' WHEN 'NetIncomeLoss' THEN 'ProfitLoss'
                 ELSE 'StockholdersEquityIncludingPortionAttributableToNoncontrollingInterest' END AS sec_tag,
       unit, start_date, end_date, filed_date, val / 2 AS val, pos - 1 AS pos
FROM base WHERE sec_tag IN ('Revenues', 'NetIncomeLoss', 'StockholdersEquity')
"""

# Fiscal-period labels: FY, Q1, a blank one, none, Q4.
FX_FACTS_RAW = f"""
SELECT *, CASE WHEN start_date < end_date - 300 THEN 'FY' WHEN quarter(end_date) = 2 THEN ''
               WHEN quarter(end_date) = 3 THEN NULL
               ELSE 'Q' || CAST(quarter(end_date) AS STRING) END AS fp
FROM (WITH base AS ({_FX_BASE_FACTS}) SELECT * FROM base
      UNION ALL SELECT * FROM ({_FX_MORE_FACTS}) UNION ALL SELECT * FROM ({_FX_ALIASES})) entries
"""

FX_META = """
SELECT 'P' || lpad(CAST(s_suppkey AS STRING), 6, '0')                         AS permaTicker,
       CASE WHEN s_suppkey % 25 = 7 THEN 'T' || CAST(s_suppkey AS STRING) || '-P'
            ELSE 'T' || CAST(s_suppkey AS STRING) END                         AS ticker,
       lpad(CAST(CASE WHEN s_suppkey % 10 = 9 THEN s_suppkey - 1 ELSE s_suppkey END AS STRING),
            10, '0')                                                          AS cik,
       100 + (s_suppkey * 97) % 9000                                          AS sicCode,
       n_name AS industry, r_name AS sector
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""

_TABLES = ["region", "nation", "supplier", "orders", "lineitem", "events"]


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; its footer is read for the schema once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def adapter(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Run one of the definitions above over the tables of a folder."""
    used = [t for t in _TABLES if t in sql]
    return spark.sql(sql.replace("FROM supplier)", "FROM {supplier})")
                     .replace("FROM lineitem ", "FROM {lineitem} ")
                     .replace("FROM orders", "FROM {orders}")
                     .replace("FROM supplier JOIN nation", "FROM {supplier} JOIN {nation}")
                     .replace("JOIN region", "JOIN {region}"),
                     **{t: table(spark, sf_dir, t) for t in used})


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One bar per (permaTicker, p_date) by construction."""
    return adapter(spark, sf_dir, FX_PRICES)


def raw_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapter(spark, sf_dir, FX_FACTS_RAW)


def meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapter(spark, sf_dir, FX_META)
