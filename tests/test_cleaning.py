from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from knownby.functions import cleaning as C
from knownby.operators.facts import clean_facts


def _map(spark, values, kind, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v")).alias("out")).collect()]


def test_company_ids(spark):
    texts = ["320193", "320193.0", "ABC", None, "12345678901", "-5", "1e5", "320193D", "nan"]
    assert _map(spark, texts, "string", C.normalize_cik) == [
        "0000320193", "0000320193", "0000000ABC", "0000000000", "12345678901", "-000000005",
        "0000100000", "000320193D", "0000000nan"]
    assert _map(spark, [320193.0], "double", C.normalize_cik) == ["0000320193"]
    assert _map(spark, [320193], "bigint", C.normalize_cik) == ["0000320193"]


def test_common_stock(spark):
    tickers = ["ABC", "abc", "ABC-P", "PRU", "ABCDEF", "", None, "X.U", "A WRT", "NEWS", "A-W"]
    assert _map(spark, tickers, "string", C.is_common_stock) == [
        True, True, False, False, False, False, False, False, False, False, False]


def test_industry_codes(spark):
    codes = ["2834", "3571", "6798", "6797", "100", "9999", "", "x1", None, "8011", "7372", "0"]
    out = _map(spark, codes, "string", lambda c: C.classify_sic(c, F.lit("desc")))
    assert [tuple(r) for r in out] == [
        ("Healthcare", "desc"), ("Technology", "desc"), ("Real Estate", "REIT"),
        ("Financial Services", "desc"), ("Consumer Defensive", "desc"), ("Other", "desc"),
        ("Unknown", "Unknown"), ("Unknown", "desc"), ("Unknown", "Unknown"), ("Healthcare", "desc"),
        ("Technology", "desc"), ("Other", "desc")]


def test_days_and_ids(spark):
    days = _map(spark, ["2020-01-05T00:00:00Z", "2020-1-5", "2020-02-30", "x", None], "string",
                C.parse_day)
    assert [str(d) for d in days] == ["2020-01-05", "2020-01-05", "None", "None", "None"]
    row = spark.sql("SELECT ' ' AS p, 'T' AS t").select(
        C.security_id(F.col("p"), F.col("t"))).first()
    assert row[0] == "T"


ENTRY = ("cik string, sec_tag string, unit string, start_date date, end_date date, filed_date date, "
         "fp string, val double, pos bigint")


def _clean(spark, rows):
    typed = spark.createDataFrame(
        rows, "cik string, sec_tag string, unit string, s string, e string, f string, fp string, "
              "val double, pos bigint")
    return clean_facts(typed.select("cik", "sec_tag", "unit", F.to_date("s").alias("start_date"),
                                    F.to_date("e").alias("end_date"),
                                    F.to_date("f").alias("filed_date"), "fp", "val", "pos"))


@pytest.mark.parametrize("days,quarter,annual", [
    (79, False, False), (80, True, False), (105, True, False), (106, False, False),
    (349, False, False), (350, False, True), (380, False, True), (381, False, False)])
def test_period_lengths(spark, days, quarter, annual):
    start = spark.sql(f"SELECT CAST(date_sub(DATE'2020-12-31', {days}) AS STRING)").first()[0]
    rows = _clean(spark, [("1", "Revenues", "USD", start, "2020-12-31", "2021-02-01", None, 5.0, 0)]
                  ).collect()
    assert [(r.is_quarter, r.is_fy) for r in rows] == ([(quarter, annual)] if quarter or annual else [])


def test_rejections_and_labels(spark):
    rows = [
        ("1", "Revenues", "USD", None, "2020-12-31", "2021-02-01", "Q4", 1.0, 0),  # flow, no start
        ("1", "Assets", "USD", None, "2020-12-31", "2021-02-01", "", 2.0, 0),      # instant
        ("1", "Assets", "CAD", None, "2020-09-30", "2021-02-01", "Q3", 3.0, 0),    # wrong unit
        ("1", "Liabilities", "USD", None, "2020-12-31", None, "Q4", 4.0, 0),       # no filing date
        ("1", "NotATag", "USD", None, "2020-12-31", "2021-02-01", "Q4", 5.0, 0),
        ("1", "CommonStockSharesOutstanding", "USD", None, "2020-12-31", "2021-02-01", "Q4", 6.0, 0),
    ]
    out = _clean(spark, rows).collect()
    assert [(r.tag, r.val, r.raw_val, r.fp, r.is_fy, r.is_quarter) for r in out] == [
        ("total_assets", 2.0, 2.0, "Unknown", False, False)]


def test_alias_priority_then_position(spark):
    key = (None, "2020-12-31", "2021-02-01", "Q4")
    rows = [("1", "StockholdersEquityIncludingPortionAttributableToNoncontrollingInterest", "USD",
             *key, 1.0, 0),
            ("1", "StockholdersEquity", "USD", *key, 3.0, 9),
            ("1", "StockholdersEquity", "USD", *key, 2.0, 4)]
    assert [r.val for r in _clean(spark, rows).collect()] == [2.0]
