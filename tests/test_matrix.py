from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from knownby.contract import inputs
from knownby.options import EngineOptions
from knownby.plans.matrix import bars_with_filings, build_matrix
from knownby.schemas import MATRIX, MATRIX_COLUMNS
from knownby.sources.sinks import check_contract
from tests.test_pit import FACTS, annual, day, instant

SF_DIR = "/root/testdata/sf0.001"
BARS = "permaTicker string, p_date date, close double, adjClose double"
FILINGS = "permaTicker string, f_date date, shares_sec double, a double, b double"


def _known(spark, bars, filings, **options):
    out = bars_with_filings(spark.createDataFrame(bars, BARS), spark.createDataFrame(filings, FILINGS),
                            ["a", "b"], EngineOptions(**options))
    return out.select("p_date", "n_shares", "known.a", "known.b").orderBy("p_date").collect()


def test_fill_sees_only_the_newest_filing_between_sessions(spark):
    bars = [("P", day("2024-01-05"), 10.0, 10.0), ("P", day("2024-01-08"), 10.0, 10.0),
            ("P", day("2024-01-09"), 10.0, 10.0)]
    filings = [("P", day("2024-01-05"), 7.0, 1.0, 1.0),   # on a session: known that day
               ("P", day("2024-01-06"), 8.0, 2.0, 2.0),   # superseded before the next session
               ("P", day("2024-01-07"), None, 3.0, None)]
    out = _known(spark, bars, filings)
    assert [(r.a, r.b) for r in out] == [(1.0, 1.0), (3.0, 1.0), (3.0, 1.0)]
    assert [r.n_shares for r in out] == [7.0, 7.0, 7.0]  # weekend share count is not priced
    later = _known(spark, bars, filings, share_match="asof")
    assert [r.n_shares for r in later] == [7.0, 8.0, 8.0]


def test_zero_adjusted_close_gives_no_share_factor(spark):
    bars = [("P", day("2024-01-05"), 10.0, 0.0), ("P", day("2024-01-08"), 10.0, 5.0)]
    filings = [("P", day("2024-01-05"), 7.0, 1.0, 1.0), ("P", day("2024-01-08"), 3.0, 1.0, 1.0)]
    assert [r.n_shares for r in _known(spark, bars, filings)] == [None, 6.0]


def test_matrix_contract(spark):
    built = inputs.built_matrix(spark, SF_DIR)
    assert built.columns == ["permaTicker", *MATRIX_COLUMNS] and len(MATRIX_COLUMNS) == 41
    assert [f.dataType for f in built.schema.fields] == [f.dataType for f in MATRIX.fields]
    with pytest.raises(ValueError):
        check_contract(built.drop("ev"))


def test_facts_filed_later_change_nothing_earlier(spark):
    cut = dt.date(1998, 1, 1)
    prices, facts, meta = (f(spark, SF_DIR) for f in (inputs.prices, inputs.facts, inputs.meta))
    early = build_matrix(prices, facts.where(F.col("filed_date") < cut), meta, inputs.OPTIONS)
    full = build_matrix(prices, facts, meta, inputs.OPTIONS)
    companies = facts.where(F.col("filed_date") < cut).select("cik").distinct()
    before = full.where(F.col("p_date") < cut).join(companies, "cik", "left_semi").select(*full.columns)
    early = early.where(F.col("p_date") < cut)
    assert before.exceptAll(early).count() == 0 and early.exceptAll(before).count() == 0
    assert early.where("pe_ratio IS NOT NULL").count() > 0


def test_split_leaves_market_cap_unchanged(spark):
    """A 10-for-1 split: raw close drops, adjusted close does not, the next filing has 10x shares."""
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(40)]
    meta = spark.createDataFrame([("P", "T", "1", None, None)],
                                 "permaTicker string, ticker string, cik string, sector string, "
                                 "industry string")

    def caps(split):
        bars = [("P", d, 100.0 / (10 if split and i >= 20 else 1), 10.0, 1.0, 1.0)
                for i, d in enumerate(days)]
        facts = [instant("2023-12-31", "2024-01-02", 50.0, "shares_outstanding"),
                 instant("2024-01-25", "2024-01-31", 500.0 if split else 50.0, "shares_outstanding"),
                 annual("2023-12-31", "2024-01-02", 25.0)]
        out = build_matrix(
            spark.createDataFrame(bars, "permaTicker string, p_date date, close double, "
                                        "adjClose double, volume double, adjVolume double"),
            spark.createDataFrame([(f"{int(r[0]):010d}", *r[1:]) for r in facts], FACTS), meta)
        return out.orderBy("p_date").collect()

    plain, split = caps(False), caps(True)
    assert [r.mkt_cap for r in plain] == [r.mkt_cap for r in split] == [None] + [5000.0] * 39
    assert split[-1].pe_ratio == 200.0 and split[-1].sector == "Unknown"


def test_symbol_on_the_bar_wins(spark):
    meta = spark.createDataFrame([("P", "NEW", "1", "S", "I")], "permaTicker string, ticker string, "
                                 "cik string, sector string, industry string")
    bars = spark.createDataFrame([("P", day("2024-01-05"), 1.0, 1.0, 1.0, 1.0, "OLD")],
                                 "permaTicker string, p_date date, close double, adjClose double, "
                                 "volume double, adjVolume double, ticker string")
    facts = spark.createDataFrame([instant("2023-12-31", "2024-01-02", 5.0, "equity",
                                           cik="0000000001")], FACTS)
    assert build_matrix(bars, facts, meta).first().ticker == "OLD"


def test_registry_columns_join_behind_the_windows(spark):
    """The bars' shuffle and windows carry no symbol, company, sector or industry."""
    prices = spark.createDataFrame([], "permaTicker string, p_date date, close double, adjClose double, volume double, adjVolume double")
    facts = spark.createDataFrame([], FACTS)
    meta = spark.createDataFrame([], "permaTicker string, ticker string, cik string, sector string, industry string")
    frame = build_matrix(prices, facts, meta, EngineOptions(unique_bars=True))
    plan = frame._jdf.queryExecution().analyzed().toString().split("\n")
    first = {word: next(i for i, line in enumerate(plan) if word in line) for word in ("Join Inner", "Window [")}
    assert first["Join Inner"] < first["Window ["]
