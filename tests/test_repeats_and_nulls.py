"""Repeated listings and profiles, null keys and days, empty landings, late rows, limits and layout."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from knownby.operators.registry import completeness
from knownby.operators.timeseries import axis, forward_fill, in_chunks, lag_return
from knownby.plans import audits, research
from knownby.plans.matrix import universe
from knownby.session import WORK_FOLDER, work_folder
from knownby.sources import bronze
from knownby.streaming import incremental

DAY = dt.date(2024, 1, 1)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_last_listing_counts(spark):
    meta = spark.createDataFrame(
        [("P1", "OLD", "1", None, None, "2020"), ("P1", "NEW", "2", "s", "i", "2021"), ("P2", "ABC", "3", "s", "i", None),
         ("P3", "GOOD", "4", "s", "i", "2020"), ("P3", "GOOD-P", "4", "s", "i", "2021")],
        "permaTicker string, ticker string, cik string, sector string, industry string, last_update string")
    assert [r[:3] for r in rows(universe(meta))] == [("P1", "NEW", "0000000002"), ("P2", "ABC", "0000000003")]


def test_one_profile_per_company(spark):
    registry = spark.createDataFrame([("P1", "A", "1")], "permaTicker string, ticker string, cik string")
    wide = registry.select("*", *[F.lit(None).cast("string").alias(c) for c in (
        "sector", "industry", "sicCode", "sicIndustry", "status_metadata")])
    profiles = spark.createDataFrame([("0000000001", "2834", "x"), ("0000000001", "3571", "y")], "cik string, sic string, sicDescription string")
    assert bronze.enrich_registry(wide, profiles).count() == 1


def with_nulls(spark):
    data = [(k, None if d is None else DAY + dt.timedelta(days=d), v) for k in ("a", None) for d, v in (
        (None, 5.0), (1, None), (2, 7.0), (40, None), (41, 3.0), (90, None))]
    return spark.createDataFrame(data, "k string, d date, v double")


def test_segmented_fill_keeps_null_keys_and_days(spark):
    df = with_nulls(spark)
    whole = forward_fill(df, by=["k"], order="d", columns=["v"])
    assert rows(forward_fill(df, by=["k"], order="d", columns=["v"], segment_days=7)) == rows(whole)
    assert whole.where("v IS NULL").count() == 0


def test_chunks_keep_null_keys_and_days(spark):
    df = with_nulls(spark).fillna(1.0)
    whole = df.withColumn("r", lag_return(F.col("v"), 2, axis(["k"], ["d"])))
    cut = in_chunks(df, by=["k"], order="d", lookback=2, chunk_rows=2)
    parts = cut.withColumn("r", lag_return(F.col("v"), 2, axis(["k", "_chunk"], ["d"]))).where("_own").select("k", "d", "v", "r")
    assert rows(parts) == rows(whole)


def test_work_folder_must_be_named(spark):
    named = spark.conf.get(WORK_FOLDER)
    try:
        spark.conf.unset(WORK_FOLDER)
        with pytest.raises(ValueError):
            work_folder(spark, "x")
    finally:
        spark.conf.set(WORK_FOLDER, named)


def test_increments_after_an_empty_landing_and_a_late_row(spark):
    schema = spark.createDataFrame([], "permaTicker string, p_date date, close double").schema
    landing, target, offsets = (work_folder(spark, n) for n in ("landing", "target", "offsets"))
    assert incremental.read_increments(spark, target, schema).count() == 0
    spark.createDataFrame([("a", dt.date(1990, 5, 3), 1.0), ("a", dt.date(2024, 1, 2), 2.0), ("a", None, 3.0), ("b", dt.date(2024, 2, 28), 4.0)], schema) \
        .write.parquet(landing)
    history = spark.createDataFrame([("a", dt.date(2024, 1, 2), 9.0), ("b", dt.date(2010, 1, 1), 9.0), ("a", None, 9.0)], schema)
    incremental.ingest_prices(spark, landing, schema, target=target, checkpoint=offsets, history=history)
    assert [(r[0], r[2]) for r in rows(incremental.read_increments(spark, target, schema))] == [("a", 1.0), ("b", 4.0)]


def test_unreadable_increments_are_an_error(spark, tmp_path):
    bad = tmp_path / "target"
    bad.mkdir()
    (bad / "part-0.parquet").write_text("no parquet")
    schema = spark.createDataFrame([], "permaTicker string").schema
    with pytest.raises(Exception, match="(?i)parquet"):
        incremental.read_increments(spark, str(bad), schema).count()


def test_reports_return_every_row_unless_asked(spark):
    table = spark.createDataFrame([(f"P{i:03}", f"T{i:03}", DAY, 1.0) for i in range(60)], "permaTicker string, ticker string, p_date date, close double")
    assert research.screen(table).count() == 60 and research.screen(table, limit=20).count() == 20


def test_latest_date_reads_the_last_year_only(spark):
    path = work_folder(spark, "by-year")
    table = spark.createDataFrame([(f"P{y}", dt.date(y, 3, 1)) for y in range(2010, 2020)], "permaTicker string, p_date date")
    table.withColumn("p_year", F.year("p_date")).write.partitionBy("p_year").parquet(path)
    latest = research.on_latest_date(spark.read.parquet(path))
    assert rows(latest) == [("P2019", dt.date(2019, 3, 1))]
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == plan.count("PartitionFilters: [isnotnull(p_year") >= 1
    only_old = spark.read.parquet(path).where("p_year <= 2012")
    assert rows(research.on_latest_date(only_old)) == [("P2012", dt.date(2012, 3, 1))]


def test_audits_of_what_is_absent(spark):
    prices = spark.createDataFrame([("a", DAY), ("a", dt.date(2024, 1, 5)), ("b", DAY), ("b", None), ("c", dt.date(2024, 1, 3))], "permaTicker string, p_date date")
    assert rows(audits.trailing_gaps(prices)) == [("b", DAY, 2), ("c", dt.date(2024, 1, 3), 1)]
    assert rows(audits.lost_securities(prices, prices.where("permaTicker = 'a'"))) == [("b", DAY), ("c", dt.date(2024, 1, 3))]


def test_terminal_statuses_by_column(spark):
    registry = spark.createDataFrame([("failed_no_xbrl", "failed_no_xbrl", "1"), ("failed_404", None, "1")], "status_prices string, status_fundamentals string, cik string")
    assert rows(completeness(registry)) == [(1, 1)]
