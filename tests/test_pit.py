from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from knownby.operators import pit
from knownby.options import EngineOptions

FACTS = ("cik string, tag string, val double, end_date date, filed_date date, fp string, "
         "is_fy boolean, is_quarter boolean")


def day(text):
    return dt.date.fromisoformat(text)


def quarter(end, filed, val, tag="net_income", cik="1", fp="Unknown"):
    return (cik, tag, val, day(end), day(filed), fp, False, True)


def annual(end, filed, val, tag="net_income", cik="1", fp="FY"):
    return (cik, tag, val, day(end), day(filed), fp, True, False)


def instant(end, filed, val, tag, cik="1", fp="Unknown"):
    return (cik, tag, val, day(end), day(filed), fp, False, False)


RESTATED = [
    quarter("2020-03-31", "2020-05-01", 10.0), quarter("2020-06-30", "2020-08-01", 15.0),
    quarter("2020-09-30", "2020-11-01", 20.0), quarter("2020-12-31", "2021-03-01", 25.0),
    quarter("2020-03-31", "2021-03-15", 12.0),
]


def ttm(spark, rows, column="net_income_ttm", **options):
    out = pit.pit_ttm(spark.createDataFrame(rows, FACTS), EngineOptions(**options))
    return [r[0] for r in out.orderBy("cik", "f_date").select(column).collect()]


def test_restatement_golden(spark):
    assert ttm(spark, RESTATED) == [None, None, None, 70.0, 72.0]


def test_other_span_window(spark):
    assert ttm(spark, RESTATED, ttm_min_days=330, ttm_max_days=390) == [None] * 5


def test_period_gaps_golden(spark):
    ends = ["2019-12-31", "2020-03-31", "2020-06-30", "2020-09-30", "2020-12-31"]
    rows = [quarter(e, "2021-02-01", 1.0) for e in ends]
    out = pit.period_gaps(spark.createDataFrame(rows, FACTS)).orderBy("e_date").collect()
    assert [r.days_3 for r in out] == [None, None, None, 274, 275]
    assert [r.days_4 for r in out] == [None, None, None, None, 366]


def test_nulls_sum_to_zero_only_for_tags_seen(spark):
    rows = RESTATED[:4] + [quarter("2019-12-31", "2020-02-01", 7.0, tag="capex")]
    assert ttm(spark, rows, "capex_ttm")[-1] == 0.0
    assert ttm(spark, rows, "revenue_ttm")[-1] is None


def test_presence_is_not_taken_from_the_future(spark):
    rows = RESTATED + [quarter("2021-12-31", "2022-02-01", 7.0, tag="capex")]
    assert ttm(spark, rows, "capex_ttm")[:5] == [None] * 5


def test_restatement_replaces_the_whole_version(spark):
    rows = RESTATED[:4] + [quarter("2020-12-31", "2021-03-01", 4.0, tag="revenue"),
                           quarter("2020-12-31", "2021-04-01", 9.0, tag="revenue")]
    assert ttm(spark, rows, "revenue_ttm")[-2:] == [4.0, 9.0]
    assert ttm(spark, rows)[-2:] == [70.0, 45.0]  # the new version carries no income


def test_annual_overrides_and_newest_period(spark):
    rows = RESTATED[:4] + [annual("2020-12-31", "2021-03-01", 71.0),
                           instant("2020-09-30", "2021-03-01", 5.0, "equity"),
                           instant("2020-12-31", "2021-03-01", 900.0, "shares_outstanding"),
                           instant("2020-09-30", "2021-03-01", 950.0, "shares_outstanding")]
    state = pit.filing_state(spark.createDataFrame(rows, FACTS)).orderBy(F.desc("f_date")).first()
    assert state.net_income_ttm == 71.0 and state.net_income == 71.0 and state.net_income_fy == 71.0
    assert state.equity is None  # reported for an older period of the same filing
    assert state.shares_outstanding == 900.0 and state.shares_sec == 950.0


def _brute_force_ttm(rows):
    """The definition, spelled out: for one company and tag."""
    out = {}
    for filed in sorted({r[4] for r in rows}):
        latest = {}
        for r in sorted(rows, key=lambda r: r[4]):
            if r[4] <= filed:
                latest[r[3]] = r[2]
        ends = sorted(latest, reverse=True)[:4]
        ok = len(ends) == 4 and 265 <= (ends[0] - ends[-1]).days <= 285
        out[filed] = sum(latest[e] for e in ends) if ok else None
    return out


def test_bucketed_join_equals_definition(spark):
    rng = random.Random(7)
    ends = [day("2015-03-31") + dt.timedelta(days=round(91.3 * i)) for i in range(24)]
    rows, want = [], {}
    for cik in map(str, range(6)):
        own = {}
        for _ in range(90):
            end = rng.choice(ends)
            filed = end + dt.timedelta(days=rng.choice([20, 40, 45, 120, 400, 900]))
            own[(end, filed)] = (cik, "net_income", float(rng.randint(1, 99)), end, filed, "Unknown",
                                 False, True)
        rows += own.values()
        want.update({(cik, f): v for f, v in _brute_force_ttm(list(own.values())).items()})
    out = pit.pit_ttm(spark.createDataFrame(rows, FACTS)).select("cik", "f_date", "net_income_ttm")
    assert {(r[0], r[1]): r[2] for r in out.collect()} == want
    assert sum(v is not None for v in want.values()) > 50
