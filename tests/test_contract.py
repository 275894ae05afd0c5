"""Every registered query against its SQL counterpart, over whole tables of the smallest scale."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from knownby.contract.queries import queries as engine_queries
from tests.check_contract import compare, oracle_connection

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(engine_queries()) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(engine_queries()))
def test_query_equals_sql(spark, con, name):
    out = compare(spark, con, name, SF_DIR)
    assert out["bad"] == 0, out["sample"]


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["permaTicker", "ticker", "p_date", "close", "mkt_cap", "pe_ratio"]
    assert df.where("pe_ratio IS NOT NULL").count() > 0
