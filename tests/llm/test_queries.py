"""The registered queries over the smallest tables: SQL counterparts, and the pipeline by brute force."""

from __future__ import annotations

import hashlib
from collections import Counter

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from knownby.llm import quality
from knownby.llm import queries as llm
from knownby.llm.common import table
from tests.check_contract import compare, oracle_connection
from tests.llm.test_operators import near_brute, norm

SF_DIR = "/root/testdata/sf0.001"


def test_all_are_registered():
    assert {*llm.queries(), "pipeline"} <= set(contract.queries()) and len(llm.queries()) == 13


@pytest.mark.parametrize("name", sorted(llm.oracles()))
def test_query_equals_sql(spark, name):
    out = compare(spark, oracle_connection(SF_DIR), name, SF_DIR)
    assert out["bad"] == 0, out["sample"]


def test_pipeline(spark):
    docs = table(spark, SF_DIR, "documents")
    rows = {r["doc_id"]: r for r in docs.collect()}
    model = quality.train(docs, table(spark, SF_DIR, "labels"))
    good = {r["doc_id"] for r in quality.quality_scores(docs, model).where("predicted = 1").collect()}
    first = {}
    for i in sorted(good):
        first.setdefault(norm(rows[i]["text"]), i)
    alone = [i for i, _, _, kept in near_brute([(i, rows[i]["text"]) for i in sorted(first.values())]) if kept]
    mixed = {r["doc_id"]: r["copies"] for r in llm.mixing.mixture(docs.where(docs.doc_id.isin(alone)), llm.mix_levels(), llm.MIX_WEIGHTS).collect()}
    got = corpus_pipeline.run(spark, SF_DIR).collect()
    assert Counter(r["doc_id"] for r in got) == Counter({i: n for i, n in mixed.items() if n})
    assert all(r["decoded_sha256"] == hashlib.sha256(rows[r["doc_id"]]["text"].encode()).hexdigest() for r in got)
