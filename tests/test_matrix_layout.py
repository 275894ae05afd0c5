"""The stored daily table by year and bucket: a refresh leaves untouched buckets' files alone."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from knownby.contract import inputs as I
from knownby.contract.queries import _CUT
from knownby.sources import sinks
from knownby.streaming import incremental

SF_DIR = "/root/testdata/sf0.001"


def files(path):
    out = {}
    for root, _, names in os.walk(path):
        part = os.path.relpath(root, path)
        if part.startswith("p_year="):
            out[part] = sorted(n for n in names if n.endswith(".parquet"))
    return out


def test_refresh_rewrites_only_touched_buckets(spark, tmp_path):
    prices, facts, meta = I.prices(spark, SF_DIR), I.facts(spark, SF_DIR), I.meta(spark, SF_DIR)
    path = str(tmp_path / "matrix")
    old = (prices.where(F.col("p_date") < _CUT), facts.where(F.col("filed_date") < _CUT))
    sinks.write_matrix(incremental.build_matrix(*old, meta, I.OPTIONS), path)
    before = files(path)
    # one security gets a new bar: only its bucket, from that bar's year on, is rewritten
    one = prices.where(F.col("p_date") >= _CUT).orderBy("permaTicker", "p_date").limit(1)
    perma, day = one.first()["permaTicker"], one.first()["p_date"]
    scope = incremental.rebuild_scope(one, None, meta)
    fresh = incremental.rebuilt_rows(scope, prices.where((F.col("p_date") < _CUT) | (F.col("p_date") == day)),
                                     old[1], meta, I.OPTIONS)
    incremental.refresh_matrix(path, scope, fresh)
    after = files(path)
    bucket = spark.range(1).select(sinks.matrix_bucket(F.lit(perma))).first()[0]
    touched = {p for p in after if p.endswith(f"/p_bucket={bucket}") and int(p.split("/")[0][7:]) >= day.year}
    assert touched and all(after[p] != before.get(p) for p in touched)
    assert all(after[p] == names for p, names in before.items() if p not in touched)
    rows = sinks.security_rows(spark, path, perma)
    assert rows.where(F.col("p_date") == day).count() == 1
    assert rows.select("permaTicker").distinct().count() == 1


def test_lookup_reads_one_bucket(spark, tmp_path):
    path = str(tmp_path / "matrix")
    sinks.write_matrix(I.built_matrix(spark, SF_DIR), path)
    perma = sinks.read_matrix(spark, path).select("permaTicker").first()[0]
    plan = sinks.security_rows(spark, path, perma)._jdf.queryExecution().executedPlan().toString()
    assert "p_bucket" in plan and "PartitionFilters" in plan
    whole = sinks.read_matrix(spark, path).where(F.col("permaTicker") == perma)
    assert sorted(map(tuple, sinks.security_rows(spark, path, perma).collect())) == sorted(map(tuple, whole.collect()))
