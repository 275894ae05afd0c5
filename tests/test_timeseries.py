from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from knownby.operators.dedupe import daily_axis, union_dedupe
from knownby.operators.timeseries import (
    asof_join,
    axis,
    forward_fill,
    in_chunks,
    lag_return,
    rolling_stddev,
    strict_rolling,
)

START = dt.date(2010, 1, 1)


def _random_sides(seed=3):
    rng = random.Random(seed)
    left = [(k, START + dt.timedelta(days=rng.randrange(2500))) for k in "ab" for _ in range(300)]
    right = {(k, START + dt.timedelta(days=rng.randrange(2500))): rng.choice([None, 1.5, 2.5])
             for k in "ab" for _ in range(60)}
    return left, right


def _brute_force(left, right):
    out = []
    for k, d in left:
        known = [(day, v) for (key, day), v in right.items() if key == k and day <= d]
        out.append((k, d, *(max(known, key=lambda x: x[0]) if known else (None, None))))
    return sorted(out, key=str)


def test_asof_equals_brute_force_whole_and_segmented(spark):
    left, right = _random_sides()
    lhs = spark.createDataFrame(left, "k string, d date")
    rhs = spark.createDataFrame([(k, d, v) for (k, d), v in right.items()], "k string, f date, v double")
    for days in (None, 10, 200):
        out = asof_join(lhs, rhs, by=["k"], left_on="d", right_on="f", values=["f", "v"],
                        segment_days=days)
        assert sorted(map(tuple, out.collect()), key=str) == _brute_force(left, right)


def test_forward_fill_segmented_equals_whole(spark):
    rng = random.Random(5)
    rows = [(k, START + dt.timedelta(days=i), rng.choice([None, None, None, float(i)]))
            for k in "ab" for i in range(900) if rng.random() < 0.4]
    df = spark.createDataFrame(rows, "k string, d date, v double")
    whole = forward_fill(df, by=["k"], order="d", columns=["v"])
    cut = forward_fill(df, by=["k"], order="d", columns=["v"], segment_days=30)
    assert sorted(map(tuple, whole.collect()), key=str) == sorted(map(tuple, cut.collect()), key=str)


def test_chunks_reproduce_row_windows_for_a_hot_key(spark):
    rng = random.Random(9)
    days = [START + dt.timedelta(days=i) for i in range(6000)]
    rows = [("hot", d, rng.random()) for d in days]
    rows += [(f"k{i}", days[rng.randrange(6000)], 1.0) for i in range(50)]
    df = spark.createDataFrame(rows, "k string, d date, v double").dropDuplicates(["k", "d"])

    def measure(frame, keys):
        w = axis(keys, ["d"])
        return frame.withColumns({"lag": lag_return(F.col("v"), 252, w),
                                  "mean": strict_rolling(F.col("v"), 20, w)})

    whole = measure(df, ["k"]).select("k", "d", "lag", "mean")
    cut = measure(in_chunks(df, by=["k"], order="d", lookback=252, chunk_rows=300), ["k", "_chunk"])
    chunks = cut.where("_own").groupBy("_chunk").count()
    assert chunks.agg(F.max("count")).first()[0] < 400
    assert sorted(map(tuple, whole.collect())) == sorted(
        map(tuple, cut.where("_own").select("k", "d", "lag", "mean").collect()))


def test_strict_rolling_needs_a_full_frame(spark):
    rows = [(START + dt.timedelta(days=i), None if i == 30 else 2.0) for i in range(60)]
    df = spark.createDataFrame(rows, "d date, v double")
    out = df.select("d", strict_rolling(F.col("v"), 20, axis([], ["d"])).alias("m")).orderBy("d").collect()
    means = [r.m for r in out]
    assert means[18] is None and means[19] == 2.0
    assert means[29] == 2.0 and means[30:50] == [None] * 20 and means[50] == 2.0


def test_lag_return_guards_zero(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 5.0), (3, 10.0)], "d int, v double")
    out = df.select(lag_return(F.col("v"), 1, axis([], ["d"])).alias("r"), "d").orderBy("d").collect()
    assert [r.r for r in out] == [None, None, 1.0]


def test_daily_axis_folds_a_hot_day(spark):
    bars = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("s"), "id")).alias(
            "permaTicker"),
        F.lit(START).alias("p_date"), (F.col("id") % 7).cast("double").alias("close"))
    out = daily_axis(bars)
    assert out.where("permaTicker = 'hot'").collect() == [("hot", START, 6.0)]
    assert out.count() == bars.select("permaTicker").distinct().count()


def test_union_dedupe_prefers_the_earlier_source(spark):
    a = spark.createDataFrame([("x", 1, 1.0)], "k string, d int, v double")
    b = spark.createDataFrame([("x", 1, 9.0), ("x", 2, 2.0)], "k string, d int, v double")
    assert sorted(map(tuple, union_dedupe([a, b], ["k", "d"]).collect())) == [
        ("x", 1, 1.0), ("x", 2, 2.0)]


def test_rolling_stddev_equals_the_frame_form(spark):
    """Nulls, NaN, a run of equal values and a large value that leaves the frame again."""
    values = [((i * 37) % 11 - 5) / 7 for i in range(60)] + [0.1] * 40 + [1e9] + [0.1] * 60
    rows = [(k, i, None if i in (20, 70) and k == "a" else float("nan") if i == 50 and k == "b" else v)
            for k in "ab" for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "k string, at int, v double")
    w = axis(["k"], ["at"])
    frames = {"s30": 30, "s90": 90, "s7": 7, "s2": 2}
    got = rolling_stddev(df, "v", frames, w).withColumns(
        {f"e_{n}": strict_rolling(F.col("v"), r, w, F.stddev_samp) for n, r in frames.items()})
    assert got.columns == ["k", "at", "v", *sorted(frames, key=frames.get), *[f"e_{n}" for n in frames]]
    for row in got.collect():
        for name in frames:
            mine, its = row[name], row[f"e_{name}"]
            assert (mine is None) == (its is None), (row, name)
            if mine is not None:
                assert (mine != mine and its != its) or abs(mine - its) <= 1e-9 * max(1, abs(its)), (row, name)
    equal = got.where("at between 90 and 99").agg(F.max("s30")).first()[0]
    assert equal == 0
    assert "stddev" not in rolling_stddev(df, "v", frames, w)._jdf.queryExecution().optimizedPlan().toString()
