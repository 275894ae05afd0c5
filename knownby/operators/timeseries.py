"""Ordered per-key operators: backward as-of join, forward fill, row lags and strict rolling stats.

Group sizes. The window forms put one key's axis into one task, which is bounded when the axis holds
at most one row per calendar day (see ``operators.dedupe.daily_axis``). For axes without that bound
(intraday stamps, duplicated bars) the ``segment_days`` forms and ``in_chunks`` split a key into
slices and carry the state across slice borders, with identical results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from knownby.functions.cleaning import non_zero

_SEGMENT = "_segment"


def axis(by: Sequence[str], order: Sequence[str | Column]) -> WindowSpec:
    return W.partitionBy(*by).orderBy(*order)


def so_far(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(W.unboundedPreceding, W.currentRow)


def last_known(value: Column, window: WindowSpec) -> Column:
    """Most recent non-null value up to and including the current row."""
    return F.last(value, ignorenulls=True).over(so_far(window))


def lag_return(value: Column, rows: int, window: WindowSpec) -> Column:
    """Relative change against the value ``rows`` rows earlier; null when that is zero or absent."""
    return value / non_zero(F.lag(value, rows).over(window)) - 1


def strict_rolling(value: Column, rows: int, window: WindowSpec, stat=F.avg) -> Column:
    """``stat`` over the last ``rows`` rows; null until all of them hold a value."""
    frame = window.rowsBetween(1 - rows, W.currentRow)
    return F.when(F.count(value).over(frame) == rows, stat(value).over(frame))


def rolling_stddev(df: DataFrame, value: str, frames: dict[str, int], window: WindowSpec) -> DataFrame:
    """Add sample deviations of ``value`` over the last rows, ``frames`` giving their names and numbers (2 at least).

    As ``strict_rolling``: null until all rows of a frame hold a value. A frame is joined from equal shorter ones
    by their means and squared deviations, 30 rows from 5, 15 and 90 from 30, so that a row costs a few lags and
    not an update for each row of the frame; nothing is added up over more rows than the frame holds.
    """
    out = df.withColumns({"_mean_1": F.col(value), "_dev_1": F.when(F.col(value).isNotNull(), F.lit(0.0))})
    known = [1]
    for name, rows in sorted(frames.items(), key=lambda frame: frame[1]):
        have = max(n for n in known if rows % n == 0)
        while have < rows:
            times = next(t for t in (5, 3, 2, *range(7, rows + 1)) if rows // have % t == 0)
            part = F.struct(f"_mean_{have}", f"_dev_{have}")
            parts = [f"_part_{j}" for j in range(1, times)]
            out = out.withColumns({c: F.lag(part, j * have).over(window) for j, c in enumerate(parts, 1)})
            own = F.col(f"_mean_{have}")
            means = [own, *[F.col(f"{c}._mean_{have}") for c in parts]]
            devs = [F.col(f"_dev_{have}"), *[F.col(f"{c}._dev_{have}") for c in parts]]
            mean = own + sum((m - own for m in means[1:]), F.lit(0.0)) / times
            out = out.withColumn(f"_mean_{have * times}", mean)
            apart = sum((F.pow(m - F.col(f"_mean_{have * times}"), 2) for m in means), F.lit(0.0))
            out = out.withColumn(f"_dev_{have * times}", sum(devs, F.lit(0.0)) + have * apart).drop(*parts)
            have *= times
            known.append(have)
        out = out.withColumn(name, F.sqrt(F.col(f"_dev_{rows}") / (rows - 1)))
    return out.drop(*[f"_{kind}_{n}" for n in known for kind in ("mean", "dev")])


def day_gap(day: Column, rows: int, window: WindowSpec) -> Column:
    return F.date_diff(day, F.lag(day, rows).over(window))


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on ``keys`` in which a null key meets a null key."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = [left[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys]
    return left.join(renamed, same).drop(*[f"_r_{k}" for k in keys])


def _segment_of(day: Column, days: int) -> Column:
    return F.floor(F.unix_date(day.cast("date")) / days).cast("int")


def asof_join(left: DataFrame, right: DataFrame, *, by: Sequence[str], left_on: str, right_on: str,
              values: Sequence[str], segment_days: int | None = None) -> DataFrame:
    """Give every left row the ``values`` of the latest right row with ``right_on <= left_on``.

    Both sides are tagged and unioned, so one shuffle on ``by`` and one sort do the join; nothing is
    paired up. The whole right row is taken, inner nulls included. ``right`` holds at most one row
    per (by, right_on). With ``segment_days`` the key is split into day ranges and every range opens
    with the right row that was current when it began.
    """
    by = list(by)
    left_columns = left.columns
    state = F.struct(*[F.col(v) for v in values])
    lhs = left.select(*by, F.col(left_on).alias("_at"), F.lit(1).alias("_side"),
                      F.struct(*[F.col(c) for c in left_columns]).alias("_row"))
    rhs = right.select(*by, F.col(right_on).alias("_at"), F.lit(0).alias("_side"),
                       state.alias("_state"))
    keys = by
    if segment_days is not None:
        keys = [*by, _SEGMENT]
        lhs = lhs.withColumn(_SEGMENT, _segment_of(F.col("_at"), segment_days))
        rhs = rhs.withColumn(_SEGMENT, _segment_of(F.col("_at"), segment_days))
        # Per slice: did the left side use it, and what was its last right row?
        slices = (
            lhs.select(*keys, "_at", "_side", F.lit(None).cast(rhs.schema["_state"].dataType)
                       .alias("_state"))
            .unionByName(rhs)
            .groupBy(*keys)
            .agg(F.max("_side").alias("_used"),
                 F.max_by("_state", F.when(F.col("_side") == 0, F.col("_at"))).alias("_closing"))
        )
        before = axis(by, [_SEGMENT]).rowsBetween(W.unboundedPreceding, -1)
        openings = (
            slices.withColumn("_state", F.last("_closing", ignorenulls=True).over(before))
            .where((F.col("_used") == 1) & F.col("_state").isNotNull())
            .select(*keys, F.lit(None).cast(rhs.schema["_at"].dataType).alias("_at"),
                    F.lit(-1).alias("_side"), "_state")
        )
        rhs = rhs.unionByName(openings)
    merged = lhs.unionByName(rhs, allowMissingColumns=True)
    current = last_known(F.col("_state"), axis(keys, ["_at", "_side"]))
    return (
        merged.withColumn("_state", current)
        .where(F.col("_side") == 1)
        .select(*[F.col(f"_row.`{c}`").alias(c) for c in left_columns],
                *[F.col(f"_state.`{v}`").alias(v) for v in values])
    )


def forward_fill(df: DataFrame, *, by: Sequence[str], order: str, columns: Sequence[str],
                 segment_days: int | None = None) -> DataFrame:
    """Replace nulls in ``columns`` by the key's latest earlier non-null value along ``order``."""
    by = list(by)
    if segment_days is None:
        window = axis(by, [order])
        return df.withColumns({c: last_known(F.col(c), window) for c in columns})
    keys = [*by, _SEGMENT]
    cut = df.withColumn(_SEGMENT, _segment_of(F.col(order), segment_days))
    closing = cut.groupBy(*keys).agg(*[
        # The order stands in a struct, so that a row without a day counts, as the first one.
        F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.struct(order))).alias(f"_carry_{c}")
        for c in columns
    ])
    before = axis(by, [_SEGMENT]).rowsBetween(W.unboundedPreceding, -1)
    carry = closing.select(*keys, *[
        F.last(f"_carry_{c}", ignorenulls=True).over(before).alias(f"_carry_{c}") for c in columns
    ])
    window = axis(keys, [order])
    filled = _null_safe_join(cut, carry, keys).withColumns({
        c: F.coalesce(last_known(F.col(c), window), F.col(f"_carry_{c}")) for c in columns
    })
    return filled.select(*df.columns)


def in_chunks(df: DataFrame, *, by: Sequence[str], order: str, lookback: int,
              chunk_rows: int = 4096) -> DataFrame:
    """Split every key into slices of about ``chunk_rows`` rows for row-count windows.

    Adds ``_chunk`` and ``_own``: compute windows over (by, _chunk), then keep ``_own`` rows. A month
    of a key goes to the slice its starting position falls in, and also to every later slice that
    can reach back into it within ``lookback`` rows, so lags and rolling frames are exact. Positions
    come from monthly row counts; the full rows are never numbered as one group.
    """
    by = list(by)
    bucket = F.trunc(F.col(order).cast("date"), "month")
    months = df.groupBy(*by, bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = axis(by, ["_bucket"]).rowsBetween(W.unboundedPreceding, -1)
    start = F.coalesce(F.sum("_rows").over(earlier), F.lit(0))
    slices = months.withColumn("_start", start).select(
        *by, "_bucket",
        F.floor(F.col("_start") / chunk_rows).alias("_first"),
        F.floor((F.col("_start") + F.col("_rows") - 1 + lookback) / chunk_rows).alias("_last"),
    )
    return (
        _null_safe_join(df.withColumn("_bucket", bucket), slices, [*by, "_bucket"])
        .withColumn("_chunk", F.explode(F.sequence("_first", "_last")))
        .withColumn("_own", F.col("_chunk") == F.col("_first"))
        .drop("_bucket", "_first", "_last")
    )
