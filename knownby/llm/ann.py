"""Approximate nearest neighbours by several shifted Hilbert curves.

Each curve projects all vectors onto a few random directions, shifts them by a random offset and orders them
by Hilbert key. A direction's cells follow quantiles of all rows' projections, so a few very long vectors fall
into border cells and do not crowd the others into one. Spark range-partitions the rows by (curve, key, vec_id), so ties and copies spread over
partitions; a row's rank is its place in its partition plus the rows of the partitions before. A query looks
at a window of ranks on both sides of its own place, on every curve; windows are cut into blocks of rows, so
a task holds one block and the queries that want it and returns each query's nearest of the block. The
lists of all blocks and curves merge into the final ranking, with exact distances of the original vectors.

The window is a share of all rows, since a fixed one would find less the more rows there are. ``WINDOW`` was
chosen by recall against brute force on vectors without structure, the hardest case (see README).

Defined results: vectors that are null, empty, zero, of another length than most, or hold null or non-finite
components take no part, nor do rows without vec_id. Rows that repeat a vec_id count once, with the nearest.
Fewer candidates than k are returned all. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knownby.llm.common import store

CURVES, DIRECTIONS, BITS = 8, 8, 6
#: Ranks a query looks at on either side: this share of all rows, and at least MIN_WINDOW.
WINDOW, MIN_WINDOW = 0.1, 256
#: Rows of a block.
BLOCK = 2_048


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert index of integer grid cells (rows), by Gray-code transposition of their coordinates."""
    x = cells.astype(np.int64).copy()
    dims = x.shape[1]
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for i in range(dims):
            turned = (x[:, i] >> level & 1).astype(bool)
            swap = np.where(turned, 0, (x[:, 0] ^ x[:, i]) & low)
            x[:, 0] ^= np.where(turned, low, swap)
            x[:, i] ^= swap if i else 0
    for i in range(1, dims):
        x[:, i] ^= x[:, i - 1]
    fix = np.zeros(len(x), np.int64)
    for level in range(bits - 1, 0, -1):
        fix ^= np.where(x[:, -1] >> level & 1, (1 << level) - 1, 0)
    x ^= fix[:, None]
    key = np.zeros(len(x), np.int64)
    for level in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | (x[:, i] >> level & 1)
    return key


def usable(vector: Column) -> Column:
    """Neither null nor zero, all components finite."""
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return vector.isNotNull() & ~bad & F.exists(vector, lambda v: v != 0)


def _frames(dim: int, curves: int, seed: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Directions and offset of each curve."""
    rng = np.random.default_rng(seed)
    width = min(DIRECTIONS, dim)
    return [(np.linalg.qr(rng.normal(size=(dim, width)))[0], rng.uniform(0, 1, width)) for _ in range(curves)]


def _borders(rows: DataFrame, frames: list) -> np.ndarray:
    """Quantiles of the projections of all rows: a row for each direction of each curve."""
    directions = np.hstack([d for d, _ in frames])

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                y = np.stack(batch["v"].to_numpy(zero_copy_only=False)) @ directions
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in y.T], [f"y{i}" for i in range(y.shape[1])])

    count = directions.shape[1]
    projected = rows.select("v").mapInArrow(project, ", ".join(f"y{i} double" for i in range(count)))
    shares = [i / (1 << BITS) for i in range((1 << BITS) + 1)]
    found = projected.agg(*[F.percentile_approx(f"y{i}", shares, 1_000).alias(f"y{i}") for i in range(count)]).first()
    return np.array(list(found))


def _curve_keys(frames: list, borders: np.ndarray):
    width = len(frames[0][1])
    places = np.linspace(0, 1, borders.shape[1])

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.stack(batch["v"].to_numpy(zero_copy_only=False))
                for curve, (directions, shift) in enumerate(frames):
                    share = np.stack([np.interp(y, borders[curve * width + i], places) for i, y in enumerate((x @ directions).T)], axis=1)
                    cells = np.clip(((share + shift) / 2 * (1 << BITS)).astype(np.int64), 0, (1 << BITS) - 1)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(x), curve, np.int32)), pa.array(hilbert_keys(cells, BITS)), batch["vec_id"], batch["v"]],
                        ["curve", "key", "vec_id", "v"])

    return keys


def _nearest(k: int):
    def search(key: tuple, rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(queries):
            x, ids = np.stack(rows["v"].to_numpy()), rows["vec_id"].to_numpy()
            for query_id, q in zip(queries["query_id"], queries["q"]):
                d = np.sqrt(np.square(x - q).sum(axis=1))
                d[ids == query_id] = np.inf
                take = np.flatnonzero(d <= np.partition(d, k - 1)[k - 1]) if len(d) > k else np.arange(len(d))
                take = take[np.isfinite(d[take])]
                take = take[np.lexsort((ids[take], d[take]))]
                _, first = np.unique(ids[take], return_index=True)  # copies of a row in one block
                take = take[np.sort(first)][:k]
                out.append(pd.DataFrame({"query_id": query_id, "vec_id": ids[take], "score": d[take]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    return search


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, curves: int = CURVES, window: float = WINDOW,
            min_window: int = MIN_WINDOW, block: int = BLOCK, seed: int = 7) -> DataFrame:
    """query_id, rank, vec_id, score of each query's k nearest; ``vectors`` has vec_id and embedding."""
    v = F.col("embedding").cast("array<double>")
    rows = vectors.where(F.col("vec_id").isNotNull()).select("vec_id", v.alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks")) \
        .where(usable(F.col("v"))).withColumn("dim", F.size("v"))
    empty = "query_id long, rank int, vec_id long, score double"
    most = rows.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()
    if most is None:
        return vectors.sparkSession.createDataFrame([], empty)
    rows = rows.where(F.col("dim") == most["dim"])
    frames = _frames(most["dim"], curves, seed)
    keyed = rows.select("vec_id", "v").mapInArrow(_curve_keys(frames, _borders(rows, frames)), "curve int, key long, vec_id long, v array<double>")
    ordered = store(keyed.repartitionByRange("curve", "key", "vec_id").sortWithinPartitions("curve", "key", "vec_id")
                    .withColumn("part", F.spark_partition_id())
                    .withColumn("place", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)), "hilbert-order")
    sizes = ordered.groupBy("curve", "part").agg(F.count("*").alias("n"), F.min("place").alias("first_place"))
    # A row for each curve and partition: the ranks before a partition, counted from the curve's start.
    starts = sizes.withColumn("before", F.expr("sum(n) OVER (PARTITION BY curve ORDER BY part ROWS UNBOUNDED PRECEDING) - n"))
    ranked = ordered.join(starts.select("curve", "part", "before", "first_place"), ["curve", "part"]) \
        .withColumn("pos", F.expr("before + place - first_place"))
    total = int(most["count"])
    reach = max(min_window, int(total * window))
    blocks = ranked.select("curve", F.expr(f"pos DIV {block}").alias("block"), "vec_id", "v")
    asked = ranked.join(rows.where("asks").select("vec_id").distinct(), "vec_id", "left_semi")
    wanted = asked.select(F.col("curve").alias("q_curve"), F.explode(F.expr(
        f"sequence(greatest(pos - {reach}, 0L) DIV {block}, least(pos + {reach}, {total - 1}L) DIV {block})")).alias("q_block"),
        F.col("vec_id").alias("query_id"), F.col("v").alias("q"))
    found = blocks.groupBy("curve", "block").cogroup(wanted.groupBy("q_curve", "q_block")) \
        .applyInPandas(_nearest(k), "query_id long, vec_id long, score double")
    best = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    place = F.expr("CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INT)")
    return best.withColumn("rank", place).where(f"rank <= {k}").select("query_id", "rank", "vec_id", "score")
