"""Incremental ingest with Structured Streaming, and the partial rebuild of the daily table.

Correctness rests on the business keys, never on a watermark: late filings and restatements are new
keys, repeated rows are known keys. Every micro-batch writes its own ``batch_id`` folder, so a retry
after a lost executor or driver replaces that folder instead of appending twice.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from knownby.functions.cleaning import normalize_cik
from knownby.operators.dedupe import last_row_per_key
from knownby.options import DEFAULT, EngineOptions
from knownby.plans.matrix import build_matrix
from knownby.sources.sinks import check_contract, matrix_bucket, read_matrix, write_matrix

PRICE_KEYS = ["permaTicker", "p_date"]
FACT_KEYS = ["cik", "tag", "end_date", "filed_date", "fp", "is_fy", "is_quarter"]


def _increments(spark: SparkSession, path: str, schema: T.StructType, batch_id: int) -> DataFrame:
    """Rows of all other batches."""
    return _stored(spark, path, schema).where(F.col("batch_id") != batch_id).drop("batch_id")


def _stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All batches with their ``batch_id``; an absent folder is an empty table, any other fault an error."""
    full = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], full)
    return spark.read.schema(full).parquet(path)


def _in_months(day: str, months: list[dt.date]) -> Column:
    """Whether ``day`` lies in one of these months; runs of months become one range, which scans can use."""
    found, start = F.lit(False), None
    ordered = sorted(months)
    for month, after in zip(ordered, [*ordered[1:], None]):
        start = start or month
        ends = (month.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
        if after != ends:
            found = found | ((F.col(day) >= F.lit(start)) & (F.col(day) < F.lit(ends)))
            start = None
    return found


def ingest(landing: DataFrame, *, history: DataFrame | None, target: str, checkpoint: str,
           keys: Sequence[str], day: str) -> None:
    """Append the landing stream's unseen keys to ``target``; runs until the landing is drained.

    ``history`` is never touched: it only supplies keys already known. The known keys read per batch
    are limited to the batch's own months of ``day``, so a late row does not widen the range to all since.
    """
    schema = landing.schema

    def append(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        months = [r[0] for r in batch.select(F.trunc(day, "month")).distinct().collect()]  # of the calendar
        if not months:
            return
        in_range = _in_months(day, [m for m in months if m is not None])
        if None in months:
            in_range = in_range | F.col(day).isNull()
        known = _increments(spark, target, schema, batch_id).where(in_range).select(*keys)
        if history is not None:
            known = known.unionByName(history.where(in_range).select(*keys))
        rest = [c for c in batch.columns if c not in keys]
        fresh = last_row_per_key(batch, keys, rest).join(
            known.withColumnsRenamed({k: f"_k_{k}" for k in keys}),
            [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys], "left_anti")
        fresh.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    query = (
        landing.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def landing_stream(spark: SparkSession, path: str, schema: T.StructType,
                   files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    return reader.parquet(path)


def ingest_prices(spark: SparkSession, landing: str, schema: T.StructType, *, target: str,
                  checkpoint: str, history: DataFrame | None = None,
                  files_per_batch: int | None = None) -> None:
    """New bars per (permaTicker, p_date); the original price history stays as it is."""
    ingest(landing_stream(spark, landing, schema, files_per_batch), history=history, target=target,
           checkpoint=checkpoint, keys=PRICE_KEYS, day="p_date")


def ingest_facts(spark: SparkSession, landing: str, schema: T.StructType, *, target: str,
                 checkpoint: str, history: DataFrame | None = None,
                 files_per_batch: int | None = None) -> None:
    """New fact versions; a restatement has its own filing date and so never replaces a row."""
    ingest(landing_stream(spark, landing, schema, files_per_batch), history=history, target=target,
           checkpoint=checkpoint, keys=FACT_KEYS, day="filed_date")


def read_increments(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """All rows ingested so far; none after an empty landing."""
    return _stored(spark, target, schema).drop("batch_id")


def rebuild_scope(new_prices: DataFrame | None, new_facts: DataFrame | None,
                  meta: DataFrame) -> DataFrame:
    """(permaTicker, since): securities with new input and the first day it can change.

    A fact changes nothing before its filing date, a bar nothing before its own day.
    """
    parts = []
    if new_prices is not None:
        parts.append(new_prices.groupBy("permaTicker").agg(F.min("p_date").alias("since")))
    if new_facts is not None:
        companies = new_facts.groupBy("cik").agg(F.min("filed_date").alias("since"))
        listed = meta.select("permaTicker", normalize_cik(F.col("cik")).alias("cik"))
        parts.append(listed.join(companies, "cik").select("permaTicker", "since"))
    scope = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return scope.groupBy("permaTicker").agg(F.min("since").alias("since"))


def rebuilt_rows(scope: DataFrame, prices: DataFrame, facts: DataFrame, meta: DataFrame,
                 options: EngineOptions = DEFAULT) -> DataFrame:
    """New rows of the affected securities from their first changed day on.

    Their whole history is read, because fills and one-year lags reach back; nothing else is.
    """
    touched = meta.join(scope.select("permaTicker"), "permaTicker", "left_semi")
    bars = prices.join(touched.select("permaTicker"), "permaTicker", "left_semi")
    companies = touched.select(normalize_cik(F.col("cik")).alias("cik")).distinct()
    own_facts = facts.join(companies, "cik", "left_semi")
    fresh = build_matrix(bars, own_facts, touched, options)
    return (
        fresh.join(scope, "permaTicker").where(F.col("p_date") >= F.col("since")).drop("since")
    )


def updated_matrix(stored: DataFrame, scope: DataFrame, fresh: DataFrame) -> DataFrame:
    """The stored rows that still hold, together with the rebuilt ones."""
    kept = (
        stored.join(scope, "permaTicker", "left")
        .where(F.col("since").isNull() | (F.col("p_date") < F.col("since")))
    )
    return check_contract(kept).unionByName(check_contract(fresh))


def refresh_matrix(path: str, scope: DataFrame, fresh: DataFrame) -> None:
    """Apply a rebuild to the stored table, replacing only the (year, bucket) folders it reaches.

    Years before the earliest change and buckets without a touched security are neither read nor
    written, so their files keep their names. The replaced folders are staged by the commit protocol and
    swapped in when the job succeeds. The list of touched buckets has at most ``MATRIX_BUCKETS`` entries.
    """
    spark = fresh.sparkSession
    first = scope.agg(F.min(F.year("since"))).first()[0]
    if first is None:
        return
    buckets = [r[0] for r in scope.select(matrix_bucket(F.col("permaTicker"))).distinct().collect()]
    stored = read_matrix(spark, path, with_bucket=True) \
        .where((F.col("p_year") >= first) & F.col("p_bucket").isin(buckets)).drop("p_bucket")
    write_matrix(updated_matrix(stored, scope, fresh), path, dynamic=True)
