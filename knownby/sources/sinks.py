"""Writers: silver tables, the partitioned daily table and research exports."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from knownby.schemas import MATRIX


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)


def check_contract(df: DataFrame) -> DataFrame:
    """The daily table in contract order; raises when a column is missing or of another type."""
    found = {f.name: f.dataType for f in df.schema.fields}
    wrong = [f"{f.name}: {found.get(f.name)}" for f in MATRIX.fields if found.get(f.name) != f.dataType]
    if wrong:
        raise ValueError("daily table breaks its contract: " + ", ".join(wrong))
    return df.select(*MATRIX.names)


#: Hash buckets of permaTicker inside each year of the stored daily table. Fixed for a table's life:
#: a refresh rewrites only the (year, bucket) folders of the securities it touches.
MATRIX_BUCKETS = 16


def matrix_bucket(perma_ticker: Column) -> Column:
    """The storage bucket of a security: a stable hash of its permanent id."""
    return F.pmod(F.xxhash64(perma_ticker), F.lit(MATRIX_BUCKETS)).cast("int")


def write_matrix(matrix: DataFrame, path: str, dynamic: bool = False) -> None:
    """Store the daily table by year and bucket of security, sorted by security and day inside each file.

    The rebalance lets adaptive execution size the files and split a heavy year over several tasks.
    ``dynamic`` replaces only the (year, bucket) folders present in ``matrix``; all other files stay as
    they are, names included.
    """
    (
        check_contract(matrix).withColumn("p_year", F.year("p_date"))
        .withColumn("p_bucket", matrix_bucket(F.col("permaTicker")))
        .hint("rebalance", "p_year", "p_bucket")
        .sortWithinPartitions("p_year", "p_bucket", "permaTicker", "p_date")
        .write.mode("overwrite").option("compression", "zstd")
        .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
        .partitionBy("p_year", "p_bucket").parquet(path)
    )


def read_matrix(spark: SparkSession, path: str, with_bucket: bool = False) -> DataFrame:
    """The stored daily table, ``p_year`` last. The schema is the contract; no footer is read for it.

    ``with_bucket`` keeps the ``p_bucket`` folder column, for reads pruned to some securities' buckets.
    """
    stored = spark.read.schema(T.StructType([*MATRIX.fields, T.StructField("p_year", T.IntegerType()),
                                             T.StructField("p_bucket", T.IntegerType())])).parquet(path)
    return stored if with_bucket else stored.drop("p_bucket")


def security_rows(spark: SparkSession, path: str, perma_ticker: str) -> DataFrame:
    """One security's stored rows, read from its bucket's folders only."""
    bucket = spark.range(1).select(matrix_bucket(F.lit(perma_ticker))).first()[0]
    return read_matrix(spark, path, with_bucket=True) \
        .where((F.col("p_bucket") == bucket) & (F.col("permaTicker") == perma_ticker)).drop("p_bucket")


def export_history(matrix: DataFrame, ticker: str, path: str) -> None:
    """One security's rows as CSV with a header."""
    matrix.where(F.col("ticker") == ticker).drop("p_year").write.mode("overwrite").csv(path, header=True)


def research_extract(matrix: DataFrame, *, start: dt.date | None = None,
                     columns: Sequence[str] = (), min_adv: float | None = None) -> DataFrame:
    """Rows from ``start`` on with at least ``min_adv`` traded per day; ids plus chosen columns."""
    rows = matrix
    if start is not None:
        rows = rows.where(F.col("p_date") >= F.lit(start))
        if "p_year" in matrix.columns:
            rows = rows.where(F.col("p_year") >= start.year)
    if min_adv is not None:
        rows = rows.where(F.col("adv_20d") >= min_adv)
    ids = ["permaTicker", "ticker", "p_date"]
    return rows.select(*ids, *[c for c in columns if c not in ids])


def export_research(extract: DataFrame, path: str) -> None:
    write_table(extract, path)


def as_json_records(df: DataFrame) -> DataFrame:
    """Each row as one JSON text, nulls included, for machine consumers."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("record"))
