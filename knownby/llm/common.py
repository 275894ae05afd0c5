"""Helpers the operators share: the shared folder, stored tables, inputs and word hashing."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession

#: The white space of the contracts, \x20 and \x09-\x0D, which is also what bytes.split() splits at.
SPACES = r"[\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which driver and executors share.

    Only a local session (tests on one machine) may leave the setting out; it then gets a folder here.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def store(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the shared folder and read again: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of an Arrow batch of whole texts: JVM and Python hold several copies of each batch at once.
TEXT_ROWS = 1_000
_ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Bytes of an Arrow batch of texts or ids; one longer row is a batch of its own.
BATCH_BYTES = 4_000_000
_ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """From now on the session hands rows to Python in batches of about ``BATCH_BYTES``.

    Operators that return a plan over Python call it. Spark reads the setting when the caller runs the plan, so it is
    not put back; a smaller one stays.
    """
    before = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(_ARROW_BYTES))
    if not 0 < before <= BATCH_BYTES:
        spark.conf.set(_ARROW_BYTES, str(BATCH_BYTES))


@contextlib.contextmanager
def text_batches(spark: SparkSession, rows: int = TEXT_ROWS) -> Iterator[None]:
    """Jobs run inside hand texts to Python in batches of ``rows`` rows at most; the setting is put back after."""
    before = spark.conf.get(_ARROW_ROWS)
    if not 0 < int(before) <= rows:
        spark.conf.set(_ARROW_ROWS, str(rows))
    try:
        yield
    finally:
        spark.conf.set(_ARROW_ROWS, before)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over a 64-bit word (uint64 in, uint64 out)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class WordHashes(dict):
    """Word bytes to a 64-bit hash, remembered; the memory is emptied when it grows past its bound."""

    def __init__(self, bound: int = 500_000):
        super().__init__()
        self.bound = bound

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.bound:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def utf8(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""
