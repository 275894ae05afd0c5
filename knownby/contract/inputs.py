"""Shared inputs of the registered queries, stored once per application as silver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from knownby.operators.facts import clean_facts
from knownby.options import EngineOptions
from knownby.plans.matrix import build_matrix
from knownby.schemas import FACTS
from knownby.session import work_folder
from knownby.sources import driver_tables as D
from knownby.sources.sinks import read_matrix, write_matrix, write_table

# The adapter groups by (security, day), so its bars are unique already.
OPTIONS = EngineOptions(unique_bars=True)
_STORED: dict[tuple[str, str, str], str] = {}


def _stored(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STORED:
        path = work_folder(spark, name)
        write(path)
        _STORED[key] = path
    return _STORED[key]


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.prices(spark, sf_dir)


def meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.meta(spark, sf_dir)


def raw_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.raw_facts(spark, sf_dir)


def actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.adapter(spark, sf_dir, D.FX_ACTIONS)


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver facts table: cleaned once, then read by every plan that needs it."""
    path = _stored(spark, sf_dir, "facts",
                   lambda p: write_table(clean_facts(raw_facts(spark, sf_dir)), p))
    return spark.read.schema(FACTS).parquet(path)


def built_matrix(spark: SparkSession, sf_dir: str, options: EngineOptions = OPTIONS) -> DataFrame:
    return build_matrix(prices(spark, sf_dir), facts(spark, sf_dir), meta(spark, sf_dir), options)


def matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored daily table the research reports and audits read."""
    path = _stored(spark, sf_dir, "matrix",
                   lambda p: write_matrix(built_matrix(spark, sf_dir), p))
    return read_matrix(spark, path)


def rounded(df: DataFrame, **places: int) -> DataFrame:
    """Round the named columns: sums of doubles taken in another order differ in their last bits.

    Everything else is compared as computed.
    """
    return df.withColumns({c: F.round(c, n) for c, n in places.items()})
