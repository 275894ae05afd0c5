"""Session and scratch-folder helpers."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app: str = "knownby", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: A query's shuffle files go when it ends, not when the driver next collects its garbage; both sides of a join
#: may stay dealt out by some of its keys.
_LITTLE_DISK = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
                "spark.sql.requireAllClusterKeysForCoPartition": "false"}


@contextlib.contextmanager
def little_disk(spark: SparkSession) -> Iterator[None]:
    """Queries run inside shuffle less and keep no shuffle files; the settings are put back after."""
    before = {key: spark.conf.get(key, None) for key in _LITTLE_DISK}
    for key, value in _LITTLE_DISK.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


WORK_FOLDER = "spark.knownby.workDir"


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the one ``spark.knownby.workDir`` names.

    The setting has no default: driver and executors must all reach the folder, which only the caller
    can know.
    """
    root = spark.conf.get(WORK_FOLDER, None)
    if not root:
        raise ValueError(f"{WORK_FOLDER} must name a folder that driver and executors share")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
