"""Exact deduplication with an extendible-hash index on shared files.

Texts are equal when they are identical after each run of white space became one space. The key of a
text is the leading part of its SHA-256. A directory of 2**depth cells maps key prefixes to buckets; it
doubles while a bucket at full depth holds more distinct keys than its capacity. Rows are folded where
they are read (a hot text leaves one row per Arrow batch), then travel once to the task that owns their
bucket, a range of keys. The owner compares the bytes of rows with one key, gives every different text
its place in the key's chain, and writes the entries to the index files. Documents then look up their
entry by key and digest.

Defined results: null text counts as empty. ``keep_id`` is the smallest doc_id of the equal texts, null if
none has an id; a row without id stays only then. Repeated rows of the id that stays are all marked as kept;
``drop_copies`` leaves one of them. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knownby.llm.common import SPACES, store, text_batches

#: Distinct keys a bucket holds before it splits.
CAPACITY = 32_768
KEY_BITS = 60


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def _key(sha: Column, key_bits: int) -> Column:
    """The leading key_bits (60 at most) of a hexadecimal digest, as a long."""
    top = F.conv(F.substring(sha, 1, 15), 16, 10).cast("long")
    return F.shiftright(top, KEY_BITS - key_bits)


@dataclass
class Directory:
    """Global depth, and for every cell of 2**depth the bucket it points to."""

    key_bits: int
    depth: int
    cells: np.ndarray

    def bucket_of(self, keys: np.ndarray) -> np.ndarray:
        return self.cells[keys >> (self.key_bits - self.depth)]


def _cell_counts(keys: DataFrame, key_bits: int, depth: int) -> np.ndarray:
    cell = F.shiftright("key", key_bits - depth).alias("cell")
    found = keys.groupBy(cell).count().collect()  # 2**depth rows at most
    counts = np.zeros(1 << depth, np.int64)
    for row in found:
        counts[row["cell"]] = row["count"]
    return counts


def build_directory(keys: DataFrame, capacity: int = CAPACITY, key_bits: int = KEY_BITS) -> Directory:
    """Directory for a table of distinct keys, split until no bucket is overfull.

    Counts come from one grouped count at a depth a little finer than needed; deeper ones are fetched
    only if some prefix is still overfull there. The driver holds counts per cell, never keys.
    """
    total = keys.count()
    fine = min(key_bits, 2 + max(0, math.ceil(math.log2(max(1, total) / capacity))))
    while True:
        running = np.concatenate([[0], np.cumsum(_cell_counts(keys, key_bits, fine))])

        def held(depth: int, prefix: int) -> int:
            width = 1 << (fine - depth)
            return int(running[(prefix + 1) * width] - running[prefix * width])

        depth, cells = 0, [(0, 0)]
        while True:
            overfull = [(d, p) for d, p in set(cells) if held(d, p) > capacity and d < fine]
            if not overfull:
                break
            if any(d == depth for d, _ in overfull):  # the directory doubles
                depth, cells = depth + 1, [b for b in cells for _ in (0, 1)]
            split = set(overfull)
            for i, (d, p) in enumerate(cells):
                if (d, p) in split:
                    cells[i] = (d + 1, i >> (depth - d - 1))
        if fine == key_bits or all(held(d, p) <= capacity for d, p in set(cells)):
            break
        fine = min(key_bits, fine + 4)
    number = {b: n for n, b in enumerate(dict.fromkeys(cells))}
    return Directory(key_bits, depth, np.array([number[b] for b in cells], np.int64))


def _fold(directory: Directory):
    """Equal texts of a batch become one row; the text is compared, not its digest."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch]).group_by(["key", "sha", "norm"]).aggregate(
                [("doc_id", "min"), ("doc_id", "count", pc.CountOptions(mode="all"))])
            bucket = directory.bucket_of(rows["key"].to_numpy())
            out = pa.table({"bucket": pa.array(bucket, pa.int64()), "key": rows["key"], "sha": rows["sha"],
                            "norm": rows["norm"], "keep_id": rows["doc_id_min"],
                            "group_size": rows["doc_id_count"]})
            yield from out.to_batches()

    return fold


def build_index(docs: DataFrame, directory: Directory) -> DataFrame:
    """The entries: bucket, key, place in the chain, digest, smallest doc_id and number of rows."""
    key_bits = directory.key_bits
    rows = docs.select("doc_id", normalised(F.col("text")).alias("norm")) \
        .withColumn("sha", F.sha2("norm", 256)).withColumn("key", _key(F.col("sha"), key_bits))
    folded = rows.mapInArrow(_fold(directory), "bucket long, key long, sha string, norm string, "
                                               "keep_id long, group_size long")
    owned = folded.repartition("bucket").groupBy("bucket", "key", "norm", "sha").agg(
        F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    by_key = "row_number() OVER (PARTITION BY bucket, key ORDER BY keep_id, sha) - 1"
    chained = owned.select("bucket", "key", "sha", "keep_id", "group_size") \
        .withColumn("place", F.expr(by_key))
    with text_batches(docs.sparkSession):  # the fold needs no large batches: the owners fold what is left
        return store(chained.sortWithinPartitions("bucket", "key", "place"), "hash-index")


def exact_groups(docs: DataFrame, capacity: int = CAPACITY, key_bits: int = KEY_BITS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    sha = F.sha2(normalised(F.col("text")), 256)
    hashed = store(docs.select("doc_id", sha.alias("sha")).withColumn("key", _key(F.col("sha"), key_bits)),
                   "text-keys")
    directory = build_directory(hashed.select("key").distinct(), capacity, key_bits)
    index = build_index(docs, directory)
    found = hashed.join(index.select("key", "sha", "keep_id", "group_size"), ["key", "sha"])
    return found.select("doc_id", "keep_id", "group_size",
                        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                        F.col("sha").alias("text_sha256"))


def drop_copies(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns, one row for each different text."""
    groups = store(exact_groups(docs), "exact-groups")
    sha = F.sha2(normalised(F.col("text")), 256)
    gone = groups.where("NOT kept").select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha"))
    stay = docs.join(gone.distinct(), F.col("doc_id").eqNullSafe(F.col("__id")) & (sha == F.col("__sha")),
                     "left_anti")
    repeated = groups.where("kept AND group_size > 1").groupBy("doc_id", "text_sha256") \
        .agg(F.count("*").alias("n")).where("n > 1") \
        .select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha"))
    if repeated.isEmpty():
        return stay
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (sha == F.col("__sha"))
    once = stay.join(repeated, same, "left_semi").withColumn("__sha", sha) \
        .dropDuplicates(["doc_id", "__sha"]).drop("__sha")
    return stay.join(repeated, same, "left_anti").unionByName(once)
