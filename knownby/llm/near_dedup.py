"""Near-duplicate detection with HyperMinHash sketches, exact verification and connected components.

A document's set holds its distinct 5-word shingles as 64-bit hashes (two different shingles share one with
probability 2**-64). Documents with one word sequence are represented by the smallest doc_id among them, so
copies are never paired with each other.

* Sketch: the leading bits of a shingle's hash choose one of 384 registers. A register keeps its smallest
  remainder compressed to one byte: the count of leading zeros (4 bits, 14 at most) and 4 mantissa bits.
* Banding: 64 bands of 6 registers, packed into one long with the band's number. Empty registers borrow
  from others by fixed random probes, so small sets fill their bands too. At a similarity of 0.75
  all bands miss a pair with probability (1 - 0.75**6)**64 = 4e-6.
* Sets of at most 64 shingles are matched by an exact prefix filter instead: with shingles ordered from rare
  to common, sets of similarity 0.75 share one of their first n - ceil(0.75 n) + 1.
* A bucket of n members never emits its n * n pairs. First every member meets the smallest one; the
  components of the links so found are contracted; members of buckets that still hold several components
  meet a second, random member; at last, members of different components are compared, as pairs in buckets
  of up to 32 members and block by block in larger ones. A pair that is never compared joins documents
  already known to be in one component, so no component is lost.
* Estimate: the share of equal registers, less the matches expected by chance from the two set sizes, drops
  a pair before verification only where it lies six standard deviations below the threshold.
* Verification intersects the full sets: linked if 100 * intersection >= 75 * union.

Defined results: null and empty texts have no shingle, stay alone and are kept. A text of fewer than five words
has one shingle, its whole sequence. A row without doc_id is linked with nothing, has no component_id and is
kept. Repeated rows of one doc_id share a component. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knownby.llm.common import WordHashes, mix64, store, utf8
from knownby.llm.components import connected_components

WORDS = 5
PERCENT = 75
BANDS, ROWS = 64, 6
REGISTERS = BANDS * ROWS
LZ_CAP, MANTISSA = 14, 4
EMPTY = 255
SMALL = 64
#: A set this large can still be linked with one of SMALL shingles.
SMALL_PARTNER = SMALL * 100 // PERCENT
#: Members of a bucket whose pairs are built as rows (so at most FEW / 2 for each member); larger ones go in blocks.
FEW = 32
#: Shingles in a block of a large bucket, and columns of a dense slice.
BLOCK, SLICE = 65_536, 4_096
_REST_BITS = 48
_PLACES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5,
                    0x85EBCA77C2B2AE63], np.uint64)
_PROBES = np.random.default_rng(20240607).integers(0, REGISTERS, (REGISTERS, 64))


def shingles(words: list[bytes], hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the 5-word shingles; of the whole sequence if it is shorter."""
    if not words:
        return np.empty(0, np.uint64)
    h = hashes.of(words)
    width = min(WORDS, len(words))
    acc = np.full(len(words) - width + 1, width, np.uint64)
    for i in range(width):
        acc += mix64(h[i:len(h) - width + 1 + i] * _PLACES[i])
    return np.unique(mix64(acc))


def registers(hashed: np.ndarray) -> np.ndarray:
    """One byte for each register: leading zeros and mantissa of the smallest hash that falls into it."""
    out = np.full(REGISTERS, EMPTY, np.uint8)
    if not len(hashed):
        return out
    register = ((hashed >> np.uint64(_REST_BITS)) * np.uint64(REGISTERS)) >> np.uint64(64 - _REST_BITS)
    rest = (hashed & np.uint64((1 << _REST_BITS) - 1)).astype(np.float64) + 0.5
    first = np.concatenate([[True], register[1:] != register[:-1]])  # hashes are sorted: so are registers
    smallest = rest[first] if len(hashed) == first.sum() else np.minimum.reduceat(rest, np.flatnonzero(first))
    fraction, exponent = np.frexp(smallest)
    zeros = np.minimum(_REST_BITS - exponent, LZ_CAP)
    mantissa = ((fraction * 2 - 1) * (1 << MANTISSA)).astype(np.int64)
    mantissa[_REST_BITS - exponent >= LZ_CAP] = 0  # all below the last level count as one value
    out[register[first].astype(np.int64)] = (zeros << MANTISSA) + mantissa
    return out


def filled(regs: np.ndarray) -> np.ndarray:
    """Empty registers take the value of the first full one among their fixed probes."""
    empty = np.flatnonzero(regs == EMPTY)
    if len(empty) in (0, REGISTERS):
        return regs
    values = regs[_PROBES[empty]]
    hit = (values != EMPTY).argmax(axis=1)
    out = regs.copy()
    out[empty] = values[np.arange(len(empty)), hit]
    left = np.flatnonzero(out == EMPTY)  # no probe hit: the next full one to the right
    if len(left):
        full = np.flatnonzero(regs != EMPTY)
        out[left] = regs[full[np.searchsorted(full, left) % len(full)]]
    return out


def band_keys(regs: np.ndarray) -> np.ndarray:
    """Bands as longs: the band's number above its six register bytes."""
    parts = filled(regs).reshape(BANDS, ROWS).astype(np.int64)
    return (np.arange(BANDS, dtype=np.int64) << 48) + (parts << (8 * np.arange(ROWS))).sum(axis=1)


def chance_matches(n1: np.ndarray, n2: np.ndarray) -> np.ndarray:
    """Expected share of registers that are equal by chance for disjoint sets of these sizes."""
    k1, k2 = n1 / REGISTERS, n2 / REGISTERS
    total = k1 + k2
    share = np.zeros_like(total)
    for level in range(LZ_CAP):  # minima between 2**-(level+1) and 2**-level, in 2**MANTISSA cells
        high, low = 2.0 ** -level, 2.0 ** -(level + 1)
        width = low / (1 << MANTISSA)
        share += width * k1 * k2 / total * (np.exp(-total * low) - np.exp(-total * high))
    below = 2.0 ** -LZ_CAP
    return share + (1 - np.exp(-k1 * below)) * (1 - np.exp(-k2 * below))


def estimate(a: np.ndarray, b: np.ndarray, n1: np.ndarray, n2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Jaccard estimates of sketch rows corrected for chance matches, and the registers that count."""
    used = ((a != EMPTY) | (b != EMPTY)).sum(axis=1)
    equal = ((a == b) & (a != EMPTY)).sum(axis=1)
    used = np.maximum(used, 1)
    chance = np.minimum(chance_matches(n1, n2) * REGISTERS / used, 0.99)
    return (equal / used - chance) / (1 - chance), used


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        seq, size, regs, small = [], [], [], []
        for text in batch["text"].to_pylist():
            words = utf8(text).lower().split()  # bytes.lower() changes A-Z only
            s = shingles(words, hashes)
            seq.append(hashlib.blake2b(b" ".join(words), digest_size=16).digest())
            size.append(len(s))
            regs.append(registers(s).tobytes() if len(s) > SMALL else b"")
            small.append(s.view(np.int64) if 0 < len(s) <= SMALL_PARTNER else [])
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.array(seq, pa.binary()), pa.array(size, pa.int64()), pa.array(regs, pa.binary()),
             pa.array(small, pa.list_(pa.int64()))], ["doc_id", "seq", "n_shingles", "regs", "small"])


def _bands(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        if len(f):
            keys = [band_keys(np.frombuffer(r, np.uint8)) for r in f["regs"]]
            yield pd.DataFrame({"key": np.concatenate(keys), "doc": np.repeat(f["doc"].to_numpy(), BANDS),
                                "n": np.repeat(f["n"].to_numpy(), BANDS)})


def _near(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pairs whose estimate does not rule them out; pairs without two sketches pass."""
    for f in frames:
        keep = np.ones(len(f), bool)
        both = np.flatnonzero((f["regs_a"].str.len() > 0) & (f["regs_b"].str.len() > 0))
        for part in np.array_split(both, max(1, len(both) // 4096)):
            if len(part):
                a, b = (np.frombuffer(b"".join(f[c].iloc[part]), np.uint8).reshape(-1, REGISTERS)
                        for c in ("regs_a", "regs_b"))
                j, used = estimate(a, b, f["n_a"].to_numpy()[part], f["n_b"].to_numpy()[part])
                keep[part] = j >= PERCENT / 100 - 6 * np.sqrt(0.1875 / used)
        yield f.loc[keep, ["a", "b"]]


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        sets = [shingles(utf8(t).lower().split(), hashes).view(np.int64) for t in batch["text"].to_pylist()]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(sets, pa.list_(pa.int64()))], ["doc", "shingles"])


def _linked(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        keep = []
        for x, y in zip(f["set_a"], f["set_b"]):
            common = len(x) + len(y) - len(np.union1d(x, y))
            keep.append(100 * common >= PERCENT * (len(x) + len(y) - common))
        yield f.loc[keep, ["a", "b"]]


class _Pairs:
    """Judges candidate pairs against sketches and full sets; remembers what was judged."""

    def __init__(self, docs: DataFrame, reps: DataFrame, members: DataFrame):
        self.sketches = reps.where("doc IS NOT NULL").select("doc", "n", "regs")
        wanted = members.selectExpr("explode(array(pivot, doc)) AS __doc").distinct()
        texts = docs.select("doc_id", "text").join(wanted, F.col("doc_id") == F.col("__doc"), "left_semi")
        self.sets = store(texts.mapInArrow(_sets, "doc long, shingles array<bigint>"), "shingle-sets")
        self.judged: DataFrame | None = None
        self.links: DataFrame | None = None

    def judge(self, pairs: DataFrame) -> None:
        """pairs: (a, b), in any order; ones judged before are left out."""
        pairs = pairs.selectExpr("least(a, b) AS a", "greatest(a, b) AS b").where("a != b").distinct()
        if self.judged is not None:
            pairs = pairs.join(self.judged, ["a", "b"], "left_anti")
        pairs = store(pairs, "pairs")
        s = self.sketches
        with_a = pairs.join(s.select(F.col("doc").alias("a"), F.col("n").alias("n_a"), F.col("regs").alias("regs_a")), "a")
        both = with_a.join(s.select(F.col("doc").alias("b"), F.col("n").alias("n_b"), F.col("regs").alias("regs_b")), "b")
        both = both.where(f"100 * least(n_a, n_b) >= {PERCENT} * greatest(n_a, n_b)")
        near = store(both.select("a", "b", "n_a", "n_b", "regs_a", "regs_b").mapInPandas(_near, "a long, b long"),
                     "near-pairs")
        sets = self.sets
        full = near.join(sets.select(F.col("doc").alias("a"), F.col("shingles").alias("set_a")), "a") \
            .join(sets.select(F.col("doc").alias("b"), F.col("shingles").alias("set_b")), "b")
        links = store(full.select("a", "b", "set_a", "set_b").mapInPandas(_linked, "a long, b long"), "found-links")
        self.judged = pairs if self.judged is None else self.judged.unionByName(pairs)
        self.links = links if self.links is None else self.links.unionByName(links)


def _small_keys(reps: DataFrame) -> DataFrame:
    """Prefix-filter keys of the small sets: their rarest shingles, as (key, doc, n)."""
    rows = reps.where("size(small) > 0").select("doc", "n", F.explode("small").alias("key"))
    common = rows.groupBy("key").agg(F.count("*").alias("df"))
    ranked = rows.join(common.where("df > 1"), "key", "left").groupBy("doc", "n").agg(
        F.sort_array(F.collect_list(F.struct(F.coalesce("df", F.lit(1)).alias("df"), "key"))).alias("order"))
    # A key of one document pairs with nothing but still takes its place in the prefix.
    prefix = f"slice(order, 1, CAST(n - ceil({PERCENT} * n / 100) + 1 AS INT))"
    return ranked.selectExpr("doc", "n", f"explode({prefix}) AS e").where("e.df > 1").selectExpr("e.key AS key", "doc", "n")


def _members(reps: DataFrame) -> DataFrame:
    """Buckets with several members as (key, pivot, doc): every member but the smallest, with the smallest."""
    small = _small_keys(reps).selectExpr("'small' AS kind", "key", "doc", "n")
    bands = reps.where(F.length("regs") > 0).select("doc", "n", "regs") \
        .mapInPandas(_bands, "key long, doc long, n long").selectExpr("'band' AS kind", "key", "doc", "n")
    keyed = small.unionByName(bands)
    pivot = "first_value(doc) OVER (PARTITION BY kind, key ORDER BY doc)"
    return keyed.withColumn("pivot", F.expr(pivot)).where("doc != pivot").select("kind", "key", "pivot", "doc", "n")


def _mixed(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (kind, key, doc, component) of the buckets that hold several components."""
    rows = members.selectExpr("kind", "key", "doc") \
        .unionByName(members.selectExpr("kind", "key", "pivot AS doc").distinct())
    rows = rows.join(labels.withColumnRenamed("node", "doc"), "doc", "left") \
        .select("kind", "key", "doc", F.coalesce("component", "doc").alias("component"))
    several = rows.groupBy("kind", "key").agg(F.min("component").alias("low"), F.max("component").alias("high")) \
        .where("low != high").select("kind", "key")
    return rows.join(several, ["kind", "key"], "left_semi")


def _cross_links(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links between documents of different components in two blocks, from dense slices of their sets."""
    for f in frames:
        a, b = [], []
        for left, right in zip(f["left_rows"], f["right_rows"]):
            sides = []
            for rows in (left, right):
                sizes = np.array([len(r["shingles"]) for r in rows])
                flat = np.concatenate([r["shingles"] for r in rows])
                sides.append((np.array([r["doc"] for r in rows]), np.array([r["component"] for r in rows]), sizes,
                              np.repeat(np.arange(len(rows)), sizes), flat))
            (d1, c1, n1, row1, s1), (d2, c2, n2, row2, s2) = sides
            both = np.intersect1d(s1, s2)
            common = np.zeros((len(d1), len(d2)), np.float32)
            at = []
            for row, flat in ((row1, s1), (row2, s2)):
                place = np.minimum(np.searchsorted(both, flat), max(0, len(both) - 1))
                hit = both[place] == flat if len(both) else np.zeros(len(flat), bool)
                at.append((row[hit], place[hit]))
            for start in range(0, len(both), SLICE):
                m = []
                for (row, place), n in zip(at, (len(d1), len(d2))):
                    inside = (place >= start) & (place < start + SLICE)
                    dense = np.zeros((n, SLICE), np.float32)
                    dense[row[inside], place[inside] - start] = 1
                    m.append(dense)
                common += m[0] @ m[1].T
            union = n1[:, None] + n2[None, :] - common
            i, j = np.nonzero((c1[:, None] != c2[None, :]) & (100 * common >= PERCENT * union))
            a.append(np.minimum(d1[i], d2[j]))
            b.append(np.maximum(d1[i], d2[j]))
        yield pd.DataFrame({"a": np.concatenate(a) if a else [], "b": np.concatenate(b) if b else []})


def _links_in_blocks(mixed: DataFrame, sets: DataFrame) -> DataFrame:
    """All links between components inside large buckets, without a row for each pair.

    A bucket's members are cut into blocks of bounded total set size; a task gets two blocks of a
    bucket, intersects all their sets at once and returns only the links.
    """
    rows = mixed.join(sets.dropDuplicates(["doc"]), "doc")
    upto = "sum(size(shingles)) OVER (PARTITION BY kind, key ORDER BY doc ROWS UNBOUNDED PRECEDING)"
    blocks = store(rows.withColumn("block", F.expr(f"CAST({upto} DIV {BLOCK} AS INT)")).groupBy("kind", "key", "block")
                   .agg(F.collect_list(F.struct("doc", "component", "shingles")).alias("rows")), "bucket-blocks")
    left = blocks.selectExpr("kind", "key", "block AS left_block", "rows AS left_rows")
    right = blocks.selectExpr("kind", "key", "block AS right_block", "rows AS right_rows")
    two = left.join(right, ["kind", "key"]).where("left_block <= right_block")
    return store(two.select("left_rows", "right_rows").mapInPandas(_cross_links, "a long, b long"), "block-links")


def near_groups(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    sketched = store(docs.select("doc_id", "text").mapInArrow(
        _sketch, "doc_id long, seq binary, n_shingles long, regs binary, small array<bigint>"), "sketches")
    some = sketched.where("n_shingles > 0 AND doc_id IS NOT NULL")
    reps = store(some.groupBy("seq").agg(
        F.min("doc_id").alias("doc"), F.first("n_shingles").alias("n"), F.first("regs").alias("regs"),
        F.first("small").alias("small")), "representatives")
    members = store(_members(reps), "bucket-members")
    pairs = _Pairs(docs, reps, members)

    pairs.judge(members.selectExpr("pivot AS a", "doc AS b"))
    mixed = store(_mixed(members, connected_components(pairs.links)), "mixed-buckets")
    if not mixed.isEmpty():
        # A second member for all of the bucket, drawn by a hash that differs from bucket to bucket.
        second = "first_value(struct(doc, component)) OVER (PARTITION BY kind, key ORDER BY xxhash64(key, doc))"
        star = mixed.withColumn("p", F.expr(second)).where("p.component != component")
        pairs.judge(star.selectExpr("p.doc AS a", "doc AS b"))
        mixed = store(_mixed(members, connected_components(pairs.links)), "mixed-buckets")
    if not mixed.isEmpty():
        sized = mixed.join(mixed.groupBy("kind", "key").agg(F.count("*").alias("held")), ["kind", "key"])
        few = sized.where(f"held <= {FEW}").select("kind", "key", "doc", "component")
        other = few.selectExpr("kind", "key", "doc AS b", "component AS other")
        rest = few.withColumnRenamed("doc", "a").join(other, ["kind", "key"]).where("component < other")
        pairs.judge(rest.select("a", "b"))
        pairs.links = pairs.links.unionByName(_links_in_blocks(sized.where(f"held > {FEW}"), pairs.sets))
    labels = connected_components(pairs.links)
    named = reps.select("seq", "doc").join(labels.withColumnRenamed("node", "doc"), "doc", "left") \
        .select("seq", F.coalesce("component", "doc").alias("component"))
    # A doc_id on several rows may stand in several components of its texts: its rows join them.
    out = sketched.select("doc_id", "seq", "n_shingles").join(named, "seq", "left")
    mine = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", mine.alias("component_id")) \
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns: one of each group."""
    gone = near_groups(docs).where("NOT kept").select(F.col("doc_id").alias("__id")).distinct()
    return docs.join(gone, F.col("doc_id") == F.col("__id"), "left_anti")
