"""Cross-entropy difference: how much better a target model predicts a text than a background model.

Both models are byte 5-gram models. They share one vocabulary, the 256 byte values, and are matched in order,
smoothing and mass: the background, counted over all documents, is scaled to the target's number of bytes.
P_k(c | h) = (n(hc) + KAPPA * P_(k-1)(c | h')) / (n(h) + KAPPA), down to the uniform distribution; all lower
orders derive from the 5-gram counts, and a text begins after four zero bytes.

Documents are gathered into blocks of bounded size by a hash of doc_id; a block sends one row for each distinct
5-gram, with its counts. Counts meet by 5-gram, losses return to the blocks that hold it, and each document's
score is the mean over its bytes of target loss less background loss (nats; lower is closer to the target).

Defined results: null and empty texts have no bytes and null losses; so has every text if the target is empty.
Repeated rows count and are scored each; rows without doc_id are never target. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knownby.llm.common import store, utf8

ORDER = 5
KAPPA = 4.0
#: Characters of a block, on average.
BLOCK_CHARS = 8_000_000


def grams(text: str | None) -> np.ndarray:
    """The 5-gram that ends at each byte, as a number below 256**5."""
    b = np.frombuffer(b"\0" * (ORDER - 1) + utf8(text), np.uint8).astype(np.int64)
    out = np.zeros(max(0, len(b) - ORDER + 1), np.int64)
    for i in range(ORDER):
        out = (out << 8) | b[i:len(out) + i]
    return out


def _count(key: tuple, docs: pa.Table, target: pa.Table) -> pa.Table:
    """Distinct 5-grams of a block with their counts in target documents and in all."""
    wanted = set(target["doc_id"].to_pylist())
    each = [grams(t) for t in docs["text"].to_pylist()]
    mine = [g for g, i in zip(each, docs["doc_id"].to_pylist()) if i is not None and i in wanted]
    none = np.empty(0, np.int64)
    found, n_all = np.unique(np.concatenate([none, *each]), return_counts=True)
    in_target, n_target = np.unique(np.concatenate([none, *mine]), return_counts=True)
    n = np.zeros(len(found), np.int64)
    n[np.searchsorted(found, in_target)] = n_target
    return pa.table({"block": pa.array(np.full(len(found), docs["block"][0].as_py() if len(docs) else 0, np.int32)), "gram": found, "n_target": n, "n_all": n_all})


def _score(key: tuple, docs: pa.Table, losses: pa.Table) -> pa.Table:
    """Mean losses of a block's documents."""
    known = losses["gram"].to_numpy()
    order = np.argsort(known)
    known, table = known[order], np.stack([losses[c].to_numpy()[order] for c in ("target_loss", "all_loss")]) if len(known) else np.zeros((2, 0))
    n, means = [], [[], []]
    for text in docs["text"].to_pylist():
        g, counts = np.unique(grams(text), return_counts=True)
        n.append(int(counts.sum()))
        if len(g) and len(known):
            at = np.searchsorted(known, g)
            if at[-1] >= len(known) or (known[at] != g).any():
                raise RuntimeError("losses of a block's 5-grams are incomplete")
            for out, row in zip(means, table):
                out.append(float(row[at] @ counts / n[-1]))
        else:
            means[0].append(None)
            means[1].append(None)
    return pa.table({"doc_id": docs["doc_id"], "n_tokens": pa.array(n, pa.int64()), "target_loss": pa.array(means[0], pa.float64()),
                     "background_loss": pa.array(means[1], pa.float64())})


def _losses(counts: DataFrame) -> DataFrame:
    """gram, target_loss, all_loss from counts (gram, n_target, n_all) of distinct 5-grams; empty without a target."""
    sizes = counts.agg(F.sum("n_target").alias("t"), F.sum("n_all").alias("a")).where("t > 0")  # one row
    rows = counts.join(F.broadcast(sizes), F.lit(True)).select(
        "gram", F.col("n_target").cast("double").alias("t"), (F.col("n_all") * (F.col("t") / F.col("a"))).alias("a"))
    below = None
    for k in range(1, ORDER + 1):
        size = 1 << 8 * k
        held = rows.groupBy(F.expr(f"gram & {size - 1}L").alias("gram")).agg(F.sum("t").alias("t"), F.sum("a").alias("a"))
        context = held.groupBy(F.shiftright("gram", 8).alias("context")).agg(F.sum("t").alias("ht"), F.sum("a").alias("ha"))
        level = held.withColumn("context", F.shiftright("gram", 8)).join(context, "context")
        if below is None:
            level = level.withColumns({"pt": F.lit(1 / 256), "pa": F.lit(1 / 256)})
        else:
            level = level.withColumn("lower", F.expr(f"gram & {(size >> 8) - 1}L")).join(below, "lower")
        p = lambda n, h, q: (F.col(n) + KAPPA * F.col(q)) / (F.col(h) + KAPPA)
        below = store(level.select(F.col("gram").alias("lower"), p("t", "ht", "pt").alias("pt"), p("a", "ha", "pa").alias("pa")), f"order-{k}")
    return below.select(F.col("lower").alias("gram"), (-F.log("pt")).alias("target_loss"), (-F.log("pa")).alias("all_loss"))


def cross_entropy_difference(docs: DataFrame, target: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per document: doc_id, n_tokens, target_loss, background_loss, score. ``target`` holds doc_ids."""
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    n_blocks = max(1, -(-chars // block_chars))
    own = F.coalesce(F.col("doc_id").cast("string"), F.col("text"), F.lit(""))
    blocks = docs.select(F.pmod(F.xxhash64(own), F.lit(n_blocks)).cast("int").alias("block"), "doc_id", "text")
    wanted = target.where("doc_id IS NOT NULL").select("doc_id").distinct() \
        .withColumn("t_block", F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(n_blocks)).cast("int"))
    counted = store(blocks.groupBy("block").cogroup(wanted.groupBy("t_block")).applyInArrow(_count, "block int, gram long, n_target long, n_all long"), "gram-counts")
    total = store(counted.groupBy("gram").agg(F.sum("n_target").alias("n_target"), F.sum("n_all").alias("n_all")), "gram-totals")
    back = counted.select(F.col("block").alias("l_block"), "gram").join(_losses(total), "gram").select("l_block", "gram", "target_loss", "all_loss")
    scored = blocks.groupBy("block").cogroup(back.groupBy("l_block")) \
        .applyInArrow(_score, "doc_id long, n_tokens long, target_loss double, background_loss double")
    return scored.withColumn("score", F.col("target_loss") - F.col("background_loss"))
