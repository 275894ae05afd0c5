"""Mixing sources to target weights with a hierarchical token budget.

Leaves hang in a tree of levels, such as domain, language, source. Every node has an integer weight and may
give at most ``max_epochs`` times the tokens below it. The budget flows down from the root: siblings share it
by weight; one that cannot use its share gives the rest to its siblings, by their weights, and only what all of
them cannot use goes to their parent's siblings (a parent is never given more than its children can use).
All amounts are whole tokens, computed exactly; rounding down can leave a few tokens unused.

Each leaf takes whole epochs while its budget lasts, then the longest prefix of one more epoch whose tokens fit.
An epoch's order is that of a seeded digest of doc_id and the epoch's number. The running total is kept in
two steps, over 4096 digest ranges of a leaf and inside each, so that no task holds a leaf.

Defined results: a null level value is the node ``(none)``; null text has no tokens. A document without tokens
never uses budget: it is taken with the prefix it stands in. Repeated rows count each for itself. Unknown
nodes have weight 1. Extra columns are ignored, or kept by ``select_mixture``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knownby.llm.common import SPACES, store

NONE = "(none)"
MAX_EPOCHS, BUDGET_PERCENT, SEED = 2, 80, "mix-1"


def word_count(text: Column) -> Column:
    spaced = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " "))
    return F.when(spaced == "", 0).otherwise(F.length(spaced) - F.length(F.replace(spaced, F.lit(" "))) + 1).cast("long")


def _weight(path: Sequence[str], weights: Mapping[tuple[str, ...], int]) -> Column:
    """Weight of the node at this path; keys of ``weights`` are paths from the root."""
    known = {k: w for k, w in weights.items() if len(k) == len(path)}
    if not known:
        return F.lit(1).cast("decimal(12,0)")
    out = None
    for key, weight in known.items():
        here = F.lit(True)
        for column, value in zip(path, key):
            here = here & (F.col(column) == value)
        out = F.when(here, weight) if out is None else out.when(here, weight)
    return out.otherwise(1).cast("decimal(12,0)")


def _share(children: DataFrame, parent: Sequence[str]) -> DataFrame:
    """Split each parent's ``amount`` among its children (weight w, most they can use cap)."""
    over = f"PARTITION BY {', '.join(parent)}" if parent else "PARTITION BY 1"
    before = f"OVER ({over} ORDER BY cap / w, cap, node ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    rows = children.selectExpr(
        "*", f"CAST(coalesce(sum(cap) {before}, 0) AS DECIMAL(24,0)) AS cap_before",
        f"CAST(sum(w) OVER ({over}) - coalesce(sum(w) {before}, 0) AS DECIMAL(12,0)) AS w_left")
    rows = rows.withColumn("full", F.expr("cap * w_left <= w * CAST(amount - cap_before AS DECIMAL(24,0))"))
    rows = rows.selectExpr(
        "*", f"CAST(sum(IF(full, cap, 0)) OVER ({over}) AS DECIMAL(24,0)) AS cap_full",
        f"CAST(sum(IF(full, 0, w)) OVER ({over}) AS DECIMAL(12,0)) AS w_open")
    own = "CASE WHEN full THEN cap ELSE CAST((w * CAST(amount - cap_full AS DECIMAL(24,0))) DIV w_open AS DECIMAL(24,0)) END"
    return rows.withColumn("amount", F.expr(own).cast("decimal(24,0)"))


def allocate(leaves: DataFrame, levels: Sequence[str], weights: Mapping[tuple[str, ...], int],
             max_epochs: int = MAX_EPOCHS, percent: int = BUDGET_PERCENT) -> DataFrame:
    """leaves: level columns and ``tokens``; returns them with ``budget``, in whole tokens.

    The total budget is ``percent`` of all tokens.
    """
    cap = f"CAST(sum(tokens) * {int(max_epochs)} AS DECIMAL(24,0))"
    total = leaves.selectExpr(f"CAST(coalesce(sum(tokens), 0) * {int(percent)} DIV 100 AS DECIMAL(24,0)) AS amount")
    given = total
    for depth in range(1, len(levels) + 1):
        path = list(levels[:depth])
        nodes = leaves.groupBy(*path).agg(F.expr(cap).alias("cap")) \
            .withColumn("w", _weight(path, weights)).withColumn("node", F.col(path[-1]))
        children = nodes.join(given, path[:-1]) if depth > 1 else nodes.join(F.broadcast(given), F.lit(True))  # one row
        given = _share(children, path[:-1]).select(*path, "amount")
    return leaves.join(given, list(levels)).withColumn("budget", F.col("amount").cast("long")).drop("amount")


def mixture(docs: DataFrame, levels: Mapping[str, Column], weights: Mapping[tuple[str, ...], int],
            max_epochs: int = MAX_EPOCHS, percent: int = BUDGET_PERCENT, seed: str = SEED) -> DataFrame:
    """One row per document: doc_id, the level values, n_tokens, budget of its leaf, copies to take."""
    names = list(levels)
    if not names or set(names) & {"doc_id", "tokens", "budget"}:
        raise ValueError("levels need names of their own")
    valued = {n: F.coalesce(c.cast("string"), F.lit(NONE)) for n, c in levels.items()}
    rows = store(docs.select("doc_id", *(c.alias(n) for n, c in valued.items()), word_count(F.col("text")).alias("n_tokens")),
                 "mixture-rows")
    leaves = rows.groupBy(*names).agg(F.sum("n_tokens").alias("tokens"))
    planned = allocate(leaves, names, weights, max_epochs, percent) \
        .withColumn("epochs", F.expr("IF(tokens > 0, budget DIV tokens, 0)")) \
        .withColumn("rest", F.expr("budget - epochs * tokens"))
    planned = store(planned, "mixture-plan")
    order = F.md5(F.concat_ws("-", F.lit(seed), F.col("epochs").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    placed = rows.join(planned.drop("tokens"), names).withColumn("digest", order) \
        .withColumn("cell", F.substring("digest", 1, 3))
    leaf = ", ".join(names)
    cells = placed.groupBy(*names, "cell").agg(F.sum("n_tokens").alias("held")).withColumn(
        "before", F.expr(f"sum(held) OVER (PARTITION BY {leaf} ORDER BY cell ROWS UNBOUNDED PRECEDING) - held"))
    inside = f"sum(n_tokens) OVER (PARTITION BY {leaf}, cell ORDER BY digest, doc_id, n_tokens ROWS UNBOUNDED PRECEDING)"
    out = placed.join(cells.drop("held"), [*names, "cell"]).withColumn("upto", F.expr(f"before + {inside}"))
    return out.select("doc_id", *names, "n_tokens", "budget",
                      F.expr("epochs + IF(upto <= rest, 1, 0)").cast("long").alias("copies"))


def select_mixture(docs: DataFrame, levels: Mapping[str, Column], weights: Mapping[tuple[str, ...], int], **options) -> DataFrame:
    """The chosen documents with all their columns, each as often as it is taken."""
    values = {"doc_id": F.col("doc_id"), **{n: F.coalesce(c.cast("string"), F.lit(NONE)) for n, c in levels.items()}, "n_tokens": word_count(F.col("text"))}
    taken = store(mixture(docs, levels, weights, **options).groupBy(*values).agg(F.sum("copies").alias("__n"), F.count("*").alias("__rows"))
                  .where("__n > 0").withColumnsRenamed({c: f"__{c}" for c in values}), "mixture-taken")
    same = F.lit(True)
    for name, value in values.items():
        same = same & value.eqNullSafe(F.col(f"__{name}"))
    met = docs.join(taken, same)
    # Rows that repeat a doc_id and all else count as one group; its copies are dealt out evenly.
    place = F.lit(0)
    if not taken.where("__n % __rows != 0").isEmpty():
        keys = ", ".join(f"__{c}" for c in values)
        place = F.expr(f"row_number() OVER (PARTITION BY {keys} ORDER BY __n) - 1")
    own = met.withColumn("__own", (F.expr("__n DIV __rows") + (place < F.expr("__n % __rows")).cast("int")).cast("int"))
    each = own.withColumn("__copy", F.explode(F.expr("IF(__own > 0, sequence(1, __own), array())")))
    return each.select(*docs.columns)
