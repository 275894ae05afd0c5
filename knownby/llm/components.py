"""Connected components of a table of links, by hooking and contracting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knownby.llm.common import store


def connected_components(links: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) for every node of the links (a, b).

    Each round hooks every root to its smallest neighbour, jumps twice over the resulting pointers and
    contracts the links to what still joins different roots. Roots only ever point to smaller ones, so the
    last root of a component is its minimum. A round is two grouped aggregates and joins on stored
    tables; a hub with many links is folded by the aggregate's map side.
    """
    edges = store(links.where("a != b").selectExpr("least(a, b) AS a", "greatest(a, b) AS b").distinct(), "links")
    labels = store(edges.selectExpr("explode(array(a, b)) AS node").distinct()
                   .select("node", F.col("node").alias("component")), "labels")
    while not edges.isEmpty():
        ends = edges.selectExpr("explode(array(struct(a AS root, b AS other), struct(b AS root, a AS other))) AS e")
        hook = store(ends.groupBy("e.root").agg(F.min("e.other").alias("other"))
                     .select("root", F.least("root", "other").alias("up")), "hooks")
        jump = _follow(hook, hook, "up")
        jump = store(_follow(jump, hook, "up"), "jumps")
        labels = store(_follow(labels, jump, "component"), "labels")
        moved = _follow(_follow(edges, jump, "a"), jump, "b").where("a != b")
        edges = store(moved.selectExpr("least(a, b) AS a", "greatest(a, b) AS b").distinct(), "links")
    return labels


def _follow(rows: DataFrame, pointers: DataFrame, column: str) -> DataFrame:
    """Replace the column's nodes by what they point to."""
    step = pointers.select(F.col("root").alias("__root"), F.col("up").alias("__up"))
    return rows.join(step, F.col(column) == F.col("__root"), "left") \
        .withColumn(column, F.coalesce("__up", column)).drop("__root", "__up")
