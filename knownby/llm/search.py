"""Ranked lexical search: impact lists of a term index, read by the Best Position Algorithm.

The index holds one posting per (term, document) with its score contribution ``c``; each term's postings form
an *impact list* ordered by ``c`` descending, then doc_id ascending, and every posting knows its position in
that list. A search runs in rounds over all pending queries at once. A round reads every list of a query down
to a depth (sorted access), looks up each document so seen in all the query's other lists (direct access) and
so knows its full score. Per list, the *best position* is the end of the contiguous run of seen positions from
the top, direct accesses included; the threshold is the sum of the contributions at the best positions (zero
for a list seen to its end). A query is finished once its k-th score lies strictly above the threshold, or the
threshold is zero: no unseen document can then enter its top k, ties by doc_id included. Other queries go on
with a deeper read. Lists are never cut: the depth grows until every query stops, at the latest when its lists
are read to their ends.

Texts are cut into terms once: the counts of the asked terms are stored, with one row a document for all its
other terms, which gives the lengths. Positions are numbered without a window over a whole list: the postings are range-partitioned by (term, order), numbered inside each range and offset by the counts of earlier ranges of the same term, so a
term held by a third of all documents is spread over many tasks. Texts are split at the complement of the term
pattern, which yields the same terms as extracting them at a third of the cost.

Terms, weights and scores are those of the contract of ``op11``:

* terms: maximal runs of characters outside the ASCII punctuation, space and control ranges, A-Z lower-cased;
* N documents with a term, L terms in all, n of a document, df of a term, tf in a document;
* w = floor(1000 * ln((2N + 2) / (2df + 1))), m = 10 + (90 n N) div L,
  c = w * ((10^9 tf) div (1000 tf + 8 m)), a query's score sums c over its distinct terms.

Defined cases: a document is a non-null doc_id; rows that repeat a doc_id are parts of one document and their
terms count together; rows with a null doc_id are no document. A null or term-less text adds no term. Queries
likewise: a null item_id is no query, a query without terms has no result. Documents with a score of 0 are
never returned. Equal scores rank by ascending doc_id. Empty tables give empty results. Only the named columns
are read, so other columns, whatever their names, do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from knownby.llm.common import store

# Fixed values of the contract: the term pattern and its case folding of A-Z only.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Its complement, at which texts are split: faster than extracting the matches, and the same terms.
SEPARATOR = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

#: Depth of the first sorted access, and its growth from round to round.
FIRST_DEPTH = 256
GROWTH = 8


def terms(text: Column) -> Column:
    """All terms of a text, in order, with repeats; none for null."""
    parts = F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), SEPARATOR)
    return F.filter(parts, lambda term: term != "")


def build_index(docs: DataFrame, vocabulary: DataFrame | None = None) -> DataFrame:
    """Impact lists: term, doc_id, c (long), pos (from 1 within the term's list), len (the list's length).

    Statistics (N, L, n, df) always cover every document. With ``vocabulary`` (a column ``term``), only the
    lists of those terms are built.
    """
    occurrences = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"),
                                                                 F.explode(terms(F.col("text"))).alias("term"))
    if vocabulary is not None:  # the terms nobody asks for stay as one count, under null
        known = vocabulary.select(F.col("term").alias("known")).distinct()
        occurrences = occurrences.join(known, F.col("term") == F.col("known"), "left") \
            .select("doc_id", F.col("known").alias("term"))
    counts = store(occurrences.groupBy("doc_id", "term").agg(F.count("*").alias("tf")), "search-counts")
    lengths = counts.groupBy("doc_id").agg(F.sum("tf").alias("n"))
    totals = lengths.agg(F.count("*").alias("n_docs"), F.sum("n").alias("n_terms"))
    postings = counts.where(F.col("term").isNotNull())
    df = postings.groupBy("term").agg(F.count("*").alias("df"))
    w = F.floor(F.lit(1000.0) * F.log((F.col("n_docs") * 2 + 2).cast("double") / (F.col("df") * 2 + 1).cast("double")))
    weighted = postings.join(df, "term").join(lengths, "doc_id").crossJoin(F.broadcast(totals)) \
        .withColumn("m", F.expr("10 + (90 * n * n_docs) div n_terms")) \
        .select("term", "doc_id", (w.cast("long") * F.expr("(1000000000 * tf) div (1000 * tf + 8 * m)")).alias("c"))
    return _positions(weighted)


def _positions(postings: DataFrame) -> DataFrame:
    """Number each term's postings by (c descending, doc_id ascending) with bounded groups."""
    ranged = postings.repartitionByRange("term", F.desc("c"), "doc_id").withColumn("part", F.spark_partition_id())
    local = ranged.withColumn("lpos", F.row_number().over(
        Window.partitionBy("part", "term").orderBy(F.desc("c"), "doc_id")))
    counts = local.groupBy("part", "term").agg(F.count("*").alias("cnt"))
    before = Window.partitionBy("term").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", "term", F.coalesce(F.sum("cnt").over(before), F.lit(0)).alias("off"),
                            F.sum("cnt").over(Window.partitionBy("term")).alias("len"))
    return local.join(offsets, ["part", "term"]) \
        .select("term", "doc_id", "c", (F.col("off") + F.col("lpos")).alias("pos"), "len")


def _runs(hits: DataFrame, asked: DataFrame) -> DataFrame:
    """item_id, term, run: seen positions that follow a list's depth without a gap, for lists with any.

    Positions behind the depth fall into blocks that double. Blocks seen whole are only counted; the
    positions themselves are numbered in the first other block alone.
    """
    beyond = hits.join(asked.where("depth > 0"), ["item_id", "term"]).where(F.col("pos") > F.col("depth")) \
        .withColumn("block", F.expr("length(bin((pos - 1) div depth)) - 1"))  # floor(log2), in whole numbers
    whole = beyond.groupBy("item_id", "term", "depth", "block").agg(F.count("*").alias("held")) \
        .where(F.col("held") == F.expr("shiftleft(depth, block)"))
    first = whole.withColumn("rn", F.row_number().over(Window.partitionBy("item_id", "term").orderBy("block"))) \
        .where(F.col("block") == F.col("rn") - 1).groupBy("item_id", "term").agg(F.max("rn").alias("open"))
    inside = beyond.join(first, ["item_id", "term"], "left").withColumn("open", F.coalesce("open", F.lit(0))) \
        .withColumn("start", F.expr("shiftleft(depth, open)"))
    rest = inside.where(F.col("block") == F.col("open")) \
        .withColumn("rn", F.row_number().over(Window.partitionBy("item_id", "term").orderBy("pos"))) \
        .where(F.col("pos") - F.col("rn") == F.col("start")).select("item_id", "term", (F.col("pos") - F.col("depth")).alias("run"))
    counted = first.join(asked, ["item_id", "term"]).select(
        "item_id", "term", F.expr("shiftleft(depth, open) - depth").alias("run"))
    return rest.unionByName(counted).groupBy("item_id", "term").agg(F.max("run").alias("run"))


def _round(index: DataFrame, asked: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """One round for the pending queries ``asked`` (item_id, term, depth): their top k and their state.

    Direct access joins the documents seen, each with the queries that saw it, with the lists, and keeps
    the queries that also ask for the list's term.
    """
    lists = index.select("term", "doc_id", "c", "pos")
    seen = lists.join(asked.where("depth > 0"), "term").where(F.col("pos") <= F.col("depth")).select("doc_id", "item_id")
    seen_by = seen.repartition("doc_id").groupBy("doc_id").agg(F.collect_set("item_id").alias("items"))
    askers = asked.groupBy("term").agg(F.collect_set("item_id").alias("askers"))
    hits = store(lists.join(seen_by, "doc_id").join(askers, "term").select(
        "doc_id", "term", "c", "pos", F.explode(F.array_intersect("items", "askers")).alias("item_id")), "search-hits")
    scored = hits.groupBy("item_id", "doc_id").agg(F.sum("c").alias("score")).where("score > 0")
    top = store(scored.withColumn("rank", F.row_number().over(
        Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")).cast("int")).where(F.col("rank") <= k), "search-top")
    sizes = index.where("pos = 1").select("term", "len")
    best = asked.join(sizes, "term", "left").join(_runs(hits.drop("doc_id", "c"), asked), ["item_id", "term"], "left") \
        .select("item_id", "term", "len", F.least(F.col("depth") + F.coalesce("run", F.lit(0)), "len").alias("bp")) \
        .withColumn("at", F.greatest("bp", F.lit(1)))  # of an unread list the first posting bounds all
    at = best.join(lists.select("term", F.col("pos").alias("at"), F.col("c").alias("c_bp")), ["term", "at"], "left")
    threshold = at.groupBy("item_id").agg(F.sum(F.when(F.col("bp") < F.col("len"), F.col("c_bp")).otherwise(0))
                                          .alias("threshold"))
    kth = top.groupBy("item_id").agg(F.count("*").alias("found"), F.min("score").alias("kth"))
    stop = (F.col("threshold") <= 0) | ((F.col("found") >= k) & (F.col("kth") > F.col("threshold")))
    state = threshold.join(kth, "item_id", "left").select(
        "item_id", F.coalesce(stop, F.lit(False)).alias("done"), F.when(F.col("found") >= k, F.col("kth")).alias("kth"))
    return top, state


def _next_depths(index: DataFrame, pending: DataFrame, depths: list[int]) -> DataFrame:
    """The pending queries (item_id, term, kth) with the depth of their next read for each list.

    ``kth`` is a score that k documents reach, null if there are fewer. A read to a depth leaves unseen at
    most the sum of the contributions there, and a list left unread its largest. Of ``depths``, the last of
    which reads all lists to their ends, each query takes the one with the fewest postings that brings this
    sum below ``kth``; at a depth, lists are left unread while the sum stays below, cheapest first.
    """
    def left(depth: int) -> Column:
        return F.max(F.when((F.col("pos") == depth) & (F.col("pos") < F.col("len")), F.col("c")))

    known = index.where(F.col("pos").isin([1, *depths])).groupBy("term").agg(
        F.max("len").alias("len"), F.max("c").alias("largest"), *[left(d).alias(f"c_{d}") for d in depths])
    choices = pending.join(known, "term").select("item_id", "term", "kth", "len", "largest", F.explode(F.array(*[
        F.struct(F.lit(d).cast("long").alias("depth"), F.coalesce(f"c_{d}", F.lit(0)).alias("rest")) for d in depths
    ])).alias("at")).select("item_id", "term", "kth", "len", "largest", "at.*")
    each = Window.partitionBy("item_id", "depth")
    unread = F.sum(F.col("largest") - F.col("rest")).over(each.orderBy(F.col("largest") - F.col("rest"), "term").rowsBetween(
        Window.unboundedPreceding, Window.currentRow))
    bound = F.sum("rest").over(each)
    choices = choices.withColumns({"unread": unread, "bound": bound}) \
        .withColumn("skip", F.coalesce(F.col("bound") + F.col("unread") < F.col("kth"), F.lit(False)))
    costs = choices.where((F.col("bound") < F.col("kth")) | (F.col("depth") == depths[-1])).groupBy("item_id", "depth").agg(
        F.sum(F.when(F.col("skip"), 0).otherwise(F.least("depth", "len"))).alias("cost"))
    chosen = costs.groupBy("item_id").agg(F.min_by("depth", F.struct("cost", "depth")).alias("depth"))
    return choices.join(chosen, ["item_id", "depth"]) \
        .select("item_id", "term", F.when(F.col("skip"), 0).otherwise(F.col("depth")).alias("depth"))


def search(docs: DataFrame, queries: DataFrame, k: int = 10, first_depth: int = FIRST_DEPTH,
           growth: int = GROWTH) -> DataFrame:
    """The k best documents of every query: item_id, rank (int, from 1), doc_id, score (long).

    ``queries`` has item_id and text; ``docs`` has doc_id and text. Every query reads to ``first_depth``, then,
    if it must, once more, to the power of ``growth`` times that depth that its k-th score asks for. Each
    round's state is written to the shared folder, so a lost executor costs one round's stage, not the search.
    """
    asked = store(queries.where(F.col("item_id").isNotNull())
                  .select("item_id", F.explode(terms(F.col("text"))).alias("term")).distinct(), "search-terms")
    index = store(build_index(docs, asked), "search-index")
    longest = index.where("pos = 1").agg(F.max("len")).first()[0] or 0
    depths = [first_depth * growth]
    while depths[-1] < longest:
        depths.append(depths[-1] * growth)
    asked = asked.withColumn("depth", F.lit(first_depth).cast("long"))
    found: list[DataFrame] = []
    while True:
        top, state = _round(index, asked, k)
        state = store(state, "search-state")
        found.append(top.join(state.where("done").select("item_id"), "item_id", "left_semi"))
        pending = asked.drop("depth").join(state.where("NOT done").select("item_id", "kth"), "item_id")
        asked = store(_next_depths(index, pending, depths), "search-terms")
        if asked.isEmpty():
            break
    result = found[0]
    for more in found[1:]:
        result = result.unionByName(more)
    return result.select("item_id", "rank", "doc_id", "score")


def brute_scores(docs: DataFrame, queries: DataFrame) -> DataFrame:
    """Every positive (item_id, doc_id, score) by a full join of queries with the index: for tests."""
    asked = queries.where(F.col("item_id").isNotNull()) \
        .select("item_id", F.explode(terms(F.col("text"))).alias("term")).distinct()
    return build_index(docs, asked).join(asked, "term").groupBy("item_id", "doc_id") \
        .agg(F.sum("c").alias("score")).where("score > 0")
