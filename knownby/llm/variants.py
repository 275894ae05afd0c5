"""Spelling variants: words one edit apart, found by pivotal bigrams, and each word's more common form.

Words are counted over all texts (a shuffle with map-side combine). Candidate pairs come from the *pivotal
prefix* filter for edit distance 1 with bigrams (q = 2, tau = 1):

* bigrams are ordered globally by how many word positions hold them (rarest first, then by code points);
* a word's *prefix* holds its q*tau + 1 = 3 first bigram occurrences in that order, widened to every occurrence
  of the same bigram values, so repeated bigrams cannot hide a match;
* its two *pivots* are two disjoint occurrences of the prefix (positions at least 2 apart) of least total
  frequency, chosen by dynamic programming. One edit touches the bigrams over one or two adjacent positions,
  so at most one pivot is lost, and the other survives shifted by at most one position.

If two words are one edit apart, the one whose third prefix bigram comes first in the order has a surviving
pivot among the other's prefix. So every near pair meets where a pivot of that word equals a prefix bigram of
the other at a position at most 1 away, with lengths at most 1 apart: an equi-join on (bigram, position,
length) after shifting the prefix rows by -1, 0, +1 in position and length, kept only in that direction
(pivot side's last prefix bigram not after the other's), which halves the candidates. Candidates are verified by
Levenshtein distance with a bound of 1. The global order is computed over all words and is small by
construction: at most 90 * 90 bigrams over the 90 code points that can occur, so it is broadcast.

Joins on words are sort-merge by hint. Spark sizes a stored table by its compressed file and an explode by its input,
so left alone it sends the nine-fold prefix rows, gigabytes, through the driver as a broadcast.

A word's form is its near word of largest count (ties: smallest in code-point order) when that count is at
least ``ratio`` times its own; roots follow forms to the end. Counts grow strictly along a chain, so chains are
short (log base ``ratio`` of the largest count) and acyclic; each step is one join, written to the shared folder.

Defined cases: a null text holds no runs; a null doc_id hashes as the empty string; repeated rows count again;
an empty table gives an empty result. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from knownby.llm.common import store

# Fixed values of the contract: the run pattern, the planted-typo rule, and the word bounds.
NOT_RUN = "[^A-Za-zÀ-ÿ]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
TYPO_MODULUS = 199
MIN_LENGTH = 6
MIN_COUNT = 5
RATIO = 5

#: Bigrams of the prefix (q * tau + 1) and pivots chosen from it (tau + 1).
PREFIX, PIVOTS = 3, 2


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """word, n: the runs of all texts after the planted deletions, of the given length and count."""
    text = F.translate(F.coalesce(F.col("text"), F.lit("")), UPPER, LOWER)
    # a run shorter than min_length stays shorter after a deletion, so it is dropped before the explode
    runs = F.filter(F.split(text, NOT_RUN), lambda r: F.length(r) >= min_length)
    exploded = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
                           F.explode(runs).alias("run"))
    h = F.crc32(F.encode(F.concat("id", F.lit(":"), "run"), "UTF-8"))
    cut = exploded.withColumn("h", h).withColumn("k", (F.col("h") % F.length("run")).cast("int")).select(
        F.when(F.col("h") % TYPO_MODULUS == 0, F.expr("concat(substring(run, 1, k), substring(run, k + 2))"))
        .otherwise(F.col("run")).alias("word"))
    return cut.where(F.length("word") >= min_length).groupBy("word").agg(F.count("*").alias("n")) \
        .where(F.col("n") >= min_count)


def choose_pivots(grams: list[tuple[int, str, int]], count: int = PIVOTS, q: int = 2) -> list[int]:
    """Indexes of ``count`` disjoint occurrences of least total frequency: a DP over occurrences by position.

    ``grams`` holds (frequency, bigram, position); occurrences are disjoint when positions differ by q or more.
    """
    order = sorted(range(len(grams)), key=lambda i: grams[i][2])
    inf = float("inf")
    # best[j][c]: least cost of c pivots among the first j occurrences by position, and the choice
    best = [[(0.0, ())] + [(inf, ())] * count]
    for j, i in enumerate(order):
        row = list(best[-1])
        freq, _, pos = grams[i]
        back = j  # the last occurrence before this one that it does not overlap
        while back > 0 and grams[order[back - 1]][2] > pos - q:
            back -= 1
        for c in range(1, count + 1):
            cost, chosen = best[back][c - 1]
            if cost + freq < row[c][0]:
                row[c] = (cost + freq, chosen + (i,))
        best.append(row)
    return list(best[-1][count][1])


def _grams(word: str) -> list[tuple[str, int]]:
    return [(word[p:p + 2], p) for p in range(len(word) - 1)]


def _prefix_rows(frequency: dict[str, int]):
    rank = {g: i for i, g in enumerate(sorted(frequency, key=lambda g: (frequency[g], g)))}  # the global order

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out_word, out_len, out_role, out_gram, out_pos, out_last = [], [], [], [], [], []
            for word in batch["word"]:
                occ = sorted(((frequency[g], g, p) for g, p in _grams(word)))
                last = occ[PREFIX - 1][:2]
                prefix = [o for o in occ if o[:2] <= last]
                for role, chosen in (("pre", prefix), ("piv", [prefix[i] for i in choose_pivots(prefix)])):
                    for _, g, p in chosen:
                        out_word.append(word)
                        out_len.append(len(word))
                        out_role.append(role)
                        out_gram.append(g)
                        out_pos.append(p)
                        out_last.append(rank[last[1]])
            yield pd.DataFrame({"word": out_word, "len": out_len, "role": out_role, "gram": out_gram, "pos": out_pos,
                                "last": out_last})
    return rows


def near_pairs(words: DataFrame) -> DataFrame:
    """a, b: every pair of distinct words one insertion, deletion or replacement apart (both orders)."""
    spark = words.sparkSession
    positions = words.select("word", F.explode(F.sequence(F.lit(0), F.length("word") - 2)).alias("p"))
    counts = positions.groupBy(F.expr("substring(word, p + 1, 2)").alias("gram")).agg(F.count("*").alias("f"))
    frequency = {r["gram"]: r["f"] for r in counts.collect()}  # at most 90 * 90 rows, see the module's text
    schema = "word string, len int, role string, gram string, pos int, last int"
    marked = store(words.select("word").mapInPandas(_prefix_rows(frequency), schema), "variant-grams")
    shifts = F.explode(F.array(*[F.struct(F.lit(dp).alias("dp"), F.lit(dl).alias("dl"))
                                 for dp in (-1, 0, 1) for dl in (-1, 0, 1)])).alias("s")
    pre = marked.where("role = 'pre'").select(F.col("word").alias("b"), "gram", "pos", "len", F.col("last").alias("b_last"),
                                              shifts) \
        .select("b", "gram", (F.col("pos") + F.col("s.dp")).alias("pos"), (F.col("len") + F.col("s.dl")).alias("len"), "b_last")
    piv = marked.where("role = 'piv'").select(F.col("word").alias("a"), "gram", "pos", "len", F.col("last").alias("a_last"))
    # the lemma needs one direction only: pivots of the word whose prefix ends first in the order
    candidates = piv.join(pre.hint("merge"), ["gram", "pos", "len"]).where((F.col("a") != F.col("b")) & (F.col("a_last") <= F.col("b_last"))) \
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    near = candidates.where(F.levenshtein("a", "b", 1) == 1)
    return near.unionByName(near.select(F.col("b").alias("a"), F.col("a").alias("b")))


def variants(docs: DataFrame, ratio: int = RATIO, min_length: int = MIN_LENGTH,
             min_count: int = MIN_COUNT) -> DataFrame:
    """word, form, root (string), n, n_near, form_n (long) for every counted word."""
    words = store(word_counts(docs, min_length, min_count), "variant-words")
    pairs = near_pairs(words).join(words.select(F.col("word").alias("b"), F.col("n").alias("b_n")).hint("merge"), "b")
    best = pairs.withColumn("r", F.row_number().over(Window.partitionBy("a").orderBy(F.desc("b_n"), "b"))) \
        .withColumn("n_near", F.count("*").over(Window.partitionBy("a"))).where("r = 1") \
        .select(F.col("a").alias("word"), "n_near", F.col("b").alias("top"), F.col("b_n").alias("top_n"))
    formed = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(F.col("top_n") >= F.col("n") * ratio, F.col("top")).alias("form"),
        F.when(F.col("top_n") >= F.col("n") * ratio, F.col("top_n")).alias("form_n"))
    formed = store(formed, "variant-forms")
    steps = formed.select(F.col("word").alias("root"), F.col("form").alias("next")).where("next IS NOT NULL") \
        .hint("merge")
    rooted = formed.withColumn("root", F.coalesce("form", "word"))
    while True:
        moved = rooted.join(steps, "root", "left")
        rooted = store(moved.withColumn("root", F.coalesce("next", "root")).drop("next"), "variant-roots")
        if rooted.join(steps, "root", "left_semi").isEmpty():
            break
    return rooted.select("word", "form", "root", "n", "n_near", "form_n")
