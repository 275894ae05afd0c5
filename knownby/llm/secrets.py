"""Secret scan: fixed patterns, and character Markov models that tell random strings from words.

All of it is DataFrame expressions. The base patterns give spans of kinds assign, access and hex. The values
they find and the long words without a digit are the labelled samples of two first-order Markov models over
characters, one of random strings and one of ordinary identifiers, counted over all documents. Every other
long run of identifier characters is scored by the mean log-likelihood ratio of its transitions; above the
threshold it becomes a span of kind ``markov``. Base spans are never changed, and no other span overlaps one.

A match's place comes from the lengths of the pieces between the matches, in code points. Distinct strings
are folded before their characters are spread out, and the transition table is as large as the alphabet
squared, whatever the corpus.

Defined results: null and empty texts have no span and the digest of the empty string. Without samples of both
labels no ``markov`` span is added. Repeated rows and rows without doc_id are reported one by one. Extra columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knownby.llm.common import store

# Fixed values of the contract: kind, pattern, group that is measured, least length. A run of at least n
# characters is matched where the run starts, so for access and hex the length may stand in the pattern.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
ASSIGN_LENGTH = 12

#: Runs that the Markov models judge, and the least mean log-likelihood ratio of a secret.
RUN = r"[A-Za-z0-9+/_=-]{16,}"
THRESHOLD = 0.75
#: Characters a run can hold, and the weight of a character's own frequency against its transitions.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."
PRIOR = 8.0

_SPAN = "array<struct<start: bigint, rank: int, end: bigint, kind: string, value: string>>"


def _spans(text: Column, pattern: str, kind: str, rank: int, group: int = 0) -> Column:
    """Spans of all matches, leftmost first; value is the group's text."""
    matches, values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    pieces = F.split(text, pattern, -1)
    zipped = F.arrays_zip(F.slice(pieces, 1, F.size(matches)).alias("piece"), matches.alias("match"), values.alias("value"))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(_SPAN).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.length(x["piece"])
        end = (begin + F.length(x["match"])).cast("long")
        span = F.struct(begin.cast("long").alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"),
                        x["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    return F.when(text.rlike(pattern), F.aggregate(zipped, start, step)["out"]).otherwise(F.array().cast(_SPAN))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _base(docs: DataFrame) -> DataFrame:
    """A stored row for each document: its base spans and the other long runs."""
    text = F.coalesce(F.col("text"), F.lit(""))
    assigned = F.filter(_spans(text, ASSIGN, "assign", 0, 2), lambda s: F.length(s["value"]) >= ASSIGN_LENGTH)
    base = F.array_sort(F.concat(assigned, _spans(text, ACCESS, "access", 1), _spans(text, HEX, "hex", 2)))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", base.alias("base"), _spans(text, RUN, "markov", 3).alias("runs"))
    free = F.filter("runs", lambda r: ~F.exists("base", lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"])))
    return store(rows.withColumn("runs", free), "secret-spans")


def _transitions(strings: DataFrame) -> DataFrame:
    """value, and its characters' pairs a, b, spread out; strings are distinct."""
    pairs = F.transform(F.sequence(F.lit(1), F.length("value") - 1), lambda i: F.substring(F.col("value"), i, F.lit(2)))
    return strings.where(F.length("value") > 1).withColumn("pair", F.explode(pairs))


def transition_ratios(samples: DataFrame) -> DataFrame:
    """pair, ratio for all pairs of the alphabet: ln P(b | a, random) - ln P(b | a, ordinary).

    samples: value, n, random. P(b | a) = (n(ab) + PRIOR * P(b)) / (n(a) + PRIOR), and P(b) is add-one smoothed.
    """
    counts = _transitions(samples).groupBy("pair").agg(
        F.sum(F.when(F.col("random"), F.col("n")).otherwise(0)).alias("r"), F.sum(F.when(~F.col("random"), F.col("n")).otherwise(0)).alias("o"))
    # From here on tables have a row for each pair or character of the alphabet.
    grid = samples.sparkSession.createDataFrame([(a, b, a + b) for a in ALPHABET for b in ALPHABET], "a string, b string, pair string") \
        .join(counts, "pair", "left").withColumns({"r": F.coalesce("r", F.lit(0)), "o": F.coalesce("o", F.lit(0))})
    before = grid.groupBy("a").agg(F.sum("r").alias("r_a"), F.sum("o").alias("o_a"))
    after = grid.groupBy("b").agg(F.sum("r").alias("r_b"), F.sum("o").alias("o_b"))
    total = grid.agg(F.sum("r").alias("r_all"), F.sum("o").alias("o_all"))

    def log_p(x: str) -> Column:
        single = (F.col(f"{x}_b") + 1) / (F.col(f"{x}_all") + len(ALPHABET))
        return F.log((F.col(x) + PRIOR * single) / (F.col(f"{x}_a") + PRIOR))

    return grid.join(before, "a").join(after, "b").join(F.broadcast(total), F.lit(True)).select("pair", (log_p("r") - log_p("o")).alias("ratio"))


def _secret_values(found: DataFrame, threshold: float) -> DataFrame:
    """The distinct runs that look random."""
    values = lambda column: found.select(F.explode(column).alias("s")).select(F.col("s.value").alias("value"))
    known = values("base").groupBy("value").agg(F.count("*").alias("n")).withColumn("random", F.lit(True))
    runs = store(values("runs").groupBy("value").agg(F.count("*").alias("n")), "secret-runs")
    digit = F.col("value").rlike("[0-9]")
    ratios = store(transition_ratios(known.unionByName(runs.where(~digit).withColumn("random", F.lit(False)))), "secret-model")
    labels = known.limit(1).select("random").unionByName(runs.where(~digit).limit(1).select(F.lit(False).alias("random")))
    ready = labels.agg((F.count("*") == 2).alias("ready"))  # one row
    scored = _transitions(runs.where(digit)).join(F.broadcast(ratios), "pair", "left")  # the alphabet's pairs
    mean = F.round(F.sum(F.coalesce("ratio", F.lit(0.0))) / F.count("*"), 6)
    return scored.groupBy("value").agg(mean.alias("mean")).join(F.broadcast(ready), F.lit(True)) \
        .where(F.col("ready") & (F.col("mean") > threshold)).select("value")


def find_secrets(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, n_markov, base_sha256, spans."""
    found = _base(docs)
    runs = found.select("row", F.explode("runs").alias("s"))
    flagged = runs.join(_secret_values(found, threshold), F.col("s.value") == F.col("value"), "left_semi")
    extra = flagged.groupBy("row").agg(F.collect_list("s").alias("extra"))
    rows = found.join(extra, "row", "left").withColumn("extra", F.coalesce("extra", F.array().cast(_SPAN)))
    counted = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return rows.select("doc_id", counted("assign").alias("n_assign"), counted("access").alias("n_access"), counted("hex").alias("n_hex"),
                       F.size("extra").cast("long").alias("n_markov"), F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
                       _listed(F.array_sort(F.concat("base", "extra"))).alias("spans"))
