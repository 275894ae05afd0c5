"""The registered queries of this subpackage: thin, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from knownby.llm import ann, bpe, exact_dedup, langid, licenses, lmscore, mixing, near_dedup, quality, rules, search, secrets, variants
from knownby.llm.common import table
from knownby.llm.oracles import ORACLES

Query = Callable[[SparkSession, str], DataFrame]

#: Vocabulary of op9 and of the pipeline's last stage.
RANKS = "byte_bpe_multi_50k.tiktoken"

#: Target weights of op3: domains, then languages of each domain; sources of a language weigh alike.
MIX_WEIGHTS: dict[tuple[str, ...], int] = {
    ("web",): 5, ("books",): 3, ("code",): 2,
    **{(d, lang): w for d in ("web", "books", "code") for lang, w in (("en", 4), ("de", 3), ("fr", 2), ("es", 1))},
}


def _domain() -> Column:
    number = F.regexp_extract(F.coalesce("source", F.lit("")), "^src([0-9]+)$", 1)
    return F.when(number == "", mixing.NONE).when(number.cast("int") % 3 == 0, "web") \
        .when(number.cast("int") % 3 == 1, "books").otherwise("code")


def mix_levels() -> dict[str, Column]:
    """domain, lang and source of a document; the domain groups sources by their number."""
    return {"domain": _domain(), "lang": F.col("lang"), "source": F.col("source")}


def _path() -> Column:
    """A place for each document in a source tree: its source, then directories of 500 and of 25 documents.

    The first document of a directory is its licence file.
    """
    outer, inner = F.expr("doc_id DIV 500"), F.expr("doc_id DIV 25 % 20")
    return F.when(_is_license_file(), F.concat_ws("/", "source", outer, F.when(F.col("doc_id") % 500 != 0, inner), F.lit("LICENSE"))) \
        .otherwise(F.concat_ws("/", "source", outer, inner, F.concat(F.lit("doc-"), F.col("doc_id"))))


def _is_license_file() -> Column:
    return F.col("doc_id") % 25 == 0


def op1_lm_scoring(spark: SparkSession, d: str) -> DataFrame:
    good = table(spark, d, "labels").where("quality = 1").select("doc_id")
    return lmscore.cross_entropy_difference(table(spark, d, "documents"), good)


def op2_exact_dedup(spark: SparkSession, d: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, d, "documents"))


def op3_mixing(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mixture(table(spark, d, "documents"), mix_levels(), MIX_WEIGHTS)


def op4_language_id(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return langid.identify(docs, langid.train(docs))


def op5_license_scan(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    placed = docs.select("doc_id", F.when(F.col("doc_id").isNotNull(), _path()).alias("path"), "text")
    return licenses.scan_licenses(placed, _is_license_file())


def op6_near_dedup(spark: SparkSession, d: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, d, "documents"))


def op7_quality(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return quality.quality_scores(docs, quality.train(docs, table(spark, d, "labels")))


def op8_secret_scan(spark: SparkSession, d: str) -> DataFrame:
    return secrets.find_secrets(table(spark, d, "documents"))


def op9_bpe(spark: SparkSession, d: str) -> DataFrame:
    ranks = bpe.load_ranks(public_tokenizers.path(RANKS))
    encoded = bpe.encode(table(spark, d, "documents"), ranks, public_tokenizers.PATTERN)
    return bpe.with_digests(bpe.decode(encoded, ranks)).drop("ids")


def op10_ann(spark: SparkSession, d: str) -> DataFrame:
    return ann.nearest(table(spark, d, "embeddings"), F.col("vec_id") % 100 == 0)


def op11_search(spark: SparkSession, d: str) -> DataFrame:
    return search.search(table(spark, d, "documents"), table(spark, d, "benchmark"), k=10)


def op12_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    judged = rules.judge(table(spark, d, "documents").select("doc_id", "text"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op13_spelling_variants(spark: SparkSession, d: str) -> DataFrame:
    return variants.variants(table(spark, d, "documents"))


def queries() -> dict[str, Query]:
    found = [op1_lm_scoring, op2_exact_dedup, op3_mixing, op4_language_id, op5_license_scan, op6_near_dedup, op7_quality,
             op8_secret_scan, op9_bpe, op10_ann, op11_search, op12_quality_rules,
             op13_spelling_variants]
    return {f.__name__: f for f in found}


def oracles() -> dict[str, str]:
    return dict(ORACLES)
