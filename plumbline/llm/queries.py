"""The operators of this package over the given tables, and SQL where SQL can express their results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from plumbline.llm import conversation_repair, crf_quality, decontaminate, exact_dedup, html_wrapper, license_scan, line_dedup, nn_descent, packing, simhash, spelling_variants, token_counts, warc
from plumbline.sources.tables import load

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """File of a public tokenizer; the operators take any other path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(load(spark, folder, "documents"))


def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(load(spark, folder, "pages"))


def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(load(spark, folder, "documents"), vocabulary())


def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.matches(load(spark, folder, "documents"), load(spark, folder, "benchmark"))


def op5_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_wrapper.main_text(load(spark, folder, "pages"))


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    return crf_quality.quality(load(spark, folder, "documents"), load(spark, folder, "labels"))


def op7_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return nn_descent.nearest(load(spark, folder, "embeddings"))


def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.deduplicated(load(spark, folder, "documents"))


def op9_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan(load(spark, folder, "documents"))


def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.counted(load(spark, folder, "documents"), vocabulary())


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    words = spelling_variants.counted(load(spark, folder, "documents"), typo=spelling_variants.TYPO_DIVISOR)
    return spelling_variants.variants(words)


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return conversation_repair.audited(load(spark, folder, "conversations"))


def op13_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.duplicates(load(spark, folder, "documents"))


_ALL = (
    op1_simhash,
    op2_warc,
    op3_packing,
    op4_decontamination,
    op5_main_text,
    op6_quality,
    op7_neighbours,
    op8_line_dedup,
    op9_licenses,
    op10_token_counts,
    op11_spelling_variants,
    op12_conversation_repair,
    op13_exact_dedup,
)
QUERIES: dict[str, Query] = {f.__name__: f for f in _ALL}
ORACLE: dict[str, str] = {"op9_licenses": license_scan.oracle(), "op13_exact_dedup": exact_dedup.oracle()}
