"""The stages that turn raw documents into packed training sequences, in order.

Each stage takes (spark, docs, folder of the tables) and works on all rows of its predecessor: documents of low quality
go, repeated passages are taken out, one document of each near-duplicate group stays, documents that hold benchmark
items go, and what is left is packed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plumbline.llm import crf_quality, decontaminate, line_dedup, packing, simhash
from plumbline.llm.common import stored
from plumbline.llm.queries import vocabulary
from plumbline.sources.tables import load


def quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return crf_quality.accepted(docs, load(spark, folder, "labels"))


def lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return line_dedup.cleaned(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return simhash.deduplicated(docs)


def benchmark(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return decontaminate.decontaminated(docs, load(spark, folder, "benchmark"))


def sequences(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return packing.packed(docs, vocabulary())


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", benchmark),
    ("best-fit packing", sequences),
]

# The classifier and the packing have no form in SQL; the tests hold the run against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over ``documents``; every result is written as Parquet and read again for the next stage."""
    docs = load(spark, folder, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, folder))
    return STAGES[-1][1](spark, docs, folder)
