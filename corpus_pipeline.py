"""The corpus pipeline: from documents to a training mix, in five stages.

Each stage takes the documents that the stage before it wrote, and its decisions take
effect: toxic documents go, near-duplicate lines go, one document of each near-duplicate
group stays, contaminated documents go, and the rest is mixed to target weights.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from courier.llm.common import DOCUMENT_COLUMNS, read_table
from courier.llm.decontamination import drop_contaminated
from courier.llm.line_dedup import deduplicate_lines
from courier.llm.mixing import mix_documents
from courier.llm.simhash_dedup import keep_one_of_each_group
from courier.llm.toxicity import drop_toxic
from courier.package import ship_package
from courier.sources.scratch import materialise


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return drop_toxic(docs, read_table(spark, sf_dir, "labels")).select(*DOCUMENT_COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return deduplicate_lines(docs).select(*DOCUMENT_COLUMNS)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return keep_one_of_each_group(docs).select(*DOCUMENT_COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark")).select(
        *DOCUMENT_COLUMNS
    )


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_documents(docs).select(*DOCUMENT_COLUMNS, "copies")


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

#: The toxicity models and the fingerprints' hashes are not SQL; tests check the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; each result is written and read back."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
