"""Packets from files, and batches to files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courier.functions.packets import empty_attributes
from courier.operators.order import send_order
from courier.operators.transfer import checksums, combined
from courier.sources.scratch import materialise


def file_packets(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """One packet per file: no attributes, the file's bytes.

    Empty files give nothing; unreadable ones are passed over.
    """
    reader = spark.read.format("binaryFile").option("ignoreCorruptFiles", "true")
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).where("length > 0").select(
        "path",
        empty_attributes().alias("attributes"),
        "content",
        F.col("length").alias("declared_length"),
    )


def deliver_to_folder(batch: DataFrame, path: str) -> DataFrame:
    """Write the frames and the manifest of packets in flight; gives the manifest.

    Frames lie in send order under ``frames/transaction_id=…``, each with its length and
    checksum.  They are built once: the manifest is made of what was written.  A transaction
    is spread over files by its send order, so a large one does not pass through one task.  Sent
    again, a transaction takes the place of what was written of it before.
    """
    # Range bounds are sampled, so the batch, which may be a costly view, is written first.
    built = materialise(checksums(batch), "frames")
    by_transaction = built.repartitionByRange("transaction_id", *send_order())
    (
        by_transaction.sortWithinPartitions("transaction_id", *send_order())
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("transaction_id")
        .parquet(f"{path}/frames")
    )
    summary = materialise(combined(built), "manifest")
    (
        summary.withColumn("sent_as", F.col("transaction_id"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("sent_as")
        .parquet(f"{path}/manifests")
    )
    return summary
