"""Queue, peer and reply inputs derived from the star-schema test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courier.config import Prioritizer
from courier.functions import packets as P
from courier.schema import QUEUE_COLUMNS

#: 2024-01-16T00:00:00Z in reference milliseconds.
NOW_MS = 727_056_000_000
DAY_MS = 86_400_000

PRIORITY = """CASE event_type WHEN 'error' THEN 0 WHEN 'purchase' THEN 1
  WHEN 'signup' THEN 2 WHEN 'click' THEN 3 ELSE 4 END"""
TTL_MILLIS = f"""(CASE event_type WHEN 'error' THEN 20 WHEN 'purchase' THEN 15
  WHEN 'signup' THEN 10 WHEN 'click' THEN 5 ELSE 2 END) * {DAY_MS}L"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One packet per event: type and user as attributes, ``props`` as content."""
    return P.from_attributes(
        table(spark, sf_dir, "events"),
        F.create_map(
            F.lit("event_type"), F.col("event_type"),
            F.lit("user_id"), F.col("user_id").cast("string"),
        ),
        F.encode("props", "UTF-8"),
        keep=("event_id", "ts", "user_id", "event_type"),
    )


def event_queue(
    spark: SparkSession,
    sf_dir: str,
    prioritizer: Prioritizer | None = None,
    transaction: Column | None = None,
) -> DataFrame:
    """The queue all queue queries run on; ``transaction`` puts packets in flight."""
    rows = P.to_queue_rows(
        event_packets(spark, sf_dir),
        created=P.reference_millis(P.utc_wall_clock(F.col("ts"))),
        packet_id="event_id",
        prioritizer=prioritizer or Prioritizer(PRIORITY, TTL_MILLIS),
        keep=("user_id", "event_type"),
    )
    if transaction is not None:
        rows = rows.withColumn("transaction_id", transaction)
    return rows.select(*QUEUE_COLUMNS)


def user_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The queue with every packet in flight, one transaction per user."""
    user = F.col("user_id").cast("string")
    return event_queue(spark, sf_dir, transaction=F.concat(F.lit("tx-"), user))


def partly_in_flight(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The queue with purchases and signups in flight, one transaction per type."""
    kind = F.col("event_type")
    flying = F.when(kind.isin("purchase", "signup"), F.concat(F.lit("tx-"), kind))
    return event_queue(spark, sf_dir, transaction=flying)
