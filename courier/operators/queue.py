"""The packet queue: filters, batches, trims, state changes and status.

Batches and trims are filters on a cut point (see ``order.find_cut``), so payloads are
neither sorted nor shuffled.  Age-off and trims also remove packets in flight unless
told otherwise, and counts include them.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courier.config import QueueConfig
from courier.operators.order import Cut, find_cut, send_order

# --- filters -------------------------------------------------------------------


def unassigned(queue: DataFrame) -> DataFrame:
    return queue.where(F.col("transaction_id").isNull())


def transaction_packets(queue: DataFrame, transaction_id: str) -> DataFrame:
    """The packets of one transaction, in send order."""
    return queue.where(F.col("transaction_id") == F.lit(transaction_id)).orderBy(*send_order())


def in_send_order(queue: DataFrame) -> DataFrame:
    return queue.orderBy(*send_order())


def has_packets(queue: DataFrame) -> bool:
    return not queue.isEmpty()


def unexpired(now_ms: int) -> Column:
    """Only ``expires < now`` ages off: a packet that expires now, or never, stays."""
    return F.col("expires").isNull() | (F.col("expires") >= F.lit(now_ms))


def age_off(queue: DataFrame, now_ms: int) -> DataFrame:
    return queue.where(unexpired(now_ms))


# --- batches -------------------------------------------------------------------


def batch_cut(
    queue: DataFrame, count_limit: int | None, byte_limit: int | None, **search
) -> Cut | None:
    """Where the next batch ends; 0 or ``None`` means no limit.

    The packet that reaches the byte limit is part of the batch, so a batch may exceed
    the limit by that packet.
    """
    return find_cut(
        unassigned(queue), rows=count_limit or None, size=byte_limit or None, **search
    )


def batch(
    queue: DataFrame, count_limit: int | None = None, byte_limit: int | None = None, **search
) -> DataFrame:
    """The next batch of unassigned packets by count, by bytes, by both or by neither."""
    cut = batch_cut(queue, count_limit, byte_limit, **search)
    pending = unassigned(queue)
    return pending if cut is None else pending.where(cut.inside())


def assign(
    queue: DataFrame,
    transaction_id: str,
    count_limit: int | None = None,
    byte_limit: int | None = None,
    **search,
) -> DataFrame:
    """The queue with the next batch marked as belonging to ``transaction_id``."""
    cut = batch_cut(queue, count_limit, byte_limit, **search)
    chosen = F.col("transaction_id").isNull()
    if cut is not None:
        chosen = chosen & cut.inside()
    return queue.withColumn(
        "transaction_id", F.when(chosen, F.lit(transaction_id)).otherwise(F.col("transaction_id"))
    )


def assign_ids(queue: DataFrame, chosen: DataFrame) -> DataFrame:
    """Set ``transaction_id`` by key from ``chosen (packet_id, transaction_id)``."""
    slim = chosen.select("packet_id", F.col("transaction_id").alias("_new"))
    return (
        queue.join(slim, "packet_id", "left")
        .withColumn("transaction_id", F.coalesce("_new", "transaction_id"))
        .select(*queue.columns)
    )


def acknowledge(queue: DataFrame, transaction_id: str) -> DataFrame:
    """The queue without the packets of a delivered transaction."""
    return queue.where(~F.col("transaction_id").eqNullSafe(F.lit(transaction_id)))


def release(queue: DataFrame, transaction_id: str) -> DataFrame:
    """The queue with a failed transaction's packets free to be sent again."""
    mine = F.col("transaction_id") == F.lit(transaction_id)
    return queue.withColumn(
        "transaction_id", F.when(mine, F.lit(None)).otherwise(F.col("transaction_id"))
    )


# --- trims ---------------------------------------------------------------------


def rows_cut(queue: DataFrame, max_rows: int | None, **search) -> Cut | None:
    """The key of the last of the first ``max_rows`` rows; ``None`` if all fit."""
    return find_cut(queue, rows=max_rows, **search) if max_rows else None


def bytes_cut(queue: DataFrame, max_bytes: int | None, **search) -> Cut | None:
    """The key of the row that reaches ``max_bytes``; ``None`` if all fit.

    Nothing is cut while the total is within the limit.  A limit of 0 leaves the first row.
    """
    if max_bytes is None:
        return None
    return find_cut(queue, size=max_bytes, only_if_over=True, **search)


def trim_rows(
    queue: DataFrame, max_rows: int | None, protect_in_flight: bool = False, **search
) -> DataFrame:
    """Keep the first rows in send order.  0 keeps none, ``None`` keeps all."""
    trim = Trim(
        None, rows_cut(queue, max_rows, **search), max_rows == 0, protect_in_flight
    )
    return queue.where(trim.kept())


def trim_bytes(
    queue: DataFrame, max_bytes: int | None, protect_in_flight: bool = False, **search
) -> DataFrame:
    """Keep the rows up to the one that reaches ``max_bytes``; ``None`` keeps all."""
    trim = Trim(None, bytes_cut(queue, max_bytes, **search), False, protect_in_flight)
    return queue.where(trim.kept())


@dataclass(frozen=True)
class Trim:
    """What a clean-up decided, as a condition on rows: a time and a cut, not a list of ids."""

    now_ms: int | None
    cut: Cut | None
    keep_none: bool = False
    protect_in_flight: bool = False

    def kept(self) -> Column:
        kept = F.lit(True)
        if self.now_ms is not None:
            kept = kept & unexpired(self.now_ms)
        if self.keep_none:
            kept = F.lit(False)
        elif self.cut is not None:
            kept = kept & self.cut.inside()
        return kept | F.col("transaction_id").isNotNull() if self.protect_in_flight else kept


def plan_clean_up(queue: DataFrame, config: QueueConfig, now_ms: int, **search) -> Trim:
    """Age off, then trim by rows, then trim by bytes: what stays."""
    protect = config.protect_in_flight
    trim = Trim(now_ms, None, config.max_packets == 0, protect)
    if trim.keep_none:
        return trim
    cut = rows_cut(queue.where(trim.kept()), config.max_packets, **search)
    trim = replace(trim, cut=cut)
    # The byte cut lies among the rows kept so far, so it is the stricter one.
    cut = bytes_cut(queue.where(trim.kept()), config.max_bytes, **search) or cut
    return replace(trim, cut=cut)


def clean_up(queue: DataFrame, config: QueueConfig, now_ms: int, **search) -> DataFrame:
    """The queue after a clean-up."""
    return queue.where(plan_clean_up(queue, config, now_ms, **search).kept())


def cleaned_away(queue: DataFrame, config: QueueConfig, now_ms: int, **search) -> DataFrame:
    """The rows that ``clean_up`` removes."""
    return queue.where(~plan_clean_up(queue, config, now_ms, **search).kept())


def removed(before: DataFrame, after: DataFrame) -> DataFrame:
    """The rows of ``before`` that ``after`` no longer has."""
    return before.join(after.select("packet_id"), "packet_id", "left_anti")


def kept(before: DataFrame, keep: DataFrame) -> DataFrame:
    return before.join(keep.select("packet_id"), "packet_id", "left_semi")


def changed_rows(before: DataFrame, after: DataFrame) -> DataFrame:
    """How many rows a state change removed, added or gave another transaction."""
    was = before.select("packet_id", F.col("transaction_id").alias("was"), F.lit(1).alias("b"))
    now = after.select("packet_id", F.col("transaction_id").alias("now"), F.lit(1).alias("a"))
    both = was.join(now, "packet_id", "full_outer")
    return both.agg(
        F.count_if(F.col("a").isNull()).alias("removed"),
        F.count_if(F.col("b").isNull()).alias("added"),
        F.count_if(
            F.col("a").isNotNull() & F.col("b").isNotNull() & ~F.col("was").eqNullSafe(F.col("now"))
        ).alias("updated"),
    )


# --- status --------------------------------------------------------------------


def queue_status(queue: DataFrame, config: QueueConfig) -> DataFrame:
    """One row: count, bytes, truncated average, capacity fraction and whether it is full.

    Full by count at the count limit; else full by bytes at the byte limit less one
    average packet.
    """
    return _status(
        queue.agg(
            F.count(F.lit(1)).alias("queued_packets"),
            F.coalesce(F.sum("estimated_size"), F.lit(0)).alias("queued_bytes"),
            F.coalesce(F.avg("estimated_size").cast("bigint"), F.lit(0)).alias("average_bytes"),
        ),
        config,
    )


def status_of_totals(totals: DataFrame, config: QueueConfig) -> DataFrame:
    """The same from ``totals (packets, bytes)`` of any parts of the queue."""
    summed = totals.agg(
        F.coalesce(F.sum("packets"), F.lit(0)).alias("queued_packets"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("queued_bytes"),
    )
    average = F.expr("coalesce(queued_bytes div nullif(queued_packets, 0), 0L)")
    return _status(summed.withColumn("average_bytes", average), config)


def _status(totals: DataFrame, config: QueueConfig) -> DataFrame:
    full = F.lit(False)
    if config.max_packets:
        full = full | (F.col("queued_packets") >= F.lit(config.max_packets))
    if config.max_bytes:
        full = full | (F.col("queued_bytes") >= F.lit(config.max_bytes) - F.col("average_bytes"))
    fraction = (
        F.col("queued_packets") / F.lit(config.max_packets)
        if config.max_packets
        else F.lit(None).cast("double")
    )
    return totals.withColumn("capacity_fraction", fraction).withColumn("is_full", full)


def transaction_totals(queue: DataFrame) -> DataFrame:
    """Packets and content bytes of every transaction in flight."""
    return (
        queue.where(F.col("transaction_id").isNotNull())
        .groupBy("transaction_id")
        .agg(
            F.count(F.lit(1)).alias("packets"),
            F.sum(F.coalesce(F.octet_length("content"), F.lit(0))).alias("content_bytes"),
        )
    )


