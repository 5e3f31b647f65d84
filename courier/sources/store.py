"""The stored queue: two append-only tables bucketed by packet id, and a summary of each write.

``packets``  rows as they were enqueued
``events``   per packet: its new transaction, or that it was removed; the latest counts
``totals``   what each write added or took away: rows and bytes by hour of expiry

Nothing is rewritten.  Assigning, releasing, acknowledging and cleaning up write packet ids,
never payloads; the queue is a view over the two tables, which share their buckets, so that
the latest event of each packet is found and joined without a shuffle.  Status, and whether a
clean-up has anything to do, follow from ``totals`` alone.

A packet id is (batch, writer, row): batches are numbered by their writer, rows inside their
batch.  So drivers that append at the same time need no shared counter: give each its own
``writer`` number, and likewise each stream, whose micro-batches bring their numbers.  A batch
number that its writer used before is a replay.  Let one driver at a time change states.
"""

from __future__ import annotations

import functools
import hashlib
import threading
import time
from collections import defaultdict
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from courier.config import QueueConfig
from courier.operators import queue as Q
from courier.schema import QUEUE_COLUMNS, QUEUE_SCHEMA
from courier.sources.scratch import materialise

ROW_BITS, WRITER_BITS = 32, 5
EXPIRY_MILLIS = 3_600_000
BUCKETS = 32

PACKETS = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in QUEUE_SCHEMA)
EVENTS = "packet_id bigint, transaction_id string, removed boolean, seq bigint"
TOTALS = (
    "generation int, buckets int, seq bigint, writer int, batch bigint, expiry bigint, "
    "packets bigint, bytes bigint"
)
#: What a change needs to know of its packets.
CHANGED = ("packet_id", "estimated_size", "expires")

_locks: dict[str, threading.RLock] = defaultdict(threading.RLock)


def _one_at_a_time(write):
    """Let the threads of a driver that write to the same folder take turns."""

    @functools.wraps(write)
    def run(self, *args, **options):
        with _locks[self.path]:
            return write(self, *args, **options)

    return run


def first_id(writer: int, batch: int) -> int:
    """The id before the first row of a writer's batch."""
    if not 0 <= writer < 1 << WRITER_BITS or not 0 <= batch < 1 << 63 - ROW_BITS - WRITER_BITS:
        raise ValueError(f"no ids for writer {writer}, batch {batch}")
    return (batch << WRITER_BITS | writer) << ROW_BITS


class QueueStore:
    """A packet queue in a folder that driver and executors share."""

    def __init__(
        self, spark: SparkSession, path: str, *, writer: int = 0, buckets: int = BUCKETS
    ) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.writer, self.buckets = writer, buckets

    # --- reading --------------------------------------------------------------------

    def _totals(self) -> DataFrame:
        try:
            return self.spark.read.schema(TOTALS).parquet(f"{self.path}/totals")
        except Exception as error:
            if "PATH_NOT_FOUND" in str(error):
                raise FileNotFoundError(f"no queue at {self.path}") from None
            raise

    def _state(self, writer: int | None = None) -> Row:
        """The generation and its buckets, the latest change, the writer's latest batch."""
        mine = F.col("writer") == (self.writer if writer is None else writer)
        return self._totals().agg(
            F.max("generation").alias("generation"),
            F.max_by("buckets", "generation").alias("buckets"),
            F.max("seq").alias("seq"),
            F.coalesce(F.max(F.when(mine, F.col("batch"))), F.lit(-1)).alias("batch"),
        ).first()

    def _table(self, name: str, columns: str, state: Row) -> str:
        """The table of this folder in the session's catalog, which knows its buckets."""
        folder = f"{self.path}/{name}/generation={state['generation']}"
        table = f"courier_{name}_{hashlib.md5(folder.encode()).hexdigest()}"
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
            f"CLUSTERED BY (packet_id) INTO {state['buckets']} BUCKETS LOCATION "
            f"'{folder.replace(chr(39), chr(92) + chr(39))}'"
        )
        self.spark.catalog.refreshTable(table)  # files of other sessions
        return table

    def _packets(self, state: Row) -> DataFrame:
        return self.spark.table(self._table("packets", PACKETS, state))

    def _events(self, state: Row) -> DataFrame:
        return self.spark.table(self._table("events", EVENTS, state))

    def queue(self) -> DataFrame:
        """The queue as it stands."""
        state = self._state()
        return _with_latest(self._packets(state), self._events(state))

    def packets(self, transaction_id: str) -> DataFrame:
        """The packets of one transaction, in send order."""
        return Q.in_send_order(self._in_transaction(transaction_id))

    def _in_transaction(self, transaction_id: str) -> DataFrame:
        """The packets of one transaction; its ids bound the rows to read."""
        state = self._state()
        rows, events = self._packets(state), self._events(state)
        own = F.col("transaction_id") == F.lit(transaction_id)
        ids = events.where(own).select("packet_id").union(rows.where(own).select("packet_id"))
        low, high = ids.agg(F.min("packet_id"), F.max("packet_id")).first()
        between = F.col("packet_id").between(low, high)
        return _with_latest(rows.where(between), events.where(between)).where(own)

    def live(self) -> DataFrame:
        """Packets and bytes in the queue by hour of expiry, from the summaries."""
        totals = self._totals()
        newest = totals.agg(F.max("generation").alias("generation"))  # one row
        kept = totals.join(F.broadcast(newest), "generation").groupBy("expiry")
        return kept.agg(F.sum("packets").alias("packets"), F.sum("bytes").alias("bytes")).where(
            "packets > 0"
        )

    def status(self, config: QueueConfig) -> DataFrame:
        """The queue's status, without reading the queue."""
        return Q.status_of_totals(self.live(), config)

    def transaction_kind(self, transaction_id: str) -> str | None:
        """``open`` if packets are in flight, ``ended`` if some were acknowledged, else ``None``."""
        if not self._in_transaction(transaction_id).isEmpty():
            return "open"
        own = (F.col("transaction_id") == F.lit(transaction_id)) & F.col("removed")
        return None if self._events(self._state()).where(own).isEmpty() else "ended"

    # --- writing --------------------------------------------------------------------

    @_one_at_a_time
    def create(self) -> "QueueStore":
        """Create the queue if it is not there yet."""
        try:
            self._state()
        except FileNotFoundError:
            self._summarise(self.spark.createDataFrame([], QUEUE_SCHEMA), 0, self.buckets, 0)
        return self

    def _summarise(
        self, rows: DataFrame, generation: int, buckets: int, seq: int,
        sign: int = 1, writer: int | None = None, batch: int | None = None,
    ) -> None:
        """Add what a write did to ``totals``, and a row that only names the write."""
        by_hour = rows.groupBy(F.expr(f"expires div {EXPIRY_MILLIS}L").alias("expiry")).agg(
            (F.count(F.lit(1)) * sign).alias("packets"),
            (F.coalesce(F.sum("estimated_size"), F.lit(0)) * sign).alias("bytes"),
        )
        named = self.spark.range(1).selectExpr("NULL AS expiry", "0L AS packets", "0L AS bytes")
        both = by_hour.union(named).selectExpr(
            f"{generation} AS generation", f"{buckets} AS buckets", f"{seq}L AS seq",
            f"CAST({'NULL' if writer is None else writer} AS int) AS writer",
            f"CAST({'NULL' if batch is None else batch} AS bigint) AS batch",
            "expiry", "packets", "bytes",
        )
        both.coalesce(1).write.mode("append").parquet(f"{self.path}/totals")

    def _insert(self, rows: DataFrame, name: str, columns: str, state: Row) -> None:
        """Add rows to a table, a file for each bucket."""
        table = self._table(name, columns, state)
        rows.repartition(state["buckets"], "packet_id").write.insertInto(table)

    @_one_at_a_time
    def append(
        self,
        rows: DataFrame,
        *,
        order_by: Sequence[str | Column] = (),
        writer: int | None = None,
        batch: int | None = None,
    ) -> bool:
        """Add queue rows; their ids follow those of the writer's earlier batches.

        Ids rise in the order of ``order_by``, or in the order in which Spark reads the
        rows, one by one without gaps.  Without ``batch`` the writer's next number is taken.  A
        given number that is not above the writer's latest is a replay: nothing is written, and
        the result is ``False``.  Of a batch that was cut off, the rows still missing are added.
        """
        writer = self.writer if writer is None else writer
        state = self._state(writer)
        number = state["batch"] + 1 if batch is None else batch
        if number <= state["batch"]:
            return False
        base = first_id(writer, number)
        # A sort leaves partitions in order.  Rows are numbered inside their partition, and
        # the sizes of the partitions before it are added.
        ordered = rows.orderBy(*order_by) if order_by else rows
        placed = materialise(ordered.withColumn("_at", F.monotonically_increasing_id()), "append")
        part = F.shiftright("_at", 33).alias("_part")
        sizes = placed.groupBy(part).agg(F.count(F.lit(1)).alias("_size"))
        earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        offsets = sizes.select(  # one row per partition
            "_part", (F.coalesce(F.sum("_size").over(earlier), F.lit(0)) + base + 1).alias("_first")
        )
        last = base + (1 << ROW_BITS) - 1
        number_of = F.col("_first") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
        full = F.raise_error(F.lit("too many rows for one batch")).cast("bigint")
        numbered = placed.withColumn("_part", part).join(offsets, "_part")
        numbered = numbered.withColumn(
            "packet_id", F.when(number_of <= last, number_of).otherwise(full)
        ).select(*QUEUE_COLUMNS)
        mine = F.col("packet_id").between(base + 1, last)
        there = self._packets(state).where(mine).select("packet_id")
        if not there.isEmpty():
            numbered = numbered.join(there, "packet_id", "left_anti")
        self._insert(numbered.select(*QUEUE_COLUMNS), "packets", PACKETS, state)
        added = self._packets(state).where(mine)
        self._summarise(
            added, state["generation"], state["buckets"], state["seq"], 1, writer, number
        )
        return True

    def _change(self, rows: DataFrame, transaction_id: str | None, removed: bool) -> int:
        """Record an event for every row; gives their number."""
        state = self._state()
        changed = materialise(rows.select(*CHANGED), "changed")
        count = changed.count()
        if count:
            seq = max(state["seq"] + 1, time.time_ns())  # later than one that was cut off
            events = changed.select(
                "packet_id",
                F.lit(transaction_id).cast("string").alias("transaction_id"),
                F.lit(removed).alias("removed"),
                F.lit(seq).cast("bigint").alias("seq"),
            )
            self._insert(events, "events", EVENTS, state)
            gone = changed if removed else changed.limit(0)
            self._summarise(gone, state["generation"], state["buckets"], seq, -1)
        return count

    @_one_at_a_time
    def assign(
        self, transaction_id: str, count_limit: int | None, byte_limit: int | None, **search
    ) -> int:
        """Give the next batch to a transaction; the number of packets in it."""
        chosen = Q.batch(self.queue(), count_limit, byte_limit, **search)
        return self._change(chosen, transaction_id, False)

    @_one_at_a_time
    def acknowledge(self, transaction_id: str) -> int:
        return self._change(self._in_transaction(transaction_id), transaction_id, True)

    @_one_at_a_time
    def release(self, transaction_id: str) -> int:
        return self._change(self._in_transaction(transaction_id), None, False)

    @_one_at_a_time
    def clean_up(self, config: QueueConfig, now_ms: int, **search) -> int:
        """Age off and trim; the number of packets removed."""
        low, packets, size = (
            self.live().agg(F.min("expiry"), F.sum("packets"), F.sum("bytes")).first()
        )
        young = low is None or now_ms <= low * EXPIRY_MILLIS
        few = config.max_packets is None or (packets or 0) <= config.max_packets
        if young and few and (config.max_bytes is None or (size or 0) <= config.max_bytes):
            return 0
        return self._change(Q.cleaned_away(self.queue(), config, now_ms, **search), None, True)

    @_one_at_a_time
    def compact(self) -> None:
        """Write the queue as it stands as a new generation, with exact totals.

        Reads then skip what came before.  Ids, batch numbers and ended transactions stay known.
        """
        state = self._state()
        after = Row(generation=state["generation"] + 1, buckets=state["buckets"])
        self._insert(self.queue(), "packets", PACKETS, after)
        ended = self._events(state).where("removed AND transaction_id IS NOT NULL")
        ended = ended.groupBy("transaction_id").agg(F.max("seq").alias("seq"))
        ended = ended.selectExpr("-1L AS packet_id", "transaction_id", "true AS removed", "seq")
        self._insert(ended, "events", EVENTS, after)
        self._summarise(
            self._packets(after), after["generation"], after["buckets"], state["seq"]
        )


def _with_latest(rows: DataFrame, events: DataFrame) -> DataFrame:
    """Packets that no event removed, with their latest transaction."""
    latest = events.groupBy("packet_id").agg(
        F.max_by(F.struct("transaction_id", "removed"), "seq").alias("event")
    )
    here = rows.join(latest, "packet_id", "left").where(
        "event IS NULL OR NOT event.removed"
    )
    own = F.when(F.col("event").isNull(), F.col("transaction_id")).otherwise(
        F.col("event.transaction_id")
    )
    return here.withColumn("transaction_id", own).select(*QUEUE_COLUMNS)
