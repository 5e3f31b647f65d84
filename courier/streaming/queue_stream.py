"""Continuous enqueue and processing.

Micro-batches go through ``foreachBatch``; a replayed batch is recognised by its number
and not enqueued again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle

from courier.functions.packets import reference_millis
from courier.plans.service import Deliver, QueueService
from courier.schema import REFERENCE_EPOCH_MILLIS


def enqueue_stream(
    packets: DataFrame,
    service: QueueService,
    *,
    writer: int,
    now: Callable[[], int],
    checkpoint: str,
    created: Column | None = None,
    status_path: str | None = None,
    clean_up: bool = True,
) -> DataStreamWriter:
    """Enqueue a stream of packets.  Set a trigger and start it.

    ``writer`` is the stream's own writer number, under which its micro-batches are numbered.
    Each micro-batch is appended once, then the queue is cleaned up, which also ages off
    packets whose time is over.  With ``status_path`` the status after each micro-batch is
    appended there.
    """

    def enqueue(batch: DataFrame, number: int) -> None:
        status = service.enqueue(
            batch, now(), created=created, writer=writer, batch=number, clean_up=clean_up
        )
        if status_path is not None:
            append_status(status, number, status_path)

    return packets.writeStream.foreachBatch(enqueue).option("checkpointLocation", checkpoint)


def process_stream(
    ticks: DataFrame,
    service: QueueService,
    deliver: Deliver,
    *,
    transaction_id: Callable[[int], str],
    now: Callable[[], int],
    checkpoint: str,
    status_path: str | None = None,
) -> DataStreamWriter:
    """Clean up and send the next batch at every micro-batch of ``ticks``.

    ``ticks`` may be any stream, such as the rate source with
    ``trigger(processingTime="5 seconds")``.
    """

    def process(_: DataFrame, number: int) -> None:
        status = service.process(now(), transaction_id(number), deliver)
        if status_path is not None:
            append_status(status, number, status_path)

    return ticks.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)


def append_status(status: DataFrame, number: int, path: str) -> None:
    """Write the status of a micro-batch; a replay takes the place of the first write."""
    status.coalesce(1).write.mode("overwrite").parquet(f"{path}/batch={number}")


def live_packets(rows: DataFrame, now_ms: Column | int | None = None) -> DataFrame:
    """A stream of queue rows without those expired when their micro-batch runs."""
    if now_ms is None:
        now_ms = reference_millis(F.current_timestamp())
    now = F.lit(now_ms) if isinstance(now_ms, int) else now_ms
    return rows.where(F.col("expires").isNull() | (F.col("expires") >= now))


_EXPIRED = "packet_id bigint, priority string, expires bigint"
#: One chunk of a bucket: the packets that one micro-batch added to it.
_WAITING = "packet_id array<bigint>, priority array<string>, expires array<bigint>"
#: Where ``transformWithState`` keeps its state.
_STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
HOUR_MILLIS = 3_600_000


class _Expiry(StatefulProcessor):
    """The packets of one shard whose expiry lies in one bucket, in chunks of arrays.

    The bucket's one timer is set to its earliest expiry.  When it fires, the packets that
    are over come out and the rest stay, under a timer for the next.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._waiting = handle.getListState("waiting", _WAITING)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        arrived = pd.concat(list(rows), ignore_index=True)[["packet_id", "priority", "expires"]]
        yield from self._split(arrived, timerValues, self._waiting.appendValue)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        chunks = [pd.DataFrame(dict(zip(_Expiry._COLUMNS, map(list, c)))) for c in self._waiting.get()]
        if not chunks:
            return
        self._waiting.clear()
        yield from self._split(
            pd.concat(chunks, ignore_index=True), timerValues, self._waiting.appendValue
        )

    _COLUMNS = ("packet_id", "priority", "expires")

    def _split(self, packets: pd.DataFrame, timers, keep) -> Iterator[pd.DataFrame]:
        clock = timers.getCurrentWatermarkInMs() - REFERENCE_EPOCH_MILLIS
        over = packets["expires"] < clock
        waits = packets[~over]
        if len(waits):
            keep(tuple(waits[c].astype(object).tolist() for c in self._COLUMNS))
            self._handle.registerTimer(int(waits["expires"].min()) + REFERENCE_EPOCH_MILLIS + 1)
        if over.any():
            yield packets[over]

    def close(self) -> None:
        pass


def expired_packets(
    rows: DataFrame,
    delay: str = "0 seconds",
    *,
    bucket_millis: int = HOUR_MILLIS,
    shards: int = 8,
) -> DataFrame:
    """Packets of a stream of queue rows, each once its time is over.

    The clock is the latest enqueue time seen, less ``delay``.  A packet waits as state until
    the clock passes its expiry, together with the packets of its shard that expire in the
    same ``bucket_millis``: there is one state and one timer for each shard and bucket, so
    wide buckets make few of them and ``shards`` keep one bucket from being one task's work.
    A packet that is over when it arrives, because it is late or because its life is zero or
    negative, comes out at once; so every row with an expiry comes out exactly once, rows that
    repeat an id too.  Packets without an expiry never do.  Use append mode.

    State is kept in RocksDB, which the session is set to.
    """
    rows.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", _STATE_STORE)
    clocked = (
        rows.where(F.col("expires").isNotNull())
        .withColumn(
            "created_at",
            F.timestamp_millis(
                F.coalesce("created", F.lit(-REFERENCE_EPOCH_MILLIS)) + F.lit(REFERENCE_EPOCH_MILLIS)
            ),
        )
        .withWatermark("created_at", delay)
    )
    # Only the clock is wanted.  Rows go on without their event time, so none counts as late.
    timely = clocked.select(
        "packet_id",
        F.col("priority").cast("string"),  # pandas would make numbers with nulls inexact
        "expires",
        F.expr(f"expires div {bucket_millis}L").alias("bucket"),
        F.pmod(F.xxhash64("packet_id"), F.lit(shards)).alias("shard"),
    )
    expired = timely.groupBy("bucket", "shard").transformWithStateInPandas(
        _Expiry(), _EXPIRED, "append", "EventTime"
    )
    return expired.withColumn("priority", F.col("priority").cast("bigint"))
