"""The queue's cycles: enqueue, process, clean up.

Each cycle ends with the queue's status; one that fails raises instead.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courier.config import QueueConfig
from courier.functions.packets import to_queue_rows
from courier.operators import queue as Q
from courier.sources.files import deliver_to_folder
from courier.sources.store import QueueStore

#: Takes the batch in send order and its transaction id, gives the final state.
Deliver = Callable[[DataFrame, str], str]


class DeliveryFailed(RuntimeError):
    """The transaction did not complete; its packets are free to be sent again."""


class QueueService:
    def __init__(self, store: QueueStore, config: QueueConfig | None = None) -> None:
        self.store = store
        self.config = config or QueueConfig()

    def status(self) -> DataFrame:
        return self.store.status(self.config)

    def enqueue(
        self,
        packets: DataFrame,
        now_ms: int,
        *,
        created: Column | int | None = None,
        order_by: Sequence[str | Column] = (),
        writer: int | None = None,
        batch: int | None = None,
        clean_up: bool = True,
    ) -> DataFrame:
        """Append packets, clean up, report.  ``created`` defaults to ``now_ms``.

        ``writer`` and ``batch`` number the append, see ``QueueStore.append``.  A clean-up that
        has something to do reads the queue's sort columns; where appends are frequent and the
        queue is large, leave it out and run ``clean_up`` at a slower pace.
        """
        ordered = packets.orderBy(*order_by) if order_by else packets
        rows = to_queue_rows(
            ordered,
            created=now_ms if created is None else created,
            packet_id=F.lit(0),
            prioritizer=self.config.prioritizer,
        )
        self.store.append(rows, writer=writer, batch=batch)
        return self.clean_up(now_ms) if clean_up else self.status()

    def clean_up(self, now_ms: int) -> DataFrame:
        self.store.clean_up(self.config, now_ms)
        return self.status()

    def process(self, now_ms: int, transaction_id: str, deliver: Deliver) -> DataFrame:
        """Clean up, send the next batch, acknowledge or release it, report.

        An empty queue sends nothing.  A transaction id used before takes no new batch:
        what it still holds is sent again, and once acknowledged nothing is.  Only a completed
        transaction is acknowledged: any other state, and any error, frees its packets and raises.
        """
        kind = self.store.transaction_kind(transaction_id)
        if kind == "ended":
            return self.status()
        self.store.clean_up(self.config, now_ms)
        if not Q.has_packets(self.store.live()):
            return self.status()
        taken = kind == "open" or self.store.assign(
            transaction_id, self.config.batch_packets, self.config.batch_bytes
        )
        if taken:
            try:
                state = deliver(self.store.packets(transaction_id), transaction_id)
            except Exception:
                self.store.release(transaction_id)
                raise
            if state != "TRANSACTION_COMPLETED":
                self.store.release(transaction_id)
                raise DeliveryFailed(f"{transaction_id} ended as {state}")
            self.store.acknowledge(transaction_id)
        return self.status()


def folder_delivery(path: str) -> Deliver:
    """Delivery into a folder: frames, and a manifest per transaction."""

    def deliver(batch: DataFrame, transaction_id: str) -> str:
        deliver_to_folder(batch, path)
        return "TRANSACTION_COMPLETED"

    return deliver
