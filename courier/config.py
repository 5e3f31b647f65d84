"""Configuration objects.  Clocks and transaction ids are arguments, never read here."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

KIB = 1024
MIB = 1024 * KIB


@dataclass(frozen=True)
class Prioritizer:
    """Priority and time-to-live of a packet, as Spark expressions.

    Each is a SQL text or a ``Column`` over the packet's columns (``attributes``,
    ``content`` and whatever else the packet rows carry).  The default gives every
    packet priority 0 and one second to live; a TTL of 0 is kept when asked for.
    """

    priority: str | Column = "0"
    ttl_millis: str | Column = "1000"

    @classmethod
    def fixed_ttl(cls, seconds: float) -> "Prioritizer":
        return cls(ttl_millis=str(int(seconds * 1000.0)))

    def priority_column(self) -> Column:
        return _as_column(self.priority).cast("bigint")

    def ttl_column(self) -> Column:
        return _as_column(self.ttl_millis).cast("bigint")


@dataclass(frozen=True)
class QueueConfig:
    """Limits of a queue.  ``None`` switches a limit off.

    An explicit 0 means "no limit" for a batch, "no full check" for the status, and
    "keep nothing" (rows) or "keep the first row only" (bytes) for a trim.
    """

    max_packets: int | None = 10_000
    max_bytes: int | None = 100 * MIB
    batch_packets: int | None = 100
    batch_bytes: int | None = MIB
    prioritizer: Prioritizer = field(default_factory=Prioritizer)
    protect_in_flight: bool = False


@dataclass(frozen=True)
class ClientConfig:
    """Where packets go: input port by id or name."""

    port_id: str | None = None
    port_name: str | None = None
    timeout_seconds: float = 30.0
    peer_update_seconds: float = 0.0


def _as_column(value: str | Column) -> Column:
    return F.expr(value) if isinstance(value, str) else value
