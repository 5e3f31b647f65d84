"""What each transaction sends: frames, a manifest and its checksum check.

A manifest needs the checksum of all frames of a transaction in send order.  Frames are
not brought together for it.  Each packet's frame is checksummed where it is read; only
the checksum, the length and the sort key travel, and they are combined first inside sorted
partitions, then over them.  A transaction of any size spreads over as many tasks as it needs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courier.functions.frames import (
    MARKER_CRC,
    SOCKET_MARKER,
    frame,
    shift_checksum,
    shift_checksums,
)
from courier.functions.packets import parse_attributes
from courier.operators.order import SEND_ORDER, send_order
from courier.schema import BAD_CHECKSUM, CONFIRM_TRANSACTION
from courier.sources.scratch import materialise


def in_flight(queue: DataFrame) -> DataFrame:
    return queue.where(F.col("transaction_id").isNotNull())


def _parsed(queue: DataFrame) -> DataFrame:
    """Packets in flight with their attribute map, parsed once for all its uses."""
    return in_flight(queue).select(
        "transaction_id",
        *SEND_ORDER,
        parse_attributes(F.col("attributes")).alias("attributes"),
        "content",
    )


def unreadable(attributes: Column) -> Column:
    """Is the attribute text no JSON object?  Such a packet is sent without attributes."""
    return parse_attributes(attributes).isNull()


def frames(queue: DataFrame) -> DataFrame:
    """``transaction_id``, the send order columns and ``frame`` of packets in flight.

    A packet with unreadable attributes is framed with none, and with its content.
    """
    return _parsed(queue).select(
        "transaction_id",
        *SEND_ORDER,
        frame(F.col("attributes"), F.col("content")).alias("frame"),
    )


def socket_frames(queue: DataFrame) -> DataFrame:
    """``frames`` with the marker before every packet but a transaction's first."""
    first = (
        in_flight(queue)
        .groupBy("transaction_id")
        .agg(F.min(F.struct(*SEND_ORDER)).alias("first"))
        .select(F.col("first.packet_id").alias("packet_id"), F.lit(True).alias("is_first"))
    )
    marked = F.when(F.col("is_first"), F.col("frame")).otherwise(
        F.concat(F.lit(bytearray(SOCKET_MARKER)), F.col("frame"))
    )
    built = frames(queue)
    return built.join(first, "packet_id", "left").withColumn("frame", marked).select(*built.columns)


def checksums(queue: DataFrame) -> DataFrame:
    """``frames`` with each frame's ``length`` and ``crc``; only what is asked for is built."""
    return frames(queue).withColumns(
        {"length": F.octet_length("frame").cast("bigint"), "crc": F.crc32("frame")}
    )


_PART = "transaction_id string, priority bigint, created bigint, packet_id bigint, " \
    "packets bigint, bytes bigint, crc bigint"


def manifest(
    queue: DataFrame, *, socket: bool = False, partitions: int | None = None
) -> DataFrame:
    """Per transaction in flight: packets, bytes and CRC-32 of its frames in send order."""
    slim = checksums(queue).select("transaction_id", *SEND_ORDER, "length", "crc")
    # Written once, so that sampling range bounds does not build the frames again.
    return combined(materialise(slim, "checksums"), socket=socket, partitions=partitions)


def combined(
    checked: DataFrame, *, socket: bool = False, partitions: int | None = None
) -> DataFrame:
    """The manifest of written ``checked (transaction_id, priority, created, packet_id, length, crc)``.

    Length and checksum of neighbouring frames combine into those of both.  Slim rows are
    range-partitioned in send order (into ``spark.sql.shuffle.partitions`` parts unless
    ``partitions`` is given); each partition combines its part of a transaction into one row,
    and these rows, at most one for a transaction and partition, are combined in turn.
    """
    columns = ("transaction_id", *SEND_ORDER, "length", "crc")
    keys = [F.col("transaction_id"), *send_order()]
    number = [partitions] if partitions else []
    ordered = checked.select(*columns).repartitionByRange(*number, *keys).sortWithinPartitions(*keys)

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list | None = None  # the part that the next batch may go on with
        for batch in batches:
            if not batch.num_rows:
                continue
            parts = _combine_runs(batch, socket)
            if held is not None and held[0] == parts[0][0]:
                first = parts[0]
                shifted = shift_checksums(np.array([held[6]]), np.array([first[5]]))[0]
                parts[0] = [*held[:4], held[4] + first[4], held[5] + first[5], shifted ^ first[6]]
            elif held is not None:
                parts.insert(0, held)
            held = parts.pop()
            if parts:
                yield _part_rows(parts)
        if held is not None:
            yield _part_rows([held])

    parts = ordered.mapInArrow(combine, _PART)
    later = Window.partitionBy("transaction_id").orderBy(
        *[F.col(c).desc_nulls_last() for c in SEND_ORDER]
    ).rowsBetween(Window.unboundedPreceding, -1)
    after = F.coalesce(F.sum("bytes").over(later), F.lit(0))
    totals = (
        parts.withColumn("part", shift_checksum("crc", after))
        .groupBy("transaction_id")
        .agg(
            F.sum("packets").alias("packets"),
            F.sum("bytes").alias("bytes"),
            F.bit_xor("part").alias("checksum"),
        )
    )
    if socket:  # every packet was counted with a marker; the first one's is taken off
        totals = totals.withColumn("bytes", F.col("bytes") - len(SOCKET_MARKER)).withColumn(
            "checksum",
            F.col("checksum").bitwiseXOR(shift_checksum(F.lit(MARKER_CRC), F.col("bytes"))),
        )
    return totals


def _combine_runs(batch: pa.RecordBatch, socket: bool) -> list[list]:
    """One row of ``_PART`` for each transaction's run of rows in a sorted batch."""
    length = batch.column("length").to_numpy()
    crc = batch.column("crc").to_numpy()
    if socket:
        crc = shift_checksums(np.full(len(crc), MARKER_CRC), length) ^ crc
        length = length + len(SOCKET_MARKER)
    name = batch.column("transaction_id").to_pylist()
    starts = [i for i in range(len(name)) if i == 0 or name[i] != name[i - 1]]
    sizes = np.diff([*starts, len(name)])
    totals = np.add.reduceat(length, starts)
    upto = np.cumsum(length)
    after = np.repeat(upto[np.cumsum(sizes) - 1], sizes) - upto
    folded = np.bitwise_xor.reduceat(shift_checksums(crc, after), starts)
    keys = [batch.column(c) for c in SEND_ORDER]
    return [
        [name[i], *(k[i].as_py() for k in keys), int(n), int(size), int(code)]
        for i, n, size, code in zip(starts, sizes, totals, folded)
    ]


def _part_rows(parts: list[list]) -> pa.RecordBatch:
    types = [pa.string(), *[pa.int64()] * 6]
    names = ["transaction_id", *SEND_ORDER, "packets", "bytes", "crc"]
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kind) for column, kind in zip(zip(*parts), types)], names=names
    )


def check_checksums(manifests: DataFrame, acknowledged: DataFrame) -> DataFrame:
    """Compare with ``acknowledged (transaction_id, server_checksum)``, one row each.

    Gives the response code to end the transaction with: confirm, or bad checksum.  A
    transaction that nobody acknowledged, or with a null checksum, ends as bad checksum.
    """
    answers = acknowledged.select("transaction_id", "server_checksum")
    return manifests.join(answers, "transaction_id", "left").withColumn(
        "response_code",
        F.when(
            F.col("checksum") == F.col("server_checksum"), F.lit(CONFIRM_TRANSACTION)
        ).otherwise(F.lit(BAD_CHECKSUM)),
    )
