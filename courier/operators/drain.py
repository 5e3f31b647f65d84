"""Which batch will each queued packet leave in?

Byte-limited batches restart after the packet that reaches the limit, so a batch starts
where the one before it ended.  That chain is followed without passing the queue through
one task:

1. every row gets its global position and running bytes (``running_totals``);
2. each range partition works out, for every place a batch arriving from earlier
   partitions could end in it, where the chain leaves the partition; neighbouring places
   that leave alike are merged, so a partition reports a few short rows;
3. the reports of ``fan`` neighbouring partitions are combined into one, those again, and so
   on up to a single report; going back down, the place where the chain enters is worked out
   for each group and then for each partition in it, ``fan`` of them per task;
4. each partition numbers its batches from there.

A report has a row per place only as long as places leave unlike each other; with the usual
limits a partition of a million rows reports at most a hundred, and combining keeps reports
about as short, since chains that meet never part again.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courier.operators.order import CHUNK_ROWS, SEND_ORDER, running_totals
from courier.operators.queue import unassigned
from courier.sources.scratch import materialise

#: Neighbouring reports that one task combines.
FAN = 64

_FIELDS = ["chunk", "place", "last_row", "last_byte", "open_row", "open_byte", "batches"]
_REPORT = "chunk int, " + ", ".join(f"{f} bigint" for f in _FIELDS[1:])
_ENTRY = "chunk int, open_row bigint, open_byte bigint, done bigint"
_NO_LIMIT = np.iinfo(np.int64).max // 4


def drain_plan(
    queue: DataFrame,
    count_limit: int | None,
    byte_limit: int | None = None,
    *,
    chunk_rows: int = CHUNK_ROWS,
    fan: int = FAN,
) -> DataFrame:
    """``packet_id, send_position, running_bytes, batch`` of every unassigned packet.

    Repeating "take the next batch" until the queue is empty gives the same batches,
    numbered from 1.  A limit of 0 or ``None`` is off; with both off there is one batch.
    """
    slim = unassigned(queue).select(
        *SEND_ORDER, F.coalesce("estimated_size", F.lit(0)).alias("size")
    )
    placed = running_totals(slim, total="size", chunk_rows=chunk_rows).select(
        "packet_id",
        "chunk",
        "size",
        F.col("row_number").alias("send_position"),
        F.col("running_total").alias("running_bytes"),
    )
    if not byte_limit:
        number = (
            F.expr(f"(send_position - 1) div {int(count_limit)} + 1")
            if count_limit
            else F.lit(1).cast("bigint")
        )
        return placed.select(
            "packet_id", "send_position", "running_bytes", number.alias("batch")
        )

    limits = (count_limit or _NO_LIMIT, byte_limit)
    placed = materialise(placed, "drain")
    reports = materialise(
        placed.groupBy("chunk").applyInPandas(lambda rows: _report(rows, *limits), _REPORT),
        "drain-reports",
    )
    entries = _entries(reports, fan, *limits)
    return (
        placed.join(entries, "chunk")
        .groupBy("chunk")
        .applyInPandas(
            lambda rows: _number(rows, *limits),
            "packet_id bigint, send_position bigint, running_bytes bigint, batch bigint",
        )
    )


def _entries(reports: DataFrame, fan: int, count_limit: int, byte_limit: int) -> DataFrame:
    """Per chunk: the batch open on entry, and how many batches ended before it."""
    group = F.expr(f"cast(chunk div {int(fan)} as int)").alias("group")
    levels = [reports]
    while (levels[-1].agg(F.max("chunk")).first()[0] or 0) > 0:
        grouped = levels[-1].withColumn("group", group)
        combined = grouped.groupBy("group").applyInPandas(
            lambda found: _combined(found, count_limit, byte_limit), _REPORT
        )
        levels.append(materialise(combined, "drain-reports"))
    spark = reports.sparkSession
    entries = spark.range(1).selectExpr(
        "cast(0 as int) AS chunk", "1L AS open_row", "0L AS open_byte", "0L AS done"
    )
    for level in reversed(levels[:-1]):
        given = entries.select(
            F.col("chunk").alias("group"),
            F.col("open_row").alias("in_row"),
            F.col("open_byte").alias("in_byte"),
            F.col("done").alias("in_done"),
        )
        walked = (
            level.withColumn("group", group)
            .join(given, "group")
            .groupBy("group")
            .applyInPandas(lambda found: _walk(found, count_limit, byte_limit), _ENTRY)
        )
        entries = materialise(walked, "drain-entries")
    return entries


def _ends(rows: pd.DataFrame, count_limit: int, byte_limit: int):
    """Sorted positions and bytes of a chunk, and where a batch starting at each row ends.

    ``ends[i]`` is the index of the last row of that batch, or the chunk's length when
    the batch is still open at the end of the chunk.
    """
    rows = rows.sort_values("send_position")
    position = rows["send_position"].to_numpy(np.int64)
    upto = rows["running_bytes"].to_numpy(np.int64)
    before = upto - rows["size"].to_numpy(np.int64)
    by_bytes = np.searchsorted(upto, before + byte_limit, side="left")
    by_count = np.arange(len(rows), dtype=np.int64) + (count_limit - 1)
    return rows, position, upto, np.minimum(np.minimum(by_bytes, by_count), len(rows))


def _report(rows: pd.DataFrame, count_limit: int, byte_limit: int) -> pd.DataFrame:
    """How a chain of batches can pass through this chunk.

    The row with ``place`` 0 is for a batch that starts with the chunk.  Each other row
    stands for a run of places where a batch open on entry may end: up to row
    ``last_row``, at which ``last_byte`` bytes are queued.  ``open_row`` and ``open_byte``
    describe the batch then open at the end of the chunk, ``batches`` counts those ended.
    """
    rows, position, upto, ends = _ends(rows, count_limit, byte_limit)
    n = len(rows)
    before = upto - rows["size"].to_numpy(np.int64)
    # Index n stands for a batch that starts with the next chunk.  Each start leads to the
    # start after its batch; the last one leads to itself.  Doubling finds it for all.
    after = np.r_[ends + 1, n]
    leads = np.where(after <= n, after, np.arange(n + 1))
    batches = (leads != np.arange(n + 1)).astype(np.int64)
    while True:
        further = leads[leads]
        if (further == leads).all():
            break
        batches = batches + batches[leads]
        leads = further
    open_row = np.r_[position, position[-1] + 1][leads]
    open_byte = np.r_[before, upto[-1]][leads]
    # A batch open on entry began earlier, so it ends within these first rows.
    window = int(np.searchsorted(upto, before[0] + byte_limit, side="left")) + 1
    window = min(n, window, count_limit)
    found = pd.DataFrame(
        {
            "place": np.arange(1, window + 1),
            "last_row": position[:window],
            "last_byte": upto[:window],
            "open_row": open_row[1 : window + 1],
            "open_byte": open_byte[1 : window + 1],
            "batches": batches[1 : window + 1] + 1,
        }
    )
    if count_limit == _NO_LIMIT:  # an empty packet never reaches a byte limit
        found = found[upto[:window] > before[:window]]
    found = _merged(found)
    start = pd.DataFrame(
        {
            "place": [0],
            "last_row": position[:1],
            "last_byte": before[:1],
            "open_row": open_row[:1],
            "open_byte": open_byte[:1],
            "batches": batches[:1],
        }
    )
    return pd.concat([start, found], ignore_index=True).assign(chunk=rows["chunk"].iloc[0])[_FIELDS]


def _merged(found: pd.DataFrame) -> pd.DataFrame:
    """Neighbouring places that leave alike, as one row: the last."""
    alike = found[["open_row", "batches"]]
    return found[~(alike == alike.shift(-1)).all(axis=1)]


def _passed(report: pd.DataFrame, row, byte, count_limit: int, byte_limit: int):
    """How chains whose batch opened at ``row`` and ``byte`` leave a chunk; and batches ended.

    The first row of ``report`` is for a batch that starts with it.
    """
    last_row, last_byte, out_row, out_byte, ended = (
        report[f].to_numpy(np.int64)
        for f in ("last_row", "last_byte", "open_row", "open_byte", "batches")
    )
    row, byte = np.asarray(row, np.int64), np.asarray(byte, np.int64)
    by_bytes = np.searchsorted(last_byte[1:], byte + byte_limit, "left")
    by_count = np.searchsorted(last_row[1:], row - 1 + count_limit, "left")
    at = np.where(row == last_row[0], 0, 1 + np.minimum(by_bytes, by_count))
    stays = at == len(report)  # still open after it
    at = np.where(stays, 0, at)
    return (
        np.where(stays, row, out_row[at]),
        np.where(stays, byte, out_byte[at]),
        np.where(stays, 0, ended[at]),
    )


def _combined(found: pd.DataFrame, count_limit: int, byte_limit: int) -> pd.DataFrame:
    """One report for a group of neighbouring chunks, from theirs."""
    group = int(found["group"].iloc[0])
    parts = [p for _, p in found.sort_values(["chunk", "place"]).groupby("chunk")]
    whole = parts[0][_FIELDS].reset_index(drop=True)
    for part in parts[1:]:
        row, byte, ended = _passed(
            part, whole["open_row"], whole["open_byte"], count_limit, byte_limit
        )
        whole = whole.assign(open_row=row, open_byte=byte, batches=whole["batches"] + ended)
        rows = int(part["last_row"].iloc[0]) - int(whole["last_row"].iloc[0])
        size = int(part["last_byte"].iloc[0]) - int(whole["last_byte"].iloc[0])
        places = [whole.iloc[1:]]
        if rows < count_limit and size < byte_limit:  # a batch may reach across all so far
            places.append(part[_FIELDS].iloc[1:])
        whole = pd.concat([whole.iloc[:1], _merged(pd.concat(places, ignore_index=True))])
    return whole.assign(chunk=group, place=np.arange(len(whole)))[_FIELDS]


def _walk(found: pd.DataFrame, count_limit: int, byte_limit: int) -> pd.DataFrame:
    """The entries of neighbouring chunks, from the entry into the first of them."""
    row, byte, done = (int(found[f].iloc[0]) for f in ("in_row", "in_byte", "in_done"))
    entries = []
    for chunk, report in found.sort_values(["chunk", "place"]).groupby("chunk"):
        entries.append((chunk, row, byte, done))
        out_row, out_byte, ended = _passed(report, [row], [byte], count_limit, byte_limit)
        row, byte, done = int(out_row[0]), int(out_byte[0]), done + int(ended[0])
    return pd.DataFrame(entries, columns=["chunk", "open_row", "open_byte", "done"])


def _number(rows: pd.DataFrame, count_limit: int, byte_limit: int) -> pd.DataFrame:
    rows, position, upto, ends = _ends(rows, count_limit, byte_limit)
    n = len(rows)
    open_row, open_byte = int(rows["open_row"].iloc[0]), int(rows["open_byte"].iloc[0])
    batch = np.empty(n, np.int64)
    number = int(rows["done"].iloc[0]) + 1
    start = 0
    if open_row < position[0]:  # finish the batch that came in
        by_bytes = int(np.searchsorted(upto, open_byte + byte_limit, side="left"))
        by_count = open_row - 1 + count_limit - position[0]
        start = min(by_bytes, by_count, n - 1) + 1
        batch[:start] = number
        number += 1
    while start < n:
        stop = min(int(ends[start]) + 1, n)
        batch[start:stop] = number
        number += 1
        start = stop
    return pd.DataFrame(
        {
            "packet_id": rows["packet_id"],
            "send_position": position,
            "running_bytes": upto,
            "batch": batch,
        }
    )
