"""One global order without a one-task window.

Two tools:

``find_cut`` answers "how far does the order run until N rows or B bytes are reached?"
with the key of the last row inside.  A batch or a trim is then a plain filter on that
key.  Only grouped counts travel: each round splits the range that holds the answer
into bins, and goes into the one bin where the limit is crossed.  Nothing is sorted or
shuffled but the last few thousand rows, and payloads are not read.

``running_totals`` numbers every row of every group and gives it a running sum: range
partitions cut into pieces, one total per piece, then a window inside each piece.  A group
may span any number of pieces, so one that holds a third of all rows is split.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courier.sources.scratch import materialise

SEND_ORDER = ("priority", "created", "packet_id")

#: Rows up to which a range is searched with one sorted window.
FINISH_ROWS = 250_000
#: Row limit up to which a top-N is cheaper than searching: every task hands over at
#: most this many slim rows.
TAKE_ROWS = 200
#: Bins per search round, which is also the number of rows a round brings back.
BINS = 1024
#: Rows of a piece of a range partition in ``running_totals``.
CHUNK_ROWS = 1_000_000
#: Range partitions in ``running_totals``, as a multiple of the shuffle partitions, at most.
RANGES_PER_SHUFFLE = 4


def send_order(columns: Sequence[str] = SEND_ORDER) -> list[Column]:
    """Lowest priority value first, then oldest, then lowest id; nulls first."""
    return [F.col(c).asc_nulls_first() for c in columns]


# --- cut points ----------------------------------------------------------------


@dataclass(frozen=True)
class Cut:
    """The key of the last row inside a limit."""

    columns: tuple[str, ...]
    key: tuple

    def inside(self) -> Column:
        """Rows up to and including the cut, nulls first."""
        condition = None
        for name, value in reversed(list(zip(self.columns, self.key))):
            col = F.col(name)
            if value is None:
                before, same = F.lit(False), col.isNull()
            else:
                before, same = col.isNull() | (col < F.lit(value)), col == F.lit(value)
            condition = before | (same if condition is None else same & condition)
        # The leading column alone bounds the scan, so state it for file pruning.
        first, value = F.col(self.columns[0]), self.key[0]
        bound = first.isNull() if value is None else first.isNull() | (first <= F.lit(value))
        return bound & condition


def find_cut(
    df: DataFrame,
    *,
    rows: int | None = None,
    size: int | None = None,
    order: Sequence[str] = SEND_ORDER,
    size_column: str = "estimated_size",
    only_if_over: bool = False,
    finish_rows: int = FINISH_ROWS,
    take_rows: int = TAKE_ROWS,
    bins: int = BINS,
) -> Cut | None:
    """The first row, in order, at which ``rows`` rows or ``size`` bytes are reached.

    ``None`` when the whole input stays below both limits; with ``only_if_over`` also when
    it comes to exactly ``size`` bytes.  A null size counts as 0.
    The order columns are integers; the last one should be unique, otherwise rows that
    tie on all of them are taken together.
    """
    if rows is None and size is None:
        return None
    if rows is not None and rows < 1:
        raise ValueError("a row limit must be at least 1")
    order = tuple(order)
    slim = df.select(*order, F.coalesce(F.col(size_column), F.lit(0)).cast("bigint").alias("_size"))

    if rows is not None and rows <= take_rows and not only_if_over:
        head = slim.orderBy(*send_order(order)).limit(rows)
        return _search_rows(head, order, rows, size, 0, 0)

    span = slim.agg(*_span(order, 0)).first().asDict()
    if only_if_over and span["b"] <= size:
        return None
    seen_rows = seen_size = 0
    depth, scope = 0, F.lit(True)
    while span["n"]:
        reached_rows = rows is not None and seen_rows + span["n"] >= rows
        reached_size = size is not None and seen_size + span["b"] >= size
        if not (reached_rows or reached_size):
            return None
        if span["n"] <= finish_rows:
            return _search_rows(slim.where(scope), order, rows, size, seen_rows, seen_size)
        while depth < len(order) and _single(span, depth):
            depth += 1
        if depth == len(order):
            return Cut(order, tuple(span[f"lo{i}"] for i in range(depth)))

        name = order[depth]
        found = (
            slim.where(scope)
            .groupBy(_bin(name, span[f"lo{depth}"], span[f"hi{depth}"], bins).alias("bin"))
            .agg(*_span(order, depth))
            .orderBy("bin")
            .collect()  # at most `bins` + 1 rows
        )
        for row in found:
            crosses = (rows is not None and seen_rows + row["n"] >= rows) or (
                size is not None and seen_size + row["b"] >= size
            )
            if crosses:
                break
            seen_rows += row["n"]
            seen_size += row["b"]
        else:
            raise RuntimeError("the input changed while it was searched")
        span = {**span, **row.asDict()}
        if span[f"hi{depth}"] is None:
            scope = scope & F.col(name).isNull()
        else:
            scope = scope & F.col(name).between(span[f"lo{depth}"], span[f"hi{depth}"])
    return None


def _span(order: tuple[str, ...], start: int) -> list[Column]:
    stats = [F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("_size"), F.lit(0)).alias("b")]
    for i in range(start, len(order)):
        col = F.col(order[i])
        stats += [
            F.min(col).alias(f"lo{i}"),
            F.max(col).alias(f"hi{i}"),
            F.count_if(col.isNull()).alias(f"nulls{i}"),
        ]
    return stats


def _bin(name: str, lo: int, hi: int, bins: int) -> Column:
    """Equal-width bin of an integer column in [lo, hi]; nulls, which go first, are -1."""
    width = max(1, math.ceil((hi - lo + 1) / bins))
    if hi - lo < 2**62:
        place = F.expr(f"(`{name}` - CAST('{lo}' AS BIGINT)) div {width}L")
    else:  # the difference may not fit a long
        place = F.floor((F.col(name).cast("decimal(20,0)") - F.lit(lo)) / F.lit(width))
    return F.coalesce(place.cast("bigint"), F.lit(-1).cast("bigint"))


def _single(span: dict, i: int) -> bool:
    """Does the range hold one value of column ``i``?"""
    if span[f"nulls{i}"]:
        return span[f"lo{i}"] is None
    return span[f"lo{i}"] == span[f"hi{i}"]


def _search_rows(rows_df, order, rows, size, seen_rows, seen_size) -> Cut | None:
    """Exact search among a bounded number of rows (``finish_rows`` or ``take_rows``)."""
    upto = Window.orderBy(*send_order(order)).rowsBetween(Window.unboundedPreceding, 0)
    reached = F.lit(False)
    if rows is not None:
        reached = reached | (F.col("_rows") >= rows - seen_rows)
    if size is not None:
        reached = reached | (F.col("_bytes") >= size - seen_size)
    hit = (
        rows_df.withColumn("_rows", F.count(F.lit(1)).over(upto))
        .withColumn("_bytes", F.sum("_size").over(upto))
        .where(reached)
        .orderBy("_rows")
        .select(*order)
        .first()
    )
    return None if hit is None else Cut(tuple(order), tuple(hit))


def send_key(key: tuple) -> tuple:
    """A key that Python compares the way the order does, nulls first."""
    return tuple((value is not None, 0 if value is None else value) for value in key)


# --- running totals ------------------------------------------------------------


def running_totals(
    df: DataFrame,
    *,
    group: Sequence[str] = (),
    order: Sequence[str] = SEND_ORDER,
    total: str | None = None,
    reverse: bool = False,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Rows with ``row_number`` (from 1) and ``running_total`` inside their group.

    ``running_total`` includes the row itself.  With ``reverse`` the order runs backwards.
    Rows go into a bounded number of range partitions, each of which is cut into pieces of
    ``chunk_rows``; ``chunk`` numbers the pieces in order, with gaps.  Pass slim rows: they are
    written once when they do not fit one piece.
    """
    group, order = tuple(group), tuple(order)
    keys = [F.col(c).asc_nulls_first() for c in group] + [
        F.col(c).desc_nulls_last() if reverse else F.col(c).asc_nulls_first() for c in order
    ]
    value = F.lit(0) if total is None else F.coalesce(F.col(total), F.lit(0))
    rows = df.withColumn("_value", value.cast("bigint"))
    total_rows = rows.count()
    if total_rows <= chunk_rows:  # few rows in all, so no group can be large
        carried = (
            rows.withColumn("chunk", F.lit(0))
            .withColumn("_rows0", F.lit(0))
            .withColumn("_sum0", F.lit(0))
        )
    else:
        # A chunk continues at most one group of an earlier one: its first.  So the carried
        # totals are one row per chunk, found from per-chunk summaries.
        most = RANGES_PER_SHUFFLE * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        ranges = min(math.ceil(total_rows / chunk_rows), most)
        at = F.monotonically_increasing_id()
        piece = F.expr(f"cast((_at & {(1 << 33) - 1}L) div {int(chunk_rows)} as int)")
        pieces = math.ceil(total_rows / chunk_rows)  # no partition has more
        placed = materialise(
            rows.repartitionByRange(ranges, *keys)
            .sortWithinPartitions(*keys)
            .withColumn("_at", at)
            .withColumn("chunk", (F.spark_partition_id() * pieces + piece).cast("int"))
            .drop("_at"),
            "ordered",
        )
        carried = placed.join(_carry(placed, group), ["chunk"], "left")
        same = F.lit(True)
        for c in group:
            same = same & F.col(c).eqNullSafe(F.col(f"_first_{c}"))
        carried = carried.withColumn(
            "_rows0", F.when(same, F.coalesce("_rows0", F.lit(0))).otherwise(0)
        ).withColumn("_sum0", F.when(same, F.coalesce("_sum0", F.lit(0))).otherwise(0))
    inside = (
        Window.partitionBy("chunk", *group)
        .orderBy(*keys[len(group):])
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        carried.withColumn("row_number", F.count(F.lit(1)).over(inside) + F.col("_rows0"))
        .withColumn("running_total", F.sum("_value").over(inside) + F.col("_sum0"))
        .select(*df.columns, "chunk", "row_number", "running_total")
    )


def _carry(placed: DataFrame, group: tuple[str, ...]) -> DataFrame:
    """Per chunk: its first group, and that group's rows and sum in earlier chunks."""
    if not group:
        totals = placed.groupBy("chunk").agg(
            F.count(F.lit(1)).alias("_n"), F.sum("_value").alias("_s")
        )
        earlier = Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
        return totals.select(
            "chunk",
            F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_rows0"),
            F.coalesce(F.sum("_s").over(earlier), F.lit(0)).alias("_sum0"),
        )
    # First and last group of each chunk: groups seen in two chunks are among these.
    ends = placed.groupBy("chunk").agg(
        F.min(F.struct(*group)).alias("_min"), F.max(F.struct(*group)).alias("_max")
    )
    firsts = ends.select("chunk", F.col("_min").alias("_g"))
    lasts = ends.select("chunk", F.col("_max").alias("_g"))
    edges = firsts.unionByName(lasts).distinct()
    on_edge = placed.join(
        edges.withColumnRenamed("chunk", "_edge_chunk"),
        (F.col("chunk") == F.col("_edge_chunk")) & F.struct(*group).eqNullSafe(F.col("_g")),
    )
    totals = on_edge.groupBy("chunk", "_g").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("_value").alias("_s")
    )
    earlier = (
        Window.partitionBy("_g").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = totals.select(
        "chunk",
        "_g",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_rows0"),
        F.coalesce(F.sum("_s").over(earlier), F.lit(0)).alias("_sum0"),
    )
    return carried.join(firsts, ["chunk", "_g"]).select(
        "chunk", "_rows0", "_sum0", *[F.col(f"_g.{c}").alias(f"_first_{c}") for c in group]
    )
